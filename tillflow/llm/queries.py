"""The registered ``opN_<name>`` queries and their DuckDB SQL.

Each query runs its operator with production parameters over the whole table
and derives the result columns from what the operator returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ball_kmeans, cas_archive, compression, filter_audit, hash_tree, lattice_lm, minhash, mixing, ordinal,
               piece_merge, simhash_trie, threshold_topk, toxicity)
from .common import fold, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return keep


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT x, y FROM inter JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS r FROM documents
  UNION
  SELECT b.y AS node, reach.r FROM reach JOIN both_ways b ON b.x = reach.node WHERE reach.r < b.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT node, min(r) AS component_id FROM reach GROUP BY node) m ON m.node = d.doc_id
"""


@query("op1_ordinal")
def op1_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ordinal.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return found.withColumn("held_out", fold("doc_id", ordinal.HELD_OUT[0]) == ordinal.HELD_OUT[1])


@query("op4_compression")
def op4_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.judged(table(spark, sf_dir, "documents"), ["doc_id"])


@query("op3_minhash", OP3_SQL)
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


OP2_SHARDS = hash_tree.Tree.regular(5, 2, 4)


@query("op2_hash_tree")
def op2_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hash_tree.shards_of(table(spark, sf_dir, "documents"), OP2_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


OP5_SQL = """
WITH e AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op5_threshold_topk", OP5_SQL)
def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, by_row=True)


@query("op6_lattice_lm")
def op6_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.scores(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op7_counterfactual")
def op7_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return found.select("doc_id", (fold("doc_id", toxicity.HELD_OUT[0]) == toxicity.HELD_OUT[1]).alias("held_out"),
                        "score", "predicted")


@query("op8_block_mix")
def op8_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.usage(table(spark, sf_dir, "documents"))


@query("op9_piece_merge")
def op9_piece_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = piece_merge.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                              decoded="decoded", keep=["doc_id"])
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS b, sha256(h) AS s FROM p),
f AS (SELECT s, min(page_id) AS first_id FROM d WHERE b >= 100 GROUP BY s)
SELECT d.page_id, d.b AS payload_bytes, d.s AS payload_digest,
  CASE WHEN f.first_id IS NULL OR f.first_id = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON f.s = d.s
"""


@query("op10_cas_archive", OP10_SQL)
def op10_cas_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = cas_archive.store(cas_archive.records(table(spark, sf_dir, "pages")))
    found = cas_archive.read(cas_archive.restore(spark, archive))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_simhash_trie")
def op11_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))


def _op12_sql() -> str:
    """Rounds of assignment (distance and lowest index of the nearest entry of every
    part) and update, over components x of parts p of rows r."""
    near = """SELECT r, p, least_of[2] AS e, least_of[1] AS d FROM (
  SELECT r, p, min([d, e]) AS least_of FROM (
    SELECT x.r, x.p, b.e, sum((x.x - b.x) * (x.x - b.x))::BIGINT AS d
    FROM x JOIN {book} b ON b.p = x.p AND b.i = x.i GROUP BY x.r, x.p, b.e) GROUP BY r, p)"""
    ctes = ["""k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label,
    list_transform(embedding, lambda c: floor(4096 * c::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0)""", """x AS MATERIALIZED (
  SELECT r, (c - 1) // (n // 8) AS p, (c - 1) % (n // 8) AS i, x FROM (
    SELECT r, len(v) AS n, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS c FROM k))""",
            "b0 AS MATERIALIZED (SELECT p, r - 1 AS e, i, x FROM x WHERE r <= 16)"]
    for t in range(6):
        ctes += [f"a{t} AS MATERIALIZED ({near.format(book=f'b{t}')})", f"""b{t + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.i, coalesce(n.x, b.x) AS x FROM b{t} b LEFT JOIN (
    SELECT x.p, a.e, x.i, floor(sum(x.x)::DOUBLE / count(*))::BIGINT AS x
    FROM x JOIN a{t} a ON a.r = x.r AND a.p = x.p GROUP BY x.p, a.e, x.i) n ON n.p = b.p AND n.e = b.e AND n.i = b.i)"""]
    ctes += [f"a6 AS MATERIALIZED ({near.format(book='b6')})", """c AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY r)"""]
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) FROM b6) AS codebooks_sha256
FROM c JOIN k USING (r)"""


@query("op12_ball_kmeans", _op12_sql())
def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_kmeans.compressed(table(spark, sf_dir, "embeddings"))


OP13_SQL = r"""
WITH t AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT text, min(doc_id) AS first_id FROM t GROUP BY text),
m AS MATERIALIZED (
  SELECT part, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 3 * length(w.text))::INT
    + 8 * regexp_matches(w.text, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > f.first_id, false)::INT AS mask,
    count(*) AS n, count(*) FILTER (l.good) AS good, count(*) FILTER (l.toxic) AS toxic
  FROM w JOIN f ON f.text = w.text LEFT JOIN l ON l.doc_id = w.doc_id GROUP BY 1, 2),
one AS (SELECT unnest(range(5)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM one a, one b, one c, one d, one e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS MATERIALIZED (
  SELECT list_aggregate(list_transform(o, lambda i: substr('ABCDE', (i + 1)::INT, 1)), 'string_agg', '') AS filter_order,
    (k + 1)::INT AS step, o[k + 1] AS f, (1 << o[k + 1]::INT) AS bit,
    coalesce(list_sum(list_transform(o[1:k], lambda i: 1 << i::INT)), 0)::INT AS before FROM o, (SELECT unnest(range(5)) AS k)),
r AS MATERIALIZED (
  SELECT p.part, s.filter_order, s.step, s.f,
    coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM (SELECT DISTINCT part FROM m) p CROSS JOIN s JOIN m ON m.part = p.part GROUP BY p.part, s.filter_order, s.step, s.f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM r
"""


@query("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
