import random

import corpus_pipeline
from tillflow.llm import compression, minhash

from .helpers import corpus, frame, prose

NAMES = ["quality", "rules", "near_dedup", "mix", "encode"]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES


def test_each_stage_on_its_own_input(spark, tmp_path):
    """Decisions take effect, columns stay, and each stage equals its operator."""
    sf = str(tmp_path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(frame(spark, [
        (10_000 + (r[0] or 0), *r[1:]) for r in corpus()]))
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{sf}/labels.parquet")
    docs.write.parquet(f"{sf}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name == "encode":
            assert out.count() == docs.count()
            assert all(r.n_tokens == len(r.ids) and r.ids[-1] == 2 for r in out.collect())
            break
        assert out.columns == docs.columns
        out.write.parquet(f"{sf}/out/{name}")
        out = spark.read.parquet(f"{sf}/out/{name}")
        ids = {r.doc_id for r in out.collect()}
        if name == "rules":
            assert ids == {r.doc_id for r in compression.judged(docs).collect() if r.kept}
        if name == "near_dedup":
            assert out.count() == len(ids)
            assert ids == {r.doc_id for r in minhash.near_duplicates(docs).collect() if r.kept}
        sizes.append(out.count())
        docs = out
    assert sizes[0] >= sizes[1] > sizes[2] > 0


def test_one_doc_id_with_different_texts(spark):
    """Only near-equal texts are duplicates; which row stays does not depend on Spark."""
    rng = random.Random(4)
    a, b, c, d = (prose(rng, 200, 3000) for _ in range(4))
    rows = [(7, a, "en", "s"), (7, b, "en", "s"), (7, c, "en", "t"), (7, c, "de", "s"), (7, c + " end", "en", "s"),
            (9, a + " more", "en", "s"), (3, b + " more", "en", "s"), (8, d, "en", "s"), (8, "", "en", "s"), (8, None, "en", "s"),
            (None, a, "en", "s"), (None, a, "en", "s")]
    docs = frame(spark, [(*r, len(r[1] or "")) for r in rows])
    once, again = (sorted(map(tuple, corpus_pipeline.near_dedup(spark, docs.repartition(n), "").collect()), key=str) for n in (1, 5))
    assert once == again
    got = [(r[0], r[1]) for r in once]
    assert len(got) == 8 and got.count((None, a)) == 2  # rows without an id all stay
    assert {(7, a), (3, b + " more"), (8, d), (8, ""), (8, None)} < set(got)
    assert [g for g in got if g[0] == 7 and g[1].startswith(c)] in ([(7, c)], [(7, c + " end")])


def test_empty_documents(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
