import math
import random
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tillflow.llm import hash_tree

from .helpers import corpus, frame

TREE = hash_tree.Tree.regular(5, 2, 4)


def keys(spark, n=20000):
    return spark.range(n).withColumnRenamed("id", "doc_id")


def placed(spark, tree, n=20000):
    return {r.doc_id: r.shard for r in hash_tree.assign(keys(spark, n), tree).collect()}


def test_even_and_reproducible(spark):
    at = placed(spark, TREE)
    counts = Counter(at.values())
    assert sorted(counts) == list(range(40)) and 400 < min(counts.values()) and max(counts.values()) < 600
    assert at == placed(spark, TREE)


def test_new_shards_take_rows_only_into_themselves(spark):
    tree, at = TREE, placed(spark, TREE)
    for _ in range(3):
        tree = tree.grown()
        after, new = placed(spark, tree), max(tree.shards())
        moved = [k for k in at if at[k] != after[k]]
        assert moved and all(after[k] == new for k in moved)
        at = after


def test_weights_and_confined_movement(spark):
    heavy = TREE.reweighted({0: 3.0})
    at, after = placed(spark, TREE), placed(spark, heavy)
    assert Counter(after.values())[0] > 2 * Counter(at.values())[0]
    # region 0 (shards 0-7) holds the changed subtrees: nothing moves between others
    assert all(after[k] < 8 for k in at if at[k] != after[k])
    assert all(after[k] < 4 for k in at if at[k] < 8 and at[k] != after[k])
    gone = placed(spark, TREE.reweighted({9: 0.0}))
    assert 9 not in gone.values()
    assert all(8 <= at[k] < 16 or gone[k] == at[k] for k in at)


def test_slots_and_digest_columns(spark):
    rows = corpus()
    out = hash_tree.shards_of(frame(spark, rows).withColumn("slot", F.lit("x")).withColumn("_task", F.lit(1)), TREE).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    import zlib
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == want
    assert hash_tree.shards_of(frame(spark, []), TREE).collect() == []


def test_written_shards_read_back(spark, tmp_path):
    rows = hash_tree.assign(frame(spark, corpus()), TREE)
    hash_tree.write_shards(rows, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((str(r.doc_id), r.shard) for r in back.collect()) == sorted((str(r.doc_id), r.shard) for r in rows.collect())


def test_a_tree_without_weight_is_refused(spark):
    with pytest.raises(ValueError):
        hash_tree.assign(keys(spark, 1), TREE.reweighted(dict.fromkeys(range(40), 0.0)))


def descent(key, tree):
    """The shard of a key by the definition: at each node the child of the least variate."""
    node, path = tree.root, ""
    while node.children:
        draws = []
        for c in node.children:
            if c.weight > 0:
                at = f"{path}/{c.name}"
                h = xxhash.xxh64_intdigest(struct.pack("<q", key), 42) if key is not None else 42
                u = ((xxhash.xxh64_intdigest(at.encode(), h) >> 11) + 0.5) / 2**53
                draws.append((-math.log(u) / c.weight, at, c))
        _, path, node = min(draws, key=lambda d: d[:2])
    return node.shard


def test_descent_by_definition(spark):
    rng = random.Random(3)
    heavy = TREE.grown(2.5).reweighted({0: 3.0, 9: 0.0, 17: 0.25})
    ids = [rng.randrange(-2**63, 2**63) for _ in range(300)] + [0, -1, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    for tree in (TREE, heavy, heavy.grown()):
        got = Counter((r.doc_id, r.shard) for r in hash_tree.assign(rows, tree).collect())
        assert got == Counter((i, descent(i, tree)) for i in ids)
