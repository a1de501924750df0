"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a row draws, for every child of the node it stands in, an
exponential variate from a hash of (key, level, child) divided by the child's
weight, and descends into the smallest.  A child is therefore taken in
proportion to its weight, and a changed weight moves rows only into or out of
the subtrees whose weights change.  A new shard opens a region of its own
(``Tree.grown``), so no other node's weight changes and the only rows that move
are those that the new shard takes.

Draws are Spark SQL expressions.  Slots come from a running count per (task,
shard) that is stored with the rows, plus offsets summed over the small table
of (task, shard) counts: no shard is ever gathered in one task.

Defined cases: a null key hashes like any other value and always lands in the
same shard; a null text has 16 bytes of size and checksum 0; equal keys share
a shard and get different slots; an empty table gives an empty result; of
columns with the names of result columns the result's are returned.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import staged

OVERHEAD = 16   # bytes that a row takes besides its text


@dataclass(frozen=True)
class Node:
    """A shard (no children) or an inner node.  ``name`` identifies it among
    its siblings for good; the weight of an inner node is its children's sum."""

    name: str
    own: float = 1.0
    children: tuple[Node, ...] = ()
    shard: int | None = None

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own


@dataclass(frozen=True)
class Tree:
    root: Node

    @classmethod
    def regular(cls, regions: int, racks: int, shards: int) -> Tree:
        """``regions * racks * shards`` shards of weight 1, numbered in order."""
        made = []
        for i in range(regions):
            inner = [Node(f"rack{j}", children=tuple(
                Node(f"shard{k}", shard=(i * racks + j) * shards + k) for k in range(shards))) for j in range(racks)]
            made.append(Node(f"region{i}", children=tuple(inner)))
        return cls(Node("root", children=tuple(made)))

    def shards(self) -> list[int]:
        def walk(node):
            return [s for c in node.children for s in walk(c)] if node.children else [node.shard]
        return walk(self.root)

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region and rack of its own."""
        shards = self.shards()
        leaf = Node("shard0", weight, shard=max(shards) + 1)
        name = f"region{len(self.root.children)}"
        region = Node(name, children=(Node("rack0", children=(leaf,)),))
        return Tree(replace(self.root, children=(*self.root.children, region)))

    def reweighted(self, weights: dict[int, float]) -> Tree:
        """The same tree with other shard weights."""
        def walk(node):
            if node.children:
                return replace(node, children=tuple(walk(c) for c in node.children))
            return replace(node, own=weights.get(node.shard, node.own))
        return Tree(walk(self.root))


def _draw(key: Column, path: str, weight: float) -> Column:
    """Exponential variate with rate ``weight`` from the hash of key and node."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(uniform) / weight


def assign(rows: DataFrame, tree: Tree, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """Adds the shard that each row's key descends to, one level at a time."""
    if tree.root.weight <= 0:
        raise ValueError("a tree needs a shard of positive weight")
    level, leaves, path = {"": tree.root}, {}, F.lit("")
    rows = rows.withColumn(out, path)
    while level:
        below, choice = {}, None
        for name, node in level.items():
            live = {f"{name}/{c.name}": c for c in node.children if c.weight > 0}
            draws = [F.struct(_draw(F.col(key), p, c.weight).alias("draw"), F.lit(p).alias("path")) for p, c in live.items()]
            least = F.array_min(F.array(*draws))["path"]
            choice = F.when(F.col(out) == name, least) if choice is None else choice.when(F.col(out) == name, least)
            leaves.update({p: c.shard for p, c in live.items() if not c.children})
            below.update({p: c for p, c in live.items() if c.children})
        rows = rows.withColumn(out, choice.otherwise(F.col(out)))  # a shard that ended higher up stays
        level = below
    numbers = F.create_map(*[F.lit(x) for pair in leaves.items() for x in pair])
    return rows.withColumn(out, numbers[F.col(out)].cast("int"))


def with_slots(rows: DataFrame, shard: str = "shard", out: str = "slot") -> DataFrame:
    """Adds a gapless position from 0 within the row's shard.

    Rows are written once to the shared folder with their task's number and a
    running count per shard; a retried task writes the same, and only what is
    committed is read.
    """
    kept = [f for f in rows.schema.fields if f.name not in (out, "_task", "_local")]
    schema = StructType(list(kept)).add("_task", IntegerType()).add("_local", LongType())
    names = [f.name for f in kept]

    def count(batches):
        from pyspark import TaskContext
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            shards = batch.column(shard).to_numpy(zero_copy_only=False)
            local = np.empty(len(shards), np.int64)
            for s in np.unique(shards):
                at = np.flatnonzero(shards == s)
                local[at] = seen.get(s, 0) + np.arange(len(at))
                seen[s] = seen.get(s, 0) + len(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(np.full(len(shards), task, np.int32)), pa.array(local)],
                names + ["_task", "_local"])

    stored = staged(rows.select(names).mapInArrow(count, schema), "shards")
    counts = stored.groupBy(shard, "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(shard).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(shard, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (stored.join(offsets, [shard, "_task"])
            .select(*names, (F.col("_offset") + F.col("_local")).alias(out)))


def shards_of(docs: DataFrame, tree: Tree, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Narrow placement table: key, size, text_crc32, shard, grown_shard, slot."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    placed = docs.select(F.col(key), (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
                         F.crc32(raw).alias("text_crc32"))
    placed = assign(assign(placed, tree, key, "shard"), tree.grown(), key, "grown_shard")
    return with_slots(placed)


def write_shards(rows: DataFrame, path: str, shard: str = "shard", files: int = 4) -> None:
    """One folder a shard; a shard is written by up to ``files`` tasks."""
    (rows.withColumn("_file", F.pmod(F.xxhash64(*rows.columns), F.lit(files)))
     .repartition(shard, "_file").drop("_file").write.partitionBy(shard).parquet(path))
