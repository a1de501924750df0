"""Joins between feed members, lookups and the retailer registry.

No join carries a broadcast hint: adaptive execution broadcasts a side by its
run-time size under the session's threshold and shuffles beyond it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.session import shared_dir

def join_inner_chain(members: list[DataFrame], keys: list[str]) -> DataFrame:
    """Inner-join members on shared keys (order free)."""
    return reduce(lambda a, b: a.join(b, keys, "inner"), members)


def join_lookup_left(items: DataFrame, lookup: DataFrame, keys: list[str], group: str = "retailer_id") -> DataFrame:
    """Items left-joined to a lookup table of the same retailer."""
    return items.join(lookup, [group, *keys], "left")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, "members", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_anchor_left(members: dict[str, DataFrame], keys: list[str],
                     group: str = "retailer_id") -> DataFrame:
    """Left-join all members onto the largest member of each group.

    The anchor is chosen per ``group`` value (per retailer) by row count; ties
    go to the member listed first.  The rows of every retailer's anchor member
    are stacked, and each member is then left-joined to the rows whose anchor is
    another one; its rows of the groups that it anchors itself can match nothing and are
    left out before the join's shuffle.  Every member is needed three times (count, anchor, join), so its
    picked rows are written once to the shared folder, and so is the anchors' small table; left joins of a
    skewed key can be split.
    """
    names = list(members)
    members = {n: _stored(d, n) for n, d in members.items()}
    counts = reduce(lambda a, b: a.unionByName(b), [
        d.groupBy(group).agg(F.count(F.lit(1)).alias("n")).withColumn("member", F.lit(n))
         .withColumn("prio", F.lit(i)) for i, (n, d) in enumerate(members.items())])
    anchors = counts.groupBy(group).agg(
        F.max_by(F.col("member"), F.struct(F.col("n"), -F.col("prio"))).alias("_anchor"))
    anchors = _stored(anchors, "anchors")
    base = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        d.join(anchors.where(F.col("_anchor") == n), group) for n, d in members.items()])
    for n in names:
        own = [c for c in members[n].columns if c not in keys]
        others = members[n].join(anchors.where(F.col("_anchor") != n), group, "left_semi")
        side = others.select(*keys, *[F.col(c).alias(f"_{n}_{c}") for c in own], F.lit(n).alias("_side"))
        joined = base.join(side, [base[k] == side[k] for k in keys] + [base["_anchor"] != side["_side"]], "left")
        base = joined.select(*[base[c] for c in base.columns if c not in own],
                             *[F.when(base["_anchor"] == n, base[c]).otherwise(side[f"_{n}_{c}"]).alias(c) for c in own])
    return base.drop("_anchor")


def join_registry(df: DataFrame, registry: DataFrame, file_col: str = "_file_name"):
    """Attach retailer id and POS kind by case-insensitive file name.

    Returns ``(matched, rejected)``; the first registry row by id wins when
    several share a file name.  The registry is a small dimension table.
    """
    reg = (registry.withColumn("_fname", F.lower(F.col("filename")))
           .groupBy("_fname").agg(F.min_by(F.struct(F.col("id").cast("string").alias("retailer_id"),
                                                     F.col("pos").alias("pos")), F.col("id")).alias("_r"))
           .select("_fname", "_r.retailer_id", "_r.pos"))
    keyed = df.withColumn("_fname", F.lower(F.col(file_col)))
    matched = keyed.join(reg, "_fname", "inner").drop("_fname")
    rejected = keyed.join(reg, "_fname", "left_anti").drop("_fname")
    return matched, rejected
