"""Row picking per key: first in order, group max with ties, dedup.

All pickers are ``row_number() = 1`` or ``rank() = 1`` over the key.  Spark
plans such a filter as a group limit before and after ONE exchange: every map
task first keeps its own best rows of a key, so a key with a large share of all
rows is reduced where it lies, and the input is read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tillflow.functions.text import as_double
from tillflow.operators.columns import ORD


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def first_per_key(df: DataFrame, keys: list[str], order: list, tiebreak_all: bool = False) -> DataFrame:
    """One row per key: the smallest by ``order`` (lexicographic, nulls first).

    With ``tiebreak_all`` every other column is appended to the order, so the
    pick is deterministic (and identical on a task retry) even when ``order``
    ties.
    """
    ref = lambda c: F.col(f"`{c}`")  # noqa: E731  (names may contain dots)
    by = _cols(order)
    if tiebreak_all:
        by += [ref(c) for c in df.columns if c not in keys and not isinstance(df.schema[c].dataType, MapType)]
    win = Window.partitionBy(*keys).orderBy(*by)
    return (df.withColumn("_rn", F.row_number().over(win)).where(F.col("_rn") == 1)
            .select(*keys, *[ref(c) for c in df.columns if c not in keys]))


def dedup_first_in_file(df: DataFrame, keys: list[str]) -> DataFrame:
    """First row per key in file order (``_ord``)."""
    return first_per_key(df, keys, [ORD])


def keep_group_max(df: DataFrame, keys: list[str], by: list) -> DataFrame:
    """Rows whose ``by`` values equal the per-key lexicographic maximum.

    Rows with a null in ``by`` or in a key never qualify (a null never equals
    the maximum), but still take part in choosing earlier fields' maximum,
    matching 'filter x == max(x) per key, then y == max(y) among them'.
    """
    by = _cols(by)
    names = [f"_by{i}" for i in range(len(by))]
    present = reduce(lambda x, y: x & y, [F.col(f"`{k}`").isNotNull() for k in keys])
    win = Window.partitionBy(*keys).orderBy(*[F.col(n).desc_nulls_last() for n in names])
    best = (df.withColumns(dict(zip(names, by))).where(present & F.col(names[0]).isNotNull())
            .withColumn("_rank", F.rank().over(win)).where(F.col("_rank") == 1))
    return best.where(reduce(lambda x, y: x & y, [F.col(n).isNotNull() for n in names])).drop("_rank", *names)


def keep_latest(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Rows with the newest timestamp per key (ties kept, null dropped)."""
    return keep_group_max(df, keys, [ts])


def keep_maxqty_then_latest(df: DataFrame, keys: list[str], qty: str, ts: str) -> DataFrame:
    """Max quantity per key (compared as numbers, text included), then the
    newest among those (ties kept)."""
    return keep_group_max(df, keys, [as_double(qty), ts])


def keep_longest(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Rows whose ``col`` text is the longest of their key (ties kept)."""
    return keep_group_max(df, keys, [F.length(F.col(col))])


def dedup_smallest(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """One row per key with the smallest ``col`` (numeric when it reads as a
    number, nulls last), file order breaking ties."""
    c = F.col(col)
    order: list[Column] = [c.isNull(), c.cast("string").try_cast("double"), c.cast("string"), F.col(ORD)]
    return first_per_key(df, keys, order)


def max_length(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Per-key length of the longest text of ``col``."""
    return df.groupBy(*keys).agg(F.max(F.length(F.col(col))).alias("max_len"))


def group_max(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Per-key maximum of each column (aggregation form of a max transform)."""
    return df.groupBy(*keys).agg(*[F.max(c).alias("max_" + c) for c in cols])
