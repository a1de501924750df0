"""Page gate: a feed of API pages goes on when all its pages are there.

Pages arrive in drops, in any order and some more than once.  They are kept in a current table (one row per
retailer and page, the latest copy), and a retailer's feed is released by the drop that completes it,
whole; until then it is held, and nothing of it goes on.  A drop that is repeated under its number releases the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.columns import KEY
from tillflow.plans.current import current, marks, merge
from tillflow.sources.structured import page_check


def gate(spark: SparkSession, table: str, pages: DataFrame, drop: int, declared: str = "TotalPages",
         items: str = "Results") -> tuple[DataFrame, DataFrame]:
    """(pages of the feeds that are complete with this drop, held: retailer_id, pages, items, declared).

    ``pages``: retailer_id, page, the declared number and the items; of copies in one drop the first by all
    columns is taken, a later drop's copy replaces an earlier one.  A feed that declares nothing is held.  A drop
    that brings new copies of a complete feed's pages releases it again."""
    merge(spark, table, pages, drop, keys=(KEY, "page"))
    now = current(spark, table, pages.schema, before=drop + 1)
    touched = marks(spark, table, drop + 1).where(F.col("version") == drop).select(KEY)
    state = page_check(now, declared, items)
    whole = state.where(F.coalesce("complete", F.lit(False))).select(KEY)
    released = now.join(whole, KEY, "left_semi").join(touched, KEY, "left_semi")
    return released, state.where(~F.coalesce("complete", F.lit(False))).drop("complete")
