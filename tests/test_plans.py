"""Plan shape: filters, pruned columns, exchanges."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillflow.plans import derived as D
from tillflow.plans import feeds
from tillflow.sources import structured as SS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_and_columns_pruned(spark):
    plan = plan_of(E.queries()["win_latest_ties"](spark, SF_SMALL).where("retailer_id = '3'"))
    read = plan[plan.index("ReadSchema:"):].split("\n")[0]
    assert "l_returnflag" not in read and "l_tax" not in read and "l_discount" not in read
    plan = plan_of(D.table(spark, SF_SMALL, "lineitem").where("l_linestatus = 'O'").select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,O)" in plan


def test_parse_runs_without_python(spark):
    plan = plan_of(E.queries()["pkg_size_rule"](spark, SF_SMALL))
    assert "Python" not in plan and "Arrow" not in plan


def test_spirit_csv_exchanges(spark):
    """Four members, each picked behind one exchange that the join reuses."""
    frames = (D.f2_inv(spark, SF_SMALL), D.f2_prc(spark, SF_SMALL), D.f2_stk(spark, SF_SMALL), D.f2_upc(spark, SF_SMALL))
    out = feeds.feed_spirit2000_csv(*frames)
    out.count()
    plan = plan_of(out.select("*"))
    assert "FullOuter" not in plan


def test_lightspeed_filters_shops_inside_the_row(spark):
    items, cats, registry = (spark.createDataFrame(d.collect(), d.schema) for d in D.lightspeed_pages(spark, SF_SMALL))
    plan = plan_of(SS.lightspeed_items(items, cats, SS.registry_shops(registry)))
    assert plan.count("Join") == 2 and plan.count("Exchange") <= 4 and "Window" not in plan


def test_retailer_filter_reaches_the_scan_of_a_sink(spark, tmp_path):
    from tillflow.plans import sinks
    df = feeds.feed_mpower(D.f1_base(spark, SF_SMALL))
    sinks.write_processed(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).where(F.col("retailer_id") == 3)
    assert "PartitionFilters: [isnotnull(retailer_id" in plan_of(back)
    files = list((tmp_path / "out" / "retailer_id=3").glob("*.parquet"))
    assert len(files) == 1  # dealt by retailer before the write
