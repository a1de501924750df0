"""Anchored join of members."""

from tillflow.operators.joins import join_anchor_left


def test_a_member_sends_no_rows_of_the_groups_it_anchors(spark):
    a = spark.createDataFrame([("r1", "1", "a1"), ("r1", "2", "a2"), ("r2", "1", "a3"), (None, "1", "a4")], "retailer_id string, sku string, x string")
    b = spark.createDataFrame([("r1", "1", "b1"), ("r2", "1", "b2"), ("r2", "3", "b3"), ("r3", "7", "b4")], "retailer_id string, sku string, y string")
    out = join_anchor_left({"a": a, "b": b}, ["retailer_id", "sku"])
    assert sorted(map(tuple, out.select("retailer_id", "sku", "x", "y").collect())) == [
        ("r1", "1", "a1", "b1"), ("r1", "2", "a2", None), ("r2", "1", "a3", "b2"), ("r2", "3", None, "b3"), ("r3", "7", None, "b4")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2
