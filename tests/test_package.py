"""Package parse: label table, per-rule behaviour and quirks."""

import pytest
from pyspark.sql import functions as F

from tillflow.functions.package import parse_package, with_item_size_rule, with_pkg_size_rule

# (description, package size text, item size text, expected label)
LABELS = [
    ("Bud Light 6 pk", "6pk", "", "6 pack"),
    ("Oskar Blues Dales Pale Ale 12 pk", "12 pk", "", "12 pack"),
    ("x 6 PK 12 OZ CANS", "", "", "6 pack 12 OZ Aluminum Cans"),
    ("x 12/ PK BTL", "", "", "12 pack Glass Bottles"),
    ("x 750 ML", "", "", "1 pack 750 ML Bottles"),
    ("x 0.75L", "", "", "1 pack 750 ML Bottles"),
    ("x 1500ML", "", "", "1 pack 1.5 L Bottles"),
    ("x 1.75L", "", "", "1 pack 1.75 L Bottles"),
    ("x 1/2 KEG", "", "", "1 pack 0.5 KEG Keg"),
    ("x 24-PACK 12OZ BOTTLE", "", "", "24 pack 12 OZ Glass Bottles"),
    ("x BOMBER", "", "", "1 pack 22 OZ Bottles"),
    ("x PINT", "", "", "1 pack 16 OZ"),
    ("x", "PINT", "", "1 pack"),
    ("x 2/12/16 OZ", "", "", "12 pack 16 OZ"),
    ("x 4.0LBS", "", "", "1 pack 4 LB Bag"),
    ("x 5KG", "", "", "1 pack  GAL"),
    ("x 5 KG", "", "", "1 pack 5 KG"),
    ("x 6-12PK", "", "", "1 pack"),
    ("x 12 LAGER", "", "", "1 pack 12 L"),
    ("x 1/24OZ", "", "", "1 pack 0.54 OZ"),
    ("AMERICAN", "", "", "1 pack Aluminum Cans"),
    ("x 6PK 12 PK", "", "", "12 pack"),
    ("x", "", "750 ML", "1 pack 750 ML Bottles"),
    ("x 12 OZ", "", "1.75L", "1 pack 1.75 L Bottles"),
    ("x ALUM BTL 16OZ", "", "", "1 pack 16 OZ Aluminum Bottles"),
    ("x TETRA 1L", "", "", "1 pack 1 L Tetra Pak"),
    ("x 3 L BOX ", "", "", "1 pack 3 L Bag-in-box"),
    ("SINGLE", "", "", "1 pack"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([r[:3] for r in LABELS],
                               "rt_brand_description string, rt_package_size string, rt_item_size string")
    return [r.package_configuration for r in parse_package(df).collect()]


@pytest.mark.parametrize("i", range(len(LABELS)))
def test_label(parsed, i):
    assert parsed[i] == LABELS[i][3], LABELS[i]


PACK = [
    ("12/PK", 12.0), ("6-PK", 6.0), ("6 -PK", 6.0), ("24-PACK", 24.0), ("30 PACK", 30.0), ("4PCK", 4.0),
    ("6XPK", None),            # found, bad number: stops the cascade
    ("2/12/16", 12.0), ("1 2/3", 2.0), ("1//2", None), ("6 PC", 6.0), ("12NR", 12.0), ("4 BTL", 4.0),
    ("KEG", 1.0), ("single", 1.0), ("", None), (None, None), ("12 OZ", None), ("-6 PK", 6.0),
]


def test_pack_rule(spark):
    df = spark.createDataFrame([(t,) for t, _ in PACK], "t string")
    got = [r.v for r in with_pkg_size_rule(df, "t", "v").collect()]
    assert got == [v for _, v in PACK]


ITEM = [
    ("12 OZ", (12.0, "OZ")), ("12FL OZ", (12.0, "OZ")), ("-12FL OZ", (-12.0, "OZ")), ("750ML", (750.0, "ML")),
    ("5 LBS", (5.0, "LB")), ("1 GALLON", (1.0, "GAL")), ("M375", (375.0, "ML")), ("5GG", (5.0, "GAL")),
    ("12LL", (12.0, "L")), ("1 LITER", (1.0, "L")), ("5KG", (None, "GAL")), ("19.2", (19.2, "OZ")),
    ("X 375", (375.0, "ML")), ("PINT", (None, "PINT")), ("A BOMB", (None, "BOMBER")), ("NOTHING", (None, "")),
    ("1/2 KEG", (0.5, "KEG")), ("1/6 KEG", (0.167, "KEG")),
]


def test_item_rule(spark):
    df = spark.createDataFrame([(t,) for t, _ in ITEM], "t string")
    got = [(r.v.size, r.v.unit) for r in with_item_size_rule(df, "t", "v").collect()]
    assert got == [v for _, v in ITEM]


def test_whole_long_text_is_linear(spark):
    """A 200 000-character digit run must finish and read the whole text."""
    df = spark.createDataFrame([("1" * 200000 + " PK",), ("9" * 200000,)], "t string")
    got = with_pkg_size_rule(df, "t", "v").select(F.col("v").isNotNull().alias("ok")).collect()
    assert [r.ok for r in got] == [True, False]


def test_parse_is_narrow(spark):
    """The parse adds no shuffle and no Python evaluation to the plan."""
    df = spark.range(100).select(F.col("id").cast("string").alias("rt_brand_description"),
                                 F.lit("6 pk").alias("rt_package_size"), F.lit("").alias("rt_item_size"))
    plan = parse_package(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


# tokens at each other's edges: what stands between run and word, runs of one digit, line ends, the marks' own characters
EDGES = [("12+5PK", None, None), ("5--6PK", 6.0, None), ("12/6PK", 126.0, None), ("12/6 PK", 6.0, None), ("7\nPK", None, None), ("7x-PK", None, None),
         ("12//PK", 12.0, None), ("3\u0004OZ", None, None), ("3\u0001OZ 4 L", None, None), ("1..5OZ", None, 0.5), ("16GG", None, 16.0),
         ("4\U0001f600OZ", None, None), ("9 12BTL", 12.0, None), ("1BTL", None, None)]


def test_rules_at_edges(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(EDGES)], "i int, t string")
    got = with_item_size_rule(with_pkg_size_rule(df, "t", "n"), "t", "r").orderBy("i").collect()
    assert [(r.n, r.r["size"]) for r in got] == [(n, s) for _, n, s in EDGES]


def test_rules_run_as_compiled_methods(spark):
    """No rule is interpreted: neither in a lambda function nor in a generated method that HotSpot leaves out."""
    df = spark.createDataFrame([("6 PK", "", "")], "rt_brand_description string, rt_package_size string, rt_item_size string")
    plan = parse_package(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "rt_brand_description" in plan
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_layouts_are_tried_on_texts_with_their_separators(spark):
    """A layout that cannot fit costs an exception a row in the parser; the values are those of all layouts tried."""
    from tillflow.functions.text import parse_ts
    texts = ["2024-01-02 03:04:05", "2024-01-02T03:04:05", "2024-01-02t03:04:05", "2024-01-02", "01/02/2024 03:04:05", "01/02/2024",
             "2024/01/02", "2024-1-2", " 2024-01-02", "", "n/a", "T", "2024-01-02 03:04", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    layouts = parse_ts.__defaults__[0]
    every = F.coalesce(*[F.try_to_timestamp("t", F.lit(x)) for x in layouts]).cast("timestamp_ntz")
    rows = df.select(parse_ts(F.col("t")).alias("got"), every.alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows] and sum(r.got is not None for r in rows) >= 6
    plan = df.select(parse_ts(F.col("t")).alias("got"))._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("case when") >= len(layouts) and plan.count("contains(") >= len(layouts)
