"""API pages: envelopes, repeated pages, cursors, the gate."""

import json
import os
import tempfile
import time

from tillflow.sources import structured as SS
from tillflow.streaming.pages import gate


def _land(folder, name, *pages):
    with open(os.path.join(folder, name), "w") as fh:
        fh.writelines(json.dumps(p) + "\n" for p in pages)


def test_square_envelopes(spark):
    d = tempfile.mkdtemp(prefix="tf-sq-")
    item = lambda i, name: {"type": "ITEM", "id": i, "item_data": {"name": name, "category_id": "C1"}}
    old = {"retailer_id": "1", "types": "ITEM", "offset": None, "cursor": "a", "objects": [item("I1", "old"), item("I2", "x")]}
    _land(d, "p1.json", old)
    os.utime(os.path.join(d, "p1.json"), (time.time() - 500,) * 2)
    _land(d, "p1-again.json", {**old, "objects": [item("I1", "new"), item("I2", "x")]})
    _land(d, "p2.json", {"retailer_id": "1", "types": "ITEM", "offset": "a", "objects": [item("I2", "x"), item("I3", "y")]},
          {"retailer_id": "1", "types": "CATEGORY", "objects": [{"type": "CATEGORY", "id": "C1", "category_data": {"name": "Gin"}}]},
          {"retailer_id": "1", "types": "ITEM_VARIATION", "cursor": "b", "objects": [{"type": "ITEM_VARIATION", "id": "V1", "item_variation_data": {
              "item_id": "I1", "sku": "9", "name": "6 pk", "price_money": {"amount": 999}}}]},
          {"retailer_id": "1", "types": "COUNTS", "counts": [{"catalog_object_id": "V1", "location_id": "L", "state": "IN_STOCK", "quantity": "4"}]})
    pages = SS.scan_square_pages(spark, d)
    assert pages.count() == 5
    items, cats, variations, counts = SS.square_members(pages)
    assert sorted((r.id, r.item_data.name) for r in items.collect()) == [("I1", "new"), ("I2", "x"), ("I3", "y")]
    locations = spark.createDataFrame([("1", "L")], "retailer_id string, location_id string")
    rows = SS.square_catalog(items, cats, variations, counts, locations).collect()
    assert [(r.item_data.name, r.category_data.name, r.item_variation_data.sku, r.quantity) for r in rows] == [("new", "Gin", "9", "4")]
    state = {r.types: (r.pages, r.complete) for r in SS.square_page_check(pages).collect()}
    assert state == {"ITEM": (2, True), "CATEGORY": (1, True), "ITEM_VARIATION": (1, False), "COUNTS": (1, True)}


def test_a_feed_waits_for_its_last_page(spark):
    table = tempfile.mkdtemp(prefix="tf-gate-") + "/t"
    schema = "retailer_id string, page long, TotalPages long, Results array<string>"
    run = lambda drop, *rows: gate(spark, table, spark.createDataFrame(list(rows), schema), drop)
    see = lambda out: sorted((r.retailer_id, r.page, r.Results[0]) for r in out[0].collect())
    out = run(0, ("a", 1, 3, ["a1"]), ("a", 2, 3, ["old"]), ("b", 1, 1, ["b1"]), ("c", 1, None, ["c1"]))
    assert see(out) == [("b", 1, "b1")]
    assert sorted((r.retailer_id, r.pages, r.declared) for r in out[1].collect()) == [("a", 2, 3), ("c", 1, None)]
    out = run(1, ("a", 2, 3, ["new"]))
    assert see(out) == [] and out[1].count() == 2
    for _ in range(2):                       # the drop is run again
        out = run(2, ("a", 3, 3, ["a3"]))
        assert see(out) == [("a", 1, "a1"), ("a", 2, "new"), ("a", 3, "a3")]
        assert [r.retailer_id for r in out[1].collect()] == ["c"]
