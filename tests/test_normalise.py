"""Uploads as real files: names, kinds, dirty cells, rejects."""

import os
import tempfile
import zipfile

from tillflow.plans.normalise import kinds, normalise, upload_name

HEAD = "product_id,upc_code,brand_description,package_size,price_regular,qty_on_hand,casepk\n"


def _write(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def _zip(root, name, **members):
    with zipfile.ZipFile(os.path.join(root, name), "w") as z:
        for member, text in members.items():
            z.writestr(member + ".csv", text)


def test_files_folders_archives_and_rejects(spark):
    root = tempfile.mkdtemp(prefix="tf-up-")
    _write(root, "Acme.csv", HEAD + "1,11,Ale 6 PK 12 OZ CANS,6 pk,9.99,5,1e30\n,9,no id,,1,1,1\n2,22,Wine 750 ML,NULL,n/a,x,2\n3,3,free,,0,1,1\n4,4,too long,,1,1,1,more\n")
    _write(root, "upload=beta.csv/part-0.csv", HEAD + "1,77,Keg 1/2 KEG,,150,1,\n")
    _write(root, "upload=beta.csv/part-1.csv", "price_regular,product_id,brand_description\n5,9,PINT\n")
    _write(root, "notes.csv", "a\n1\n")
    _write(root, "gamma.txt", HEAD)
    _write(root, "delta.csv", HEAD)
    spirit = dict(
        inv="SKU,NAME,SNAME,PACK,TYPENAME\n5,Gin,750 ML,12,SPIRITS\n6,Rum,1 L,6,SPIRITS\n",
        prc="SKU,QTY,PRICE,SALE,LEVEL,TSTAMP\n5,9,10,0,1,2020-01-01\n5,12,99,0,1,2020-01-01\n5,n/a,1,0,1,2021-01-01\n6,bad,7,0,1,2020-01-01\n",
        stk="SKU,BACK,TSTAMP\n5,24,2020-01-01\n", upc="SKU,UPC,TSTAMP\n5,0555,2020-01-01\n")
    _zip(root, "epsilon.zip", **spirit)
    for r in ("1", "2"):  # equal pack ids, other names
        _zip(root, f"adv{r}.zip", ZZ_AdventPOS_Raw=f"SKU,ITEMNAME,DESCRIPTION,CATID,PACKID,SIZEID,PRICEPERUNIT,INSTOREQTY,MAINUPC\n{r},a,b,5,1,1,3,4,8\n",
             ZZ_AdventPOS_Raw_ItemSize=f"SIZEID,SIZENAME\n1,{r}00 ML\n", ZZ_AdventPOS_Raw_ItemPack=f'PACKID,PACKNAME\n1,"{r}4 PK,x"\n')
    registry = spark.createDataFrame(
        [(1, "MPower", "ACME.CSV"), (2, "mpower", "beta.csv"), (3, "mpower", "gamma.txt"), (4, "nonesuch", "delta.csv"),
         (5, "spirit2000_csv", "epsilon.zip"), (6, "AdventPOS", "adv1.zip"), (7, "AdventPOS", "adv2.zip")],
        "id int, pos string, filename string")
    good, bad = normalise(spark, root, registry, "2020-06-01 00:00:00")
    rows = {(r.retailer_id, r.rt_product_id): r for r in good.collect()}
    # item 6 has no price of a readable quantity: the anchor (inv) keeps it
    assert sorted(rows) == [("1", "1"), ("1", "2"), ("2", "1"), ("2", "9"), ("5", "5"), ("5", "6"), ("6", "1"), ("7", "2")]
    assert rows["1", "1"].package_configuration == "6 pack 12 OZ Aluminum Cans"
    assert rows["1", "1"].wholesale_package_size == "1" + "0" * 30 + " Pack"
    assert (rows["1", "2"].price_regular, rows["1", "2"].qty_on_hand) == (0.0, 0.0)
    assert rows["2", "9"].item_size == "16 OZ" and rows["2", "9"].price_regular == 5.0
    assert (rows["5", "5"].rt_package_size, rows["5", "5"].price_regular, rows["5", "5"].qty_on_hand) == ("12 pack", 99.0, 2.0)
    assert (rows["6", "1"].rt_package_size, rows["6", "1"].rt_item_size) == ("14 PK", "100 ML")
    assert (rows["7", "2"].rt_package_size, rows["7", "2"].rt_item_size) == ("24 PK", "200 ML")
    assert sorted((r.retailer_id or "", r.source or "", r.reason) for r in bad.collect()) == [
        ("", "", "no_registry_row"), ("1", "mpower", "missing_product_id"), ("1", "mpower", "over_long_row"),
        ("1", "mpower", "unparsable_qty_on_hand"), ("3", "mpower", "unrecognized_file_type"),
        ("4", "nonesuch", "unknown_pos")]
    records = {r.reason: r.record for r in bad.collect()}
    assert records["over_long_row"] == '["4","4","too long","1","1","1","more"]'
    assert records["unparsable_qty_on_hand"] == '{"rt_product_id":"2","cell":"x"}'
    assert '"rt_upc_code":"9"' in [r.record for r in bad.collect() if r.reason == "missing_product_id"][0]


def test_no_uploads(spark):
    root = tempfile.mkdtemp(prefix="tf-up-")
    _write(root, "x.csv", HEAD)
    good, bad = normalise(spark, root, spark.createDataFrame([], "id int, pos string, filename string"), "2020-06-01 00:00:00")
    assert good.count() == 0 and [r.reason for r in bad.collect()] == ["no_registry_row"]


def test_upload_names(spark):
    paths = ["file:/data/in/a.csv", "file:///data/in/up=a%20b.zip/0/part-1", "/data/in/c.csv/part-0.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for root in ("/data/in", "file:///data/in/"):
        assert [r[0] for r in df.select(upload_name(df.p, root)).collect()] == ["a.csv", "a b.zip", "c.csv"]


def test_line_ends_in_quoted_cells(spark):
    root = tempfile.mkdtemp(prefix="tf-up-")
    _write(root, "a.csv", HEAD + '1,11,"Ale\n6 PK 12 OZ\r\nCANS",6 pk,9.99,5,1\n2,22,Wine 750 ML,,3,2,7\r\n')
    _write(root, "up=b.csv/part-0.csv", HEAD.replace("\n", "\r\n") + '1,11,"Rum\n1 L",,8,5,1\r\n2,22,"Gin 1 L",,9,5,1\r\n')
    _write(root, "up=b.csv/part-1.csv", 'price_regular,product_id,brand_description\n5,9,"KEG\n""1/2"""\n')
    _write(root, "up=b.csv/part-2.csv", "")
    cells = [f"c{i}" for i in range(23)]
    wide = lambda code, text: "\t".join([code, *cells[1:3], text, *cells[4:]]) + "\n"
    _write(root, "w.csv", wide("A1", '"Red\nwine"') + wide("A2", "White wine"))
    registry = spark.createDataFrame([(1, "mpower", "a.csv"), (2, "tiger", "b.csv"), (3, "winepos", "w.csv")],
                                     "id int, pos string, filename string")
    known = kinds("2020-06-01 00:00:00")
    rows = known["winepos"].read(spark, [os.path.join(root, "w.csv")])[0].orderBy("_ord").select("_c0", "_c3", "_c22").collect()
    assert [tuple(r) for r in rows] == [("A1", "Red\nwine", "c22"), ("A2", "White wine", "c22")]
    registry = registry.where("id = 1").union(spark.createDataFrame([(2, "mpower", "b.csv")], registry.schema))
    good, bad = normalise(spark, root, registry, "2020-06-01 00:00:00")
    got = {(r.retailer_id, r.rt_product_id): r for r in good.collect()}
    assert sorted(got) == [("1", "1"), ("1", "2"), ("2", "1"), ("2", "2"), ("2", "9")]
    assert (got["1", "1"].price_regular, got["1", "2"].price_regular, got["2", "9"].price_regular) == (9.99, 3.0, 5.0)
    assert got["2", "9"].rt_brand_description == 'KEG\n"1/2"'
    assert [r.reason for r in bad.collect()] == ["no_registry_row"]  # w.csv


def test_twenty_kinds():
    assert len(kinds("2020-01-01 00:00:00")) == 20
