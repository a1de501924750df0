"""XML and JSON feeds (Spark's built-in readers, explicit schemas)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillflow.operators.columns import ORD, filter_shop

# Tags read from each 'webtable' element of a spirit2000 export.
SPIRIT_XML_TAGS = ["sku", "upccode", "prodname", "catname", "typename", "sizename", "unitprice", "sale",
                   "stockqty", "pack", "onsale"]


def scan_xml_rows(spark: SparkSession, path, row_tag: str = "webtable",
                  tags: list[str] = SPIRIT_XML_TAGS) -> DataFrame:
    """One row per ``row_tag`` element; the listed child tags as text."""
    schema = T.StructType([T.StructField(t, T.StringType()) for t in tags])
    df = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return df.withColumns({
        ORD: F.struct(F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("pos")),
        "_file_name": F.col("_metadata.file_name"), "_file_path": F.col("_metadata.file_path")})


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed API pages (one JSON document per line)."""
    return spark.read.schema(schema).json(path).withColumn("_file_name", F.col("_metadata.file_name"))


REGISTRY_SCHEMA = "id long, pos string, name string, filename string, shopid string, refreshtoken string"


def scan_registry(spark: SparkSession, path: str) -> DataFrame:
    """The retailer registry as landed JSON rows (one retailer a line)."""
    return spark.read.schema(REGISTRY_SCHEMA).json(path)


def registry_shops(registry: DataFrame) -> DataFrame:
    """``retailer_id, shop_id`` of the registry."""
    return registry.select(F.col("id").cast("string").alias("retailer_id"), F.col("shopid").alias("shop_id"))


MPOWER_PAGE_SCHEMA = (
    "retailer_id string, page long, TotalPages long, Results array<struct<Id:long, SkuNumber:string, Name:string, "
    "Department:string, Category:string, CaseQuantity:double, CaseRetail:double, Retail:double, "
    "QuantityOnHand:double, Size:string, Upc:string, AdditionalUpcs:array<struct<Upc:string, Retail:double, "
    "Quantity:double>>>>")


def mpower_items(pages: DataFrame) -> DataFrame:
    """MPower pages -> one row per item (``AdditionalUpcs`` kept as array)."""
    return pages.select("retailer_id", "page", F.explode("Results").alias("r")).select(
        "retailer_id", F.struct(F.col("page"), F.col("r.Id")).alias(ORD), "r.*")


LIGHTSPEED_ITEM_PAGE_SCHEMA = (
    "retailer_id string, page long, Item array<struct<itemID:string, systemSku:string, upc:string, "
    "description:string, categoryID:string, Prices:struct<ItemPrice:array<struct<useTypeID:string, amount:string>>>, "
    "ItemShops:struct<ItemShop:array<struct<itemID:string, shopID:string, qoh:string>>>>>")
LIGHTSPEED_CATEGORY_PAGE_SCHEMA = (
    "retailer_id string, Category array<struct<categoryID:string, name:string, fullPathName:string>>")


def lightspeed_items(item_pages: DataFrame, category_pages: DataFrame, shops: DataFrame) -> DataFrame:
    """Item pages -> items with the shop's price and quantity and the category
    (left join).  Each retailer's shop comes from the registry (``shops``:
    retailer_id, shop_id); prices and quantities are filtered to it inside the row
    before they are exploded."""
    items = item_pages.join(shops, "retailer_id").select(
        "retailer_id", "shop_id", "page", F.posexplode("Item").alias("_pos", "i"))
    base = items.select(
        "retailer_id", "shop_id", F.struct("page", "_pos").alias(ORD), "i.itemID", "i.systemSku", "i.upc", "i.description",
        "i.categoryID", F.col("i.Prices.ItemPrice").alias("_prices"), F.col("i.ItemShops.ItemShop").alias("_shops"))
    base = filter_shop(filter_shop(base, "_prices", "useTypeID"), "_shops", "shopID")
    base = base.withColumn("_p", F.explode("_prices")).withColumn("_q", F.explode("_shops"))
    base = base.withColumns({"amount": F.col("_p.amount"), "qoh": F.col("_q.qoh")}).drop("_prices", "_shops", "_p", "_q")
    cats = category_pages.select("retailer_id", F.explode("Category").alias("c")).select(
        "retailer_id", "c.categoryID", "c.name", "c.fullPathName")
    return base.join(cats, ["retailer_id", "categoryID"], "left")


def latest_pages(pages: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest copy of each page: a page may be landed more than once."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return pages.withColumn("_copy", F.row_number().over(newest)).where("_copy = 1").drop("_copy")


def page_check(pages: DataFrame, declared: str = "TotalPages", items: str = "Results") -> DataFrame:
    """Per retailer: pages and items present, pages declared, and whether any
    page is missing (null when nothing was declared)."""
    out = pages.groupBy("retailer_id").agg(F.countDistinct("page").alias("pages"), F.sum(F.size(items)).alias("items"),
                                           F.max(declared).alias("declared"))
    return out.withColumn("complete", F.col("pages") >= F.col("declared"))


def outer_upcs(items: DataFrame) -> DataFrame:
    """One row per item and additional UPC; items without any keep one row."""
    return items.select("*", F.posexplode_outer("AdditionalUpcs").alias("_pos", "_add")).drop("AdditionalUpcs")


# One landed answer of the list or count calls: what was asked (``types``, the cursor ``offset`` it
# was asked with, null for the first) and what came (``cursor`` of the next page, null on the last).
SQUARE_PAGE_SCHEMA = (
    "retailer_id string, types string, offset string, cursor string, objects array<struct<type:string, id:string, "
    "item_data:struct<name:string, product_type:string, category_id:string>, category_data:struct<name:string>, "
    "item_variation_data:struct<item_id:string, sku:string, name:string, price_money:struct<amount:long>>>>, "
    "counts array<struct<catalog_object_id:string, location_id:string, state:string, quantity:string>>")


def scan_square_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed answers, the latest copy of each (by the file's time, then its path)."""
    pages = scan_json(spark, path, SQUARE_PAGE_SCHEMA).withColumns(
        {"_landed": F.col("_metadata.file_modification_time"), "_path": F.col("_metadata.file_path")})
    return latest_pages(pages, ["retailer_id", "types", "offset"], ["_landed", "_path"]).drop("_landed", "_path", "_file_name")


def square_members(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Items, categories, variations and counts out of the pages' ``objects`` (by their type) and
    ``counts``.  An object that several pages hold counts once."""
    objects = pages.select("retailer_id", F.explode("objects").alias("o")).select("retailer_id", "o.*")

    def of(kind: str, data: str) -> DataFrame:
        return objects.where(F.col("type") == kind).select("retailer_id", "id", data).dropDuplicates(["retailer_id", "id"])

    counts = (pages.select("retailer_id", F.explode("counts").alias("c")).select("retailer_id", "c.*")
              .dropDuplicates(["retailer_id", "catalog_object_id", "location_id", "state"]))
    return of("ITEM", "item_data"), of("CATEGORY", "category_data"), of("ITEM_VARIATION", "item_variation_data"), counts


def square_page_check(pages: DataFrame) -> DataFrame:
    """Per retailer and kind of page: pages, and whether their cursors lead from the first page to the last
    (every cursor that a page names was asked with, and one page names none)."""
    out = pages.groupBy("retailer_id", "types").agg(
        F.count(F.lit(1)).alias("pages"), F.collect_set("cursor").alias("_next"), F.collect_set("offset").alias("_asked"),
        F.sum(F.col("offset").isNull().cast("int")).alias("_first"), F.sum(F.col("cursor").isNull().cast("int")).alias("_last"))
    whole = (F.size(F.array_except("_next", "_asked")) == 0) & (F.size(F.array_except("_asked", "_next")) == 0)
    return out.select("retailer_id", "types", "pages", (whole & (F.col("_first") == 1) & (F.col("_last") == 1)).alias("complete"))


def square_catalog(items: DataFrame, categories: DataFrame, variations: DataFrame, counts: DataFrame,
                   locations: DataFrame) -> DataFrame:
    """Items -> category -> variations -> in-stock counts at the retailer's
    location (inner joins, all within a retailer), nested structs kept.
    ``locations``: retailer_id, location_id (from the registry)."""
    key = "retailer_id"
    in_stock = (counts.where(F.col("state") == "IN_STOCK").join(locations, [key, "location_id"])
                .withColumnRenamed("catalog_object_id", "item_variation_object_id"))
    cats = categories.withColumnRenamed("id", "_category")
    var = variations.withColumnRenamed("id", "item_variation_object_id").withColumn(
        "_item", F.col("item_variation_data.item_id"))
    x = items.withColumn("_category", F.col("item_data.category_id")).join(cats, [key, "_category"])
    x = x.join(var, (x[key] == var[key]) & (x["id"] == var["_item"])).drop(var[key])
    return x.drop("_category", "_item").join(in_stock, [key, "item_variation_object_id"])
