"""Canonical output schema of the normalised inventory table."""

# Canonical column names and order of the product table.
CANONICAL_COLUMNS = [
    "rt_product_id", "rt_upc_code", "rt_brand_name",
    "rt_brand_description", "rt_product_type", "rt_product_category",
    "rt_package_size", "rt_item_size", "price_regular",
    "price_sale", "qty_on_hand", "wholesale_package_size", "rt_wholesale_qty",
]
NUMERIC_COLUMNS = ["price_regular", "price_sale", "qty_on_hand"]
# columns that are filled with '' when a feed does not provide them
OPTIONAL_TEXT_COLUMNS = [
    "rt_item_size", "rt_brand_name", "rt_package_size", "rt_product_category",
    "rt_product_type", "rt_upc_code", "wholesale_package_size", "rt_wholesale_qty",
]
# columns added by the package parse, in creation order
PARSED_COLUMNS = [
    "package_size_num", "item_size_value", "item_units", "container_type",
    "item_size", "package_configuration",
]
LOAD_COLUMNS = ["active", "retailer_id"]
OUTPUT_COLUMNS = CANONICAL_COLUMNS + PARSED_COLUMNS + LOAD_COLUMNS
