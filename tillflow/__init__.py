"""tillflow: point-of-sale inventory feed normalisation on Spark.

Feeds from many retailers and many POS systems are read as DataFrames, mapped
to one canonical product table, cleaned, joined, deduplicated per
``(retailer_id, product)`` and their free-text package descriptions parsed
into pack size, item size, unit, container and a package label -- all with
native Spark SQL expressions, joins and aggregations.
"""

from tillflow.schema import CANONICAL_COLUMNS, PARSED_COLUMNS, OUTPUT_COLUMNS  # noqa: F401

__version__ = "0.1.0"
