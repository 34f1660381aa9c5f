"""Lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The two lookup tables.
COUNTRY_CODES = """\
US,United States,North America
GB,United Kingdom,Europe
DE,Germany,Europe
FR,France,Europe
CA,Canada,North America
AU,Australia,Oceania
IN,India,Asia
SG,Singapore,Asia
AE,United Arab Emirates,Middle East
BR,Brazil,South America
MX,Mexico,North America
NL,Netherlands,Europe
SE,Sweden,Europe
NO,Norway,Europe
DK,Denmark,Europe
CH,Switzerland,Europe
IT,Italy,Europe
ES,Spain,Europe
PL,Poland,Europe
JP,Japan,Asia
KR,South Korea,Asia
CN,China,Asia
NZ,New Zealand,Oceania
ZA,South Africa,Africa
NG,Nigeria,Africa
"""
PRODUCT_CATEGORIES = """\
ELEC,Electronics,General
MOBI,Mobile Phones,Electronics
LAPT,Laptops,Electronics
WEAR,Wearables,Electronics
FASH,Fashion,General
CLOT,Clothing,Fashion
SHOE,Footwear,Fashion
ACCS,Accessories,Fashion
HOME,Home & Garden,General
FURN,Furniture,Home & Garden
KITC,Kitchen,Home & Garden
BOOK,Books & Media,General
SPRT,Sports & Outdoors,General
AUTO,Automotive,General
FOOD,Food & Grocery,General
HLTH,Health & Beauty,General
TOYS,Toys & Games,General
OFFC,Office Supplies,General
UNCG,Uncategorized,General
"""
COUNTRY_SCHEMA = "country_code string, country_name string, region string"
CATEGORY_SCHEMA = "category_id string, category_name string, parent_category string"


def _inline(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """An inline table: the optimizer knows its exact size, so it may broadcast it."""
    names = ", ".join(column.split()[0] for column in schema.split(", "))
    rows = ", ".join(
        "(" + ", ".join(f"'{value}'" for value in line.split(",")) + ")" for line in text.splitlines()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS seed({names})")


def country_codes(spark: SparkSession) -> DataFrame:
    return _inline(spark, COUNTRY_CODES, COUNTRY_SCHEMA)


def product_categories(spark: SparkSession) -> DataFrame:
    return _inline(spark, PRODUCT_CATEGORIES, CATEGORY_SCHEMA)
