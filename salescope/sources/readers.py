"""Sources with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The two raw inputs of a game catalogue, as their readers use them.
LISTING_SCHEMA = T.StructType([
    T.StructField(n, t) for n, t in [
        ("AppID", T.LongType()), ("Name", T.StringType()), ("Release date", T.StringType()),
        ("Estimated owners", T.StringType()), ("Peak CCU", T.LongType()),
        ("Required age", T.LongType()), ("Price", T.DoubleType()), ("Discount", T.LongType()),
        ("DLC count", T.LongType()), ("About the game", T.StringType()),
        ("Supported languages", T.StringType()), ("Full audio languages", T.StringType()),
        ("Reviews", T.StringType()), ("Header image", T.StringType()), ("Website", T.StringType()),
        ("Support url", T.StringType()), ("Support email", T.StringType()),
        ("Windows", T.BooleanType()), ("Mac", T.BooleanType()), ("Linux", T.BooleanType()),
        ("Metacritic score", T.DoubleType()), ("Metacritic url", T.StringType()),
        ("User score", T.DoubleType()), ("Positive", T.LongType()), ("Negative", T.LongType()),
        ("Score rank", T.StringType()), ("Achievements", T.LongType()),
        ("Recommendations", T.LongType()), ("Notes", T.StringType()),
        ("Average playtime forever", T.LongType()), ("Average playtime two weeks", T.LongType()),
        ("Median playtime forever", T.LongType()), ("Median playtime two weeks", T.LongType()),
        ("Developers", T.StringType()), ("Publishers", T.StringType()),
        ("Categories", T.StringType()), ("Genres", T.StringType()), ("Tags", T.StringType()),
        ("Screenshots", T.StringType()), ("Movies", T.StringType()),
    ]
])
SALES_SCHEMA = T.StructType([
    T.StructField("steamId", T.LongType()), T.StructField("unreleased", T.BooleanType()),
    T.StructField("earlyAccess", T.BooleanType()), T.StructField("firstReleaseDate", T.StringType()),
    T.StructField("copiesSold", T.DoubleType()), T.StructField("reviewScore", T.DoubleType()),
    T.StructField("publisherClass", T.StringType()), T.StructField("steamUrl", T.StringType()),
])

# The star-schema tables read by the registered queries.
STAR_SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Header CSV with quoted free text. Columns are bound by their header names.

    A quoted newline keeps a file from being split, so a big input should come as
    many files; set ``multi_line=False`` where texts hold no newlines.
    """
    return (
        spark.read.schema(schema)
        .csv(path, header=True, multiLine=multi_line, quote='"', escape='"', enforceSchema=False)
    )


def load_listing(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, LISTING_SCHEMA)


def load_sales(spark: SparkSession, path: str) -> DataFrame:
    return scan_csv(spark, path, SALES_SCHEMA)


def load_merged(spark: SparkSession, path: str) -> DataFrame:
    """The joined table, saved with the listing columns, then the sales columns."""
    fields = LISTING_SCHEMA.fields[:2] + [SALES_SCHEMA["copiesSold"]] + LISTING_SCHEMA.fields[2:] + [
        f for f in SALES_SCHEMA.fields if f.name not in ("steamId", "copiesSold")
    ]
    return scan_csv(spark, path, T.StructType(fields))


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet table; a given schema spares the job that reads footers to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet", STAR_SCHEMAS[name])
