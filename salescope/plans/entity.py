"""The entity table: one row per part of the star schema, shaped like a catalogue.

The same rules are stated once as Spark plans and once as SQL. Nulls, bad dates
and multi-label text come from arithmetic on the key, so every null rule of the
library meets real rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.sources.readers import read_table

_LINE_COLUMNS = {"copies_sold", "positive", "negative", "achievements", "estimated_owners"}

_SQL = """
WITH li AS (
  SELECT l_partkey, sum(l_quantity) AS qty, count(*) AS n_lines,
         count(*) FILTER (WHERE l_returnflag = 'N') AS pos,
         count(*) FILTER (WHERE l_returnflag = 'R') AS neg
  FROM lineitem GROUP BY l_partkey
), cat_counts AS (
  SELECT l_partkey, l_returnflag || '-' || l_linestatus AS label, count(*) AS c FROM lineitem GROUP BY 1, 2
), cat AS (
  SELECT l_partkey, string_agg(label, ',' ORDER BY label) AS categories
  FROM (SELECT *, sum(c) OVER (PARTITION BY l_partkey) AS lines FROM cat_counts) WHERE c * 4 >= lines GROUP BY l_partkey
), seg_counts AS (
  SELECT l_partkey, c_mktsegment AS label, count(*) AS c
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
), seg AS (
  SELECT l_partkey, string_agg(label, ',' ORDER BY label) AS genres
  FROM (SELECT *, sum(c) OVER (PARTITION BY l_partkey) AS lines FROM seg_counts) WHERE c * 5 >= lines GROUP BY l_partkey
), base AS (
  SELECT p.*, li.qty, li.n_lines, li.pos, li.neg, cat.categories, seg.genres, d.text AS about,
         CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE
           CAST(floor(exp((p_partkey * 7919 % 1000) / 125.0::DOUBLE
             + 2 * (CASE WHEN p_size = 49 THEN 3 WHEN p_size = 48 THEN 2
                         WHEN p_size BETWEEN 29 AND 47 THEN 1 ELSE 0 END)
             + li.qty / 1000.0::DOUBLE)) AS BIGINT) END AS copies_sold
  FROM part p LEFT JOIN li ON p_partkey = li.l_partkey
  LEFT JOIN cat ON p_partkey = cat.l_partkey
  LEFT JOIN seg ON p_partkey = seg.l_partkey
  LEFT JOIN documents d ON d.doc_id = p_partkey
), entity AS (
  SELECT p_partkey AS entity_id, p_name AS name,
    CASE WHEN p_type = 'PROMO' THEN 0.0::DOUBLE
         ELSE round((p_retailprice - 900.0::DOUBLE) * 0.6::DOUBLE, 2) END AS price,
    CASE WHEN p_size <= 28 THEN 'Hobbyist' WHEN p_size <= 47 THEN 'Indie'
         WHEN p_size = 48 THEN 'AA' WHEN p_size = 49 THEN 'AAA' END AS publisher_class,
    nullif(p_brand, 'Brand#1') AS developer, nullif(p_type, 'SMALL') AS publisher,
    CASE WHEN p_partkey % 7 <> 0 THEN replace(p_name, ' ', ',') END AS tags,
    CASE WHEN p_partkey % 11 <> 0 THEN '[''' || replace(p_name, ' ', ''', ''') || ''']' END AS languages,
    genres, categories, copies_sold,
    CASE WHEN p_partkey % 53 = 0 THEN 'bad-date'
         ELSE strftime(DATE '1995-01-01' + CAST(p_partkey * 37 % 2500 AS INTEGER), '%Y-%m-%dT05:00:00.000Z')
    END AS first_release,
    CASE WHEN p_partkey % 13 <> 0 THEN pos END AS positive, neg AS negative, about,
    CASE WHEN p_size % 4 = 0 THEN 18 ELSE 0 END AS required_age,
    TRUE AS windows, p_partkey % 5 = 0 AS mac, p_partkey % 7 = 0 AS linux,
    CASE WHEN p_partkey % 17 <> 0 THEN p_partkey % 10 = 0 END AS early_access,
    p_partkey % 3 AS dlc_count, n_lines AS achievements,
    CASE WHEN p_partkey % 19 <> 0 THEN CASE WHEN p_size >= 48 THEN p_size * 2 ELSE 0 END END AS score,
    CASE WHEN copies_sold IS NULL THEN NULL WHEN copies_sold < 500 THEN '0 - 0'
         ELSE (copies_sold // 500 * 500) || ' - ' || (copies_sold // 500 * 500 + 500) END AS estimated_owners
  FROM base
)
"""

REF_YEAR = 2000


def _label_text(counts: str, total: Column, least: int) -> Column:
    """Labels that at least one in ``least`` of a part's lines has, as sorted comma text, from (label, n) pairs."""
    pairs = F.col(counts)

    def rows_of(label: Column) -> Column:
        return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda n, p: n + F.when(p["label"] == label, p["n"]).otherwise(0))

    labels = F.array_compact(F.array_distinct(F.transform(pairs, lambda p: p["label"])))
    kept = F.array_sort(F.filter(labels, lambda x: rows_of(x) * least >= total))
    return F.when(F.size(kept) > 0, F.array_join(kept, ","))


def _line_facts(spark: SparkSession, sf_dir: str, genres: bool) -> DataFrame:
    """All that a part takes from its lines, from one scan of them.

    Lines are first counted per part and category and per part and segment, on the map
    side, so the lists of a part hold at most the two label vocabularies however many lines
    it has. The segment is joined to the orders before the lines, which are thus moved once.
    """
    lines = read_table(spark, sf_dir, "lineitem")
    segment = F.lit(None).cast("string")
    if genres:
        orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_mktsegment")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
        segment = F.col("c_mktsegment")
    keys = ["l_partkey", "l_returnflag", "l_linestatus", "segment"]
    sets = [["l_partkey", "l_returnflag", "l_linestatus"], *([["l_partkey", "segment"]] if genres else [])]
    counts = lines.select(*keys[:3], segment.alias("segment"), "l_quantity").groupingSets(sets, *keys).agg(
        (F.grouping("segment") == 1).alias("is_category"), F.sum("l_quantity").alias("qty"), F.count("*").alias("n"))
    category = F.concat_ws("-", "l_returnflag", "l_linestatus")

    def pairs(own: Column, label: Column) -> Column:
        return F.collect_list(F.when(own, F.struct(label.alias("label"), "n")))

    of_category = F.col("is_category")
    facts = counts.groupBy("l_partkey").agg(
        F.sum(F.when(of_category, F.col("qty"))).alias("qty"), F.sum(F.when(of_category, F.col("n"))).alias("n_lines"),
        F.coalesce(F.sum(F.when(F.col("l_returnflag") == "N", F.col("n"))), F.lit(0)).alias("pos"),
        F.coalesce(F.sum(F.when(F.col("l_returnflag") == "R", F.col("n"))), F.lit(0)).alias("neg"),
        pairs(of_category, category).alias("category_counts"), pairs(~of_category, F.col("segment")).alias("segment_counts"),
        F.sum(F.when(F.col("segment").isNotNull(), F.col("n"))).alias("segment_lines"),
    )
    return facts.select(
        "l_partkey", "qty", "n_lines", "pos", "neg", _label_text("category_counts", F.col("n_lines"), 4).alias("categories"),
        _label_text("segment_counts", F.col("segment_lines"), 5).alias("genres"))


def entity_table(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """Build only the requested columns, joining only the sources they need."""
    columns = list(columns)
    need = set(columns)
    df = read_table(spark, sf_dir, "part")

    if need & (_LINE_COLUMNS | {"categories", "genres"}):
        facts = _line_facts(spark, sf_dir, "genres" in need)
        df = df.join(facts, df.p_partkey == facts.l_partkey, "left").drop("l_partkey")
    if "about" in need:
        docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("about"))
        df = df.join(docs, df.p_partkey == docs.doc_id, "left").drop("doc_id")

    k, size = F.col("p_partkey"), F.col("p_size")
    class_ord = F.when(size == 49, 3).when(size == 48, 2).when(size.between(29, 47), 1).otherwise(0)
    if need & {"copies_sold", "estimated_owners"}:
        df = df.withColumn("copies_sold", F.when(
            k % 97 != 0,
            F.floor(F.exp((k * 7919 % 1000) / F.lit(125.0) + 2 * class_ord + F.col("qty") / 1000.0)),
        ).cast("bigint"))
    sold = F.col("copies_sold")
    floor500 = F.expr("copies_sold div 500 * 500")
    rules = {
        "entity_id": lambda: k,
        "name": lambda: F.col("p_name"),
        "price": lambda: F.when(F.col("p_type") == "PROMO", 0.0)
            .otherwise(F.round((F.col("p_retailprice") - 900.0) * 0.6, 2)),
        "publisher_class": lambda: F.when(size <= 28, "Hobbyist").when(size <= 47, "Indie")
            .when(size == 48, "AA").when(size == 49, "AAA"),
        "developer": lambda: F.nullif(F.col("p_brand"), F.lit("Brand#1")),
        "publisher": lambda: F.nullif(F.col("p_type"), F.lit("SMALL")),
        "tags": lambda: F.when(k % 7 != 0, F.replace(F.col("p_name"), F.lit(" "), F.lit(","))),
        "languages": lambda: F.when(k % 11 != 0, F.concat(
            F.lit("['"), F.replace(F.col("p_name"), F.lit(" "), F.lit("', '")), F.lit("']"))),
        "genres": lambda: F.col("genres"),
        "categories": lambda: F.col("categories"),
        "copies_sold": lambda: sold,
        "first_release": lambda: F.when(k % 53 == 0, "bad-date").otherwise(F.concat(
            F.date_add(F.lit("1995-01-01").cast("date"), (k * 37 % 2500).cast("int")).cast("string"),
            F.lit("T05:00:00.000Z"))),
        "positive": lambda: F.when(k % 13 != 0, F.col("pos")),
        "negative": lambda: F.col("neg"),
        "about": lambda: F.col("about"),
        "required_age": lambda: F.when(size % 4 == 0, 18).otherwise(0),
        "windows": lambda: F.lit(True),
        "mac": lambda: k % 5 == 0,
        "linux": lambda: k % 7 == 0,
        "early_access": lambda: F.when(k % 17 != 0, k % 10 == 0),
        "dlc_count": lambda: k % 3,
        "achievements": lambda: F.col("n_lines"),
        "score": lambda: F.when(k % 19 != 0, F.when(size >= 48, size * 2).otherwise(0)),
        "estimated_owners": lambda: F.when(sold < 500, "0 - 0").when(sold.isNotNull(), F.concat(
            floor500.cast("string"), F.lit(" - "), (floor500 + 500).cast("string"))),
    }
    return df.select(*[rules[c]().alias(c) for c in columns])


ALL_COLUMNS = [
    "entity_id", "name", "price", "publisher_class", "developer", "publisher", "tags",
    "languages", "genres", "categories", "copies_sold", "first_release", "positive",
    "negative", "about", "required_age", "windows", "mac", "linux", "early_access",
    "dlc_count", "achievements", "score", "estimated_owners",
]


def entity_sql(body: str) -> str:
    """A query over the ``entity`` view for the SQL side."""
    return _SQL + body
