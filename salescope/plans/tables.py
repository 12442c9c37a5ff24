"""Source, sink, join and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.operators import relational as R
from salescope.operators.preprocess import encode_class, preprocess
from salescope.plans.entity import ALL_COLUMNS, entity_sql, entity_table
from salescope.plans.registry import ENTITY, LINE_GROUPS, SEGMENT_WORDS, pre_sql, query, rounded
from salescope.session import new_table_path
from salescope.sources.readers import read_table, scan_csv, scan_parquet
from salescope.sources.sinks import sink_by_segment, sink_parquet, sink_report

_LAUNCH_INTS = [
    "entity_id", "copies_sold", "release_year", "release_month", "release_quarter", "entity_age",
    "language_count", *["genre_" + g.lower() for g in SEGMENT_WORDS], *LINE_GROUPS, "tag_count",
    "is_free_to_play", "windows", "mac", "linux", "platform_count", "description_length",
    "required_age", "required_age_flag", "has_dlc", "early_access", "publisher_class_ord",
    "developer_freq", "publisher_freq",
]
_LAUNCH_DOUBLES = ["price", "dlc_count", "achievements", "log_copies_sold"]
LAUNCH_COLUMNS = [*_LAUNCH_INTS, "name", *_LAUNCH_DOUBLES]
LAUNCH_SELECT = ", ".join([*_LAUNCH_INTS, "name", *[f"round({c}, 6) AS {c}" for c in _LAUNCH_DOUBLES]])


@query("scan_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark, sf):
    docs = read_table(spark, sf, "documents")
    path = new_table_path(spark, "documents-csv")
    sink_report(docs, path)
    return scan_csv(spark, path, docs.schema)


@query("scan_parquet", "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'")
def _(spark, sf):
    return scan_parquet(spark, f"{sf}/lineitem.parquet").where(
        F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")
    )


@query("sink_parquet", entity_sql("SELECT * FROM entity"))
def _(spark, sf):
    path = new_table_path(spark, "processed")
    sink_parquet(entity_table(spark, sf, ALL_COLUMNS), path)
    return scan_parquet(spark, path)


@query("sink_by_segment", pre_sql(
    "SELECT entity_id, copies_sold, publisher_class_ord FROM flagged WHERE publisher_class_ord IN (0, 2)"))
def _(spark, sf):
    path = new_table_path(spark, "segments")
    coded = R.filter_null_target(entity_table(spark, sf, ["entity_id", "copies_sold", "publisher_class"]), "copies_sold")
    sink_by_segment(encode_class(coded, ENTITY), path, "publisher_class_ord")
    return scan_parquet(spark, path).where(F.col("publisher_class_ord").isin(0, 2))


@query("sink_report", """
  SELECT p_brand, p_type, count(*) AS n_parts, round(avg(p_retailprice), 6) AS mean_price
  FROM part GROUP BY p_brand, p_type""")
def _(spark, sf):
    report = rounded(read_table(spark, sf, "part").groupBy("p_brand", "p_type").agg(
        F.count("*").alias("n_parts"), F.avg("p_retailprice").alias("mean_price")))
    path = new_table_path(spark, "report")
    sink_report(report, path)
    return scan_csv(spark, path, report.schema, multi_line=False)


@query("left_join_enrich", """
  SELECT p_partkey, p_name, n_chars, p_brand, p_type, p_size, p_retailprice, lang, source
  FROM part LEFT JOIN documents ON p_partkey = doc_id""")
def _(spark, sf):
    return R.left_join_enrich(
        read_table(spark, sf, "part"), read_table(spark, sf, "documents"),
        "p_partkey", "doc_id", ["lang", "source", "n_chars"], third="n_chars",
    )


@query("join_match_audit", """
  SELECT (SELECT count(*) FROM part) AS left_rows, (SELECT count(*) FROM documents) AS right_rows,
         count(*) AS merged_rows, count(doc_id) AS matched_rows, count(*) - count(doc_id) AS unmatched_rows
  FROM part LEFT JOIN documents ON p_partkey = doc_id""")
def _(spark, sf):
    docs = read_table(spark, sf, "documents").withColumn("present", F.lit(1))
    return R.join_match_audit(read_table(spark, sf, "part"), docs, "p_partkey", "doc_id", "present")


@query("validate_required", entity_sql("""
  SELECT count(*) AS n_rows, count(*) FILTER (WHERE copies_sold IS NULL) AS null_targets,
         count(*) - count(DISTINCT entity_id) AS duplicate_keys,
         CAST(count(*) FILTER (WHERE copies_sold IS NULL) > 50 AS INTEGER) AS null_warning
  FROM entity"""))
def _(spark, sf):
    df = entity_table(spark, sf, ["entity_id", "name", "copies_sold"])
    return R.validate_required(df, ["entity_id", "name", "copies_sold"], "entity_id", "copies_sold")


@query("drop_columns", "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem")
def _(spark, sf):
    return R.drop_columns(read_table(spark, sf, "lineitem"), [
        "l_suppkey", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "not_there"])


@query("filter_null_target", entity_sql("SELECT entity_id, copies_sold FROM entity WHERE copies_sold IS NOT NULL"))
def _(spark, sf):
    return R.filter_null_target(entity_table(spark, sf, ["entity_id", "copies_sold"]), "copies_sold")


@query("leakage_gate", pre_sql(
    "SELECT " + LAUNCH_SELECT.replace("entity_id, copies_sold, release_year, ", "")
    .replace(" name,", "").replace(", round(log_copies_sold, 6) AS log_copies_sold", "") + " FROM pre"))
def _(spark, sf):
    cleaned = preprocess(entity_table(spark, sf, ALL_COLUMNS), ENTITY, post_release=True)
    names = R.leakage_gate(cleaned, ENTITY.metadata, ENTITY.post_outcome, age_column="entity_age",
                           year_column="release_year", use_year=False)
    chosen_tags = [c for c in names if c.startswith("tag_") and c != "tag_count"]
    return rounded(cleaned.select(*[c for c in names if c not in chosen_tags]))
