"""Sources, sinks and validation on literal tables."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from salescope.operators import relational as R
from salescope.operators.preprocess import LISTING, preprocess
from salescope.session import checkpoint_dir, new_table_path
from salescope.sources import readers, sinks


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    rows = [(1, 'say "hi", then\nleave'), (2, "  padded  "), (3, None), (4, "a,b"), (5, "back\\slash")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    sinks.sink_report(df, str(tmp_path / "r"))
    back = readers.scan_csv(spark, str(tmp_path / "r"), df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_segment_sink_prunes_partitions(spark, tmp_path):
    df = spark.range(100).withColumn("seg", F.col("id") % 3)
    sinks.sink_by_segment(df, str(tmp_path / "s"), "seg")
    one = readers.scan_parquet(spark, str(tmp_path / "s")).where("seg = 1")
    assert one.count() == 33
    assert "PartitionFilters: [isnotnull(seg" in one._jdf.queryExecution().executedPlan().toString()


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, label double")
    pipe = PipelineModel([VectorAssembler(inputCols=["x"], outputCol="features"),
                          LinearRegression().fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))])
    sinks.save_model(pipe, str(tmp_path / "m"))
    assert sinks.load_model(str(tmp_path / "m")).transform(df).first().prediction == pytest.approx(1.0, abs=1e-6)


def test_missing_column_raises_and_counts(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (2, 1.0)], "k int, t double")
    with pytest.raises(ValueError):
        R.validate_required(df, ["k", "absent"], "k", "t")
    row = R.validate_required(df, ["k", "t"], "k", "t", max_null_targets=0).first()
    assert (row.n_rows, row.null_targets, row.duplicate_keys, row.null_warning) == (3, 1, 1, 1)


def test_leakage_gate_drops_outcome_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4, 5)], "AppID int, Price double, Positive double, game_age int, release_year int")
    gate = dict(age_column="game_age", year_column="release_year")
    assert R.leakage_gate(df, LISTING.metadata, LISTING.post_outcome, **gate) == ["Price", "game_age", "release_year"]
    assert R.leakage_gate(df, LISTING.metadata, LISTING.post_outcome, use_year=False, post_release=True, **gate) == [
        "Price", "Positive", "game_age"]


def test_pipeline_runs_on_the_listing_layout(spark, tmp_path):
    listing = spark.createDataFrame([], readers.LISTING_SCHEMA)
    names = listing.columns
    rec = dict.fromkeys(names)
    rec.update({"AppID": 1, "Name": "One", "Price": 9.99, "Positive": 3, "Negative": 1, "Tags": "Indie,2D",
                "Genres": "Action,Indie", "Categories": "Online PvP", "Supported languages": "['English']",
                "Estimated owners": "0 - 20000", "About the game": "abc", "Windows": True, "Mac": False,
                "Linux": False, "DLC count": 0, "Required age": 0, "Achievements": 5, "Metacritic score": 0.0})
    listing = spark.createDataFrame([tuple(rec[n] for n in names)], readers.LISTING_SCHEMA)
    sales = spark.createDataFrame([(1, False, False, "2021-12-08T05:00:00.000Z", 100.0, 80.0, "Indie", "u")], readers.SALES_SCHEMA)
    merged = R.left_join_enrich(listing, sales, "AppID", "steamId", [c for c in sales.columns if c != "steamId"], "copiesSold")
    assert merged.columns[2] == "copiesSold" and len(merged.columns) == 47
    sinks.sink_report(merged, str(tmp_path / "merged"))
    back = readers.load_merged(spark, str(tmp_path / "merged"))
    row = preprocess(back, LISTING).first()
    assert (row.release_year, row.game_age, row.genre_indie, row.has_multiplayer, row.tag_2d) == (2021, 5, 1, 1, 1)
    assert row.publisher_class_ord == 1 and "Positive" not in row and "review_ratio" not in row
    assert preprocess(back, LISTING, post_release=True).first().review_ratio == 0.6


def test_checkpoint_folder_follows_the_session(spark):
    assert new_table_path(spark, "x").startswith(checkpoint_dir(spark))
    old = spark.conf.get("spark.checkpoint.dir", None)
    assert old is None or checkpoint_dir(spark) == old


def test_facts_are_read_once(spark, sf, monkeypatch):
    """All columns of the entity table come from one scan of each source, and cleaning reads it once."""
    from salescope.operators import preprocess as S
    from salescope.plans.entity import ALL_COLUMNS, entity_table
    from salescope.plans.registry import ENTITY

    df = entity_table(spark, sf, ALL_COLUMNS)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_partkey#") and plan.count("Relation [l_orderkey") == 1
    written = []
    inner = S.materialize

    def watched(table, name="table"):
        written.append((name, table._jdf.queryExecution().optimizedPlan().toString()))
        return inner(table, name)

    monkeypatch.setattr(S, "materialize", watched)
    out = S.preprocess(df, ENTITY)
    final = out._jdf.queryExecution().optimizedPlan().toString()
    assert [n for n, _ in written] == ["parsed", "frequencies"]
    assert [p.count("Relation [l_orderkey") for _, p in written] == [1, 0] and "Relation [l_orderkey" not in final
    assert "about" not in inner(df.limit(0), "x").drop("about").columns and "about" not in out.columns


def test_frequencies_of_columns_and_lists(spark):
    from salescope.operators.preprocess import by_frequency, value_frequencies
    df = spark.createDataFrame([("a", "x", ["p", "q"]), ("a", None, None), (None, "x", ["p"])], "s string, t string, l array<string>")
    counts = value_frequencies(df, ["s", "t"], {"l": F.col("l")})
    assert {(r["column"], r.value): r.n for r in counts.collect()} == {
        ("s", "a"): 2, ("s", "Unknown"): 1, ("t", "x"): 2, ("t", "Unknown"): 1, ("l", "p"): 2, ("l", "q"): 1}
    assert sorted(r.f for r in by_frequency(df, counts, "s", "f").collect()) == [1, 2, 2]
