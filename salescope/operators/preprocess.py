"""The cleaning steps, one function per step, and the pipeline that chains them.

Each step is a projection (or one small join) over a lazy plan. The pipeline first
projects every row by itself, which leaves no long text, and writes that table once;
then one pass over it counts the tags, developers and publishers together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions import parsing as P
from salescope.functions import vocab
from salescope.operators.relational import drop_columns, filter_null_target
from salescope.session import materialize


@dataclass(frozen=True)
class CatalogConfig:
    """Column names and word lists of one catalogue layout."""

    key: str = "AppID"
    name: str = "Name"
    target: str = "copiesSold"
    log_target: str = "log_copies_sold"
    release: str = "firstReleaseDate"
    spare_release: str = "Release date"
    languages: str = "Supported languages"
    owners: str = "Estimated owners"
    genres: str = "Genres"
    categories: str = "Categories"
    tags: str = "Tags"
    positive: str = "Positive"
    negative: str = "Negative"
    price: str = "Price"
    platforms: tuple[str, ...] = ("Windows", "Mac", "Linux")
    about: str = "About the game"
    required_age: str = "Required age"
    dlc: str = "DLC count"
    early_access: str = "earlyAccess"
    score: str = "Metacritic score"
    publisher_class: str = "publisherClass"
    developer: str = "Developers"
    publisher: str = "Publishers"
    age: str = "game_age"
    score_flag: str = "has_metacritic"
    ref_year: int = 2026
    top_tags: int = 30
    genre_words: Sequence[str] = field(default_factory=lambda: list(vocab.GENRES))
    category_groups: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(vocab.CATEGORY_GROUPS))
    class_order: Mapping[str, int] = field(default_factory=lambda: dict(vocab.CLASS_ORDER))
    dropped: Sequence[str] = field(default_factory=lambda: list(vocab.DROPPED_COLUMNS))
    log_columns: Sequence[str] = field(default_factory=lambda: list(vocab.LOG1P_COLUMNS))
    post_outcome: Sequence[str] = field(default_factory=lambda: list(vocab.POST_OUTCOME_COLUMNS))
    binary_prefixes: tuple[str, ...] = vocab.BINARY_PREFIXES

    @property
    def metadata(self) -> list[str]:
        return [self.key, self.name, self.target, self.log_target, self.release, self.spare_release]


LISTING = CatalogConfig()


def parse_release(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    return df.withColumns(P.date_parts(F.col(c.release))).drop(c.release, c.spare_release)


def add_age(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    return df.withColumn(c.age, P.entity_age(F.col("release_year"), c.ref_year))


def parse_languages(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    return df.withColumn("language_count", P.list_string_count(F.col(c.languages))).drop(c.languages)


def parse_owners(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    return df.withColumn("estimated_owners_midpoint", P.range_midpoint(F.col(c.owners))).drop(c.owners)


def parse_genres(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    labelled = df.withColumn("__labels", P.split_labels(F.col(c.genres))).drop(c.genres)
    return labelled.withColumns(P.label_flags(F.col("__labels"), c.genre_words, "genre_")).drop("__labels")


def parse_categories(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    labelled = df.withColumn("__labels", P.split_labels(F.col(c.categories))).drop(c.categories)
    return labelled.withColumns(P.group_flags(F.col("__labels"), c.category_groups)).drop("__labels")


def top_tags(df: DataFrame, tags: str, n: int) -> DataFrame:
    """The ``n`` most frequent tags; ties go to the alphabetically first."""
    return (
        df.select(F.explode(P.tag_list(F.col(tags))).alias("tag"))
        .groupBy("tag").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "tag").limit(n)
    )


def tag_columns(df: DataFrame, chosen: Sequence[str], c: CatalogConfig = LISTING) -> DataFrame:
    listed = df.withColumn("__tags", P.tag_list(F.col(c.tags))).drop(c.tags)
    return listed.withColumns({
        "tag_count": F.size("__tags"), **P.tag_flags(F.col("__tags"), chosen)
    }).drop("__tags")


def parse_tags(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    return tag_columns(df, [r.tag for r in top_tags(df, c.tags, c.top_tags).collect()], c)


def derive_numeric(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    platforms = {p: P.loose_bool(F.col(p)) for p in c.platforms}
    return df.withColumns({
        **P.review_columns(F.col(c.positive), F.col(c.negative)),
        "is_free_to_play": P.flag(F.col(c.price) == 0),
        **platforms,
        "platform_count": sum(platforms.values(), F.lit(0)),
        "description_length": P.text_length(F.col(c.about)),
        "required_age_flag": P.positive_flag(F.col(c.required_age)),
        "has_dlc": P.positive_flag(F.col(c.dlc)),
        c.early_access: P.loose_bool(F.col(c.early_access)),
    }).drop(c.about)


def handle_score(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    return df.withColumns({
        c.score_flag: P.positive_flag(F.col(c.score)),
        c.score: F.coalesce(F.col(c.score).cast("double"), F.lit(0.0)),
    })


def encode_class(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    return df.withColumn(
        "publisher_class_ord", P.ordinal_code(F.col(c.publisher_class), c.class_order)
    ).drop(c.publisher_class)


def frequency_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Replace a category by its row count; nulls count together as "Unknown".

    Counted by a partial aggregate and joined back, so the group of unknowns never
    lands in one window partition; Catalyst picks broadcast or skew-split join by size.
    """
    filled = df.withColumn("__cat", F.coalesce(F.col(column), F.lit("Unknown")))
    freq = filled.groupBy(F.col("__cat").alias("__fcat")).agg(F.count("*").cast("int").alias(out))
    return filled.join(freq, F.col("__cat") == F.col("__fcat"), "left").drop("__cat", "__fcat", column)


def value_frequencies(df: DataFrame, columns: Sequence[str], lists: Mapping[str, Column] | None = None) -> DataFrame:
    """``(column, value, n)`` of several columns and list columns, counted in one pass.

    A null of a plain column counts as "Unknown"; list columns count each element.
    """
    plain = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias("value")) for c in columns])

    def elements(name: str, values: Column) -> Column:
        present = F.coalesce(values, F.array().cast("array<string>"))
        return F.transform(present, lambda v: F.struct(F.lit(name).alias("column"), v.alias("value")))

    more = [elements(name, x) for name, x in (lists or {}).items()]
    pairs = df.select(F.explode(F.concat(plain, *more)).alias("p")).select("p.*")
    return pairs.groupBy("column", "value").agg(F.count("*").cast("int").alias("n"))


def by_frequency(df: DataFrame, counts: DataFrame, column: str, out: str) -> DataFrame:
    """Replace a column of :func:`value_frequencies` by the frequency of its value."""
    mine = counts.where(F.col("column") == column).select(F.col("value").alias("__value"), F.col("n").alias(out))
    value = F.coalesce(F.col(column).cast("string"), F.lit("Unknown"))
    return df.join(mine, value == F.col("__value"), "left").drop("__value", column)


def encode_studios(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    counts = materialize(value_frequencies(df, [c.developer, c.publisher]), "frequencies")
    return by_frequency(by_frequency(df, counts, c.developer, "developer_freq"), counts, c.publisher, "publisher_freq")


def count_labels(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    """Tag flags and studio frequencies, from one count over the three columns."""
    counts = materialize(value_frequencies(df, [c.developer, c.publisher], {c.tags: P.tag_list(F.col(c.tags))}), "frequencies")
    top = counts.where(F.col("column") == c.tags).orderBy(F.desc("n"), "value").limit(c.top_tags)
    df = tag_columns(df, [r.value for r in top.collect()], c)
    return by_frequency(by_frequency(df, counts, c.developer, "developer_freq"), counts, c.publisher, "publisher_freq")


def log_skewed(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    present = [x for x in c.log_columns if x in df.columns]
    return df.withColumns({x: P.log1p_floor(F.col(x)) for x in present})


def add_log_target(df: DataFrame, c: CatalogConfig = LISTING) -> DataFrame:
    return df.withColumn(c.log_target, F.log1p(F.col(c.target).cast("double")))


def preprocess(df: DataFrame, c: CatalogConfig = LISTING, *, post_release: bool = False) -> DataFrame:
    """All steps; launch-time framing ends by dropping outcome-time columns.

    The sources behind ``df`` are read once, by the write of the projected rows.
    """
    df = drop_columns(df, c.dropped)
    df = filter_null_target(df, c.target)
    for step in (parse_release, add_age, parse_languages, parse_owners, parse_genres,
                 parse_categories, derive_numeric, handle_score, encode_class, log_skewed, add_log_target):
        df = df.transform(step, c)
    df = count_labels(materialize(df, "parsed"), c)
    return df if post_release else drop_columns(df, c.post_outcome)
