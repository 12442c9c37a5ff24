"""The registered queries of this package and the SQL that some of them must match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import (
    count_rtree, cover_tree, fim, line_dedup, pfair, pivot_kmeans, quality_rules, role_repair, secret_scan, suffix_groups,
    toxicity, url_rules, winnowing,
)
from salescope.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query(r"""
    WITH rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    a AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
    u AS (SELECT page_id, url, rest IS NOT NULL AS ok,
                 coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                 [x FOR x IN string_split(regexp_extract(rest, '\?([^#]*)', 1), '&')
                    IF x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=&]*|ref|fbclid|gclid)(?:=|$)')] AS q FROM a),
    -- without redirects and canonical links, as in these pages, a class is what shares a plain form
    f AS (SELECT *, regexp_replace(host, '^(?:www|m)\.', '') AS ph, regexp_replace(path, '(?:/index)?\.html?$|/+$', '') AS pp,
                 CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END AS pq FROM u),
    nodes AS (SELECT ph, pp, pq, host, path FROM f WHERE ok UNION SELECT ph, pp, pq, ph, pp FROM f WHERE ok),
    voted AS (SELECT ph, pp, pq, host, path, arg_max(verdict, length(h || p)) AS v FROM nodes
              JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL),
    votes AS (SELECT ph, pp, pq, min(v) AS class_verdict FROM voted GROUP BY ALL),
    own AS (SELECT DISTINCT host, path FROM f),
    fits AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS v FROM own
             JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL)
    SELECT page_id, f.host, f.path, rule, coalesce(v, class_verdict, 'allow') AS verdict, rule IS NULL AND class_verdict IS NOT NULL AS by_alias
    FROM f LEFT JOIN fits ON f.host = fits.host AND f.path = fits.path
           LEFT JOIN votes ON ok AND f.ph = votes.ph AND f.pp = votes.pp AND f.pq = votes.pq
""")
def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


@query(r"""
    WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
    cum AS (SELECT source, CAST(floor(round(sum(sqrt(n)) OVER (ORDER BY source NULLS FIRST) / sum(sqrt(n)) OVER () * 1000, 6)) AS BIGINT) AS upto FROM c),
    parts AS (SELECT source, upto - coalesce(lag(upto) OVER (ORDER BY source NULLS FIRST), 0) + 1 AS parts,
                     row_number() OVER (ORDER BY source NULLS FIRST) AS i FROM cum),
    s AS (SELECT list(parts ORDER BY i) AS a, CAST(sum(parts) AS BIGINT) AS p FROM parts),
    sched AS (
      SELECT CAST(0 AS BIGINT) AS t, [CAST(0 AS BIGINT) FOR x IN a] AS done, CAST(0 AS BIGINT) AS pick, a, p FROM s
      UNION ALL
      SELECT t + 1, [CASE WHEN i = best THEN done[i] + 1 ELSE done[i] END FOR i IN range(1, len(a) + 1)], best, a, p
      FROM (SELECT *, list_sort([{'due': ((done[i] + 1) * p + a[i] - 1) // a[i], 'tight': CASE WHEN (done[i] + 1) * p % a[i] = 0 THEN 1 ELSE 0 END,
                                  'gap': p // a[i], 'i': i} FOR i IN range(1, len(a) + 1) IF done[i] * p < a[i] * (t + 1) AND done[i] < a[i]])[1].i AS best
            FROM sched WHERE t < p)),
    turns AS (SELECT pick, t - 1 AS slot, p, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM sched WHERE t > 0),
    r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS rank FROM documents)
    SELECT doc_id, r.source, rank // 16 + 1 AS block, (rank // 16) // parts * p + slot AS slot, rank % 16 AS place
    FROM r JOIN parts ON r.source IS NOT DISTINCT FROM parts.source JOIN turns ON pick = i AND turn = (rank // 16) % parts
""")
def op4_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair.mix_sources(docs)


@query(r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS g
           FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
    dw AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS g
           FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
    hit AS (SELECT doc_id, item_id, i, n FROM dw JOIN iw USING (n, g)),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
    names AS (SELECT doc_id, string_agg(s, ',' ORDER BY s) AS s, count(*) AS c
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(c, 0) AS n_items,
           sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
""")
def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query(r"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS p FROM documents),
    k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (f.key IS NULL), '')) AS kept_sha256
    FROM k LEFT JOIN f USING (key) GROUP BY doc_id
""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", sha256(F.col("base")).alias("base_sha256"), "spans")


@query(r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (SELECT doc_id, i, sha256(array_to_string(w[i + 1 : i + 35], ' ')) AS g
            FROM (SELECT doc_id, w, unnest(range(len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
    rep AS (SELECT doc_id, i FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM rep),
    word AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS p FROM d)
    SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN (
        SELECT word.doc_id, count(gone.p) AS n_removed,
               string_agg(x, ' ' ORDER BY word.p) FILTER (gone.p IS NULL) AS kept
        FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY 1) k USING (doc_id)
""")
def op10_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_groups.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return found.select("doc_id", "n_words", "n_removed", sha256(F.col("kept")).alias("kept_sha256"))


@query()
def op7_count_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = count_rtree.similar_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


@query(r"""
    WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
          FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.exact_top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score_documents(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@query()
def op6_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.repair_roles(read_table(spark, sf_dir, "conversations"))


def _quality_sql(max_false_rejection: float = 0.05, error: float = 0.05) -> str:
    """The base statistics, the ladder of rules and the certified level of each language in SQL."""
    broken = {
        level: " OR ".join(
            f"100 * {counted} {'>' if side == 'above' else '<'} {cutoffs[level - 1]} * {per}"
            for counted, per, side, cutoffs in quality_rules.RULES.values())
        for level in range(1, quality_rules.n_levels() + 1)
    }
    ladder = " ".join(f"WHEN {b} THEN {level}" for level, b in broken.items())
    levels = ", ".join(str(level) for level in broken)
    return rf"""
    WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    l AS (SELECT doc_id, x, x IS NOT NULL AND regexp_matches(x, '[^\x20\x09-\x0D]') AS ok FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)),
    lines AS (SELECT doc_id, count(*) AS n_word_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM l WHERE ok GROUP BY 1),
    win AS (SELECT doc_id, i, sha256(array_to_string(w[i + 1 : i + 8], ' ')) AS g
            FROM (SELECT doc_id, w, unnest(range(len(w) - 7)) AS i FROM d WHERE len(w) >= 8)),
    rep AS (SELECT doc_id, unnest(list(i)) AS i FROM win GROUP BY doc_id, g HAVING count(*) > 1),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY 1),
    m AS (SELECT doc_id, lang, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
                 len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words, len([x FOR x IN w IF NOT regexp_matches(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]')]) AS n_plain_words,
                 len(regexp_extract_all(t, '[A-Z]')) AS n_capitals, len(regexp_extract_all(t, '[A-Za-z]')) AS n_letters,
                 len(list_distinct(w)) AS n_distinct_words, coalesce(n_word_lines, 0) AS n_word_lines
          FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, CASE {ladder} END AS level FROM m),
    good AS (SELECT doc_id FROM labels GROUP BY 1 HAVING min(quality) = 1 AND max(quality) = 1),
    trials AS (SELECT lang, level FROM s WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
    n AS (SELECT lang, count(*) AS n, count(*) OVER () AS strata FROM trials GROUP BY 1),
    k AS (SELECT n.lang, n, strata, step, (SELECT count(*) FROM trials WHERE trials.lang IS NOT DISTINCT FROM n.lang AND level <= step) AS k
          FROM n, (SELECT unnest([{levels}]) AS step)),
    tail AS (SELECT lang, step, strata, CASE WHEN k >= n THEN 1.0 ELSE list_sum([exp(lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0)
                    + i * ln({max_false_rejection}) + (n - i) * ln(1 - {max_false_rejection})) FOR i IN range(0, k + 1)]) END AS p FROM k),
    c AS (SELECT lang, coalesce(min(CASE WHEN p > {error} / strata THEN step END) - 1, {max(broken)}) AS certified FROM tail GROUP BY 1)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT coalesce(level <= certified, FALSE) AS kept
    FROM s LEFT JOIN c ON s.lang IS NOT DISTINCT FROM c.lang
    """


@query(_quality_sql())
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _kmeans_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round as a pair of CTEs over exact integers held in doubles and sums in HUGEINT."""

    def assigned(step: int) -> str:
        return f"""a{step} AS (SELECT vec_id, v, c, d FROM (
            SELECT vec_id, v, c, CAST(list_dot_product(v, v) - 2 * list_dot_product(v, m) + list_dot_product(m, m) AS BIGINT) AS d,
                   row_number() OVER (PARTITION BY vec_id ORDER BY CAST(list_dot_product(v, v) - 2 * list_dot_product(v, m) + list_dot_product(m, m) AS BIGINT), c) AS r
            FROM e, c{step}) WHERE r = 1)"""

    steps = [f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS c, v AS m FROM e ORDER BY c LIMIT {k})"]
    for step in range(rounds):
        steps.append(assigned(step))
        steps.append(f"""c{step + 1} AS (SELECT c{step}.c, coalesce(n.m, c{step}.m) AS m FROM c{step} LEFT JOIN (
            SELECT c, list(floor(s / n) ORDER BY j) AS m FROM (
                SELECT c, j, CAST(sum(x) AS DOUBLE) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS j FROM a{step}) GROUP BY c, j) GROUP BY c) n
            ON n.c = c{step}.c)""")
    steps.append(assigned(rounds))
    return f"""
    WITH e AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
               WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    {', '.join(steps)}
    SELECT vec_id, CAST(a{rounds}.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN m], ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} ON a{rounds}.c = c{rounds}.c
    """


@query(_kmeans_sql())
def op12_pivot_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")).cast("binary"), 256)
    found = pivot_kmeans.with_inertia(pivot_kmeans.cluster(read_table(spark, sf_dir, "embeddings"), order))
    digest = sha256(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


@query(r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                      sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    g AS (SELECT *, len(u) AS n, [CAST('0x' || substr(h, i, 8) AS BIGINT) FOR i IN [1, 9, 17, 25]] AS r FROM d),
    c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS lo, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS hi,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
                      WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
    p AS (SELECT *, array_to_string(u[1 : lo], '') AS pre, array_to_string(u[lo + 1 : hi], '') AS mid, array_to_string(u[hi + 1 :], '') AS suf FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                            ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
""")
def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.transform(read_table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha256(F.col("output")).alias("output_sha256"),
        sha256(restored).alias("restored_sha256"))
