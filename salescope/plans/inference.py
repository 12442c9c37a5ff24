"""Permutation and bootstrap queries; their SQL draws the same replicates in its own way."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from salescope.functions import parsing as P
from salescope.operators import inference as I
from salescope.operators import preprocess as S
from salescope.plans.entity import entity_table
from salescope.plans.features import launch_bundle
from salescope.plans.registry import ENTITY, pre_sql, query, rounded
from salescope.session import materialize

REPS = 10_000
COEF_REPS = 500
ALPHA = 0.05


def _rows(spark, sf, *more):
    """Key, log target, class, price kind, and the asked columns."""
    df = entity_table(spark, sf, ["entity_id", "copies_sold", "publisher_class", "price", *more])
    df = S.encode_class(df.where(F.col("copies_sold").isNotNull()), ENTITY)
    df = df.withColumn("is_free_to_play", P.flag(F.col("price") == 0))
    if "early_access" in more:
        df = df.withColumn("early_access", P.loose_bool(F.col("early_access")))
    if "genres" in more:
        df = S.parse_genres(df, ENTITY)
    return materialize(S.add_log_target(S.log_skewed(df, ENTITY), ENTITY), "rows")


def _reps_sql(n: int) -> str:
    return f", reps AS (SELECT unnest(range({n})) AS rep)"


_REPS_SQL = _reps_sql(REPS)

def _permuted_sql() -> str:
    """``places``: the place to which each replicate's Feistel permutation sends each row number."""
    steps, cols = "SELECT rep, i, t, n, a, b, pos // b AS l, pos % b AS r, t0, t1, t2, t3, t4, t5 FROM w JOIN tabs USING (rep) WHERE t = 0 OR pos >= n", \
        "rep, i, t, n, a, b, t0, t1, t2, t3, t4, t5"
    for j in range(I.ROUNDS):
        moved = f"(l + t{j}[r + 1]) % a AS l, r" if j % 2 == 0 else f"l, (r + t{j}[l + 1]) % b AS r"
        steps = f"SELECT {cols}, {moved} FROM ({steps})"
    lists = ", ".join(f"any_value(t) FILTER (j = {j}) AS t{j}" for j in range(I.ROUNDS))
    return f"""
  , size AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM basis)),
  tabs AS (SELECT rep, n, a, b, {lists} FROM (
    SELECT rep, j, n, a, b, list(('0x' || substr(md5('42:' || rep || ':' || j || ':' || x // 4), 1 + 8 * (x % 4), 8))::BIGINT % (CASE WHEN j % 2 = 0 THEN a ELSE b END) ORDER BY x) AS t
    FROM (SELECT *, unnest(range(CASE WHEN j % 2 = 0 THEN b ELSE a END)) AS x FROM reps, size, (SELECT unnest(range({I.ROUNDS})) AS j)) GROUP BY ALL) GROUP BY ALL),
  places AS (WITH RECURSIVE w AS (
      SELECT rep, i, i AS pos, 0 AS t FROM reps, (SELECT i FROM basis)
      UNION ALL SELECT rep, i, l * b + r, t + 1 FROM ({steps}))
    SELECT rep, i, pos FROM w, size WHERE t > 0 AND pos < n)"""


_VALUES = """
  , basis AS (SELECT log_copies_sold AS v, row_number() OVER (ORDER BY md5('42:base:' || entity_id)) - 1 AS i FROM pre)"""
_MEDIAN_SQL = pre_sql(_REPS_SQL + _VALUES + _permuted_sql() + f"""
  , k AS (SELECT count(*) FILTER (WHERE is_free_to_play = 1) AS n1,
      quantile_cont(log_copies_sold, 0.5) FILTER (WHERE is_free_to_play = 1)
      - quantile_cont(log_copies_sold, 0.5) FILTER (WHERE is_free_to_play = 0) AS obs FROM pre),
  shuffled AS (SELECT rep, v, pos + 1 AS rk FROM places JOIN basis USING (i)),
  nul AS (SELECT rep, quantile_cont(v, 0.5) FILTER (WHERE rk <= n1) - quantile_cont(v, 0.5) FILTER (WHERE rk > n1) AS stat
      FROM shuffled, k GROUP BY rep)
  SELECT 'median_diff' AS test, round(any_value(obs), 6) AS observed_stat,
    round(avg(CASE WHEN stat >= obs - 1e-9 THEN 1.0::DOUBLE ELSE 0 END), 6) AS p_value, CAST({REPS} AS INTEGER) AS n_permutations,
    {ALPHA}::DOUBLE AS alpha, CAST(avg(CASE WHEN stat >= obs - 1e-9 THEN 1.0::DOUBLE ELSE 0 END) < {ALPHA} AS INTEGER) AS reject
  FROM nul, k""")


def _median(spark, sf):
    return I.perm_median_diff(_rows(spark, sf), "entity_id", "is_free_to_play", "log_copies_sold", REPS)


@query("perm_median_diff", _MEDIAN_SQL)
def _(spark, sf):
    return rounded(_median(spark, sf))


_F_EXPR = """(sum(s * s / n) - any_value(tot) * any_value(tot) / any_value(nn)) / (count(*) - 1)
      / ((any_value(sq) - sum(s * s / n)) / (any_value(nn) - count(*)))"""
_ANOVA_SQL = pre_sql(_REPS_SQL + _VALUES + _permuted_sql() + f"""
  , g AS (SELECT publisher_class_ord AS c, count(*) AS n, sum(log_copies_sold) AS s FROM pre GROUP BY 1),
  ends AS (SELECT c, n, sum(n) OVER (ORDER BY c) AS hi, sum(n) OVER (ORDER BY c) - n AS lo FROM g),
  t AS (SELECT sum(log_copies_sold) AS tot, sum(log_copies_sold * log_copies_sold) AS sq, count(*) AS nn FROM pre),
  obs AS (SELECT {_F_EXPR} AS f FROM g, t),
  shuffled AS (SELECT rep, v, pos + 1 AS rk FROM places JOIN basis USING (i)),
  sums AS (SELECT rep, c, any_value(n) AS n, sum(v) AS s FROM shuffled JOIN ends ON rk > lo AND rk <= hi GROUP BY rep, c),
  nul AS (SELECT rep, {_F_EXPR} AS stat FROM sums, t GROUP BY rep)
  SELECT 'anova_f' AS test, round(any_value(f), 6) AS observed_stat,
    round(avg(CASE WHEN stat >= f - 1e-9 THEN 1.0::DOUBLE ELSE 0 END), 6) AS p_value, CAST({REPS} AS INTEGER) AS n_permutations,
    {ALPHA}::DOUBLE AS alpha, CAST(avg(CASE WHEN stat >= f - 1e-9 THEN 1.0::DOUBLE ELSE 0 END) < {ALPHA} AS INTEGER) AS reject
  FROM nul, obs""")


def _anova(spark, sf):
    return I.perm_anova_f(_rows(spark, sf), "entity_id", "publisher_class_ord", "log_copies_sold", REPS)


@query("perm_anova_f", _ANOVA_SQL)
def _(spark, sf):
    return rounded(_anova(spark, sf))


@query("anova_groups", pre_sql("""
  SELECT publisher_class_ord, count(*) AS n, round(quantile_cont(log_copies_sold, 0.5), 6) AS median FROM pre GROUP BY 1"""))
def _(spark, sf):
    return rounded(I.group_sizes(_rows(spark, sf), "publisher_class_ord", "log_copies_sold"))


def _residual_steps(source: str, columns: list[str], weight: str = "1", by: str = "") -> tuple[str, str]:
    """CTEs that make weighted columns mutually orthogonal, in order.

    The first column is the constant. Returns the CTE text and the last CTE's name.
    """
    over = f"OVER ({by})"
    text, prev = "", source
    for i, q in enumerate(columns[:-1]):
        cur = f"{source}_{i}"
        rest = ", ".join(
            f"{c} - {q} * (sum({weight} * {c} * {q}) {over}) / (sum({weight} * {q} * {q}) {over}) AS {c}" for c in columns[i + 1:])
        kept = ", ".join(c for c in columns[:i + 1])
        extra = "rep, w, y" if by else "entity_id, x, y"
        text += f", {cur} AS (SELECT {extra}, {kept}, {rest} FROM {prev})"
        prev = cur
    return text, prev


_CONTROLS = ["publisher_class_ord", "genre_building", "genre_machinery", "early_access"]
_Q = ["one", "c0", "c1", "c2", "c3"]


def _ols_sql(where: str, controls: list[str]) -> str:
    qs = _Q[: len(controls) + 1]
    steps, last = _residual_steps("start", qs)
    num = "sum(p * y) - " + " - ".join(f"sum(p * {q}) * any_value(y{q}) / any_value(n{q})" for q in qs)
    den = "sum(p * p) - " + " - ".join(f"sum(p * {q}) * sum(p * {q}) / any_value(n{q})" for q in qs)
    norms = ", ".join(f"sum({q} * {q}) OVER () AS n{q}, sum({q} * y) OVER () AS y{q}" for q in qs)
    return pre_sql(_REPS_SQL + f"""
  , start AS (SELECT entity_id, price AS x, log_copies_sold AS y, 1.0::DOUBLE AS one
      {''.join(f', CAST({c} AS DOUBLE) AS c{i}' for i, c in enumerate(controls))} FROM pre {where})
  {steps}, basis AS (SELECT *, row_number() OVER (ORDER BY md5('42:base:' || entity_id)) - 1 AS i, {norms} FROM {last}),
  obs AS (SELECT ({num.replace('p *', 'x *').replace('* p', '* x')}) / ({den.replace('p *', 'x *').replace('* p', '* x')}) AS b FROM basis),
  prices AS (SELECT x AS p, row_number() OVER (ORDER BY x) - 1 AS pos FROM basis)
  {_permuted_sql()},
  nul AS (SELECT rep, ({num}) / ({den}) AS stat FROM places JOIN basis USING (i) JOIN prices USING (pos) GROUP BY rep)
  SELECT 'price_coef' AS test, round(any_value(obs.b), 6) AS observed_stat,
    round(avg(CASE WHEN stat <= obs.b + 1e-9 THEN 1.0::DOUBLE ELSE 0 END), 6) AS p_value, CAST({REPS} AS INTEGER) AS n_permutations,
    {ALPHA}::DOUBLE AS alpha, CAST(avg(CASE WHEN stat <= obs.b + 1e-9 THEN 1.0::DOUBLE ELSE 0 END) < {ALPHA} AS INTEGER) AS reject
  FROM nul, obs""")


_COEF_SQL = _ols_sql("", [])


@query("perm_ols_coef", _COEF_SQL)
def _(spark, sf):
    return rounded(I.perm_ols_coef(_rows(spark, sf), "entity_id", "price", "log_copies_sold", [], REPS))


@query("perm_ols_coef_paid", _ols_sql("WHERE is_free_to_play = 0", _CONTROLS))
def _(spark, sf):
    paid = _rows(spark, sf, "genres", "early_access").where(F.col("is_free_to_play") == 0)
    return rounded(I.perm_ols_coef(paid, "entity_id", "price", "log_copies_sold", _CONTROLS, REPS))


def _uniform_sql(*parts: str) -> str:
    return f"(('0x' || substr(md5({" || ':' || ".join(parts)}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE"


#: Trials of the rejection sampler in SQL; one is accepted with a chance over two thirds.
_TRIALS = 60


def _resample_sql(name: str, where: str, seed: str) -> str:
    """Per replicate the middle of a resample: draws of the middle order statistic by rejection."""
    u, v, after = (_uniform_sql(f"'{seed}'", "rep", *x) for x in (("t", "0"), ("t", "1"), ("'next'",)))
    return f"""
  , {name}_v AS (SELECT log_copies_sold AS v, row_number() OVER (ORDER BY log_copies_sold, entity_id) - 1 AS i,
      count(*) OVER () AS n FROM pre WHERE {where}),
  {name}_p AS (SELECT n, a, n + 1 - a AS b, a::DOUBLE AS lesser, n + 1.0::DOUBLE AS total FROM (SELECT n, (n + 1) // 2 AS a FROM (SELECT any_value(n) AS n FROM {name}_v))),
  {name}_t AS (SELECT rep, t, n, a, b, total, {u} AS u, {v} AS w, sqrt((total - 2) / nullif(2.0::DOUBLE * a * b - total, 0)) AS slope FROM reps, {name}_p,
      (SELECT unnest(range({_TRIALS})) AS t)),
  {name}_o AS (SELECT *, slope * ln(u / (1 - u)) AS odds, a * exp(slope * ln(u / (1 - u))) AS x FROM {name}_t),
  {name}_u AS (SELECT rep, n, a, CASE WHEN any_value(a) = 1 THEN 1 - power(1 - arg_min(u, t), 1.0::DOUBLE / any_value(b))
        ELSE arg_min(x / (b + x), t) FILTER ((a + 1 / slope) * odds - ln(4.0::DOUBLE) + total * ln(total / (b + x)) >= ln(u * u * w)) END AS first
      FROM {name}_o GROUP BY rep, n, a),
  {name}_d AS (SELECT rep, unnest([least(CAST(floor(first * n) AS BIGINT), n - 1), least(CAST(floor(CASE WHEN n % 2 = 1 THEN first
        ELSE first + (1 - first) * (1 - power(1 - {after}, 1.0::DOUBLE / (n - a))) END * n) AS BIGINT), n - 1)]) AS j FROM {name}_u),
  {name} AS (SELECT rep, avg(v) AS m FROM {name}_d JOIN {name}_v ON j = i GROUP BY rep)"""


def _ci_select(a: str, b: str, la: str, lb: str) -> str:
    return (f"SELECT '{la}' AS group_a, '{lb}' AS group_b, round(quantile_cont({a}.m - {b}.m, 0.025), 6) AS ci_low, "
            f"round(quantile_cont({a}.m - {b}.m, 0.975), 6) AS ci_high FROM {a} JOIN {b} USING (rep)")


@query("bootstrap_median_ci", pre_sql(
    _REPS_SQL + _resample_sql("fa", "is_free_to_play = 1", "42:1") + _resample_sql("fb", "is_free_to_play = 0", "42:0")
    + _ci_select("fa", "fb", "1", "0")))
def _(spark, sf):
    return rounded(I.bootstrap_median_ci(_rows(spark, sf), "is_free_to_play", "log_copies_sold", 1, 0, REPS))


_CLASS_CODES = [-1, 0, 1, 2, 3]


@query("bootstrap_pairwise_ci", pre_sql(
    _REPS_SQL + "".join(_resample_sql(f"k{c + 1}", f"publisher_class_ord = {c}", f"42:{c}") for c in _CLASS_CODES)
    + " UNION ALL ".join(_ci_select(f"k{a + 1}", f"k{b + 1}", str(a), str(b)) for a, b in combinations(_CLASS_CODES, 2))))
def _(spark, sf):
    return rounded(I.bootstrap_pairwise_ci(
        _rows(spark, sf), "publisher_class_ord", "log_copies_sold", _CLASS_CODES, REPS))


_TRACK = ["price", "publisher_class_ord", "achievements"]


def _boot_sql() -> str:
    weight = " + ".join(f"CAST(u >= {c!r}::DOUBLE AS INTEGER)" for c in I.POISSON_CDF)
    text = _reps_sql(COEF_REPS) + f"""
  , u AS (SELECT rep, log_copies_sold AS y, {', '.join(f'CAST({c} AS DOUBLE) AS f{i}' for i, c in enumerate(_TRACK))},
      ('0x' || substr(md5('42:' || rep || ':' || entity_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM pre, reps),
  w AS (SELECT rep, y, 1.0::DOUBLE AS one, f0, f1, f2, {weight} AS w FROM u)"""
    picks = []
    for i, name in enumerate(_TRACK):
        order = ["one", *[f"f{j}" for j in range(len(_TRACK)) if j != i], f"f{i}"]
        text += f", t{i} AS (SELECT * FROM w WHERE w > 0)"
        steps, last = _residual_steps(f"t{i}", order, "w", "PARTITION BY rep")
        text += steps
        picks.append(f"SELECT '{name}' AS feature, rep, sum(w * y * f{i}) / sum(w * f{i} * f{i}) AS coef FROM {last} GROUP BY rep")
    return text + ", coefs AS (" + " UNION ALL ".join(picks) + """),
  s AS (SELECT feature, avg(coef) AS mean, stddev_pop(coef) AS sd, quantile_cont(coef, 0.025) AS lo, quantile_cont(coef, 0.975) AS hi
        FROM coefs GROUP BY feature),
  a AS (SELECT feature, avg(CASE WHEN sign(coef) = sign(mean) THEN 1.0::DOUBLE ELSE 0 END) * 100 AS pct FROM coefs JOIN s USING (feature) GROUP BY feature)
  SELECT feature, round(mean, 6) AS mean, round(sd, 6) AS std, round(pct, 6) AS sign_pct, round(lo, 6) AS ci_low, round(hi, 6) AS ci_high,
    CAST(pct >= 95 AND NOT (lo <= 0 AND hi >= 0) AS INTEGER) AS stable FROM s JOIN a USING (feature)"""


@query("bootstrap_coef_stability", pre_sql(_boot_sql()))
def _(spark, sf):
    return rounded(I.bootstrap_coef_stability(
        _rows(spark, sf, "achievements"), "entity_id", "log_copies_sold", _TRACK, n_rep=COEF_REPS))


@query("bootstrap_coef_all")
def _(spark, sf):
    """Every predictor of the launch-time matrix, refitted together in each replicate."""
    bundle = launch_bundle(spark, sf)
    data = bundle.data.select("entity_id", "label", *[F.col(f"z_{n}").alias(n) for n in bundle.names])
    return rounded(I.bootstrap_coef_stability(data, "entity_id", "label", bundle.names, n_rep=COEF_REPS), 4)


@query("inference_summary", "SELECT *, CAST(p_value < alpha / 3 AS INTEGER) AS reject_bonferroni FROM ("
    + " UNION ALL ".join(f"SELECT * FROM ({q})" for q in (_MEDIAN_SQL, _COEF_SQL, _ANOVA_SQL)) + ")")
def _(spark, sf):
    rows = _rows(spark, sf)
    tests = [
        I.perm_median_diff(rows, "entity_id", "is_free_to_play", "log_copies_sold", REPS),
        I.perm_ols_coef(rows, "entity_id", "price", "log_copies_sold", [], REPS),
        I.perm_anova_f(rows, "entity_id", "publisher_class_ord", "log_copies_sold", REPS),
    ]
    return rounded(I.inference_summary(tests))
