"""Independent fits run side by side, and the line facts move the lines once."""

import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from salescope.operators import boosting as B
from salescope.operators import selection as X
from salescope.operators import trees as T
from salescope.operators.features import assemble_features
from salescope.plans import entity


@pytest.fixture(scope="module")
def bundle(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    df = spark.createDataFrame([(i, *map(float, r), float(3 * r[0] + r[1])) for i, r in enumerate(x)],
                               "id int, a double, b double, c double, y double")
    return assemble_features(df, ["a", "b", "c"], "id", "y", stratum=None, prefixes=("is_",))


def meeting(parties, make):
    """``make`` whose first call in each of ``parties`` threads waits for the others."""
    barrier, met = threading.Barrier(parties, timeout=60), threading.local()

    def made():
        if not getattr(met, "seen", False):
            met.seen = True
            barrier.wait()
        return make()

    return made


def test_folds_are_eliminated_at_once(bundle):
    make = lambda: T.random_forest(trees=2, depth=2)
    both, calls = meeting(3, make), []

    def counted():
        calls.append(threading.get_ident())
        return both() if len(set(calls)) <= 3 and calls[-1] != threading.main_thread().ident else make()

    table, ranking = X.rfe_cv(bundle, "id", counted, min_features=1, step=1)
    assert len(set(calls) - {threading.main_thread().ident}) == 3
    assert [r.n_features for r in table.collect()] == [1, 2, 3] and ranking.count() == 3


def test_arms_are_fitted_at_once(bundle):
    make = meeting(2, lambda: {"forest": T.random_forest(trees=2, depth=2)})
    out = T.feature_toggle_ab(bundle, {"no_b": ["b"], "no_c": ["c"]}, make).collect()
    assert {(r.arm, r.n_features) for r in out} == {("no_b", 2), ("no_c", 2)}


def test_losses_of_several_rounds_are_taken_in_one_pass(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(a), float(a > 0) + float(e), i % 3 == 0) for i, (a, e) in enumerate(rng.normal(size=(300, 2)))],
                               "a double, y double, v boolean")
    data = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    train, val = data.where("not v"), data.where("v")

    def jobs(group, patience):
        spark.sparkContext.setJobGroup(group, group)
        try:
            curve = B.newton_boost(train, val, B.pseudo_huber(), "y", iterations=9, rate=1.0, depth=3, subsample=1.0, column_share=1.0,
                                   patience=patience).curve.collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return curve, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    full, few = jobs("boost-late", 9)
    each, many = jobs("boost-early", 1)
    best = int(np.argmin([r.val_loss for r in full]))
    stop = next(i for i in range(1, 9) if min(range(i + 1), key=lambda j: full[j].val_loss) < i)
    assert [(r.train_loss, r.val_loss) for r in each] == [pytest.approx((r.train_loss, r.val_loss)) for r in full[: stop + 1]]
    assert len(full) == 9 and full[best].is_best
    assert few / len(full) < many / len(each)


def _tables(spark, path):
    lines = [(o, p, float(q), f, s) for o, p, q, f, s in [
        (1, 1, 2, "N", "O"), (1, 1, 3, "N", "O"), (2, 1, 5, "R", "F"), (3, 1, 7, "R", None), (4, 1, 1, None, None),
        (1, 2, 4, "A", "F"), (None, 2, 6, "N", "O"), (9, 2, 8, "N", "F"), (1, None, 9, "N", "O"), (5, 3, 1, "N", "O")]]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double, l_returnflag string, l_linestatus string") \
        .write.parquet(f"{path}/lineitem.parquet")
    # order 2 comes twice, order 4 has no customer, customer 30 no segment
    spark.createDataFrame([(1, 10), (2, 20), (2, 20), (3, 30), (4, None), (5, 10)], "o_orderkey long, o_custkey long") \
        .write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(10, "BUILDING"), (20, "AUTO"), (30, None)], "c_custkey long, c_mktsegment string") \
        .write.parquet(f"{path}/customer.parquet")


def test_line_facts(spark, tmp_path):
    _tables(spark, str(tmp_path))
    got = {r.l_partkey: r for r in entity._line_facts(spark, str(tmp_path), True).collect()}
    assert (got[1].qty, got[1].n_lines, got[1].pos, got[1].neg) == (23.0, 6, 2, 3)
    assert (got[1].categories, got[1].genres) == ("N-O,R-F", "AUTO,BUILDING")
    assert (got[2].qty, got[2].n_lines, got[2].categories, got[2].genres) == (18.0, 3, "A-F,N-F,N-O", "BUILDING")
    plain = {r.l_partkey: r for r in entity._line_facts(spark, str(tmp_path), False).collect()}
    assert (plain[1].qty, plain[1].n_lines, plain[1].genres) == (18.0, 5, None) and plain[3].categories == "N-O"


def test_lines_are_not_moved_for_the_customers(spark, tmp_path):
    _tables(spark, str(tmp_path))
    plan = entity._line_facts(spark, str(tmp_path), True)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(plan) if "Join" in x and "c_custkey" in x)
    depth = len(plan[at]) - len(plan[at].lstrip(" :+-"))
    below = []
    for x in plan[at + 1:]:
        if len(x) - len(x.lstrip(" :+-")) <= depth:
            break
        below.append(x)
    assert below and not any("l_orderkey" in x for x in below)
