import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from martloom.operators import clustering as cl


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(11)
    middles = [(0, 0, 0), (6, 0, 1), (0, 7, 2), (8, 8, 8), (-5, 3, 9)]
    rows = []
    for i in range(1200):
        m = middles[i % 5] if i % 3 else middles[0]  # a third and more around one place
        rows.append((i, [c + rng.gauss(0, 1.2) for c in m]))
    return spark.createDataFrame(rows, "id long, x array<double>").repartition(3).cache()


def test_least_cost_is_that_of_separate_fits(blobs):
    vectors = blobs.select(array_to_vector("x").alias("features")).cache()
    fits = cl.fit_all(cl.points(blobs, "id", F.col("x")), [2, 4, 5], 8, seed=1)
    assert [(f.k, f.start) for f in fits] == [(k, i) for k in (2, 4, 5) for i in range(8)]
    for k in (2, 4, 5):
        alone = min(KMeans(k=k, seed=s, maxIter=300).fit(vectors).summary.trainingCost for s in range(8))
        assert min(f.cost for f in fits if f.k == k) <= alone * 1.001


def test_a_fit_is_a_fixed_point(blobs):
    x = np.array([r.x for r in blobs.collect()])
    for f in cl.fit_all(cl.points(blobs, "id", F.col("x")), [3, 5], 2, seed=4, tolerance=1e-9):
        away = ((x[:, None] - f.centres[None]) ** 2).sum(axis=2)
        near = away.argmin(axis=1)
        assert f.cost == pytest.approx(away.min(axis=1).sum()) and list(f.sizes) == list(np.bincount(near, minlength=f.k))
        assert np.allclose(f.centres, [x[near == j].mean(axis=0) for j in range(f.k)], atol=1e-6)


def test_jobs_do_not_grow_with_the_starts(spark, blobs):
    context, rows = spark.sparkContext, cl.points(blobs, "id", F.col("x"))
    jobs = []
    for starts in (1, 12):
        group = f"starts-{starts}"
        context.setJobGroup(group, group)
        cl.fit_all(rows, [2, 3, 4], starts, rounds=3, tolerance=0.0)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(group)))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_draws_repeat_whatever_the_partitions(blobs):
    a = cl._drawn(cl.points(blobs, "id", F.col("x")), [None, np.zeros((1, 3))], 7, 5)
    b = cl._drawn(cl.points(blobs.repartition(5), "id", F.col("x")), [None, np.zeros((1, 3))], 7, 5)
    assert all(len(p) == 7 and np.array_equal(p, q) for p, q in zip(a, b))


def test_far_rows_are_drawn_more_often(spark):
    df = spark.range(2000).select("id", F.array(F.when(F.col("id") < 1900, 1.0).otherwise(10.0)).alias("x"))
    found = cl._drawn(cl.points(df, "id", F.col("x")), [np.zeros((1, 1))] * 20, 10, 9)
    share = np.mean([(c == 10.0).mean() for c in found])  # weights 1,900 and 10,000
    assert 0.74 < share < 0.94


def test_fewer_points_than_centres_and_none(spark):
    few = spark.createDataFrame([(i, [float(i % 2), 0.0]) for i in range(30)], "id long, x array<double>")
    (fit,) = cl.fit_all(cl.points(few, "id", F.col("x")), [4], 1)
    assert sorted(map(tuple, fit.centres)) == [(0.0, 0.0), (1.0, 0.0)] and fit.cost == 0.0 and list(fit.sizes) == [15, 15]
    with pytest.raises(ValueError):
        cl.fit_all(cl.points(few.limit(0), "id", F.col("x")), [2], 1)


def test_nearest_takes_the_smaller_of_equals(spark):
    df = spark.createDataFrame([([0.0, 1.0],), ([4.0, 0.0],), ([2.0, 0.0],)], "x array<double>")
    got = df.select("x", cl.nearest(F.col("x"), np.array([[0.0, 0.0], [4.0, 0.0]])).alias("n")).collect()
    assert [r.n for r in got] == [0, 1, 0]


def test_packed_rows_are_the_same_rows(blobs):
    rows = cl.points(blobs, "id", F.col("x"))
    sets = [np.zeros((1, 3)), np.array([[0.0, 0, 0], [6, 0, 1], [6, 0, 1]]), np.array([[8.0, 8, 8], [0, 7, 2], [-5, 3, 9]])]
    x = np.array([r.x for r in blobs.collect()])
    kept = cl.packed(rows)
    assert kept.count() <= 3 < rows.count()
    for merge in (True, False):
        for c, (n, sums, cost) in zip(sets, cl._totals(kept, sets, merge)):
            away = ((x[:, None] - c[None]) ** 2).sum(axis=2)
            near = away.argmin(axis=1)  # the smaller of equals
            assert list(n) == list(np.bincount(near, minlength=len(c))) and cost == pytest.approx(away.min(axis=1).sum())
            assert np.allclose(sums, [x[near == j].sum(axis=0) for j in range(len(c))])
    assert all(np.array_equal(p, q) for p, q in zip(cl._drawn(rows, sets, 5, 1), cl._drawn(kept, sets, 5, 1)))


def test_a_round_is_one_job(spark, blobs):
    context, rows = spark.sparkContext, cl.packed(cl.points(blobs, "id", F.col("x"))).cache()
    rows.count()
    context.setJobGroup("round", "round")
    cl._totals(rows, [np.zeros((2, 3))] * 5, merge=False)
    jobs = context.statusTracker().getJobIdsForGroup("round")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
