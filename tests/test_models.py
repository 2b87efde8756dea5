"""The node table, the batched k-means and the Silver plans, each against a plain version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens import schemas
from bazaarlens.plans import clusters, isolation, silver

COLUMNS = [f"f{i}" for i in range(3)]


@pytest.fixture(scope="module")
def points(spark):
    values = [(F.pmod(F.hash("id", F.lit(i)), F.lit(1000)) / 100.0).alias(c) for i, c in enumerate(COLUMNS)]
    return spark.range(700).select(F.concat(F.lit("K"), F.col("id")).alias("k"), *values, F.lit("own").alias("_x"))


def walked(tree, x):
    node = 1
    while tree["feature"][node - 1] >= 0:
        node = 2 * node + int(x[tree["feature"][node - 1]] > tree["cut"][node - 1])
    return tree["path"][node - 1]


def test_scores_are_the_mean_walk_through_the_node_table(spark, points, folder):
    at = points.select("k", *COLUMNS)
    forest = isolation.grow_forest(isolation.points_of(at, ["k"], COLUMNS), ["k"], trees=7, sample=50)
    forest.write.parquet(f"{folder}/forest")
    trees = spark.read.parquet(f"{folder}/forest").orderBy("tree").collect()
    assert [(t.tree, t.rows, t.levels, len(t.feature)) for t in trees] == [(i, 50, 6, 127) for i in range(7)]
    assert len({tuple(t.cut[:1]) for t in trees}) == 7
    usual = isolation.average_path(50)
    for given in (None, spark.read.parquet(f"{folder}/forest")):
        got = isolation.isolation_scores(at.repartition(5), ["k"], COLUMNS, trees=7, sample=50, forest=given).collect()
        assert len(got) == 700
        for r in got:
            x = [r[c] for c in COLUMNS]
            assert r.isolation_score == pytest.approx(2 ** (-np.mean([walked(t, x) for t in trees]) / usual), rel=1e-12)


def test_scoring_has_no_python_and_no_shuffle(spark, points, folder):
    at = points.select("k", *COLUMNS)
    isolation.grow_forest(isolation.points_of(at, ["k"], COLUMNS), ["k"], trees=3, sample=20).write.parquet(f"{folder}/f")
    scored = isolation.isolation_scores(at, ["k"], COLUMNS, forest=spark.read.parquet(f"{folder}/f"))
    plan = scored._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan


def test_one_row_and_equal_rows_are_not_isolated(spark):
    one = spark.createDataFrame([("a", 1.0)], "k string, v double")
    assert 0 < isolation.isolation_scores(one, ["k"], ["v"]).first().isolation_score <= 1
    same = spark.createDataFrame([(str(i), 1.0) for i in range(40)], "k string, v double")
    assert len({r.isolation_score for r in isolation.isolation_scores(same, ["k"], ["v"], trees=5).collect()}) == 1
    assert isolation.isolation_scores(one.limit(0), ["k"], ["v"]).count() == 0


def plain_lloyd(x, start):
    centres = start.copy()
    while True:
        own = ((x[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[own == j].sum(0) / (own == j).sum() if (own == j).any() else centres[j] for j in range(len(centres))])
        if (moved == centres).all():
            return centres, own
        centres = moved


def test_batched_fits_equal_single_ones(spark, points):
    keyed = points.select("k", F.array(*((F.col(c) * 1000).cast("bigint") for c in COLUMNS)).alias("x"))
    rows = keyed.collect()
    x = np.array([r.x for r in rows], float)
    first = clusters.starts(keyed, ["k"], 4, 3, 700)
    assert len({f[0].tobytes() for f in first}) > 1
    tried = [f[:k].copy() for f in first for k in (2, 3, 4)]
    fits, n, sums, squares = clusters.lloyd(keyed.select("x").repartition(6), clusters.Centres([t.copy() for t in tried]))
    for i, start in enumerate(tried):
        centres, own = plain_lloyd(x, start)
        assert (fits.of(i) == centres).all()
        part = slice(fits.fits[i], fits.fits[i + 1])
        assert n[part].tolist() == np.bincount(own, minlength=len(centres)).tolist()
        assert sum(squares[part]) == int((x**2).sum()) and np.array(sums[part]).sum(0).tolist() == x.sum(0).astype(int).tolist()


def test_clusters_do_not_depend_on_partitions(spark, points):
    from bazaarlens.fixed_values import FEATURE_COLUMNS

    at = points.select("k", *(F.col(COLUMNS[i % 3]).alias(c) for i, c in enumerate(FEATURE_COLUMNS)))
    one, other = (clusters.fit_clusters(df, keys=["k"], restarts=2) for df in (at.coalesce(1), at.repartition(9)))
    assert one[1].collect() == other[1].collect()
    assert sorted(map(tuple, one[0].select("k", "cluster_id", "cluster_distance").collect())) == sorted(
        map(tuple, other[0].select("k", "cluster_id", "cluster_distance").collect())
    )
    with pytest.raises(ValueError):
        clusters.fit_clusters(at.limit(2), keys=["k"])


def test_silver_parses_each_payload_once(spark, folder):
    broken = [("a", "not json"), ("a", '{"id":"a","price":"1"}'), ("b", "{"), ("c", '{"id":"c"}')]
    rows = [{"record_id": i, "payload": p, "ingested_at": f"2026-09-1{n}T00:00:00Z"} for n, (i, p) in enumerate(broken)]
    spark.createDataFrame(rows).write.parquet(f"{folder}/bronze")
    bronze = spark.read.schema(schemas.BRONZE).parquet(f"{folder}/bronze")
    for name, transform in silver.TRANSFORMS.items():
        plan = transform(bronze)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, name
    found = silver.silver_item_details(bronze).collect()
    assert sorted((r.item_id, r.price) for r in found) == [("a", 1.0), ("c", None)]
