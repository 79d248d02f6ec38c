import pytest
from pyspark.sql import functions as F

from loadsplit.operators import attribution as A
from loadsplit.operators import bands as B
from loadsplit.operators import model as M
from tests.conftest import ts

BANDS = ["baseline", "hvac", "morning", "cooking", "washer", "dryer", "other"]


def _bands(spark, rows):
    df = spark.createDataFrame(rows, "esiid string, interval_start_dt timestamp_ntz, usage_kwh double, "
                                     "hour_of_day int, temp_c double")
    return B.load_bands(df).orderBy("interval_start_dt").collect()


def test_small_interval_is_all_baseline(spark):
    r = _bands(spark, [("m", ts("2025-05-01 19:00:00"), 0.10, 19, 30.0)])[0]
    assert r["baseline"] == 0.10 and r["other"] == 0.0
    assert sum(r[b] for b in BANDS) == pytest.approx(0.10)


def test_bands_sum_to_kwh_and_headroom_scaling(spark):
    r = _bands(spark, [("m", ts("2025-05-01 19:00:00"), 1.0, 19, 30.0)])[0]
    assert sum(r[b] for b in BANDS) == pytest.approx(1.0)
    assert r["baseline"] == 0.15
    # hot evening, kWh 0.2: hvac + cooking exceed the 0.05 headroom -> scaled to it
    s = _bands(spark, [("m", ts("2025-05-01 19:00:00"), 0.2, 19, 38.0)])[0]
    assert s["baseline"] == 0.15
    assert s["hvac"] + s["cooking"] + s["morning"] + s["washer"] + s["dryer"] == pytest.approx(0.05)
    assert s["other"] == pytest.approx(0.0, abs=1e-12)


def test_day_mean_fill(spark):
    rows = _bands(spark, [("m", ts("2025-05-01 10:00:00"), 1.0, 10, 30.0),
                          ("m", ts("2025-05-01 11:00:00"), 1.0, 11, None),
                          ("m", ts("2025-05-01 12:00:00"), 1.0, 12, 20.0)])
    assert rows[1]["temp_c"] == 25.0


def _z(spark, vals):
    return spark.createDataFrame([(i, *v) for i, v in enumerate(vals)],
                                 "id int, z_usage_kwh double, z_hour_sin double, z_hour_cos double, z_temp_c double, "
                                 "z_ac_proxy_int double")


def _cents(spark, rows):
    from loadsplit.schemas import CENTROIDS
    return spark.createDataFrame(rows, CENTROIDS)


def test_assign_ties_go_to_lowest_id(spark):
    cents = _cents(spark, [(i, float(v), 0.0, 0.0, 0.0, 0.0) for i, v in enumerate([1.0, -1.0, 5.0, 6.0, 7.0])])
    z = _z(spark, [(0.0, 0.0, 0.0, 0.0, 0.0)])                 # equidistant to clusters 0 and 1
    row = M.assign_cluster(z, cents).first()
    assert row["cluster"] == 0 and row["distance"] == 1.0


def test_map_clusters_rules_and_ties(spark):
    # cluster, kWh, hour_sin, hour_cos, temp, ac
    cents = _cents(spark, [(0, 0.5, 0.0, 0.0, 20.0, 0.0), (1, 0.1, 0.0, 0.0, 20.0, 0.0),
                           (2, 0.9, 0.0, 0.0, 30.0, 1.0), (3, 0.7, -0.9, 0.0, 20.0, 0.0),
                           (4, 0.5, 0.0, 0.0, 20.0, 0.0)])
    m = {r["cluster"]: r["appliance"] for r in M.map_clusters(cents).collect()}
    assert m == {1: "baseline", 2: "hvac", 3: "cooking", 0: "washer", 4: "dryer"}


def test_map_clusters_needs_five(spark):
    cents = _cents(spark, [(i, float(i), 0.0, 0.0, 0.0, 0.0) for i in range(4)])
    with pytest.raises(Exception, match="exactly 5"):
        M.map_clusters(cents).collect()


def test_confidence_bounds_and_reconcile(spark):
    from loadsplit.plans import queries as Q
    d = "/root/testdata/sf0.001"
    lab = Q.labeled(spark, d)
    lo, hi = lab.agg(F.min("confidence"), F.max("confidence")).first()
    assert 0.3 <= lo <= hi <= 1.0
    rec = Q.q_reconcile_totals(spark, d)
    assert rec.where(F.abs("diff_kwh") > 1e-9).count() == 0
    assert A.mean_confidence_by_appliance(Q.gold(spark, d)).count() == 5


def test_fit_clusters_returns_five_centroids(spark):
    from loadsplit.plans import queries as Q
    cents, cost = M.fit_clusters(Q.zscores(spark, "/root/testdata/sf0.001"), n_init=2)
    assert cents.count() == 5 and cost > 0
    proof = M.clusters_certificate(Q.zscores(spark, "/root/testdata/sf0.001"), cents).first()
    assert (proof["n_clusters"], proof["centroid_off"], proof["rows_nearer_elsewhere"]) == (5, 0.0, 0)
    off = cents.withColumn("usage_kwh", F.col("usage_kwh") + 0.01)
    assert M.clusters_certificate(Q.zscores(spark, "/root/testdata/sf0.001"), off).first()["centroid_off"] > 0
    assert M.map_clusters(M.centroids_original_units(
        M.assign_cluster(Q.zscores(spark, "/root/testdata/sf0.001"), cents))).count() == 5
