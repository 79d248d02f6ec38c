"""Feature matrix, scaling, cluster assignment and the
cluster -> appliance mapping.

Global statistics (mean temperature, feature means and deviations) are one
partial+final aggregate each; their single row is fetched once and inlined as
literals, the way a fitted scaler is applied. Centroids and the cluster
mapping are k (=5) rows: they are fetched through ``small_table`` (which
refuses anything larger than its bound) and expanded into literal expressions
or broadcast, so scoring is one codegen'd projection over the intervals.
"""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit.constants import MAX_ITER, N_CLUSTERS, N_INIT, RANDOM_SEED
from loadsplit.functions.numeric import hour_cos, hour_sin, round_half_up, to_decimal

FEATURES = ("usage_kwh", "hour_sin", "hour_cos", "temp_c", "ac_proxy_int")


def cyclical_hour(df: DataFrame, hour: str = "hour_of_day") -> DataFrame:
    """sin/cos(2*pi*hour/24), rounded to 6 places."""
    return df.withColumn("hour_sin", hour_sin(hour)).withColumn("hour_cos", hour_cos(hour))


def ac_proxy_int(df: DataFrame) -> DataFrame:
    """Boolean flag -> 0/1 (null counts as 0)."""
    return df.withColumn("ac_proxy_int", F.coalesce(F.col("ac_proxy"), F.lit(False)).cast("int"))


def small_table(df: DataFrame, max_rows: int = 64) -> DataFrame:
    """Materialize a provably small table (k centroids, a mapping) as a local
    DataFrame; fails instead of pulling an unbounded result to the driver."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows, got more")
    return df.sparkSession.createDataFrame(rows, df.schema)


def mean_of(df: DataFrame, col: str) -> float | None:
    """Exact mean of a column, rounded to 6 places (one global aggregate)."""
    return df.select(round_half_up(F.sum(to_decimal(col)).cast("double") / F.count(col), 6)).first()[0]


def impute_mean(df: DataFrame, col: str = "temp_c", value: float | None = None) -> DataFrame:
    """D3: null -> global mean of the non-null values (or a fitted ``value``)."""
    value = mean_of(df, col) if value is None else value
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast("double")))


def base_features(interval_features: DataFrame) -> DataFrame:
    """D1 + D2 on silver intervals; rows without kWh or time cannot be clustered
    and are left out (see ``null_kwh_rows``). ``temp_raw`` keeps the unfilled value."""
    df = interval_features.where(F.col("usage_kwh").isNotNull() & F.col("interval_start_dt").isNotNull())
    df = df.withColumn("temp_raw", F.col("temp_c"))
    return ac_proxy_int(cyclical_hour(df))


def feature_frame(interval_features: DataFrame, temp_fill: float | None = None) -> DataFrame:
    """``base_features`` with the temperature mean-imputed."""
    return impute_mean(base_features(interval_features), "temp_c", temp_fill)


def fit_features(interval_features: DataFrame) -> tuple[DataFrame, dict]:
    """D1-D4 fit in one statistics pass: (imputed feature frame, fitted scaler)."""
    raw = base_features(interval_features)
    fitted = fit_scaler(raw)
    return impute_mean(raw, "temp_c", fitted["fill"]), fitted


def null_kwh_rows(interval_features: DataFrame) -> DataFrame:
    lost = F.col("usage_kwh").isNull() | F.col("interval_start_dt").isNull()
    return interval_features.agg(F.count_if(lost).alias("null_kwh_rows"))


def fit_scaler(raw: DataFrame, cols: Sequence[str] = FEATURES, impute: str = "temp_c") -> dict:
    """D3 + D4 statistics in one pass over the un-imputed feature frame.

    Per feature: count, exact decimal sum and sum of squares of the non-null
    values. The imputed column's fill is the rounded mean; with it the sums of
    the imputed column are exact closed forms (S1 + n_null*fill,
    S2 + n_null*fill^2), so no second pass is needed. Returns
    ``{"fill": .., "mean_<c>": .., "std_<c>": ..}``.
    """
    from decimal import Decimal
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        d = to_decimal(c)
        aggs += [F.count(c).alias(f"n_{c}"), F.sum(d).alias(f"s1_{c}"), F.sum(d * d).alias(f"s2_{c}")]
    row = raw.agg(*aggs).first()
    n = row["n"]
    out: dict = {"n": n, "fill": None}
    for c in cols:
        nn = row[f"n_{c}"]
        s1, s2 = row[f"s1_{c}"] or Decimal(0), row[f"s2_{c}"] or Decimal(0)
        if c == impute and nn:
            fill = math.floor(float(s1) / nn * 1e6 + 0.5) / 1e6
            out["fill"] = fill
            f = Decimal(repr(fill))
            s1, s2 = s1 + (n - nn) * f, s2 + (n - nn) * f * f
        if not n:
            out[f"mean_{c}"], out[f"std_{c}"] = None, None
            continue
        mean = float(s1) / n
        var = max(0.0, float(s2) / n - mean * mean)
        out[f"mean_{c}"], out[f"std_{c}"] = mean, math.sqrt(var)
    return out


def scaler_table(spark: SparkSession, fitted: dict, cols: Sequence[str] = FEATURES) -> DataFrame:
    """The fitted scaler as a one-row table (persisted with the model, D19)."""
    from pyspark.sql import types as T
    fields = [T.StructField("fill_temp_c", T.DoubleType())]
    vals = [fitted.get("fill")]
    for c in cols:
        fields += [T.StructField(f"mean_{c}", T.DoubleType()), T.StructField(f"std_{c}", T.DoubleType())]
        vals += [fitted[f"mean_{c}"], fitted[f"std_{c}"]]
    return spark.createDataFrame([tuple(vals)], T.StructType(fields))


def standardize(df: DataFrame, cols: Sequence[str] = FEATURES, stats: DataFrame | dict | None = None) -> DataFrame:
    """Z-score with population sigma; a constant column scales to 0.

    ``stats`` can be a persisted one-row table (D19) so new data is scored
    with the fitted scaler instead of its own statistics.
    """
    stats = fit_scaler(df, cols, impute="") if stats is None else stats
    s = stats if isinstance(stats, dict) else stats.first().asDict()
    zs = []
    for c in cols:
        mean, std = s[f"mean_{c}"], s[f"std_{c}"]
        z = (F.col(c) - F.lit(mean)) / F.lit(std) if std and std > 0 else F.lit(0.0)
        zs.append(round_half_up(z, 6).alias(f"z_{c}"))
    return df.select("*", *zs)


def fit_clusters(z: DataFrame, k: int = N_CLUSTERS, seed: int = RANDOM_SEED, n_init: int = N_INIT,
                 max_iter: int = MAX_ITER, cols: Sequence[str] = FEATURES):
    """MLlib KMeans on the scaled features, best of ``n_init`` seeds by
    training cost, then moved on to a fixpoint. Returns (centroids DataFrame in
    z-space, training cost); ``clusters_certificate`` shows that it is one.

    Equal feature rows (hours, rounded temperatures and kWh repeat) are fitted
    once with their count as weight: the same objective on fewer rows, with all
    data in it. They are written once to the shared checkpoint folder and the
    iterations read that copy, not the whole lineage. ``max_iter`` bounds the
    rounds of a start, not those to the fixpoint.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    from loadsplit.session import scratch_path
    zcols = [f"z_{c}" for c in cols]
    path = scratch_path(z.sparkSession, "kmeans-input")
    z.groupBy(*zcols).agg(F.count(F.lit(1)).cast("double").alias("weight")).write.mode("overwrite").parquet(path)
    points = z.sparkSession.read.parquet(path)
    vec = VectorAssembler(inputCols=zcols, outputCol="features").transform(points).select("features", "weight")
    vec = vec.persist()          # blocks lost with an executor are re-read from the Parquet copy
    best = None
    try:
        for i in range(max(1, n_init)):
            km = KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol="features", weightCol="weight")
            model = km.fit(vec)
            cost = model.summary.trainingCost
            if best is None or cost < best[1]:
                best = (model, cost)
    finally:
        vec.unpersist()
    centers = [[float(x) for x in center] for center in best[0].clusterCenters()]
    return settle_clusters(points, centers, cols)


def _centroid_table(spark: SparkSession, centers: list[list[float]], cols: Sequence[str]) -> DataFrame:
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in cols)])
    return spark.createDataFrame([(i, *c) for i, c in enumerate(centers)], schema)


def _cluster_sums(points: DataFrame, centers: list[list[float]], cols: Sequence[str]) -> list:
    """Per cluster the weight of the points nearest to it, their exact weighted sums
    and squared distances; ``points`` has the scaled columns and ``weight``. k rows."""
    scored = assign_cluster(points, _centroid_table(points.sparkSession, centers, cols), cols)
    w = F.col("weight").cast("decimal(18,0)")
    return scored.groupBy("cluster").agg(
        F.sum(w).alias("n"), *[F.sum(F.col(f"z_{c}").cast("decimal(18,6)") * w).alias(c) for c in cols],
        F.sum(F.col("weight") * F.col("distance") * F.col("distance")).alias("cost")).collect()


def settle_clusters(points: DataFrame, centers: list[list[float]], cols: Sequence[str] = FEATURES) -> tuple[DataFrame, float]:
    """Rounds of assignment and exact weighted mean until no centroid moves. The cost
    falls with every round that moves one, and there are finitely many
    partitions, so it ends. A cluster without points keeps its centroid."""
    while True:
        sums = {r["cluster"]: r for r in _cluster_sums(points, centers, cols)}
        means = [[float(sums[i][c] / sums[i]["n"]) for c in cols] if i in sums else center for i, center in enumerate(centers)]
        if means == centers:
            return _centroid_table(points.sparkSession, centers, cols), float(sum(r["cost"] for r in sums.values()))
        centers = means


def clusters_certificate(z: DataFrame, centroids: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """D5's proof, recomputed from all rows: clusters, rows, the largest distance of a
    centroid from the mean of the rows nearest to it (6 places), and how many rows
    are nearer to a cluster's mean than to their own centroid."""
    scored = assign_cluster(z, centroids, cols)
    means = scored.groupBy("cluster").agg(*[(F.sum(to_decimal(f"z_{c}")).cast("double") / F.count(F.lit(1))).alias(c) for c in cols])
    again = assign_cluster(scored.withColumnRenamed("distance", "_own").drop("cluster"), _all_clusters(centroids, means, cols), cols)
    moved = again.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("distance") < F.col("_own")).alias("rows_nearer_elsewhere"))
    m = means.select("cluster", *[F.col(c).alias(f"_{c}") for c in cols])
    off = centroids.join(m, "cluster").agg(
        F.count(F.lit(1)).alias("n_clusters"), round_half_up(F.max(F.sqrt(sum((F.col(c) - F.col(f"_{c}")) ** 2 for c in cols))), 6).alias("centroid_off"))
    return off.crossJoin(moved)  # one row each


def _all_clusters(centroids: DataFrame, means: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The means, and the centroids of clusters without rows."""
    return means.select("cluster", *cols).unionByName(centroids.join(means, "cluster", "left_anti").select("cluster", *cols))


def _centroid_rows(centroids: DataFrame, cols: Sequence[str]) -> list:
    """The k centroid rows (k is small and fixed by the model)."""
    rows = centroids.orderBy("cluster").select("cluster", *cols).collect()
    if len(rows) != N_CLUSTERS:
        raise ValueError(f"expected {N_CLUSTERS} centroids, got {len(rows)}")
    return rows


def assign_cluster(z: DataFrame, centroids: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """D6 + D7: nearest centroid by Euclidean distance (ties -> lowest id) and
    the distance to it, rounded to 6 places."""
    rows = _centroid_rows(centroids, cols)
    d2 = []
    for r in rows:
        acc = None
        for c in cols:
            term = (F.col(f"z_{c}") - F.lit(float(r[c]))) * (F.col(f"z_{c}") - F.lit(float(r[c])))
            acc = term if acc is None else acc + term
        d2.append((int(r["cluster"]), f"_d{int(r['cluster'])}", acc))
    z = z.select("*", *[e.alias(name) for _, name, e in d2])
    z = z.withColumn("_m", F.least(*[F.col(name) for _, name, _ in d2]))
    pick = None
    for cid, name, _ in d2:
        hit = F.col(name) == F.col("_m")
        pick = F.when(hit, F.lit(cid)) if pick is None else pick.when(hit, F.lit(cid))
    # ELSE -1 (only reachable with null features) keeps ``cluster`` non-nullable,
    # so joins on it do not infer an IsNotNull filter that would inline the
    # whole distance computation a second time
    pick = pick.otherwise(F.lit(-1))
    return (z.select("*", pick.cast("int").alias("cluster"), round_half_up(F.sqrt("_m"), 6).alias("distance"))
             .drop("_m", *[name for _, name, _ in d2]))


def distance_to_centroid(z: DataFrame, centroids: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """D7 for an already labelled frame: distance to its own centroid."""
    rows = _centroid_rows(centroids, cols)
    expr = None
    for r in rows:
        acc = None
        for c in cols:
            term = (F.col(f"z_{c}") - F.lit(float(r[c]))) * (F.col(f"z_{c}") - F.lit(float(r[c])))
            acc = term if acc is None else acc + term
        expr = F.when(F.col("cluster") == int(r["cluster"]), acc) if expr is None \
            else expr.when(F.col("cluster") == int(r["cluster"]), acc)
    return z.withColumn("distance", round_half_up(F.sqrt(expr), 6))


def cluster_table(scored: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """One pass over the scored intervals: per cluster the feature means in
    original units (D8) and the largest distance (D11). k rows, local."""
    return small_table(scored.groupBy("cluster").agg(
        *[(F.sum(to_decimal(c)).cast("double") / F.count(c)).alias(c) for c in cols],
        F.max("distance").alias("max_distance_raw")))


def centroids_original_units(scored: DataFrame, cols: Sequence[str] = FEATURES, local: bool = True) -> DataFrame:
    """Per-cluster feature means in original units (k rows; returned as a
    local table unless ``local=False``)."""
    cents = scored.groupBy("cluster").agg(
        *[(F.sum(to_decimal(c)).cast("double") / F.count(c)).alias(c) for c in cols])
    return small_table(cents) if local else cents


def mapping_rows(centroids: DataFrame) -> list[tuple[int, str]]:
    """D9 rules on the k centroid rows: lowest kWh -> baseline; highest
    ac_proxy*temp -> hvac; lowest hour_sin -> cooking; of the remaining two
    the lower kWh -> washer, the higher -> dryer. Ties -> lowest id. The
    table has k rows (checked), so the rules run on the driver."""
    rows = [r.asDict() for r in small_table(centroids).collect()]
    if len(rows) != N_CLUSTERS:
        raise ValueError(f"map_clusters needs exactly {N_CLUSTERS} clusters, got {len(rows)}")
    by = {int(r["cluster"]): r for r in rows}
    left = sorted(by)

    def take(key) -> int:
        cid = min(left, key=lambda c: (key(by[c]), c))
        left.remove(cid)
        return cid

    def num(v):
        return math.inf if v is None else v

    def hvac_key(r):
        a, t = r["ac_proxy_int"], r["temp_c"]
        return math.inf if a is None or t is None else -(a * t)   # highest score first

    out = [(take(lambda r: num(r["usage_kwh"])), "baseline")]
    out.append((take(hvac_key), "hvac"))
    out.append((take(lambda r: num(r["hour_sin"])), "cooking"))
    out.append((take(lambda r: num(r["usage_kwh"])), "washer"))
    out.append((left[0], "dryer"))
    return out


def map_clusters(centroids: DataFrame) -> DataFrame:
    """D9 as a k-row table (cluster, appliance)."""
    return centroids.sparkSession.createDataFrame(mapping_rows(centroids), "cluster int, appliance string")


def label_table(clusters: DataFrame) -> DataFrame:
    """D9 + D11 of a ``cluster_table``: (cluster, appliance, max_distance_raw)."""
    return map_clusters(clusters).join(clusters.select("cluster", "max_distance_raw"), "cluster")


def model_exists(spark: SparkSession, base: str) -> bool:
    """True once all tables of the version are written."""
    from loadsplit.session import path_exists
    return path_exists(spark, f"{base}/mapping")


def persist_model(spark: SparkSession, path: str, centroids: DataFrame, stats: DataFrame,
                  labels: DataFrame, version: str) -> str:
    """Write centroids, scaler statistics and the label table (appliance and
    largest distance of each cluster) as small Parquet tables under
    ``path/version``; scoring later reads them back, so a row's confidence does
    not depend on what else is scored. A version that is there is never
    overwritten; ``mapping`` is written last and completes it."""
    base = f"{path.rstrip('/')}/{version}"
    if model_exists(spark, base):
        raise ValueError(f"model version {version} exists; give the new fit a version of its own")
    centroids.coalesce(1).write.mode("overwrite").parquet(f"{base}/centroids")
    stats.coalesce(1).write.mode("overwrite").parquet(f"{base}/scaler")
    labels.coalesce(1).write.parquet(f"{base}/mapping")
    return base


def load_model(spark: SparkSession, base: str):
    """(centroids, scaler stats, label table) of a persisted model version."""
    return (spark.read.parquet(f"{base}/centroids"), spark.read.parquet(f"{base}/scaler"),
            spark.read.parquet(f"{base}/mapping"))
