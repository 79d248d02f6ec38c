"""The medallion pipeline as Spark jobs over a warehouse folder.

Tables of a warehouse (``sources/snapshots.py``: immutable Parquet and a commit log):

    bronze             S10 rows of loaded files, by usage_date
    files              S14 manifest: every loaded file with its size, time and dates
    quality            Q5 per-file report of each ingest run
    weather            P1 hourly series
    silver_intervals   F8, by usage_date
    silver_daily       F9, by usage_date
    gold_estimates     D13 with the model version, by usage_date
    gold_profile       E1, by usage_date
    gold_summary       E3, by month

and beside them model/<version>/, the D19 centroids, scaler statistics, labels
and distances, which are never changed.

Every date of a stage carries a signature of all it was made from: of silver the
date's bronze rows and weather hours, of gold the silver signature and the model
version, of what is published gold's. A run redoes just the dates whose
signature differs from what their inputs say now, so late files, replaced files,
later weather, another model and runs that were left out all reach the exports,
and a run without changes writes nothing. Row digests are taken of new rows when
they are loaded; no run rereads a table to learn what has changed. What a run
writes is committed at once: readers see all its tables or none, and ``run_all``
commits its five stages together. What reaches the driver is one row per
date or month, and the paths of the files to be read.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import logging
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsplit.constants import MAX_ITER
from loadsplit.functions.numeric import exact_sum
from loadsplit.operators import attribution as A
from loadsplit.operators import export as E
from loadsplit.operators import features as FT
from loadsplit.operators import ingest as I
from loadsplit.operators import model as M
from loadsplit.operators import quality as Q
from loadsplit.operators import weather as W
from loadsplit.session import path_exists, remove_scratch, scratch_path
from loadsplit.sources import meter_csv as S
from loadsplit.sources import sinks
from loadsplit.sources.snapshots import NULL_PART, WHOLE, Transaction, Warehouse

LAYOUT = ("usage_date", "esiid")          # range clustering of the large stage tables
WEATHER = "datetime timestamp_ntz, temp_c double"
MANIFEST = "source_file string, length long, modified timestamp, n_rows long, dates array<date>, undated boolean, load long"
log = logging.getLogger("loadsplit")


def read_table(spark: SparkSession, warehouse: str, name: str, at: int | None = None, only: Iterable[str] | None = None) -> DataFrame:
    """A table as of commit ``at`` (the last one), or just its parts ``only``."""
    return _need(Warehouse(spark, warehouse).read(name, at, only), name)


def _need(df: DataFrame | None, name: str) -> DataFrame:
    if df is None:
        raise ValueError(f"the warehouse has no table {name} yet")
    return df


@contextlib.contextmanager
def _in(spark: SparkSession, warehouse: str, stage: str, tx: Transaction | None) -> Iterator[Transaction]:
    """The given transaction, or one of the stage's own."""
    if tx is not None:
        yield tx
    else:
        with Warehouse(spark, warehouse).transaction(stage) as own:
            yield own


@contextlib.contextmanager
def staged(spark: SparkSession, df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Write ``df`` once to the shared checkpoint folder, read it back, and
    remove it when the block that uses it ends."""
    path = scratch_path(spark, name)
    try:
        df.write.mode("overwrite").parquet(path)
        yield spark.read.parquet(path)
    finally:
        remove_scratch(spark, path)


# --- signatures -----------------------------------------------------------------------

def date_digests(rows: DataFrame, ignore: tuple[str, ...] = ()) -> dict[str, list]:
    """Per usage_date: rows and the sum of their hashes, which does not depend on their
    order or on how they were split, and can be added up. One row a date."""
    hashed = F.xxhash64(*sorted(c for c in rows.columns if c not in ("usage_date", *ignore))).cast("decimal(20,0)")
    found = rows.groupBy("usage_date").agg(F.count(F.lit(1)), F.sum(hashed)).collect()
    return {part_name(d): [n, int(total) % 2 ** 64] for d, n, total in found}


def part_name(day) -> str:
    return NULL_PART if day is None else str(day)


def _added(a: list | None, b: list) -> list:
    return b if a is None else [a[0] + b[0], (a[1] + b[1]) % 2 ** 64]


def signature(*inputs) -> str:
    return hashlib.sha256(json.dumps(inputs, sort_keys=True).encode()).hexdigest()[:24]


def stale(tx: Transaction, table: str, wanted: dict[str, str]) -> dict[str, str]:
    """The parts of ``wanted`` that were made from something else, or not yet."""
    done = tx.parts(table)
    return {part: s for part, s in wanted.items() if part not in done or done[part]["signature"] != s}


# --- P2 ---------------------------------------------------------------------------

def run_ingest(spark: SparkSession, meter_root: str, warehouse: str, layout: str = "reference", tx: Transaction | None = None) -> DataFrame:
    """S1 -> S14 -> S2..S10 -> S15 -> E5 -> Q5 -> S16. Returns the one-row
    ingest report (rows loaded, files loaded / skipped / in error).

    Only files that the manifest does not hold with their size and time are opened;
    a file that was replaced is loaded anew and its old rows go."""
    if layout == "export":
        return ingest_raw(spark, sinks.read_meter_export(spark, meter_root), warehouse, tx)
    with staged(spark, S.list_meter_files(spark, meter_root), "listing") as listing:
        return ingest_files(spark, meter_root, listing, warehouse, tx)


def manifest(tx: Transaction) -> DataFrame:
    """The loaded files, one row each, as they were loaded last."""
    files = tx.read("files")
    if files is None:
        return tx.warehouse.spark.createDataFrame([], MANIFEST)
    last = files.groupBy("source_file").agg(F.max_by(F.struct(*[c for c in files.columns if c != "source_file"]), "load").alias("_f"))
    return last.select("source_file", "_f.*")


def ingest_files(spark: SparkSession, root: str, listing: DataFrame, warehouse: str, tx: Transaction | None = None) -> DataFrame:
    """Load those of the listed files (source_file, path, length, modified) that are new or changed."""
    with _in(spark, warehouse, "ingest", tx) as tx:
        known = manifest(tx).select("source_file", F.col("length").alias("_l"), F.col("modified").alias("_m"), F.lit(True).alias("_known"))
        same = F.col("_known") & (F.col("_l").isNull() | (F.col("_l") == F.col("length")) & (F.col("_m") == F.col("modified")))
        with staged(spark, listing.join(known, "source_file", "left").withColumn("_same", F.coalesce(same, F.lit(False))), "new-files") as files:
            new = files.where(~F.col("_same"))
            headed = [(r["path"], r["header"]) for r in S.with_headers(spark, new).collect()]  # one row a file to be read
            return _ingest(spark, S.read_files(spark, root, headed), new.select("source_file", "length", "modified"),
                           files.where("_same").count(), tx)


def ingest_raw(spark: SparkSession, raw: DataFrame, warehouse: str, tx: Transaction | None = None) -> DataFrame:
    """Load raw rows whose files (``source_file``) the manifest does not hold."""
    with _in(spark, warehouse, "ingest", tx) as tx:
        files, loaded = raw.select("source_file").distinct(), manifest(tx).select("source_file")
        skipped = files.join(loaded, "source_file", "left_semi").count()
        new = I.new_files_only(files, loaded).select("source_file", F.lit(None).cast("long").alias("length"),
                                                     F.lit(None).cast("timestamp").alias("modified"))
        return _ingest(spark, I.new_files_only(raw, loaded), new, skipped, tx)


def _ingest(spark: SparkSession, raw: DataFrame, files: DataFrame, skipped: int, tx: Transaction) -> DataFrame:
    """S2..S10 -> S15 -> E5 -> Q5 for raw rows of ``files``; the S16 report of this
    batch. Shared by the batch and streaming paths."""
    bad = I.row_parse_error()
    if "missing_columns" in raw.columns:
        bad = bad | F.col("missing_columns")
    with staged(spark, I.to_bronze(raw.withColumn("_bad", bad), keep=("_bad",)), "ingest-stage") as typed:
        found = typed.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"), F.bool_or("_bad").alias("has_error"),
                                                 F.collect_set("usage_date").alias("dates"), F.bool_or(F.col("usage_date").isNull()).alias("undated"))
        status = files.join(found, "source_file", "left").select(
            "source_file", "length", "modified", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
            F.coalesce("has_error", F.lit(False)).alias("has_error"), F.coalesce("dates", F.array().cast("array<date>")).alias("dates"),
            F.coalesce("undated", F.lit(False)).alias("undated"))
        with staged(spark, status, "file-status") as status:
            ok = ~F.col("has_error")
            report = status.agg(
                F.coalesce(F.sum(F.when(ok, F.col("n_rows"))), F.lit(0)).cast("long").alias("rows_loaded"),
                F.count_if(ok).alias("files_loaded"),
                F.lit(skipped).cast("long").alias("files_skipped"),
                F.count_if(~ok).alias("files_in_error"),
            )
            report = spark.createDataFrame(report.collect(), report.schema)  # one row
            rows = typed.join(status.where(~ok).select("source_file"), "source_file", "left_anti").select(*[c for c in typed.columns if c != "_bad"])
            if report.first()["files_loaded"]:
                _load(rows, status.where(ok), tx)
            else:  # no file, or all of them in quarantine
                tx.declare("bronze", rows.schema, by="usage_date")
            return report


def _load(rows: DataFrame, files: DataFrame, tx: Transaction) -> None:
    """Bronze rows, quality reports and manifest entries of files, some of which may
    replace what was loaded under their name: those dates are written anew without the old rows."""
    old = manifest(tx).join(files.select("source_file"), "source_file", "left_semi")
    lost = [part_name(r[0]) for r in old.select(F.explode("dates")).distinct().collect()] + [NULL_PART] * bool(old.where("undated").limit(1).count())
    lost = [part for part in lost if part in tx.parts("bronze")]
    all_rows = rows
    if lost:
        all_rows = rows.unionByName(tx.read("bronze", lost).join(old.select("source_file"), "source_file", "left_anti").select(*rows.columns))
    digests = {part: [0, 0] for part in lost} | date_digests(all_rows, ignore=("loaded_at",))
    done = tx.parts("bronze")
    signed = {part: d if part in lost or part not in done else _added(done[part]["signature"], d) for part, d in digests.items()}
    tx.write("bronze", all_rows, signed, by="usage_date", replaces=lost, cluster_by=LAYOUT)
    tx.write("quality", Q.quality_report(rows).withColumn("checked_at", F.current_timestamp()), replaces=())
    tx.write("files", files.select("source_file", "length", "modified", "n_rows", "dates", "undated", F.lit(tx.number).cast("long").alias("load")), replaces=())


# --- P1 / P3 ----------------------------------------------------------------------

def run_weather(spark: SparkSession, station: DataFrame, warehouse: str, tx: Transaction | None = None) -> DataFrame:
    """P1 persisted: the hourly series is small and reread by every run."""
    return _store_weather(spark, W.build_weather(station), warehouse, tx)


def run_weather_file(spark: SparkSession, path: str, warehouse: str, hourly: bool = False, tx: Transaction | None = None) -> DataFrame:
    """P1 from CSV: irregular station readings (S12), or with ``hourly`` a file
    that already holds one temperature an hour (S11)."""
    if not hourly:
        return run_weather(spark, S.read_station_csv(spark, path), warehouse, tx)
    return _store_weather(spark, S.read_weather_csv(spark, path).where("datetime is not null"), warehouse, tx)


def _store_weather(spark: SparkSession, hours: DataFrame, warehouse: str, tx: Transaction | None) -> DataFrame:
    with _in(spark, warehouse, "weather", tx) as tx, staged(spark, hours, "weather") as hours:
        total = date_digests(hours.withColumn("usage_date", F.lit(None).cast("date"))).get(NULL_PART)
        for _ in stale(tx, "weather", {WHOLE: signature(total)}):
            tx.write("weather", hours, {WHOLE: signature(total)})
        return tx.read("weather")


def run_features(spark: SparkSession, warehouse: str, tx: Transaction | None = None) -> DataFrame:
    """S13 -> W5 -> F8 -> F9 for the dates whose bronze rows or weather hours have
    changed. The weather is a stored table, so the optimizer knows its size when
    it plans the join. Intervals stay on the date of their file's rows; those
    without a time are in no daily row."""
    with _in(spark, warehouse, "features", tx) as tx:
        with staged(spark, W.dedupe_hour(_need(tx.read("weather"), "weather")), "weather-hours") as hours:
            warm = date_digests(hours.withColumn("usage_date", F.to_date("datetime")))
            if not tx.parts("bronze"):
                raise ValueError("there are no rows in table bronze yet")
            todo = stale(tx, "silver_intervals", {d: signature(p["signature"], warm.get(d)) for d, p in tx.parts("bronze").items()})
            if todo:
                rows = I.filter_flow(tx.read("bronze", todo)).select("esiid", "interval_start_dt", "usage_kwh", "usage_date")
                with staged(spark, FT.interval_features(rows, hours, keep=("usage_date",)), "silver-stage") as feats:
                    lost = feats.agg(F.count_if(F.col("temp_c").isNull()), F.count_if(F.col("usage_kwh").isNull())).first()
                    if any(lost):
                        log.warning("%d intervals without weather, %d without kWh", *lost)
                    tx.write("silver_intervals", feats, todo, by="usage_date", cluster_by=LAYOUT)
                    daily = FT.daily_features(feats.where("interval_start_dt is not null").drop("usage_date"))
                    tx.write("silver_daily", daily, todo, by="usage_date", cluster_by=LAYOUT)
        return tx.read("silver_daily")


# --- P4 ---------------------------------------------------------------------------

def fit_model(spark: SparkSession, silver: DataFrame, path: str, version: str, centroids: DataFrame | None = None,
              n_init: int = 10, max_iter: int = MAX_ITER) -> None:
    """D1-D11 on all of silver: fit KMeans (or take given centroids) and persist
    scaler, centroids, labels and largest distances (D19)."""
    feats, fit = M.fit_features(silver)
    z = M.standardize(feats, stats=fit)
    if centroids is None:
        centroids, _cost = M.fit_clusters(z, n_init=n_init, max_iter=max_iter)
    labels = M.label_table(M.cluster_table(M.assign_cluster(z, centroids)))
    M.persist_model(spark, path, centroids, M.scaler_table(spark, fit), labels, version)


def run_disaggregate(spark: SparkSession, warehouse: str, version: str | None = None, refit: bool = False,
                     centroids: DataFrame | None = None, n_init: int = 10, max_iter: int = MAX_ITER,
                     tx: Transaction | None = None) -> DataFrame:
    """D1-D13 for the dates whose silver rows or model have changed, by the
    persisted model of ``version`` (the one in use, or v1), which is fitted first if
    there is none. ``refit`` fits anew and so needs a version that is not there
    yet. Another version scores all dates anew, so gold never mixes models."""
    with _in(spark, warehouse, "disaggregate", tx) as tx:
        version = version or tx.parts("model").get(WHOLE, {}).get("signature") or "v1"
        silver, models = _need(tx.read("silver_intervals"), "silver_intervals"), f"{warehouse.rstrip('/')}/model"
        if refit or not M.model_exists(spark, f"{models}/{version}"):
            fit_model(spark, silver.drop("usage_date"), models, version, centroids, n_init, max_iter)
        todo = stale(tx, "gold_estimates", {d: signature(p["signature"], version) for d, p in tx.parts("silver_intervals").items()})
        if todo:
            cents, stats, labels = M.load_model(spark, f"{models}/{version}")
            fit = stats.first().asDict()
            rows = tx.read("silver_intervals", todo).drop("usage_date")
            lost = M.null_kwh_rows(rows).first()[0]
            if lost:
                log.warning("%d intervals cannot be attributed", lost)
            z = M.standardize(M.feature_frame(rows, temp_fill=fit["fill_temp_c"]), stats=fit)
            scored = M.assign_cluster(z, cents)
            labeled = A.confidence(A.max_distance_per_cluster(A.label_appliance(scored, labels), labels))
            gold = A.estimate_daily(labeled).withColumn("model_version", F.lit(version))
            tx.write("gold_estimates", gold, todo, by="usage_date", cluster_by=LAYOUT)
        tx.mark("model", version)
        return tx.read("gold_estimates")


# --- P5 ---------------------------------------------------------------------------

def read_summary(spark: SparkSession, warehouse: str, at: int | None = None) -> DataFrame:
    return read_table(spark, warehouse, "gold_summary", at).drop("month")


def run_export(spark: SparkSession, warehouse: str, csv_dir: str | None = None, tx: Transaction | None = None) -> DataFrame:
    """P5: E1 + E3 -> E5 / E7 for the dates whose gold rows have changed; the summary
    has one row a date and is kept by month, so whole months of it are redone. With
    ``csv_dir`` the two tables are also written there as appliance_profile.csv and
    daily_summary.csv."""
    with _in(spark, warehouse, "export", tx) as tx:
        gold = {d: p["signature"] for d, p in tx.parts("gold_estimates").items()}
        _need(tx.read("gold_estimates", ()), "gold_estimates")
        todo = stale(tx, "gold_profile", gold)
        if todo:
            profile = E.appliance_profile(tx.read("gold_estimates", todo), ordered=False)
            tx.write("gold_profile", profile, todo, by="usage_date", cluster_by=("usage_date", "appliance", "estimated_kwh"))
        months: dict[str, list[str]] = {}
        for d in sorted(d for d in gold if d != NULL_PART):
            months.setdefault(d[:7], []).append(d)
        todo = stale(tx, "gold_summary", {m: signature([(d, gold[d]) for d in days]) for m, days in months.items()})
        if todo:
            days = [d for m in todo for d in months[m]]
            summary = E.daily_summary(tx.read("gold_estimates", days), tx.read("silver_intervals", days).drop("usage_date"), ordered=False)
            tx.write("gold_summary", summary.withColumn("month", F.date_format("usage_date", "yyyy-MM")).coalesce(1), todo, by="month")
        if csv_dir:
            sinks.write_named_csv(tx.read("gold_profile").orderBy("usage_date", "appliance"), f"{csv_dir.rstrip('/')}/appliance_profile.csv")
            sinks.write_named_csv(tx.read("gold_summary").drop("month").orderBy("usage_date"), f"{csv_dir.rstrip('/')}/daily_summary.csv")
        return tx.read("gold_summary").drop("month")


# --- P6 ---------------------------------------------------------------------------

def run_all(spark: SparkSession, meter_root: str, station: DataFrame, warehouse: str, layout: str = "reference",
            centroids: DataFrame | None = None, n_init: int = 10) -> DataFrame:
    """P2 -> P1 -> P3 -> P4 -> P5, committed together: a run that stops anywhere
    leaves every reader on what was published before, and the next one redoes it."""
    with Warehouse(spark, warehouse).transaction("all") as tx:
        run_ingest(spark, meter_root, warehouse, layout, tx).collect()
        run_weather(spark, station, warehouse, tx)
        run_features(spark, warehouse, tx)
        run_disaggregate(spark, warehouse, centroids=centroids, n_init=n_init, tx=tx)
        return run_export(spark, warehouse, tx=tx)


# --- the same pipelines fed from the driver's tables ---------------------------------

def _export_dirty(spark: SparkSession, d: str, dirty: bool = True) -> str:
    from loadsplit.sources import fixtures as X
    root = scratch_path(spark, "meter-export")
    raw = X.dirty_raw_view(spark, d) if dirty else X.raw_meter_view(spark, d)
    sinks.write_meter_export(raw, root)
    return root


def demo_run_ingest(spark: SparkSession, d: str) -> DataFrame:
    """E8 export of the dirty raw view -> P2 -> bronze (without loaded_at)."""
    wh = scratch_path(spark, "warehouse")
    run_ingest(spark, _export_dirty(spark, d), wh, layout="export").collect()
    return read_table(spark, wh, "bronze").drop("loaded_at")


def demo_ingest_incremental(spark: SparkSession, d: str) -> DataFrame:
    """E8 export of the dirty raw view -> file stream (availableNow) -> bronze
    (without loaded_at)."""
    from loadsplit.streaming.incremental import ingest_incremental
    wh = scratch_path(spark, "warehouse")
    ingest_incremental(spark, _export_dirty(spark, d), wh, scratch_path(spark, "stream-ckpt"), layout="export")
    return read_table(spark, wh, "bronze").drop("loaded_at")


def demo_read_meter_csv(spark: SparkSession, d: str) -> DataFrame:
    """One named file a day, of every other day with swapped and renamed columns and
    one more of them -> S1 + S2 + S9."""
    return S.read_meter_csv(spark, _meter_files(spark, d))


def _meter_files(spark: SparkSession, d: str) -> str:
    from loadsplit.sources import fixtures as X
    root, raw = scratch_path(spark, "meter-files"), X.raw_meter_view(spark, d)
    odd = F.substring("source_file", -5, 1).cast("int") % 2 == 1
    sinks.write_meter_files(raw.where(~odd), root)
    swapped = raw.where(odd).select(F.lit("x").alias("NOTE"), *[F.col(c).alias(f" {c.lower()} ") for c in reversed(S.RAW_COLUMNS)], "source_file")
    sinks.write_meter_files(swapped, root)
    return root


def demo_reload_replaced_files(spark: SparkSession, d: str) -> DataFrame:
    """The files of the first days come first without their estimated readings, then
    whole under the same names, then unchanged: bronze must be as if the whole
    files had come at once. ``reloaded`` counts the files the second and third run read."""
    from loadsplit.sources import fixtures as X
    wh, root = scratch_path(spark, "warehouse"), _meter_files(spark, d)
    early = X.raw_meter_view(spark, d).where("source_file < '2024/01/20240111.csv'")
    sinks.write_meter_files(early.where("ESTIMATED_ACTUAL <> 'E'"), root)
    run_ingest(spark, root, wh).collect()
    sinks.write_meter_files(early, root)
    reports = [run_ingest(spark, root, wh).first() for _ in range(2)]
    return read_table(spark, wh, "bronze").drop("loaded_at") \
        .withColumn("reloaded", F.lit(sum(r["files_loaded"] for r in reports)).cast("long"))


def _through_features(spark: SparkSession, d: str) -> str:
    from loadsplit.sources import fixtures as X
    wh = scratch_path(spark, "warehouse")
    run_ingest(spark, _export_dirty(spark, d, dirty=False), wh, layout="export").collect()
    run_weather(spark, X.station_view(spark, d), wh)
    run_features(spark, wh)
    return wh


def demo_run_features(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, _through_features(spark, d), "silver_daily")


def demo_run_disaggregate(spark: SparkSession, d: str) -> DataFrame:
    """Per meter and day what the fitted model attributed, whatever the clusters
    are called: the kWh, and whether confidence and appliances are in bounds."""
    gold = run_disaggregate(spark, _through_features(spark, d))
    return gold.groupBy("esiid", "usage_date").agg(
        exact_sum("estimated_kwh").alias("attributed_kwh"),
        F.count(F.lit(1)).between(1, 5).alias("appliances_ok"),
        ((F.min("confidence") >= 0.3) & (F.max("confidence") <= 1.0)).alias("confidence_ok"))


def demo_run_export(spark: SparkSession, d: str) -> DataFrame:
    from loadsplit.sources import fixtures as X
    wh = _through_features(spark, d)
    run_disaggregate(spark, wh, centroids=X.fixed_centroids(spark))
    return run_export(spark, wh)


def demo_run_all(spark: SparkSession, d: str) -> DataFrame:
    """The columns of the published summary that a fit cannot change."""
    from loadsplit.sources import fixtures as X
    wh = scratch_path(spark, "warehouse")
    out = run_all(spark, _export_dirty(spark, d, dirty=False), X.station_view(spark, d), wh, layout="export")
    return out.select("usage_date", "total_kwh", "avg_temp_c")


def demo_run_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Changes of every input, one after the other: the actual readings with the
    first half month's weather; the estimated readings, as late files on dates
    that are published already, with the disaggregation left out of one round; the
    rest of the weather; another model version; nothing. Silver, what gold
    attributes and what is published must be as if all had come at once."""
    from loadsplit.sources import fixtures as X
    wh, raw, cents = scratch_path(spark, "warehouse"), X.raw_meter_view(spark, d), X.fixed_centroids(spark)
    late = raw.where("ESTIMATED_ACTUAL = 'E'").withColumn("source_file", F.concat(F.lit("late/"), F.col("source_file")))
    first, station = raw.where("ESTIMATED_ACTUAL <> 'E'"), X.station_view(spark, d)

    def after(rows: DataFrame, readings: DataFrame, version: str | None = None, score: bool = True) -> int:
        ingest_raw(spark, rows, wh).collect()
        run_weather(spark, readings, wh)
        run_features(spark, wh)
        if score:
            run_disaggregate(spark, wh, version=version, centroids=cents)
        run_export(spark, wh)
        return Warehouse(spark, wh).head()

    half = station.where(F.col("DATE") < F.to_timestamp_ntz(F.lit("2024-01-16")))
    after(first, half)
    after(first.unionByName(late), half, score=False)
    after(first.unionByName(late), half)
    after(first.unionByName(late), station)
    head = after(first.unionByName(late), station, version="v2")
    unchanged = after(first.unionByName(late), station) == head
    gold = read_table(spark, wh, "gold_estimates").groupBy("esiid", "usage_date") \
        .agg(exact_sum("estimated_kwh").alias("attributed_kwh"), F.min("model_version").alias("_v"), F.max("model_version").alias("model_version"))
    published = read_summary(spark, wh).select("usage_date", F.col("total_kwh").alias("published_total_kwh"),
                                               F.col("avg_temp_c").alias("published_avg_temp_c"))
    daily = read_table(spark, wh, "silver_daily")
    return daily.join(gold.where("_v = model_version"), ["esiid", "usage_date"], "left").join(published, "usage_date", "left").select(
        *daily.columns, "attributed_kwh", "published_total_kwh", "published_avg_temp_c", "model_version",
        F.lit(unchanged).alias("rerun_wrote_nothing"))


def demo_read_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The daily rows and published totals as they stood before the estimated readings
    came, read after those were published (``now_kwh``) from the snapshot of then."""
    from loadsplit.sources import fixtures as X
    wh, raw, cents = scratch_path(spark, "warehouse"), X.raw_meter_view(spark, d), X.fixed_centroids(spark)
    late = raw.where("ESTIMATED_ACTUAL = 'E'").withColumn("source_file", F.concat(F.lit("late/"), F.col("source_file")))
    heads = []
    for rows in (raw.where("ESTIMATED_ACTUAL <> 'E'"), late):
        with Warehouse(spark, wh).transaction("all") as tx:
            ingest_raw(spark, rows, wh, tx).collect()
            run_weather(spark, X.station_view(spark, d), wh, tx)
            run_features(spark, wh, tx)
            run_disaggregate(spark, wh, centroids=cents, tx=tx)
            run_export(spark, wh, tx=tx)
        heads.append(Warehouse(spark, wh).head())
    then = read_table(spark, wh, "silver_daily", at=heads[0])
    return then.join(read_summary(spark, wh, at=heads[0]).select("usage_date", F.col("total_kwh").alias("then_kwh")), "usage_date") \
        .join(read_summary(spark, wh).select("usage_date", F.col("total_kwh").alias("now_kwh")), "usage_date") \
        .select("esiid", "usage_date", "total_kwh", "max_interval_kwh", "then_kwh", "now_kwh")
