"""Windowed trip features, feature tables, lookups and streams over events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.operators import feature_store as fs
from scorefold.operators import projection, training
from scorefold.operators.scoring import LinearModel
from scorefold.plans.registry import num, query, rnd, with_rounded
from scorefold.session import kept, scratch_path
from scorefold.sources import driver_tables as D
from scorefold.streaming import feature_stream, late_rows

SPLIT = "2024-01-16"
_MEAN, _TRIPS = fs.PICKUP_COLUMNS
_DROPS, _WEEKEND = fs.DROPOFF_COLUMNS

# ------------------------------------------------------------------ check SQL


def pickup_sql(where: str = "TRUE") -> str:
    return (
        f"SELECT pickup_zip AS zip, CAST(epoch(w) AS INTEGER) AS ts, strftime(w, '%Y-%m') AS yyyy_mm, "
        f"{rnd('CAST(avg(fare_amount) AS FLOAT)', _MEAN, 3)}, CAST(count(*) AS INTEGER) AS {_TRIPS} FROM ("
        "SELECT pickup_zip, fare_amount, time_bucket(INTERVAL 15 MINUTE, tpep_pickup_datetime) + to_minutes(CAST(15 * (k + 1) AS INTEGER)) AS w "
        f"FROM ({D.TRIPS_SQL}) CROSS JOIN range(4) AS r(k) WHERE {where}) GROUP BY pickup_zip, w"
    )


def dropoff_sql(where: str = "TRUE") -> str:
    local = "timezone('America/New_York', timezone('UTC', w))"
    return (
        f"SELECT dropoff_zip AS zip, CAST(epoch(w) AS INTEGER) AS ts, strftime(w, '%Y-%m') AS yyyy_mm, "
        f"CAST(count(*) AS INTEGER) AS {_DROPS}, CASE WHEN isodow({local}) >= 6 THEN 1 ELSE 0 END AS {_WEEKEND} FROM ("
        "SELECT dropoff_zip, time_bucket(INTERVAL 30 MINUTE, tpep_dropoff_datetime) + INTERVAL 30 MINUTE AS w "
        f"FROM ({D.TRIPS_SQL}) WHERE {where}) GROUP BY dropoff_zip, w"
    )


_EARLY = f"tpep_pickup_datetime < TIMESTAMP '{SPLIT}'"
_LATE = f"tpep_pickup_datetime >= TIMESTAMP '{SPLIT}'"
# The second batch replaces windows of the first one that straddle the split.
_MERGED_SQL = (
    f"WITH a AS ({pickup_sql(_EARLY)}), b AS ({pickup_sql(_LATE)}) SELECT * FROM b UNION ALL "
    "SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.zip = a.zip AND b.ts = a.ts)"
)


def _plain(df):
    return with_rounded(df, 3)


# ------------------------------------------------------------------- features


@query("FS-01 AG-02 FN-11 FN-13 STR-01", pickup_sql())
def pickup_features(spark, sf_dir):
    return _plain(fs.pickup_features(D.trips(spark, sf_dir)))


@query("FS-01 FLT-04", pickup_sql(f"{_LATE} AND tpep_pickup_datetime < TIMESTAMP '2024-01-21 07:07:00'"))
def pickup_features_range(spark, sf_dir):
    return _plain(fs.pickup_features(D.trips(spark, sf_dir), SPLIT, "2024-01-21 07:07:00"))


@query("FS-01 AG-02", pickup_sql())
def pickup_features_panes(spark, sf_dir):
    return _plain(fs.pickup_features(D.trips(spark, sf_dir), panes=True))


@query("FS-02 AG-03 FN-12 UDF-01", dropoff_sql())
def dropoff_features(spark, sf_dir):
    return fs.dropoff_features(D.trips(spark, sf_dir))


def _ceil_sql(column: str, minutes: int) -> str:
    step = minutes * 60
    return f"CAST(CAST(ceil(epoch_us({column}) / {step * 1_000_000}e0) AS BIGINT) * {step} AS INTEGER)"


_ROUNDED_SQL = (
    f"SELECT trip_id, pickup_zip, dropoff_zip, fare_amount, trip_distance, {_ceil_sql('tpep_pickup_datetime', 15)} AS rounded_pickup_datetime, "
    f"{_ceil_sql('tpep_dropoff_datetime', 30)} AS rounded_dropoff_datetime FROM ({D.TRIPS_SQL})"
)


@query("FS-09 FN-14 UDF-01 PRJ-12 SRC-10", _ROUNDED_SQL)
def rounded_trips(spark, sf_dir):
    view = f"trips_{uuid.uuid4().hex[:8]}"
    fs.rounded_trips(D.trips(spark, sf_dir), view=view)
    return spark.sql(f"SELECT * FROM {view}")


@query(
    "FN-12 FN-13",
    "SELECT event_id, CASE WHEN isodow(timezone('America/New_York', timezone('UTC', ts))) >= 6 THEN 1 ELSE 0 END AS weekend, "
    "strftime(ts, '%Y-%m') AS yyyy_mm FROM events",
)
def weekend_and_month(spark, sf_dir):
    events = D.table(spark, sf_dir, "events")
    return events.selectExpr("event_id", f"{K.is_weekend('ts')} AS weekend", f"{K.month_partition('ts')} AS yyyy_mm")


# --------------------------------------------------------------- feature tables


def _store(spark) -> fs.FeatureStore:
    return fs.FeatureStore(spark, scratch_path(spark, "features"))


def _name(what: str) -> str:
    return f"{what}_{uuid.uuid4().hex[:8]}"


def _pickup_table(spark, sf_dir, store, end=None) -> str:
    name = _name("trip_pickup_features")
    store.create_table(
        name, ["zip", "ts"], fs.pickup_features(D.trips(spark, sf_dir), end=end), "yyyy_mm",
        "Pick-up features", partition_from_key=True, cluster_by=["ts", "zip"],
    )
    return name


def _dropoff_table(spark, sf_dir, store) -> str:
    name = _name("trip_dropoff_features")
    store.create_table(
        name, ["zip", "ts"], fs.dropoff_features(D.trips(spark, sf_dir)), "yyyy_mm",
        "Drop-off features", partition_from_key=True, cluster_by=["ts", "zip"],
    )
    return name


@query("FS-03 FS-04", _MERGED_SQL)
def feature_merge(spark, sf_dir):
    """First half of the month as a new table, second half merged into it, twice."""
    store = _store(spark)
    name = _pickup_table(spark, sf_dir, store, end=SPLIT)
    late = fs.pickup_features(D.trips(spark, sf_dir), start=SPLIT)
    store.write_table(name, late, mode="merge")
    store.write_table(name, late, mode="merge")
    return _plain(store.table(name))


@query("FS-05", pickup_sql(_LATE))
def feature_overwrite(spark, sf_dir):
    store = _store(spark)
    name = _pickup_table(spark, sf_dir, store, end=SPLIT)
    store.write_table(name, fs.pickup_features(D.trips(spark, sf_dir), start=SPLIT), mode="overwrite")
    return _plain(store.table(name))


@query(
    "AG-04 FS-10 FLT-05",
    f"SELECT {_WEEKEND}, CAST(sum({_DROPS}) AS BIGINT) AS num_rides FROM ({dropoff_sql()}) WHERE {_WEEKEND} IS NOT NULL GROUP BY 1",
)
def weekend_rides(spark, sf_dir):
    store = _store(spark)
    name = _dropoff_table(spark, sf_dir, store)
    return spark.sql(
        f"SELECT {_WEEKEND}, SUM({_DROPS}) AS num_rides FROM {name} WHERE {_WEEKEND} IS NOT NULL GROUP BY {_WEEKEND}"
    )


_TRAINING_SQL = (
    f"SELECT t.trip_id, t.pickup_zip, t.dropoff_zip, t.trip_distance, p.{_MEAN}, p.{_TRIPS}, d.{_DROPS}, d.{_WEEKEND}, t.fare_amount "
    f"FROM ({_ROUNDED_SQL}) t LEFT JOIN ({pickup_sql()}) p ON t.pickup_zip = p.zip AND t.rounded_pickup_datetime = p.ts "
    f"LEFT JOIN ({dropoff_sql()}) d ON t.dropoff_zip = d.zip AND t.rounded_dropoff_datetime = d.ts"
)


def _lookups(spark, sf_dir):
    store = _store(spark)
    return store, fs.trip_lookups(_pickup_table(spark, sf_dir, store), _dropoff_table(spark, sf_dir, store))


@query("FS-07 FS-08 JN-11", _TRAINING_SQL)
def training_set(spark, sf_dir):
    store, lookups = _lookups(spark, sf_dir)
    trips = fs.rounded_trips(D.trips(spark, sf_dir))
    made = fs.create_training_set(
        store, trips, lookups, "fare_amount", ["rounded_pickup_datetime", "rounded_dropoff_datetime"]
    )
    return with_rounded(made.load_df(), 3, skip=("fare_amount", "trip_distance"))


_INPUTS = ["pickup_zip", "dropoff_zip", "trip_distance", *fs.PICKUP_COLUMNS, *fs.DROPOFF_COLUMNS]


def _fare_model(spark, sf_dir):
    """(store, rounded trips, train, test, model) of fares: 100 rounds at most, of depth 5, stopped by a tenth of the training rows."""
    store, lookups = _lookups(spark, sf_dir)
    trips = fs.rounded_trips(D.trips(spark, sf_dir))
    # Training reads its rows once per tree level; the joined set is written once.
    made = kept(fs.create_training_set(store, trips, lookups, "fare_amount").load_df(), "fare_training")
    train, test = training.split_rows(made, ["trip_id"])
    marked = training.with_validation(train, ["trip_id"])
    return store, trips, train, test, training.train_boosted_trees(marked, _INPUTS, "fare_amount", lookups, validation="_validation")


_SIDE = "CAST('0x' || substr(md5('123|' || trip_id), 1, 8) AS BIGINT) % 10000"


@query(
    "ML-15 ML-16",
    f"SELECT count(*) FILTER (WHERE {_SIDE} >= 2500) AS train_rows, count(*) FILTER (WHERE {_SIDE} < 2500) AS test_rows, "
    f"TRUE AS within_bound FROM ({D.TRIPS_SQL})",
)
def fare_model_bound(spark, sf_dir):
    """Rows on each side of the split, and whether the held-out error is at most 1.05 times that of the training mean."""
    _, _, train, test, packaged = _fare_model(spark, sf_dir)
    found = training.quality(packaged, train, test, "fare_amount")
    return found.selectExpr("train_rows", "test_rows", "rmse <= 1.05 * mean_rmse AS within_bound")


@query("ML-15 ML-16 ML-17 PRJ-14 FN-05")
def fare_predictions(spark, sf_dir):
    """Predictions for all trips by the saved model, which fetches its own features, and the held-out error beside them."""
    store, trips, train, test, packaged = _fare_model(spark, sf_dir)
    path = scratch_path(spark, "fare_model")
    packaged.save(spark, path)
    scored = training.score_batch(store, path, trips)
    shown = fs.display_predictions(scored, ["fare_amount", "trip_distance", "pickup_zip", "dropoff_zip", _MEAN, _WEEKEND])
    error = training.quality(packaged, train, test, "fare_amount").first()
    return shown.withColumns({"held_out_rmse": F.lit(error["rmse"]), "mean_rmse": F.lit(error["mean_rmse"])})


#: An invented linear fare model over inputs that are exact in any engine; no prediction lies half-way between two cents.
_FARE_WEIGHTS = {"trip_distance": 1.730710713, _TRIPS: 0.013001733, _DROPS: -0.007100337, _WEEKEND: 0.313370713}


@query(
    "ML-17 PRJ-14 FN-05",
    "SELECT " + rnd("2.5031e0 + " + " + ".join(f"coalesce({c}, 0) * {num(w)}" for c, w in _FARE_WEIGHTS.items()), "predicted_fare_amount", 2)
    + f", trip_id, fare_amount, trip_distance FROM ({_TRAINING_SQL})",
)
def fare_display(spark, sf_dir):
    """A linear model saved with its lookups, loaded by path, and its predictions under their display name."""
    store, lookups = _lookups(spark, sf_dir)
    path = scratch_path(spark, "linear_fares")
    training.PackagedModel(LinearModel(_FARE_WEIGHTS, 2.5031), tuple(_FARE_WEIGHTS), lookups).save(spark, path)
    scored = training.score_batch(store, path, fs.rounded_trips(D.trips(spark, sf_dir)))
    return fs.display_predictions(scored, ["trip_id", "fare_amount", "trip_distance"])


@query(
    "FLT-08 FLT-04",
    f"SELECT * FROM ({D.TRIPS_SQL}) WHERE tpep_pickup_datetime >= '2024-01-05' AND tpep_pickup_datetime < '2024-01-20' "
    "AND CAST('0x' || substr(md5('7|' || trip_id), 1, 8) AS BIGINT) % 10000 < 1000",
)
def sampled_trips(spark, sf_dir):
    return projection.sample_range(
        D.trips(spark, sf_dir), "tpep_pickup_datetime", "2024-01-05", "2024-01-20", 0.1, seed=7, key=["trip_id"]
    )


@query(
    "WN-00 FS-03",
    f"SELECT pickup_zip AS zip, max(trip_id) AS last_trip, arg_max(fare_amount, trip_id) AS fare FROM ({D.TRIPS_SQL}) GROUP BY 1",
)
def feature_merge_latest(spark, sf_dir):
    """Batches that repeat a key are merged by their latest row."""
    store, name = _store(spark), _name("latest")
    trips = D.trips(spark, sf_dir).selectExpr("pickup_zip AS zip", "trip_id AS last_trip", "fare_amount AS fare", "pickup_zip % 4 AS part")
    store.create_table(name, ["zip"], trips.limit(0), "part", partition_from_key=True)
    for batch in (trips.where("last_trip % 2 = 0"), trips):
        store.write_table(name, batch, order_by="last_trip")
    return store.table(name).select("zip", "last_trip", "fare")


# ------------------------------------------------------------------- streaming


def _trip_files(spark, sf_dir) -> str:
    path = scratch_path(spark, "trips")
    D.trips(spark, sf_dir).write.parquet(path)
    return path


def _trip_stream(spark, path: str):
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query("STR-01 STR-03 STR-04 FS-06", pickup_sql())
def stream_pickup_upsert(spark, sf_dir):
    path = _trip_files(spark, sf_dir)
    store = _store(spark)
    stream = feature_stream.pickup_feature_stream(_trip_stream(spark, path))
    name = _name("stream_pickup")
    store.create_table(name, ["zip", "ts"], spark.createDataFrame([], stream.schema), "yyyy_mm", partition_from_key=True, cluster_by=["ts", "zip"])
    feature_stream.upsert_stream(store, name, stream, scratch_path(spark, "stream")).awaitTermination()
    return _plain(store.table(name))


@query("STR-02 STR-03 FS-06", dropoff_sql())
def stream_dropoff_upsert(spark, sf_dir):
    path = _trip_files(spark, sf_dir)
    store = _store(spark)
    stream = feature_stream.dropoff_feature_stream(_trip_stream(spark, path))
    name = _name("stream_dropoff")
    store.create_table(name, ["zip", "ts"], spark.createDataFrame([], stream.schema), "yyyy_mm", partition_from_key=True, cluster_by=["ts", "zip"])
    feature_stream.upsert_stream(store, name, stream, scratch_path(spark, "stream")).awaitTermination()
    return store.table(name)


@query("STR-04 STR-01 FS-06", pickup_sql())
def stream_late_rows(spark, sf_dir):
    """Trips in files that come out of order: windows and late parts together are the batch's windows."""
    path = scratch_path(spark, "late_trips")
    # Files are taken in the order of their times, one per micro-batch: the second half of the month comes first.
    for condition in (_LATE, _EARLY):
        D.trips(spark, sf_dir).where(condition).coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    store, name, parts = _store(spark), _name("stream_late"), scratch_path(spark, "late_parts")
    store.create_table(name, ["zip", "ts"], spark.createDataFrame([], late_rows.TABLE), "yyyy_mm", partition_from_key=True, cluster_by=["ts", "zip"])
    late_rows.upsert_with_late_rows(store, name, late_rows.pickup_parts(stream), parts, scratch_path(spark, "late_stream")).awaitTermination()
    late = spark.read.schema(late_rows.PARTS).parquet(parts)
    found = late_rows.complete_windows(store.table(name), late)
    return _plain(found.selectExpr(
        "zip", "ts", f"{K.month_partition('timestamp_seconds(ts)')} AS yyyy_mm", f"CAST(mean_fare AS FLOAT) AS {_MEAN}", f"CAST(trips AS INT) AS {_TRIPS}"))
