from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scorefold.operators import feature_store as fs
from scorefold.plans import trip_queries as T
from scorefold.session import scratch_path
from scorefold.sources import driver_tables as D
from scorefold.streaming import feature_stream

TRIP = "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, pickup_zip int, dropoff_zip int, fare_amount double"


def trips(spark, times):
    return spark.createDataFrame([(t, t, 1, 2, 10.0) for t in times], TRIP)


def at(*args):
    return datetime(2024, *args)


def epoch(*args):
    return int((datetime(2024, *args) - datetime(1970, 1, 1)).total_seconds())


@pytest.mark.parametrize("panes", [True, False])
def test_window_edges(spark, panes):
    exact = fs.pickup_features(trips(spark, [at(1, 1, 10, 0)]), panes=panes)
    late = fs.pickup_features(trips(spark, [at(1, 1, 9, 59, 59, 999999)]), panes=panes)
    ends = lambda df: sorted(r["ts"] for r in df.collect())
    assert ends(exact) == [epoch(1, 1, 10, 15), epoch(1, 1, 10, 30), epoch(1, 1, 10, 45), epoch(1, 1, 11, 0)]
    assert ends(late) == [epoch(1, 1, 10, 0), epoch(1, 1, 10, 15), epoch(1, 1, 10, 30), epoch(1, 1, 10, 45)]
    month = fs.pickup_features(trips(spark, [at(1, 31, 23, 50)]), panes=panes)
    assert sorted(r["yyyy_mm"] for r in month.collect()) == ["2024-02"] * 4


def test_range_end_is_exclusive_and_windows_partial(spark):
    df = trips(spark, [at(1, 1, 9, 50), at(1, 1, 10, 0)])
    first = fs.pickup_features(df, end=at(1, 1, 10, 0))
    assert {r["count_trips_window_1h_pickup_zip"] for r in first.collect()} == {1}


def test_panes_equal_direct(spark, sf_dir):
    t = D.trips(spark, sf_dir)
    names = ["zip", "ts", "yyyy_mm", "count_trips_window_1h_pickup_zip"]
    a = fs.pickup_features(t, panes=True).select(*names, F.round("mean_fare_window_1h_pickup_zip", 3))
    b = fs.pickup_features(t, panes=False).select(*names, F.round("mean_fare_window_1h_pickup_zip", 3))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_strict_rounding_never_uses_the_trip_itself(spark):
    df = trips(spark, [at(1, 1, 10, 0), at(1, 1, 10, 1)])
    loose = [r["rounded_pickup_datetime"] for r in fs.rounded_trips(df).collect()]
    strict = [r["rounded_pickup_datetime"] for r in fs.rounded_trips(df, strict=True).collect()]
    assert loose == [epoch(1, 1, 10, 0), epoch(1, 1, 10, 15)]
    assert strict == [epoch(1, 1, 10, 0), epoch(1, 1, 10, 0)]


def store(spark):
    return fs.FeatureStore(spark, scratch_path(spark, "store"))


ROW = "zip int, ts int, yyyy_mm string, v double"


def rows(df):
    return sorted(tuple(r) for r in df.select("zip", "ts", "yyyy_mm", "v").collect())


def make(spark, data, **options):
    s, name = store(spark), T._name("t")
    s.create_table(name, ["zip", "ts"], spark.createDataFrame(data, ROW), "yyyy_mm", "it's a table", **options)
    return s, name


@pytest.mark.parametrize("from_key", [True, False])
def test_merge_replaces_adds_and_is_idempotent(spark, from_key):
    s, name = make(spark, [(1, 1, "a", 1.0), (1, 2, "a", 2.0), (1, 3, "b", 3.0)], partition_from_key=from_key)
    batch = spark.createDataFrame([(1, 2, "a", 20.0), (9, 9, "c", 9.0)], ROW)
    want = [(1, 1, "a", 1.0), (1, 2, "a", 20.0), (1, 3, "b", 3.0), (9, 9, "c", 9.0)]
    for _ in range(2):
        s.write_table(name, batch)
        assert rows(s.table(name)) == want
    s.write_table(name, spark.createDataFrame([], ROW))
    assert rows(s.table(name)) == want
    assert spark.sql("SHOW TABLES IN scorefold_staging").filter("NOT isTemporary").count() == 0


def files_of(s, name):
    return {r["f"]: r["n"] for r in s.table(name).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("from_key", [True, False])
def test_merge_rewrites_only_files_that_hold_its_keys(spark, from_key):
    """A month of many files; a batch of late times touches the last of them, and new keys none."""
    s, name = make(spark, [(0, 0, "a", 0.0)], partition_from_key=from_key, cluster_by=["ts", "zip"])
    month = spark.range(20_000).selectExpr("cast(id % 50 AS INT) AS zip", "cast(id DIV 50 AS INT) + 1 AS ts", "'m' AS yyyy_mm", "cast(id AS DOUBLE) AS v")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        s.write_table(name, month)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    old = files_of(s, name)
    assert len(old) >= 15
    late = month.where("ts > 395").selectExpr("zip", "ts", "yyyy_mm", "v + 0.5 AS v")
    s.write_table(name, late)
    new = files_of(s, name)
    gone = set(old) - set(new)
    assert gone and sum(old[f] for f in gone) < 0.15 * 20_000 and s.table(name).count() == 20_001
    assert s.table(name).where("v != floor(v)").count() == late.count()
    s.write_table(name, spark.createDataFrame([(7, 100_000, "m", 1.0)], ROW))
    assert set(new) < set(files_of(s, name)) and s.table(name).count() == 20_002
    assert spark.sql("SHOW TABLES IN scorefold_staging").filter("NOT isTemporary").count() == 0


def test_an_interrupted_commit_is_finished_by_the_next_merge(spark, monkeypatch):
    from scorefold.sources import commits
    s, name = make(spark, [(1, 1, "a", 1.0), (1, 2, "a", 2.0)])
    place = s.location(name)
    with monkeypatch.context() as m:
        m.setattr(commits, "_finish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            s.write_table(name, spark.createDataFrame([(1, 2, "a", 20.0), (2, 1, "b", 3.0)], ROW))
    spark.catalog.refreshTable(name)
    assert rows(s.table(name)) == [(1, 1, "a", 1.0), (1, 2, "a", 2.0)]  # nothing is seen before the commit
    assert commits.finish_commits(spark, place) == 1 and commits.finish_commits(spark, place) == 0
    spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")
    spark.catalog.refreshTable(name)
    assert rows(s.table(name)) == [(1, 1, "a", 1.0), (1, 2, "a", 20.0), (2, 1, "b", 3.0)]


def test_merge_moves_a_key_between_partitions(spark):
    s, name = make(spark, [(1, 1, "a", 1.0), (1, 2, "a", 2.0), (1, 3, "b", 3.0)])
    s.write_table(name, spark.createDataFrame([(1, 1, "b", 10.0)], ROW))
    assert rows(s.table(name)) == [(1, 1, "b", 10.0), (1, 2, "a", 2.0), (1, 3, "b", 3.0)]


def test_duplicate_keys_are_refused_unless_ordered(spark):
    with pytest.raises(fs.DuplicateKeyError):
        make(spark, [(1, 1, "a", 1.0), (1, 1, "a", 2.0)])
    with pytest.raises(fs.DuplicateKeyError):
        make(spark, [(None, 1, "a", 1.0)])
    s, name = make(spark, [(1, 1, "a", 1.0)])
    twice = spark.createDataFrame([(1, 1, "a", 5.0, 2), (1, 1, "a", 4.0, 1)], ROW + ", version int")
    with pytest.raises(fs.DuplicateKeyError):
        s.write_table(name, twice)
    s.write_table(name, twice, order_by="version")
    assert rows(s.table(name)) == [(1, 1, "a", 5.0)]


def test_overwrite_and_bad_mode(spark):
    s, name = make(spark, [(1, 1, "a", 1.0), (1, 2, "b", 1.0)])
    s.write_table(name, spark.createDataFrame([(7, 7, "z", 7.0)], ROW), mode="overwrite")
    assert rows(s.table(name)) == [(7, 7, "z", 7.0)]
    with pytest.raises(ValueError):
        s.write_table(name, spark.createDataFrame([], ROW), mode="append")


def test_merge_reads_only_touched_partitions(spark):
    predicate = fs._any_partition([("a",), (None,)], ["yyyy_mm"])
    df = spark.createDataFrame([("a",), ("b",), (None,)], "yyyy_mm string")
    assert df.filter(predicate).count() == 2


@pytest.mark.parametrize("named", [1_000, 0])
def test_merge_keeps_the_rest_of_touched_partitions(spark, monkeypatch, named):
    monkeypatch.setattr(fs, "MOST_NAMED_PARTITIONS", named)
    s, name = make(spark, [(1, 1, "a", 1.0), (1, 2, None, 2.0), (1, 3, None, 3.0), (1, 4, "b", 4.0)])
    s.write_table(name, spark.createDataFrame([(1, 3, None, 30.0), (1, 5, "b", 5.0)], ROW))
    assert rows(s.table(name)) == [(1, 1, "a", 1.0), (1, 2, None, 2.0), (1, 3, None, 30.0), (1, 4, "b", 4.0), (1, 5, "b", 5.0)]


def test_overwrite_refuses_a_bad_key_and_replaces_all_partitions(spark):
    s, name = make(spark, [(1, 1, "a", 1.0), (1, 2, "b", 1.0)])
    for bad in ([(7, 7, "z", 7.0), (7, 7, "y", 8.0)], [(None, 7, "z", 7.0)]):
        with pytest.raises(fs.DuplicateKeyError):
            s.write_table(name, spark.createDataFrame(bad, ROW), mode="overwrite")
    assert s.table(name).count() == 2
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        s.write_table(name, spark.createDataFrame([(7, 7, "z", 7.0)], ROW), mode="overwrite")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(s.table(name)) == [(7, 7, "z", 7.0)]


def test_lookup_keeps_unmatched_trips(spark):
    s, name = make(spark, [(1, 1, "a", 1.0)])
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1)], "z int, t int")
    out = fs.add_features(s, df, [fs.FeatureLookup(name, ["v"], ["z", "t"])])
    assert out.columns == ["z", "t", "v"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([(1, 1, 1.0), (1, 2, None), (None, 1, None)], key=str)


def test_lookup_splits_a_hot_key(spark):
    """A third of the trips share one window; adaptive execution spreads them over tasks."""
    s, name = make(spark, [(z, 1, "a", float(z)) for z in range(200)])
    df = spark.range(60_000).repartition(8).selectExpr(
        "CAST(IF(id % 3 = 0, 7, id % 200) AS INT) AS z", "1 AS t", "repeat(uuid(), 20) AS payload"
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB", "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k) for k in conf if k != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = fs.add_features(s, df, [fs.FeatureLookup(name, ["v"], ["z", "t"])])
        out.write.format("noop").mode("overwrite").save()
        assert out.filter("v = z").count() == 60_000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for k, v in before.items():
            spark.conf.set(k, v)


def test_stream_over_many_files_equals_batch(spark, sf_dir):
    """Files arrive in time order, one per micro-batch; windows are updated across batches."""
    path = scratch_path(spark, "trips")
    all_trips = D.trips(spark, sf_dir)
    for day, nxt in (("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-10 12:10:00"), ("2024-01-10 12:10:00", "2024-03-01")):
        piece = all_trips.filter(f"tpep_pickup_datetime >= '{day}' AND tpep_pickup_datetime < '{nxt}'")
        piece.coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    features = feature_stream.pickup_feature_stream(stream)
    s, name = store(spark), T._name("s")
    s.create_table(name, ["zip", "ts"], spark.createDataFrame([], features.schema), "yyyy_mm", partition_from_key=True)
    query = feature_stream.upsert_stream(s, name, features, scratch_path(spark, "stream"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    columns = ["zip", "ts", "count_trips_window_1h_pickup_zip"]
    want = fs.pickup_features(all_trips).select(*columns)
    got = s.table(name).select(*columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        s.write_table(name, features)


def test_windows_and_late_parts_of_a_stream_equal_the_batch(spark):
    from scorefold.streaming import late_rows
    path, parts = scratch_path(spark, "disordered"), scratch_path(spark, "late")
    files = [[at(1, 2, 10, 0), at(1, 2, 10, 20), at(1, 2, 12, 1)], [at(1, 2, 11, 50), at(1, 2, 10, 40), at(1, 2, 9, 3)], [at(1, 1, 7, 7), at(1, 2, 12, 30)]]
    for times in files:
        trips(spark, times).coalesce(1).write.mode("append").parquet(path)
    s, name = store(spark), T._name("late")
    s.create_table(name, ["zip", "ts"], spark.createDataFrame([], late_rows.TABLE), "yyyy_mm", partition_from_key=True)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    late_rows.upsert_with_late_rows(s, name, late_rows.pickup_parts(stream), parts, scratch_path(spark, "late_stream")).awaitTermination()
    late = spark.read.schema(late_rows.PARTS).parquet(parts)
    # Watermark 11:01 after the first file: 9:03 is late for all windows, 10:40 for one of its four; 7:07 of the day before for all.
    assert sorted(r["ts"] for r in late.collect()) == sorted(
        [epoch(1, 2, 10, 45), epoch(1, 2, 11, 0), *(epoch(1, 2, 9, 15) + 900 * k for k in range(4)), *(epoch(1, 1, 7, 15) + 900 * k for k in range(4))])
    got = {(r["zip"], r["ts"]): (r["mean_fare"], r["trips"]) for r in late_rows.complete_windows(s.table(name), late).collect()}
    batch = fs.pickup_features(trips(spark, [t for f in files for t in f]))
    assert got == {(r["zip"], r["ts"]): (r[fs.PICKUP_COLUMNS[0]], r[fs.PICKUP_COLUMNS[1]]) for r in batch.collect()}


def test_zips_of_one_group_keep_their_own_windows():
    import numpy as np
    import pandas as pd

    from scorefold.streaming import late_rows

    class State:
        exists, get, watermark = False, None, 0

        def getCurrentWatermarkMs(self):
            return self.watermark * 1000

        def update(self, value):
            self.exists, self.get = True, value

    def advance(rows):
        batch = pd.DataFrame(rows, columns=["zip", "seconds", "fare"])
        found = pd.concat(late_rows._advance((0,), iter([batch[:1], batch[1:]]), state))
        return {(r.zip, r.ts, r.late): (r.fares, r.fare_trips, r.trips) for r in found.itertuples()}

    state = State()
    ends = [900, 1800, 2700, 3600]
    first = advance([(1, 5, 2.0), (2, 7, np.nan), (1, 899, 3.0)])
    assert first == {**{(1, t, False): (5.0, 2, 2) for t in ends}, **{(2, t, False): (0.0, 0, 1) for t in ends}}
    state.watermark = 1800
    # Two of the four windows are closed; those of the other ZIP that do not change are not handed on again.
    second = advance([(1, 6, 1.0), (3, 5000, 4.0)])
    assert second == {(1, 900, True): (1.0, 1, 1), (1, 1800, True): (1.0, 1, 1), (1, 2700, False): (6.0, 3, 3), (1, 3600, False): (6.0, 3, 3),
                      **{(3, t, False): (4.0, 1, 1) for t in (5400, 6300, 7200, 8100)}}
    assert sorted(set(zip(*state.get[:2]))) == [(z, t) for z in (1, 2) for t in (2700, 3600)] + [(3, t) for t in (5400, 6300, 7200, 8100)]
