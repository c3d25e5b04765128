"""Windowed trip features, keyed feature tables and exact-key lookups."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.functions import kernels as K
from scorefold.operators.joins import lookup
from scorefold.operators.projection import between_times, rounded
from scorefold.session import staged
from scorefold.sources.commits import commit_files, finish_commits, plain_path as _plain_path

PICKUP_COLUMNS = ["mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"]
DROPOFF_COLUMNS = ["count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"]

# ----------------------------------------------------------- feature functions


def _with_times(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp"))


def pickup_features(
    df: DataFrame,
    start=None,
    end=None,
    ts: str = "tpep_pickup_datetime",
    zip_column: str = "pickup_zip",
    fare: str = "fare_amount",
    panes: bool = False,
) -> DataFrame:
    """Mean fare and trip count per ZIP over one-hour windows every 15 minutes.

    A window is known by its end.  The range filter runs before windowing, so
    windows at the ends of the range are partial, and ``end`` is exclusive.

    Trips are counted per window before the shuffle, so a busy ZIP moves as few
    rows as a quiet one.  With ``panes`` they are first summed per 15-minute
    pane and only pane totals are copied into the four windows they belong to:
    a quarter of the row expansion for a second, small shuffle.
    """
    df = _with_times(between_times(df, ts, start, end), ts)
    window = F.window(ts, "1 hour", "15 minutes")
    if panes:
        quarter = (
            df.groupBy(zip_column, F.window(ts, "15 minutes").alias("pane"))
            .agg(F.sum(fare).alias("fares"), F.count(fare).alias("fare_trips"), F.count("*").alias("trips"))
            .select(zip_column, F.col("pane.start").alias(ts), "fares", "fare_trips", "trips")
        )
        counted = quarter.groupBy(zip_column, window).agg(
            F.try_divide(F.sum("fares"), F.sum("fare_trips")).alias("mean_fare"), F.sum("trips").alias("trips")
        )
    else:
        counted = df.groupBy(zip_column, window).agg(F.mean(fare).alias("mean_fare"), F.count("*").alias("trips"))
    return counted.selectExpr(
        f"{zip_column} AS zip",
        f"{K.epoch_seconds('window.end')} AS ts",
        f"{K.month_partition('window.end')} AS yyyy_mm",
        f"CAST(mean_fare AS FLOAT) AS {PICKUP_COLUMNS[0]}",
        f"CAST(trips AS INT) AS {PICKUP_COLUMNS[1]}",
    )


def dropoff_features(
    df: DataFrame, start=None, end=None, ts: str = "tpep_dropoff_datetime", zip_column: str = "dropoff_zip"
) -> DataFrame:
    """Trip count per ZIP over 30-minute windows, and whether the window ends on a weekend."""
    df = _with_times(between_times(df, ts, start, end), ts)
    counted = df.groupBy(zip_column, F.window(ts, "30 minutes")).agg(F.count("*").alias("trips"))
    return counted.selectExpr(
        f"{zip_column} AS zip",
        f"{K.epoch_seconds('window.end')} AS ts",
        f"{K.month_partition('window.end')} AS yyyy_mm",
        f"CAST(trips AS INT) AS {DROPOFF_COLUMNS[0]}",
        f"{K.is_weekend('window.end')} AS {DROPOFF_COLUMNS[1]}",
    )


def rounded_trips(
    df: DataFrame,
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    strict: bool = False,
    view: str | None = None,
) -> DataFrame:
    """Replace trip times by the ends of the windows their features come from.

    The window that ends at the next quarter hour usually contains the trip
    itself.  ``strict`` takes the last window that had closed before the trip.
    """
    def window_end(column: str, minutes: int) -> str:
        end = K.ceil_to_minutes(column, minutes)
        exact = f"unix_micros(CAST({column} AS TIMESTAMP)) = {end} * 1000000L"
        return K.case([(exact, end)], f"{end} - {minutes * 60}") if strict else end

    out = K.with_sql(df, {
        "rounded_pickup_datetime": window_end(pickup, 15),
        "rounded_dropoff_datetime": window_end(dropoff, 30),
    }).drop(pickup, dropoff)
    if view:
        out.createOrReplaceTempView(view)
    return out


# ----------------------------------------------------------------- the tables


MOST_NAMED_PARTITIONS = 1_000


class DuplicateKeyError(ValueError):
    """A feature table or batch holds a key more than once, or a NULL key."""


@dataclass(frozen=True)
class FeatureStore:
    """Partitioned Parquet tables of the session catalog with a primary key.

    ``root`` places table files below a folder; without it the warehouse is
    used.
    """

    spark: SparkSession
    root: str | None = None

    def create_table(
        self,
        name: str,
        primary_keys: Sequence[str],
        df: DataFrame,
        partition_columns: str | Sequence[str],
        description: str = "",
        partition_from_key: bool = False,
        cluster_by: Sequence[str] | None = None,
    ) -> None:
        """Check the key of ``df`` and write it as a new table.

        ``partition_from_key`` states that equal keys always fall into the
        same partition; upserts then look only at the partitions they touch.
        Files hold ranges of ``cluster_by`` (the key, unless given), so that a
        batch meets few of them: name first what batches have in common, such
        as the time.
        """
        parts = [partition_columns] if isinstance(partition_columns, str) else list(partition_columns)
        clustering = [c for c in cluster_by or primary_keys if c not in parts]
        if "." in name:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
        with staged(df) as rows:
            if self._bad_keys(rows, primary_keys):
                raise DuplicateKeyError(f"{name}: {list(primary_keys)} is not a key")
            writer = _in_ranges(rows, parts, clustering).write.format("parquet").partitionBy(*parts)
            if self.root:
                writer = writer.option("path", f"{self.root}/{name.replace('.', '/')}")
            writer.saveAsTable(name)
        properties = {
            "primary_keys": json.dumps(list(primary_keys)),
            "partition_columns": json.dumps(parts),
            "partition_from_key": json.dumps(partition_from_key),
            "cluster_by": json.dumps(clustering),
            "comment": description.replace("'", ""),
        }
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")

    def write_table(self, name: str, df: DataFrame, mode: str = "merge", order_by: str | None = None) -> None:
        """Upsert (``merge``) or replace (``overwrite``) the rows of a table.

        A merge replaces rows with equal keys and adds the others.  A batch
        may repeat a key only if ``order_by`` says which row is the latest.
        """
        columns = self.spark.table(name).columns
        if df.isStreaming:
            raise ValueError("use scorefold.streaming.upsert_stream for streams")
        if mode == "overwrite":
            with staged(df.select(*columns)) as rows:
                if self._bad_keys(rows, self.primary_keys(name)):
                    raise DuplicateKeyError(f"rows for {name}: {self.primary_keys(name)} is not a key")
                self._overwrite(name, rows)
        elif mode == "merge":
            self._merge(name, df.select(*columns, *([order_by] if order_by and order_by not in columns else [])), order_by)
        else:
            raise ValueError("mode must be 'merge' or 'overwrite'")

    def _merge(self, name: str, batch: DataFrame, order_by: str | None) -> None:
        if finish_commits(self.spark, self.location(name)):
            self.spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")
            self.spark.catalog.refreshTable(name)
        properties = self._properties(name)
        columns = self.spark.table(name).columns
        if order_by:
            batch = latest_per_key(batch, properties["primary_keys"], order_by).select(*columns)
        # The batch is read for its summary, its keys and its rows.
        with staged(batch) as computed:
            self._merge_staged(name, computed, columns, **properties)

    def _merge_staged(
        self, name: str, batch: DataFrame, columns: Sequence[str], primary_keys: Sequence[str],
        partition_columns: Sequence[str], partition_from_key: bool, cluster_by: Sequence[str],
    ) -> None:
        """Write the rows of the files that hold keys of the batch anew, with the batch; other files stay."""
        found = _batch_summary(batch, primary_keys, partition_columns, cluster_by)
        if any(r["most"] > 1 or r["gone"] for r in found):
            raise DuplicateKeyError(f"batch for {name}: {primary_keys} is not a key")
        if not found:
            return
        current, keys = self.spark.table(name), batch.select(*primary_keys)
        candidates = current
        if partition_from_key and len(found) <= MOST_NAMED_PARTITIONS:
            candidates = candidates.filter(_any_partition([[r[c] for c in partition_columns] for r in found], partition_columns))
        if cluster_by and set(cluster_by) <= set(primary_keys):
            # Files and row groups outside the range of the batch are skipped by their statistics.
            first = cluster_by[0]
            candidates = candidates.filter(F.col(first).between(min(r["low"] for r in found), max(r["high"] for r in found)))
        held = candidates.select(*primary_keys, F.col("_metadata.file_path").alias("_file")).join(keys, primary_keys, "left_semi")
        old = [_plain_path(self.spark, r["_file"]) for r in held.select("_file").distinct().collect()]
        rows = batch.select(*columns)
        place = self.location(name)
        if old:
            kept_rows = self.spark.read.schema(current.schema).option("basePath", place).parquet(*old).select(*columns)
            rows = kept_rows.join(keys, primary_keys, "left_anti").unionByName(rows)
        if commit_files(_in_ranges(rows, partition_columns, cluster_by), place, partition_columns, old):
            self.spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")
        self.spark.catalog.refreshTable(name)

    def _overwrite(self, name: str, rows: DataFrame) -> None:
        properties = self._properties(name)
        parts = properties["partition_columns"]
        (_in_ranges(rows, parts, properties["cluster_by"]).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*parts).parquet(self.location(name)))
        self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(name)

    def location(self, name: str) -> str:
        return self.spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def primary_keys(self, name: str) -> list[str]:
        return self._properties(name)["primary_keys"]

    def _properties(self, name: str) -> dict:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        found = {r["key"]: r["value"] for r in rows}
        return {k: json.loads(found[k]) for k in ("primary_keys", "partition_columns", "partition_from_key", "cluster_by")}

    @staticmethod
    def _bad_keys(df: DataFrame, keys: Sequence[str]) -> bool:
        gone = F.lit(False)
        for k in keys:
            gone = gone | F.col(k).isNull()
        groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
        return bool(groups.filter((F.col("_n") > 1) | gone).limit(1).count())


def _any_partition(rows: Sequence, parts: Sequence[str]):
    """Predicate on partition columns; it prunes directories."""
    if len(parts) == 1 and all(r[0] is not None for r in rows):
        return F.col(parts[0]).isin([r[0] for r in rows])
    found = F.lit(False)
    for r in rows:
        this = F.lit(True)
        for part, value in zip(parts, r):
            this = this & F.col(part).eqNullSafe(F.lit(value))
        found = found | this
    return found


def _in_ranges(rows: DataFrame, parts: Sequence[str], clustering: Sequence[str]) -> DataFrame:
    """Rows dealt to files by ranges of partition and clustering columns, and sorted by them."""
    order = [*parts, *clustering]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _batch_summary(batch: DataFrame, keys: Sequence[str], parts: Sequence[str], clustering: Sequence[str]) -> list:
    """A row per touched partition: the most rows of a key, whether a key is missing, and the range of the first clustering column."""
    gone = F.lit(False)
    for k in keys:
        gone = gone | F.col(k).isNull()
    others = [c for c in parts if c not in keys]
    per_key = batch.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.min(c).alias(c) for c in others])
    ends = [F.min(clustering[0]).alias("low"), F.max(clustering[0]).alias("high")] if clustering and clustering[0] in keys else []
    return per_key.withColumn("_gone", gone).groupBy(*parts).agg(F.max("_n").alias("most"), F.max("_gone").alias("gone"), *ends).collect()


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """The row with the highest ``order_by`` per key, found by a partial aggregate."""
    others = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order_by).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)


# ------------------------------------------------------------------- lookups


@dataclass(frozen=True)
class FeatureLookup:
    """Which columns of which table to fetch, and which columns hold its key, in key order."""

    table_name: str
    feature_names: Sequence[str]
    lookup_key: Sequence[str]


@dataclass(frozen=True)
class TrainingSet:
    """A labelled frame together with the lookups that completed it."""

    store: FeatureStore
    source: DataFrame
    lookups: Sequence[FeatureLookup]
    label: str
    exclude_columns: Sequence[str] = ()

    def load_df(self) -> DataFrame:
        completed = add_features(self.store, self.source, self.lookups).drop(*self.exclude_columns)
        return completed.select(*[c for c in completed.columns if c != self.label], self.label)


def add_features(store: FeatureStore, df: DataFrame, lookups: Sequence[FeatureLookup]) -> DataFrame:
    """Left join every lookup; a trip without a matching window gets NULL."""
    for one in lookups:
        keys = store.primary_keys(one.table_name)
        df = lookup(df, store.table(one.table_name), dict(zip(one.lookup_key, keys)), one.feature_names)
    return df


def create_training_set(
    store: FeatureStore, df: DataFrame, lookups: Sequence[FeatureLookup], label: str, exclude_columns: Sequence[str] = ()
) -> TrainingSet:
    return TrainingSet(store, df, tuple(lookups), label, tuple(exclude_columns))


def trip_lookups(pickup_table: str, dropoff_table: str) -> list[FeatureLookup]:
    """Lookups of the trip example: pick-up window and drop-off window."""
    return [
        FeatureLookup(pickup_table, PICKUP_COLUMNS, ["pickup_zip", "rounded_pickup_datetime"]),
        FeatureLookup(dropoff_table, DROPOFF_COLUMNS, ["dropoff_zip", "rounded_dropoff_datetime"]),
    ]


def display_predictions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Prediction first, under its display name and with two decimals."""
    out = df.select("prediction", *columns).withColumnRenamed("prediction", "predicted_fare_amount")
    return rounded(out, ["predicted_fare_amount"], 2)
