"""Trip features as a stream that upserts into a feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scorefold.operators.feature_store import FeatureStore, dropoff_features, pickup_features


def with_event_time(df: DataFrame, ts: str, lateness: str = "1 hour") -> DataFrame:
    """Event time with a watermark, which bounds the window state that is kept."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def pickup_feature_stream(df: DataFrame, ts: str = "tpep_pickup_datetime", lateness: str = "1 hour", **columns) -> DataFrame:
    """One-hour windows every 15 minutes per pick-up ZIP over a stream of trips."""
    return pickup_features(with_event_time(df, ts, lateness), ts=ts, **columns)


def dropoff_feature_stream(df: DataFrame, ts: str = "tpep_dropoff_datetime", lateness: str = "1 hour", **columns) -> DataFrame:
    """30-minute windows per drop-off ZIP over a stream of trips."""
    return dropoff_features(with_event_time(df, ts, lateness), ts=ts, **columns)


def upsert_stream(
    store: FeatureStore, name: str, features: DataFrame, checkpoint: str, output_mode: str = "update"
) -> StreamingQuery:
    """Merge every micro-batch into the table and stop when the input is used up.

    In update mode a window is written again whenever it changes; the merge
    replaces it by key, so a batch that is run twice changes nothing.
    """
    def merge(batch: DataFrame, _: int) -> None:
        FeatureStore(batch.sparkSession, store.root).write_table(name, batch, mode="merge")

    return (
        features.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )
