"""Pick-up windows as a stream that keeps what comes too late.

A built-in windowed aggregate drops, without a trace, the part of a row that
falls into windows which the watermark has closed.  Here a stateful operator
over groups of ZIPs keeps the open windows, and hands on the parts for closed windows as
rows of their own; windows and late parts together are what a batch would count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scorefold.operators.feature_store import FeatureStore
from scorefold.session import staged
from scorefold.streaming.feature_stream import with_event_time

STEP, WIDTH = 900, 3600
#: Groups that the ZIPs are dealt to; a call per group and micro-batch, whatever the number of ZIPs.
BUCKETS = 1024
PARTS = "zip int, ts int, late boolean, fares double, fare_trips long, trips long"
STATE = "zips array<int>, ends array<int>, fares array<double>, fare_trips array<long>, trips array<long>"
WINDOWS = ["zip", "ts", "fares", "fare_trips", "trips"]
#: The feature table keeps sums, so that late parts can be added.
TABLE = "zip int, ts int, yyyy_mm string, fares double, fare_trips long, trips long"


def window_parts(zips: np.ndarray, seconds: np.ndarray, fares: np.ndarray) -> pd.DataFrame:
    """(zip, ts, fares, fare_trips, trips) by the ends of the hour-long windows, every quarter, that hold the trips."""
    here = ~np.isnan(fares)
    rows = pd.DataFrame({"zip": zips, "ts": seconds // STEP * STEP, "fares": np.where(here, fares, 0.0), "fare_trips": here.astype(np.int64), "trips": 1})
    quarters = rows.groupby(["zip", "ts"], as_index=False).sum()
    return added([quarters.assign(ts=quarters["ts"] + STEP + later) for later in range(0, WIDTH, STEP)])


def added(parts: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(parts).groupby(["zip", "ts"], as_index=False).sum()


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Adds the trips of a group of ZIPs to their open windows; late parts leave as they are, changed windows as they stand."""
    closed_until = state.getCurrentWatermarkMs() // 1000
    new = added([window_parts(b["zip"].to_numpy(), b["seconds"].to_numpy(), b["fare"].to_numpy(dtype=float, na_value=np.nan)) for b in batches])
    late = new["ts"] <= closed_until
    parts = new[late].assign(late=True)
    old = pd.DataFrame(dict(zip(WINDOWS, state.get))) if state.exists else new[:0]
    windows = added([old.assign(changes=0), new[~late].assign(changes=1)])
    changed = windows[windows["changes"] > 0].assign(late=False)
    # A closed window gets nothing any more: the feature table has it.
    kept = windows[windows["ts"] > closed_until]
    state.update(tuple(kept[c].tolist() for c in WINDOWS))
    yield pd.concat([parts, changed])[["zip", "ts", "late", "fares", "fare_trips", "trips"]]


def pickup_parts(
    df: DataFrame, ts: str = "tpep_pickup_datetime", zip_column: str = "pickup_zip", fare: str = "fare_amount", lateness: str = "1 hour",
    buckets: int = BUCKETS,
) -> DataFrame:
    """(zip, ts, late, fares, fare_trips, trips) over a stream of trips: open windows whenever they change, and late parts.

    The state is the open windows alone: per ZIP as many quarters as the
    lateness and an hour have.  ZIPs are dealt to ``buckets`` groups, which a
    task handles one at a time; the number belongs to the checkpoint, like the
    shuffle partitions.  Rows without a time or a ZIP are left out.
    """
    rows = with_event_time(df, ts, lateness).where(F.col(ts).isNotNull() & F.col(zip_column).isNotNull()).select(
        ts, F.col(zip_column).cast("int").alias("zip"), F.unix_seconds(ts).alias("seconds"), F.col(fare).cast("double").alias("fare"))
    dealt = rows.withColumn("bucket", F.pmod(F.hash("zip"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandasWithState(_advance, PARTS, STATE, "update", GroupStateTimeout.NoTimeout)


def upsert_with_late_rows(store: FeatureStore, name: str, parts: DataFrame, late_path: str, checkpoint: str) -> StreamingQuery:
    """Merges windows into the table ``name`` and writes late parts to a folder per micro-batch, until the input is used up.

    A micro-batch that is run again replaces what it wrote: windows by key, its folder of late parts as a whole.
    """
    def merge(batch: DataFrame, number: int) -> None:
        # Written once: the state is not advanced again for the second use.
        with staged(batch) as kept:
            windows = kept.where("NOT late").selectExpr(
                "zip", "ts", "date_format(timestamp_seconds(ts), 'yyyy-MM') AS yyyy_mm", "fares", "fare_trips", "trips")
            FeatureStore(batch.sparkSession, store.root).write_table(name, windows, mode="merge")
            kept.where("late").drop("late").write.mode("overwrite").parquet(f"{late_path}/batch={number}")

    return (
        parts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )


def complete_windows(windows: DataFrame, late: DataFrame) -> DataFrame:
    """(zip, ts, mean_fare, trips): windows with the parts that came late."""
    both = windows.select("zip", "ts", "fares", "fare_trips", "trips").unionByName(late.select("zip", "ts", "fares", "fare_trips", "trips"))
    return both.groupBy("zip", "ts").agg(
        F.try_divide(F.sum("fares"), F.sum("fare_trips")).alias("mean_fare"), F.sum("trips").alias("trips"))
