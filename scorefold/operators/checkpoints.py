"""Row and key checkpoints that a job gathers while it runs, instead of jobs of their own."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "step string, rows long, null_keys long, key_digest decimal(38,0)"


@dataclass
class Checkpoints:
    """Named places in a plan where rows and keys are counted.

    ``mark`` returns the frame to go on with.  After an action on the final
    frame, ``report`` has a row per place; a step that loses, adds or repeats
    rows changes the number of rows or the digest, the sum of the hashes of all
    keys.  Nothing is read a second time and no job is added.
    """

    key: str
    seen: list[tuple[str, Observation]] = field(default_factory=list)

    def mark(self, df: DataFrame, step: str) -> DataFrame:
        place = Observation(f"{step}_{len(self.seen)}_{id(self)}")
        self.seen.append((step, place))
        return df.observe(
            place, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(self.key).isNull()).alias("null_keys"),
            F.sum(F.xxhash64(F.col(self.key).cast("string")).cast("decimal(38,0)")).alias("key_digest"))

    def report(self, spark: SparkSession) -> DataFrame:
        """(step, rows, null_keys, key_digest); waits for the first action on the marked frames."""
        rows = [(step, found["rows"], found["null_keys"], found["key_digest"]) for step, found in ((s, o.get) for s, o in self.seen)]
        return spark.createDataFrame(rows, SCHEMA)

    def changed(self) -> list[str]:
        """Steps whose rows or keys are not those of the step before."""
        found = [(step, o.get["rows"], o.get["key_digest"]) for step, o in self.seen]
        return [b[0] for a, b in zip(found, found[1:]) if a[1:] != b[1:]]
