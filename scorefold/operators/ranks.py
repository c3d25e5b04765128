"""Exact values at given ranks of many columns at once, without sorting any of them.

A double's bits, with the sign folded in, order like the double.  Each round
counts the next few bits of the values that agree with a wanted value so far,
in every column in the same pass; the digit that holds the wanted rank extends
the prefix.  Four rounds of 16 bits name a value, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 16
KEY_BITS = 64
_SIGN = np.uint64(1 << 63)
_COUNTS = "name string, prefix decimal(20,0), digit int, n long"


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Unsigned integers that order as the doubles do; both zeros are one."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & _SIGN != 0, ~bits, bits | _SIGN)


def from_ordered_bits(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def digit_counts(df: DataFrame, prefixes: Mapping[str, Sequence[int]], done: int, bits: int) -> DataFrame:
    """(name, prefix, digit, n): how often each digit follows each prefix of ``done`` bits, counted per task."""
    rest = np.uint64(KEY_BITS - done)
    shift, mask = np.uint64(KEY_BITS - done - bits), np.uint64((1 << bits) - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {(c, p): np.zeros(1 << bits, np.int64) for c, own in prefixes.items() for p in own}
        for batch in batches:
            for c, own in prefixes.items():
                keys = ordered_bits(batch.column(c).drop_null().to_numpy(zero_copy_only=False))
                digits = (keys >> shift & mask).astype(np.int64)
                for p in own:
                    some = digits[keys >> rest == np.uint64(p)] if done else digits
                    counts[c, p] += np.bincount(some, minlength=1 << bits)
        for (c, p), n in counts.items():
            at = np.flatnonzero(n)
            if len(at):
                prefix = pa.array([str(p)] * len(at)).cast(pa.decimal128(20, 0))
                yield pa.RecordBatch.from_arrays([pa.array([c] * len(at)), prefix, pa.array(at.astype(np.int32)), pa.array(n[at])],
                                                 names=["name", "prefix", "digit", "n"])

    counted = df.select(*prefixes).mapInArrow(work, _COUNTS)
    return counted.groupBy("name", "prefix", "digit").agg(F.sum("n").alias("n"))


def values_at_ranks(df: DataFrame, wanted: Mapping[str, Sequence[int]], bits: int = DIGIT_BITS) -> dict[tuple[str, int], float]:
    """{(column, rank): value} for ranks from 0 among the non-NULL values of double columns; none may be NaN.

    A round moves at most ``2 ** bits`` counters per column and wanted value from
    a task, and brings one row per column and prefix to the driver: the counts of
    one prefix, at most that many, are folded by an aggregate over its digits.
    """
    bits = max(1, min(DIGIT_BITS, bits))
    # (column, rank) -> (prefix so far, rank among the values that have it)
    state = {(c, r): (0, r) for c, own in wanted.items() for r in set(own)}
    done = 0
    while state and done < KEY_BITS:
        width = min(bits, KEY_BITS - done)
        prefixes = {c: sorted({p for (name, _), (p, _) in state.items() if name == c}) for c in wanted if wanted[c]}
        counts = digit_counts(df, prefixes, done, width)
        digits = counts.groupBy("name", "prefix").agg(F.array_sort(F.collect_list(F.struct("digit", "n"))).alias("digits"))
        ranks = {}
        for (c, _), (p, r) in state.items():
            ranks.setdefault((c, p), set()).add(r)
        asked = F.create_map(*[x for (c, p), r in ranks.items() for x in (F.lit(f"{p} {c}"), F.array(*map(F.lit, sorted(r))))])
        # From the first digit on: the digits and values before a rank.
        step = ("aggregate(digits, named_struct('at', -1, 'before', 0L, 'sum', 0L), (s, d) -> if(s.at >= 0, s, if(s.sum + d.n > r, "
                "named_struct('at', d.digit, 'before', s.sum, 'sum', s.sum + d.n), named_struct('at', -1, 'before', 0L, 'sum', s.sum + d.n))))")
        picked = digits.withColumn("ranks", asked[F.concat_ws(" ", F.col("prefix").cast("string"), "name")]).selectExpr(
            "name", "prefix", f"inline(transform(ranks, r -> named_struct('rank', CAST(r AS BIGINT), 'found', {step})))")
        found = {(x["name"], int(x["prefix"]), x["rank"]): (x["found"]["at"], x["found"]["before"]) for x in picked.collect()}
        state = {k: ((p << width) | found[k[0], p, r][0], r - found[k[0], p, r][1]) for k, (p, r) in state.items()}
        done += width
    return {k: from_ordered_bits(p) for k, (p, _) in state.items()}
