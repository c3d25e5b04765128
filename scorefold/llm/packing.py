"""Sequence packing: window-filling length combinations counted by non-negative least squares."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorefold.llm.components import written
from scorefold.llm.tokens import encoder
from scorefold.llm.words import batch_of, slices, utf8

TOKENS = ("part int, doc_id long, doc_tokens long, full_before long, full_crcs array<long>, "
          "rest int, rest_rank long, rest_ids binary")
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")
#: Sequences that one uncut stretch of a document fills get ids from here on, apart by task.
FULL_BASE = 1 << 40


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, window: int, text: str) -> DataFrame:
    """Per document: checksums of its full windows, the ids left over, and running numbers within the task.

    ``rest_rank`` counts the earlier rests of the same length in the task,
    ``full_before`` the earlier full windows.  The table is written once, so the
    numbers stay as they are when a task is run again later.
    """
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, ranks, full = encoder(tokenizer).encode, TaskContext.get().partitionId(), Counter(), 0
        for batch, texts in slices(batches, "text"):
            rows = []
            for ids in encode(texts):
                ids += end
                n = len(ids) // 4
                cut = n // window * window * 4
                crcs = [zlib.crc32(ids[a:a + 4 * window]) for a in range(0, cut, 4 * window)]
                rest = n % window
                rows.append((n, full, crcs, rest, ranks[rest], ids[cut:]))
                ranks[rest] += 1
                full += len(crcs)
            n, before, crcs, rest, rank, ids = zip(*rows)
            yield batch_of(["part", "doc_id", "doc_tokens", "full_before", "full_crcs", "rest", "rest_rank", "rest_ids"],
                           np.full(len(n), part, np.int32), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(before, pa.int64()),
                           pa.array(crcs, pa.list_(pa.int64())), pa.array(rest, pa.int32()), pa.array(rank, pa.int64()), pa.array(ids, pa.binary()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("text")).mapInArrow(work, TOKENS)


# ---------------------------------------------------------------- the plan, from a histogram of at most window - 1 lengths


def combinations_filling(histogram: np.ndarray, window: int, depth: int, drawn: int, seed: int) -> np.ndarray:
    """Rows of up to ``depth`` lengths that fill ``window`` exactly, zero-padded; only lengths that occur.

    Repeats of one length closed by another, and combinations drawn in
    proportion to the histogram and closed by the length that is missing.
    """
    lengths = np.flatnonzero(histogram)
    found = set()
    for a in lengths:
        for times in range(1, depth):
            last = window - int(a) * times
            if last > 0 and histogram[last]:
                found.add(tuple(sorted([int(a)] * times + [last])))
    if len(lengths):
        rng = np.random.default_rng(seed)
        share = histogram[lengths] / histogram[lengths].sum()
        for size in range(2, depth):
            picks = rng.choice(lengths, size=(drawn, size), p=share)
            last = window - picks.sum(axis=1)
            ok = last > 0
            ok[ok] = histogram[last[ok]] > 0
            found.update(tuple(sorted(x)) for x in np.column_stack([picks[ok], last[ok]]).tolist())
    out = np.zeros((len(found), depth), np.int64)
    for i, c in enumerate(sorted(found)):
        out[i, :len(c)] = c
    return out


def non_negative_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that brings the lengths used near the histogram in least squares, by multiplicative steps."""
    live = combos > 0
    h = histogram.astype(float)
    target = (h[combos] * live).sum(axis=1)
    x = np.full(len(combos), max(h.sum(), 1.0) / max(1, live.sum()))
    for _ in range(rounds):
        used = np.bincount(combos[live], weights=np.repeat(x, live.sum(axis=1)), minlength=len(h))
        x *= target / np.maximum((used[combos] * live).sum(axis=1), 1e-12)
    return x


def rounded_counts(combos: np.ndarray, x: np.ndarray, histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whole counts, lengths left): rounded down, then topped up while every length lasts."""
    left, counts = histogram.copy(), np.zeros(len(combos), np.int64)
    kinds = [Counter(c[c > 0].tolist()) for c in combos]
    order = np.argsort(-x, kind="stable")
    for limit in (np.floor(x).astype(np.int64), np.full(len(x), np.iinfo(np.int64).max)):
        for i in order:
            n = min(int(limit[i]), min(int(left[length]) // m for length, m in kinds[i].items()))
            if n > 0:
                counts[i] += n
                for length, m in kinds[i].items():
                    left[length] -= n * m
    return counts, left


@dataclass
class Plan:
    """Where the r-th rest of each length goes; its size depends on the window and the combinations alone."""

    window: int
    #: Per length: first ranks of its segments, and for each the sequence of its first rank and the offset.
    segments: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    used: np.ndarray
    #: Place of each length's first residual in the stream of residuals, whose first sequence is ``stream_base``.
    stream_at: np.ndarray
    stream_total: int
    stream_base: int

    def places(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, tokens) for one rest; residuals of the stream may be cut."""
        if rank < self.used[length]:
            first, sequence, offset = self.segments[length]
            i = int(np.searchsorted(first, rank, side="right")) - 1
            return [(int(sequence[i]) + rank - int(first[i]), int(offset[i]), length)]
        at = int(self.stream_at[length]) + (rank - int(self.used[length])) * length
        out = []
        while length:
            number, offset, space = self.stream_place(at)
            take = min(space, length)
            out.append((self.stream_base + number, offset, take))
            at, length = at + take, length - take
        return out

    def stream_place(self, at: int) -> tuple[int, int, int]:
        """(sequence, offset, space there): full windows, and the tail in sequences of a power of two."""
        tail = self.stream_total % self.window
        whole = self.stream_total - tail
        if at < whole:
            return at // self.window, at % self.window, self.window - at % self.window
        number, begin = whole // self.window, whole
        while True:
            size = 1 << ((self.stream_total - begin).bit_length() - 1)
            if at < begin + size:
                return number, at - begin, begin + size - at
            number, begin = number + 1, begin + size


def make_plan(histogram: np.ndarray, window: int, depth: int = 6, drawn: int = 4000, seed: int = 7) -> Plan:
    """``histogram[n]`` rests of ``n`` tokens, 0 < n < window, dealt to sequences."""
    combos = combinations_filling(histogram, window, depth, drawn, seed)
    counts, left = rounded_counts(combos, non_negative_counts(combos, histogram), histogram)
    taken, parts, sequence = np.zeros(window, np.int64), {}, 0
    for c, n in zip(combos, counts):
        offset = 0
        for length in c[c > 0].tolist() if n else ():
            parts.setdefault(length, []).append((int(taken[length]), sequence, offset))
            taken[length] += n
            offset += length
        sequence += int(n)
    lengths = np.arange(window)
    stream = left * lengths
    return Plan(window, {k: tuple(np.array(x) for x in zip(*v)) for k, v in parts.items()}, taken,
                np.cumsum(stream) - stream, int(stream.sum()), sequence)


# ---------------------------------------------------------------- the operator


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Stretches of ``window`` ids fill sequences of their own.  The histogram of
    what is left over (fewer than ``window`` numbers) is all that reaches the
    driver: combinations that fill a window are counted by non-negative least
    squares and rounded; residuals follow each other in a stream that is cut at
    window borders and ends in sequences of a power of two.  So nothing is padded.

    A NULL or empty text is its end id alone; NULL ids and repeated rows are
    packed like others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = written(tokenised(docs, tokenizer, end_id, window, text), "packing")
    counts = written(rows.where("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n")), "rests")
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect():
        histogram[r["rest"]] = r["n"]
    plan = spark.sparkContext.broadcast(make_plan(histogram, window))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rest_before"))
    placed = rows.join(offsets, ["part", "rest"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        the_plan = plan.value
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                doc, n = r["doc_id"], r["doc_tokens"]
                sequence = FULL_BASE * (r["part"] + 1) + r["full_before"]
                for k, crc in enumerate(r["full_crcs"]):
                    out.append((doc, k * window, window, crc, n, sequence + k, 0))
                if r["rest"]:
                    start, ids = len(r["full_crcs"]) * window, memoryview(r["rest_ids"])
                    at = 0
                    for sequence, offset, size in the_plan.places(r["rest"], r["rest_rank"] + r["rest_before"]):
                        out.append((doc, start + at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), n, sequence, offset))
                        at += size
            if out:
                yield batch_of(names, *[pa.array(c, pa.int64()) for c in zip(*out)])

    return placed.select("part", "doc_id", "doc_tokens", "full_before", "full_crcs", "rest", "rest_rank", "rest_ids", "rest_before").mapInArrow(work, PIECES)
