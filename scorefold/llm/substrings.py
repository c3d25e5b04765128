"""Repeated passages: a count-min prefilter, then exact grouping of the windows it cannot rule out."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorefold.llm.words import (
    NO_ID, WordHashes, batch_of, joined, mixed, run_keys, slices, sliding, text_of_position, utf8,
)

WINDOW = 20
ANCHOR = 8
DEPTH = 2
#: One block of a sketch row: 2**16 counters.
BLOCK_BITS = 16


def cells_of(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The counter of each key in one row of the sketch."""
    spread = mixed(keys, np.full(len(keys), row + 1, np.uint64))
    return (spread >> np.uint64(64 - bits)).astype(np.uint32)


def anchors(keys: np.ndarray, counts: np.ndarray, window: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, anchor key of each, keys of all chosen anchors).

    The anchor of a window is the least key among its runs of ``width`` words, so
    equal windows have equal anchors.  Every run that is the anchor of some
    window is counted once, hence an anchor's count is never below the number of
    windows with one content: the sketch may count anchors in place of windows,
    which are several times as many.
    """
    n = len(keys) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64), *[np.empty(0, np.uint64)] * 2)
    text = text_of_position(counts)
    runs = run_keys(keys, width)
    span = window - width + 1
    least = sliding(runs, span, np.minimum)[:n]
    whole = text[:n] == text[window - 1:window - 1 + n]
    # A run is an anchor if a window around it has it as its least key.
    top = np.zeros(len(runs) + span - 1, np.uint64)
    top[span - 1:span - 1 + n] = np.where(whole, least, 0)
    chosen = sliding(top, span, np.maximum)[:len(runs)] == runs
    starts = np.flatnonzero(whole)
    return starts, least[starts], runs[chosen]


def partial_sketch(docs: DataFrame, bits: int, window: int, width: int) -> DataFrame:
    """(row, block, salt, once, more): for each slice of texts, the counters hit once and more often, by block."""
    low = np.uint32((1 << BLOCK_BITS) - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting, size = WordHashes(), [], 0

        def out():
            keys = np.concatenate(waiting)
            for row in range(DEPTH):
                cells, n = np.unique(cells_of(keys, row, bits), return_counts=True)
                blocks = cells >> np.uint32(BLOCK_BITS)
                firsts = np.flatnonzero(np.diff(blocks, prepend=np.uint32(0xFFFFFFFF)))
                rest, twice = (cells & low).astype("<u2"), n > 1
                once, more = [], []
                for a, b in zip(firsts, [*firsts[1:], len(cells)]):
                    t = twice[a:b]
                    once.append(rest[a:b][~t].tobytes())
                    more.append(rest[a:b][t].tobytes())
                yield batch_of(["row", "block", "once", "more"], np.full(len(firsts), row, np.int32),
                               blocks[firsts].astype(np.int32), pa.array(once, pa.binary()), pa.array(more, pa.binary()))

        for _, texts in slices(batches, "text"):
            words, counts = joined(texts)
            found = anchors(hashes.of(words), counts, window, width)[2]
            waiting.append(found)
            size += len(found)
            if size > 4_000_000:
                yield from out()
                waiting, size = [], 0
        if size:
            yield from out()

    return docs.select("text").mapInArrow(work, "row int, block int, once binary, more binary")


def merged(parts: DataFrame, salts: int) -> DataFrame:
    """Sketch parts added up by block; counts stop at two.  ``salts`` > 1 merges in two steps of bounded groups."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once, more = [], []
            for a, b in zip(batch.column("once").to_pylist(), batch.column("more").to_pylist()):
                n = np.zeros(1 << BLOCK_BITS, np.uint8)
                for x in a:
                    cells = np.frombuffer(x, "<u2")
                    n[cells] = np.minimum(n[cells] + 1, 2)
                n[np.frombuffer(b"".join(b), "<u2")] = 2
                once.append(np.flatnonzero(n == 1).astype("<u2").tobytes())
                more.append(np.flatnonzero(n == 2).astype("<u2").tobytes())
            yield batch_of(["row", "block", "once", "more"], batch.column("row"), batch.column("block"),
                           pa.array(once, pa.binary()), pa.array(more, pa.binary()))

    for salt in ([F.pmod(F.xxhash64("once", "more"), F.lit(salts)).alias("salt")] if salts > 1 else []) + [F.lit(0).alias("salt")]:
        parts = (parts.groupBy("row", "block", salt).agg(F.collect_list("once").alias("once"), F.collect_list("more").alias("more"))
                 .select("row", "block", "once", "more").mapInArrow(add, "row int, block int, once binary, more binary"))
    return parts


def sketch_bits(docs: DataFrame, max_bits: int) -> int:
    """Counters per row: about four for each expected anchor, so that few unrelated keys meet."""
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = n_bytes / 6 * 2 / (WINDOW - ANCHOR + 2)
    return max(BLOCK_BITS, min(max_bits, math.ceil(math.log2(max(1.0, 4 * expected)))))


def repeated_counters(docs: DataFrame, window: int, width: int, max_bits: int) -> tuple[int, np.ndarray]:
    """(bits, bitmap by row): the counters of the merged sketch that stand at two or more.

    The bitmaps have ``DEPTH * 2**bits`` bits, at most ``DEPTH * 2**max_bits``
    whatever the input: 64 MB at the default.
    """
    bits = sketch_bits(docs, max_bits)
    high = np.zeros((DEPTH, 1 << (bits - 3)), np.uint8)
    per_block = 1 << (BLOCK_BITS - 3)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for more in batch.column("more").to_pylist():
                flags = np.zeros(1 << BLOCK_BITS, bool)
                flags[np.frombuffer(more, "<u2")] = True
                maps.append(np.packbits(flags, bitorder="little").tobytes())
            yield batch_of(["row", "block", "bitmap"], batch.column("row"), batch.column("block"), pa.array(maps, pa.binary()))

    sketch = merged(partial_sketch(docs, bits, window, width), salts=16).where(F.octet_length("more") > 0)
    for r in sketch.mapInArrow(packed, "row int, block int, bitmap binary").toLocalIterator():
        high[r["row"], r["block"] * per_block:(r["block"] + 1) * per_block] = np.frombuffer(r["bitmap"], np.uint8)
    return bits, high


def estimated_repeated(keys: np.ndarray, bits: int, high: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for row in range(DEPTH):
        cells = cells_of(keys, row, bits)
        found &= (high[row][cells >> np.uint32(3)] >> (cells & np.uint32(7)).astype(np.uint8)) & np.uint8(1) == 1
    return found


ROW = "h1 long, h2 long, doc_id long, th long, start int, stop int"
NAMES = ["h1", "h2", "doc_id", "th", "start", "stop"]


def candidates(docs: DataFrame, window: int, width: int, max_bits: int) -> DataFrame:
    """Windows that the sketch cannot rule out.

    Of windows with equal content, each slice of texts passes on its earliest
    alone; the later ones are certain and leave as finished runs of starts
    (``stop`` > 0), so a passage in a third of all documents costs one row per slice.
    """
    bits, high = repeated_counters(docs, window, width, max_bits)
    shared = docs.sparkSession.sparkContext.broadcast((bits, high))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        bits, high = shared.value
        for batch, texts in slices(batches, "text"):
            words, counts = joined(texts)
            keys = hashes.of(words)
            starts, anchor, _ = anchors(keys, counts, window, width)
            starts = starts[estimated_repeated(anchor, bits, high)]
            if not len(starts):
                continue
            text = text_of_position(counts)[starts]
            first = np.cumsum(counts) - counts
            ids = batch.column("doc_id").to_numpy()[text]
            th = batch.column("th").to_numpy()[text]
            at = (starts - first[text]).astype(np.int32)
            h1 = run_keys(keys, window)[starts].view(np.int64)
            h2 = run_keys(mixed(keys, keys ^ np.uint64(0x5555)), window)[starts].view(np.int64)
            order = np.lexsort((at, th, ids, h2, h1))
            h1, h2, ids, th, at = (x[order] for x in (h1, h2, ids, th, at))
            head = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
            of = np.repeat(head, np.diff(np.append(head, len(h1))))
            same = (ids == ids[of]) & (th == th[of]) & (at == at[of])
            keep = np.zeros(len(h1), bool)
            keep[head] = True
            open_rows = [h1[keep], h2[keep], ids[keep], th[keep], at[keep], np.zeros(len(head), np.int32)]
            late = ~same
            if late.any():
                ids, th, at = ids[late], th[late], at[late]
                order = np.lexsort((at, th, ids))
                ids, th, at = ids[order], th[order], at[order]
                gap = (ids[1:] != ids[:-1]) | (th[1:] != th[:-1]) | (at[1:] > at[:-1] + 1)
                a = np.flatnonzero(np.concatenate([[True], gap]))
                b = np.append(a[1:], len(ids)) - 1
                closed = [th[a], at[a].astype(np.int64), ids[a], th[a], at[a], at[b] + 1]
                open_rows = [np.concatenate([x, y]) for x, y in zip(open_rows, closed)]
            yield batch_of(NAMES, *[x.astype(np.int32) if i > 3 else x for i, x in enumerate(open_rows)])

    return docs.select("doc_id", "th", "text").mapInArrow(work, ROW)


def repeated_windows(docs: DataFrame, window: int = WINDOW, width: int = ANCHOR, max_bits: int = 28) -> DataFrame:
    """(doc_id, th, starts, stops): per document the runs of starts of windows that occur earlier."""
    found = candidates(docs, window, width, max_bits)
    same = Window.partitionBy("h1", "h2", F.expr("stop > 0")).orderBy("doc_id", "th", "start")
    late = (found.withColumn("place", F.when(F.col("stop") > 0, 2).otherwise(F.rank().over(same))).where("place > 1")
            .select("doc_id", "th", "start", F.when(F.col("stop") > 0, F.col("stop")).otherwise(F.col("start") + 1).alias("stop")))
    return late.groupBy("doc_id", "th").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, width: int = ANCHOR, max_bits: int = 28) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without the words of windows that also start earlier.

    Earlier is a smaller doc_id (NULL is the smallest), then, for different
    texts under one id, a smaller hash of the text, then an earlier start in the
    document; equal rows count as one document and get the same result.  A NULL
    or empty text has no words; a text shorter than a window keeps all.  ``kept``
    is the kept words joined by one space.  Windows are compared by 128 bits.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).select(
        F.coalesce("id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("t").alias("th"), F.col("t").cast("binary").alias("text"))
    runs = repeated_windows(plain, window, width, max_bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            n_words, n_removed, kept = [], [], []
            for t, starts, stops in zip(texts, batch.column("starts").to_pylist(), batch.column("stops").to_pylist()):
                words = t.split()
                n_words.append(len(words))
                if starts:
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, starts, 1)
                    np.add.at(steps, np.asarray(stops) + window - 1, -1)
                    stays = np.cumsum(steps[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stays)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield batch_of(["doc_id", "n_words", "n_removed", "kept"], batch.column("doc_id"), pa.array(n_words, pa.int64()),
                           pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()))

    out = plain.join(runs, ["doc_id", "th"], "left").mapInArrow(work, "doc_id long, n_words long, n_removed long, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))).withColumn("kept", F.col("kept").cast("string"))


def sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


def brute_force(rows: list[tuple[int, str | None]], window: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """What ``remove_repeats`` returns, by a dictionary of all windows (for tests)."""
    split = {i: (t or "").encode().split() for i, t in rows}
    seen, out = set(), {}
    for i in sorted(split):
        words, drop = split[i], set()
        for k in range(len(words) - window + 1):
            w = tuple(words[k:k + window])
            if w in seen:
                drop.update(range(k, k + window))
            seen.add(w)
        kept = b" ".join(w for k, w in enumerate(words) if k not in drop)
        out[i] = len(words), len(drop), hashlib.sha256(kept).hexdigest()
    return out
