"""SimHash near-duplicates: fingerprints, pigeonhole blocks, exact Hamming checks, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorefold.llm.components import component_labels, written
from scorefold.llm.words import batch_of, slices, utf8

BITS = 64
SEED = 42


def fingerprint(text: bytes, width: int = 3, seed: int = SEED) -> int:
    """Bits set in over half the shingle hashes; repeats count, fewer words are one shingle, none give zero."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, seed)
    cuts = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(cuts[:len(cuts) - width + 1] + 1).tolist()]
    ends = [*cuts[width - 1:].tolist(), len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts, ends)], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i:i + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): one row per document; ``fp`` is the fingerprint as a signed long."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            fps = np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64)
            yield batch_of(["doc_id", "fp"], batch.column("doc_id"), fps)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("text")).mapInArrow(work, "doc_id long, fp long")


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of the bits that two fingerprints within ``radius`` share in at least one case.

    ``radius`` differing bits leave ``blocks - radius`` of the blocks equal, so
    every choice of that many blocks is one key.
    """
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, blocks - radius)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def spanning_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``radius`` that connect whatever is connected in ``fps``; fewer than there are fingerprints."""
    left, right, rest = [], [], fps
    while len(rest):
        queue, rest = [rest[-1:]], rest[:-1]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(rest ^ node) <= radius
            if near.any():
                found = rest[near]
                left.append(np.repeat(node, len(found)))
                right.append(found)
                queue.extend(found[i:i + 1] for i in range(len(found)))
                rest = rest[~near]
    none = np.empty(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def close_links(fps: DataFrame, radius: int = 3, blocks: int = 6, chunk: int = 1024) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that are within ``radius``.

    A block key with many fingerprints is dealt into chunks of about ``chunk``;
    every two chunks meet in one small group of their own, and each group
    returns a spanning forest of its links instead of all pairs.  Nothing is
    dropped: each close pair shares a key and its two chunks meet.
    """
    masks = block_masks(radius, blocks)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(masks)
    ])).alias("b")).select("fp", "b.k", "b.key")
    sizes = keyed.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1")
    dealt = (
        keyed.join(sizes, ["k", "key"])
        .withColumn("parts", F.ceil(F.col("n") / chunk).cast("int"))
        .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    groups = dealt.groupBy("k", "key", F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j")).agg(
        F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("fps")
            values, offsets = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
            found = [spanning_links(values[a:b], radius) for a, b in zip(offsets, offsets[1:])]
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield batch_of(["a", "b"], np.minimum(a, b), np.maximum(a, b))

    return groups.mapInArrow(work, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", radius: int = 3, blocks: int = 6, width: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): documents linked when their fingerprints differ in at most ``radius`` bits.

    Equal texts meet first as one fingerprint, so groups of copies cost one row.
    NULL and empty texts have fingerprint zero and are linked like any other.  A
    NULL doc_id stays and never names a component unless all its ids are NULL.
    Repeated rows are returned as often as they come; an empty table gives none.
    """
    prints = written(with_fingerprints(docs, text, width), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_fingerprints")
    labels = component_labels(close_links(distinct.select("fp"), radius, blocks))
    named = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    members = written(named.join(least, "label").select("fp", "component_id"), "members")
    return prints.join(members, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group, with all its columns.

    Rows with an equal doc_id count as one document and stay or go together;
    rows without a doc_id stay only when no row of their group has one.
    """
    groups = near_duplicates(docs, text)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["kept_id"]), "left_semi")
