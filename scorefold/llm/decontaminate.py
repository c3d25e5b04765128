"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, exact shingle similarity.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.components import written

SHINGLE = 5
BITS = 64
#: Differing bits up to which fingerprints are compared; the 64 bits of two windows that share
#: eight tenths of their shingles differ in about ten, with a deviation of three.
RADIUS = 24
#: Shingles of the items that may be broadcast, about 64 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    """Lower-case words between ASCII white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(words: str, width: int = SHINGLE) -> Column:
    """A 64-bit hash for every ``width`` words in a row; fewer words are one shingle, none give none."""
    run = ", ".join(f"{words}[i + {k}]" for k in range(width))
    return F.expr(f"""CASE WHEN size({words}) >= {width} THEN transform(sequence(0, size({words}) - {width}), i -> xxhash64({run}))
        WHEN size({words}) > 0 THEN array(xxhash64(concat_ws(' ', {words}))) ELSE CAST(array() AS array<bigint>) END""")


def with_shingles(df: DataFrame, text: str = "text") -> DataFrame:
    """The shingle hashes of ``text`` as column ``s`` in its place; words are split once, in a step of their own.

    To be exploded with the outer form: for the inner one Spark tests the size
    of the array first, and evaluates the split again for every word of it.
    """
    rest = [c for c in df.columns if c != text]
    words = df.select(*rest, words_of(F.col(text)).alias("w"))
    return words.select(*rest, shingle_hashes("w").alias("s"))


def fingerprint(shingles: str) -> Column:
    """Bits set in over half of the shingle hashes, repeats included; 0 for none."""
    ones = f"aggregate({shingles}, 0, (n, h) -> n + CAST(shiftrightunsigned(h, b) & 1 AS INT))"
    return F.expr(f"aggregate(sequence(0, {BITS - 1}), 0L, (fp, b) -> fp | IF(2 * {ones} > size({shingles}), shiftleft(1L, b), 0L))")


def blocks(fp: str, radius: int = RADIUS) -> Column:
    """(block, bits) of ``radius + 1`` blocks, one row each: within the radius at least one is equal."""
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    parts = (f"CAST(shiftrightunsigned({fp}, {a}) & {(1 << b - a) - 1} AS INT)" for a, b in zip(edges, edges[1:]))
    # The outer form: for the inner one Spark tests the size first and computes the fingerprint anew in every block.
    return F.expr(f"posexplode_outer(array({', '.join(parts)}))").alias("block", "bits")


def item_table(items: DataFrame, text: str = "text") -> DataFrame:
    """(item_id, item_shingles, n_words, item_fp); items without words match nothing."""
    w = items.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    s = w.select("item_id", F.size("w").alias("n_words"), shingle_hashes("w").alias("item_shingles")).distinct()
    return s.withColumn("item_fp", fingerprint("item_shingles"))


def weighted_similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles."""
    n = "size(filter({}, x -> x = h))"
    shared = f"aggregate(array_distinct({a}), 0, (total, h) -> total + least({n.format(a)}, {n.format(b)}))"
    return F.expr(f"{shared} / (size({a}) + size({b}) - {shared})")


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", similarity: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """(doc_id, th, item_id, start, n_words, similarity): the best window of a document for each item it holds.

    Windows have the item's number of words; a shorter document is one window.
    Only windows that can be the best one are built: those that begin where a run
    of shingles shared with the item begins (or the last window, when that lies
    behind it).  A window that begins elsewhere can be moved there one shingle at
    a time without losing more shared shingles than it gains; where a shared
    shingle is repeated in the document, so that this doesn't hold, windows begin
    at all shared shingles.  SimHash fingerprints of windows and of the items they
    share a shingle with meet in ``radius + 1`` blocks, so a window never meets
    items it has nothing in common with; candidates within the radius are kept if the weighted
    Jaccard similarity of the five-word shingles is ``similarity`` or more.  Ties
    go to the first start.

    NULL and empty texts hold nothing.  Equal rows give one result; rows of one
    id with different texts are told apart by ``th``, a hash of the text.
    """
    # Written once: splits and fingerprints of the items are read again by both joins.
    item = written(item_table(items, text), "items")
    shingles = item.select("item_id", "n_words", F.explode_outer("item_shingles").alias("h")).distinct()
    few = shingles.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    small = F.broadcast if few else (lambda df: df)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = plain.select("doc_id", F.xxhash64("text").alias("th"), "text")
    hits = (
        with_shingles(keyed).select("doc_id", "th", F.posexplode_outer("s").alias("p", "h"))
        .join(small(shingles), "h").select("doc_id", "th", "item_id", "n_words", "p", "h").distinct())
    runs = hits.groupBy("doc_id", "th", "item_id", "n_words").agg(
        F.sort_array(F.collect_list("p")).alias("ps"), (F.countDistinct("h") == F.count("h")).alias("single"))
    begins = F.filter("ps", lambda p, i: ~F.col("single") | (i == 0) | (F.element_at("ps", F.greatest(i, F.lit(1))) != p - 1))
    found = written(runs.select("doc_id", "th", "item_id", "n_words", F.explode(begins).alias("p")).groupBy(
        F.col("doc_id").alias("id"), F.col("th").alias("t")).agg(F.collect_set(F.struct("item_id", "n_words", "p")).alias("begins")), "leak_begins")
    # The few documents with a shared shingle are read again; nothing of the others is shuffled but their text.
    again = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("t"))).drop("id", "t")
    windows = (
        with_shingles(again)
        .select("doc_id", "th", "s", F.explode("begins").alias("x")))
    span = F.greatest(F.lit(1), F.col("x.n_words") - (SHINGLE - 1))
    last = F.greatest(F.lit(0), F.size("s") - span)
    windows = (
        windows.select("doc_id", "th", "x.item_id", F.col("x.n_words").alias("n_words"), F.least(F.col("x.p"), last).alias("start"), span.alias("span"), "s")
        .select("doc_id", "th", "item_id", "n_words", "start", F.slice("s", F.col("start") + 1, F.col("span")).alias("window"))
        .dropDuplicates(["doc_id", "th", "item_id", "start"])
        .withColumn("fp", fingerprint("window")))
    left = windows.select("*", blocks("fp", radius))
    right = item.drop("n_words").select("*", blocks("item_fp", radius))
    close = (
        left.join(right, ["item_id", "block", "bits"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .dropDuplicates(["doc_id", "th", "start", "item_id"])
        .withColumn("similarity", weighted_similarity("window", "item_shingles")).where(F.col("similarity") >= similarity))
    best = F.max_by(F.struct("start", "n_words", "similarity"), F.struct("similarity", -F.col("start")))
    return close.groupBy("doc_id", "th", "item_id").agg(best.alias("b")).select("doc_id", "th", "item_id", "b.start", "b.n_words", "b.similarity")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents, with all columns, that hold no benchmark item; equal rows go together."""
    leaks = written(find_leaks(docs, items, text).select(F.col("doc_id").alias("leak_id"), F.col("th").alias("leak_th")).distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"].cast("long").eqNullSafe(F.col("leak_id"))
                     & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == F.col("leak_th")), "left_anti")
