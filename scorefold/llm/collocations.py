"""Phrase collocations, counted with HAT-tries whose subtrees leave as sorted runs."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorefold.llm.components import written
from scorefold.llm.words import WordHashes, batch_of, mixed, slices, utf8

#: Entries of a hash container beyond which it bursts, and of all containers of a task beyond which subtrees are spilled.
BURST = 16_384
MAX_ENTRIES = 1_000_000
#: Words that a task has numbers for before it starts anew, and words taken at a time, from texts of so many bytes.
MAX_WORDS = 1 << 21
BLOCK = 1 << 20
SLICE = 8 << 20
#: Three word ids share 63 bits.
BITS = 21
#: Parts that the phrases with one first word are dealt into.
SPREAD = 64
#: Bits of the filter of frequent pairs, at most: 32 MB in every task.  A fuller filter lets more triples be counted.
FILTER_BITS = 28
FILTER_BLOCK = 16
PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)
#: Ends of pieces (as a line feed) and what separates words; A-Z are lower-cased.
MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
RUN = ["lang", "phrase", "n"]
RUN_SCHEMA = "lang string, phrase string, n long"


# ---------------------------------------------------------------- the trie


class Node:
    """A trie node: consecutive ranges of word ids, each with a hash container or, for one id, a node below.

    Keys are packed word ids, so a range of ids at a depth is a range of keys.
    A container that is too full is split at the middle id; with a single id
    it becomes a node of the next depth.
    """

    def __init__(self, depth: int, entries: dict[int, int] | None = None):
        self.shift = BITS * (2 - depth)
        self.depth = depth
        self.firsts, self.below = [0], [{} if entries is None else entries]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> int:
        """Adds sorted keys; returns how many were new."""
        ids = (keys >> self.shift) & ((1 << BITS) - 1)
        cuts = [0, *np.searchsorted(ids, self.firsts[1:]).tolist(), len(keys)]
        new = 0
        for i in range(len(self.below) - 1, -1, -1):  # from the end: a burst moves what follows
            a, b = cuts[i], cuts[i + 1]
            if a == b:
                continue
            child = self.below[i]
            if isinstance(child, Node):
                new += child.add(keys[a:b], counts[a:b])
                continue
            size, get = len(child), child.get
            for key, n in zip(keys[a:b].tolist(), counts[a:b].tolist()):
                child[key] = get(key, 0) + n
            new += len(child) - size
            if len(child) > BURST:
                self.burst(i)
        return new

    def burst(self, i: int) -> None:
        entries, mask = self.below[i], (1 << BITS) - 1
        ids = sorted((key >> self.shift) & mask for key in entries)
        middle = ids[len(ids) // 2]
        middle = middle if middle > ids[0] else ids[bisect_right(ids, middle)] if ids[-1] > middle else None
        if middle is not None:
            low, high = {}, {}
            for key, n in entries.items():
                (high if (key >> self.shift) & mask >= middle else low)[key] = n
            self.firsts.insert(i + 1, middle)
            self.below[i:i + 1] = [low, high]
        elif self.depth < 2:
            # The node is for this id alone; what lies beside it in the range keeps containers.
            own, end = ids[0], self.firsts[i + 1] if i + 1 < len(self.firsts) else 1 << BITS
            parts = [(self.firsts[i], {})] * (own > self.firsts[i]) + [(own, Node(self.depth + 1, entries))] + [(own + 1, {})] * (own + 1 < end)
            self.firsts[i:i + 1] = [f for f, _ in parts]
            self.below[i:i + 1] = [c for _, c in parts]

    def size(self) -> int:
        return sum(c.size() if isinstance(c, Node) else len(c) for c in self.below)

    def items(self) -> Iterator[tuple[int, int]]:
        for child in self.below:
            yield from child.items()


class WordIds(dict):
    """Numbers of words in the order they are met, with their XXH64; 0 and 1 are no words: nothing, and the end of a piece."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})
        self.names, self.hashes, self.hashed = [b"", b"\n"], np.zeros(2, np.uint64), 2

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.names)
        self.names.append(word)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hash_of(self, ids: np.ndarray) -> np.ndarray:
        if self.hashed < len(self.names):
            new = self.names[self.hashed:]
            self.hashes = np.concatenate([self.hashes, np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))])
            self.hashed = len(self.names)
        return self.hashes[ids]


class Trie:
    """Phrase counts of one task: a word-id trie per language, and how often each word occurs at its root."""

    def __init__(self):
        self.ids = WordIds()
        self.words: dict[str, np.ndarray] = {}
        self.roots: dict[str, Node] = {}
        self.entries = 0

    def add_words(self, lang: str, ids: np.ndarray) -> None:
        counts = np.bincount(ids)
        old = self.words.get(lang, np.empty(0, np.int64))
        if len(old) > len(counts):
            old[:len(counts)] += counts
        else:
            counts[:len(old)] += old
            self.words[lang] = counts

    def add(self, lang: str, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        if len(keys):
            self.entries += self.roots.setdefault(lang, Node(0)).add(keys, counts)

    def run(self, lang: str, subtree, names: pa.Array) -> pa.RecordBatch:
        """A subtree as a run sorted by the words' ids, so that phrases with one beginning stand together."""
        n = subtree.size() if isinstance(subtree, Node) else len(subtree)
        keys = np.fromiter((k for k, _ in subtree.items()), np.int64, n)
        counts = np.fromiter((v for _, v in subtree.items()), np.int64, n)
        order = np.argsort(keys)
        keys = keys[order]
        parts = [names.take(pa.array(keys >> BITS * (2 - i) & ((1 << BITS) - 1))) for i in range(3 if n and keys[0] & ((1 << BITS) - 1) else 2)]
        return batch_of(RUN, pa.array([lang]).take(pa.array(np.zeros(n, np.int64))), pc.binary_join_element_wise(*parts, " "), counts[order])

    def name_array(self) -> pa.Array:
        return pa.array([w.decode("utf-8", "replace") for w in self.ids.names])

    def spilled(self, keep: int) -> Iterator[pa.RecordBatch]:
        """The largest subtrees of all roots leave until at most ``keep`` entries stay."""
        names = self.name_array()
        found = sorted(((c.size() if isinstance(c, Node) else len(c), lang, node.firsts[i]) for lang, node in self.roots.items()
                        for i, c in enumerate(node.below)), reverse=True)
        for size, lang, first in found:
            if self.entries <= keep:
                break
            node = self.roots[lang]
            i = node.firsts.index(first)
            if size:
                yield self.run(lang, node.below[i], names)
            node.below[i] = {}
            self.entries -= size

    def all(self) -> Iterator[pa.RecordBatch]:
        yield from self.spilled(0)
        names = self.name_array()
        for lang, counts in self.words.items():
            at = np.flatnonzero(counts)
            yield batch_of(RUN, pa.array([lang]).take(pa.array(np.zeros(len(at), np.int64))), names.take(pa.array(at)), counts[at])
        self.__init__()


# ---------------------------------------------------------------- counting in tasks


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words of many texts); a line feed stands where a piece ends, and empty words are left in."""
    for batch, texts in slices(batches, "text", SLICE):
        groups = {}
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            groups.setdefault(lang, []).append(text)
        for lang, own in groups.items():
            yield lang, b"\n".join(own).lower().translate(MARKS).replace(b"\n", b" \n ").split(b" ")


def blocks(trie: Trie, words: list[bytes]) -> Iterator[tuple[np.ndarray | None, int]]:
    """(ids, phrases that start here) of words taken some at a time, with the two words after them; None: spill first."""
    words = list(filter(None, words))
    for begin in range(0, len(words), BLOCK):
        part = words[begin:begin + BLOCK + 2]
        if len(trie.ids.names) + len(part) > MAX_WORDS:
            yield None, 0
        yield trie.ids.of(part), min(BLOCK, len(words) - begin)


def words_and_pairs(docs: DataFrame) -> DataFrame:
    """Runs of the counts of words and pairs; the empty phrase counts all words of a language."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, totals = Trie(), {}
        for lang, words in by_language(batches):
            for ids, n in blocks(trie, words):
                if ids is None:
                    yield from trie.all()
                    continue
                first, after = ids[:n], np.append(ids[1:], 1)[:n]
                word = first > 1
                totals[lang] = totals.get(lang, 0) + int(word.sum())
                trie.add_words(lang, first[word])
                word &= after > 1
                trie.add(lang, (first[word] << 2 * BITS) + (after[word] << BITS))
                if trie.entries > MAX_ENTRIES:
                    yield from trie.spilled(MAX_ENTRIES // 2)
        yield from trie.all()
        if totals:
            yield batch_of(RUN, list(totals), [""] * len(totals), pa.array(totals.values(), pa.int64()))

    return docs.mapInArrow(work, RUN_SCHEMA)


def triples(docs: DataFrame, bits: int, filtered: np.ndarray) -> DataFrame:
    """Runs of the counts of triples both of whose pairs the filter takes for frequent."""
    shared = docs.sparkSession.sparkContext.broadcast(filtered)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, bitmap = Trie(), shared.value
        for lang, words in by_language(batches):
            for ids, n in blocks(trie, words):
                if ids is None:
                    yield from trie.all()
                    continue
                pair = (ids[:-1] > 1) & (ids[1:] > 1)
                at = np.flatnonzero(pair)
                hashes = trie.ids.hash_of(ids)
                pair[at] = in_filter(pair_keys(lang, hashes[at], hashes[at + 1]), bits, bitmap)
                at = np.flatnonzero(pair[:-1] & pair[1:])
                at = at[at < n]
                trie.add(lang, (ids[at] << 2 * BITS) + (ids[at + 1] << BITS) + ids[at + 2])
                if trie.entries > MAX_ENTRIES:
                    yield from trie.spilled(MAX_ENTRIES // 2)
        yield from trie.all()

    return docs.mapInArrow(work, RUN_SCHEMA)


def merged(runs: DataFrame, least: int, name: str) -> DataFrame:
    """Runs added up per prefix partition (language, first word, one of ``SPREAD`` parts of the rest); phrases below ``least`` go."""
    prefix = F.hash("lang", F.substring_index("phrase", " ", 1), F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).alias("prefix")
    sums = runs.select(prefix, *RUN).repartition("prefix").groupBy("prefix", "lang", "phrase").agg(F.sum("n").alias("n"))
    return written(sums.where((F.col("n") >= least) | (F.col("phrase") == "")).drop("prefix"), name)


# ---------------------------------------------------------------- the filter of frequent pairs


def pair_keys(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(mixed(first, second), np.full(len(first), xxhash.xxh64_intdigest(lang.encode()), np.uint64))


def cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(keys * np.uint64(p)) >> np.uint64(64 - bits) for p in PROBES]


def in_filter(keys: np.ndarray, bits: int, bitmap: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for c in cells(keys, bits):
        out &= (bitmap[c >> np.uint64(3)] >> (c & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return out


def pair_filter(pairs: DataFrame, max_bits: int = FILTER_BITS) -> tuple[int, np.ndarray]:
    """(bits, bitmap of 2 ** bits bits) that holds every pair of (lang, phrase): some sixteen bits a pair, up to ``max_bits``."""
    bits = max(FILTER_BLOCK, min(max_bits, math.ceil(math.log2(16 * max(1, pairs.count())))))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [np.empty(0, np.uint64)]
            langs = np.array(batch.column("lang").to_pylist(), object)
            words = [p.encode().split(b" ") for p in batch.column("phrase").to_pylist()]
            first, second = (hashes.of([w[i] for w in words]) for i in (0, 1))
            for lang in set(langs):
                own = langs == lang
                found += cells(pair_keys(lang, first[own], second[own]), bits)
            found = np.concatenate(found).astype(np.int64)
            yield batch_of(["block", "bit"], (found >> FILTER_BLOCK).astype(np.int32), (found & (1 << FILTER_BLOCK) - 1).astype(np.int32))

    def bitmap_of(table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << FILTER_BLOCK, bool)
        flags[table["bit"].to_numpy()] = True
        return pa.table({"block": table["block"][:1], "bitmap": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(1 << (bits - 3), np.uint8)
    width = 1 << (FILTER_BLOCK - 3)
    found = pairs.mapInArrow(positions, "block int, bit int").groupBy("block").applyInArrow(bitmap_of, "block int, bitmap binary")
    for r in found.toLocalIterator():
        out[r["block"] * width:(r["block"] + 1) * width] = np.frombuffer(r["bitmap"], np.uint8)
    return bits, out


# ---------------------------------------------------------------- scores


def part_of(phrase: str, begin: int, n: int):
    return F.array_join(F.slice(F.split(phrase, " ", -1), begin, n), " ")


def lookups(rows: DataFrame, counts: DataFrame, **parts) -> DataFrame:
    """``rows`` with the count of each named part of their phrase."""
    for name, part in parts.items():
        found = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias(name))
        rows = rows.withColumn("part", part).join(found, ["lang", "part"]).drop("part")
    return rows


def ratio(left: str, right: str, scale: int):
    """floor(scale * a * a / (left * right)), exact for counts below 10 ** 15."""
    a, l, r = (f"cast({c} as decimal(15,0))" for c in ("a", left, right))
    return F.expr(f"(cast({scale} as decimal(7,0)) * ({a} * {a})) div ({l} * {r})")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, percent: int = 50, scale: int = 1_000_000,
                 text: str = "text", lang: str = "lang", max_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two or three words of each language.

    ``a`` is how often the phrase occurs (``least`` at least), ``l`` and ``r``
    how often the parts do at the cut with the lowest score, ``n`` all words of
    the language.  A phrase goes where a longer one that holds it has
    ``percent`` of its occurrences.  A first pass counts words and pairs, a
    second those triples whose pairs may both be frequent; a filter of bounded
    size decides that without losing any.

    NULL languages count as ``und``; NULL and empty texts have no words;
    repeated rows count each time; an empty table gives no rows.
    """
    plain = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), utf8(text).alias("text"))
    counts = merged(words_and_pairs(plain), least, "phrases")
    totals = counts.where("phrase = ''").select("lang", F.col("n").alias("words"))
    words = written(counts.where("phrase != '' AND instr(phrase, ' ') = 0"), "frequent_words")
    pairs = written(counts.where("instr(phrase, ' ') > 0"), "frequent_pairs")
    long = merged(triples(plain, *pair_filter(pairs, max_bits)), least, "triples")

    two = lookups(pairs.withColumnRenamed("n", "a"), words, l=part_of("phrase", 1, 1), r=part_of("phrase", 2, 1))
    two = two.withColumn("score", ratio("l", "r", scale))
    inside = long.select("lang", "n", F.explode(F.array(part_of("phrase", 1, 2), part_of("phrase", 2, 2))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    two = two.join(inside, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {int(percent)} * a").drop("longer")

    three = lookups(long.withColumnRenamed("n", "a"), words, l1=part_of("phrase", 1, 1), r2=part_of("phrase", 3, 1))
    three = lookups(three, pairs, l2=part_of("phrase", 1, 2), r1=part_of("phrase", 2, 2))
    three = three.withColumns({"score1": ratio("l1", "r1", scale), "score2": ratio("l2", "r2", scale)})
    three = three.select("lang", "phrase", "a", *[F.when(F.col("score1") <= F.col("score2"), F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(c) for c in ("l", "r", "score")])

    kept = written(two.select("lang", "phrase", "a", "l", "r", "score").unionByName(three), "scored_phrases")
    # Parts of a language are cut to the top first, so that the last window of a language is small.
    parts = 16 + kept.count() // 200_000
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                            F.col("words").alias("n"), "score")
