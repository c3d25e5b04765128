"""Quality rules: each evaluated once into a ledger of failure bits; policies and ablations read the bits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.words import WordHashes, batch_of, joined, mixed, run_keys, slices, text_of_position, utf8

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = UPPER + UPPER.lower()
REPEAT_WINDOW = 8

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper", "n_exclaims"]


def repeated_words(words: list[bytes], counts: np.ndarray, hashes: WordHashes, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text the words inside windows of ``width`` words that occur twice or more in that text, first ones included."""
    total = np.zeros(len(counts), np.int64)
    n = len(words) - width + 1
    if n <= 0:
        return total
    text = text_of_position(counts)
    starts = np.flatnonzero(text[:n] == text[width - 1:])
    if not len(starts):
        return total
    keys = mixed(run_keys(hashes.of(words), width)[starts], text[starts].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    equal = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    at = starts[twice]
    np.add.at(steps, at, 1)
    np.add.at(steps, at + width, -1)
    covered = np.cumsum(steps[:-1]) > 0
    return np.bincount(text[covered], minlength=len(counts))


def without(text: bytes, marks: bytes) -> int:
    return len(text.translate(None, marks))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, measurements): every measurement of every whole text, in one pass."""
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in slices(batches, "text"):
            words, counts = joined(texts)
            lines = [[x for x in t.split(b"\n") if x.strip(SPACE)] for t in texts]
            n = [len(x) for x in lines]
            letters = [len(t) - without(t, LETTERS) for t in texts]
            columns = [
                counts, [without(t, SPACE + CONTINUATION) for t in texts], [len(t) - without(t, SYMBOLS) for t in texts],
                n, [a - len(set(x)) for a, x in zip(n, lines)], repeated_words(words, counts, hashes),
                letters, [len(t) - without(t, UPPER) for t in texts], [t.count(b"!") for t in texts],
            ]
            yield batch_of(["doc_id", *MEASURES], batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("text")).mapInArrow(work, schema)


@dataclass(frozen=True)
class Rule:
    """One bit of the ledger; ``fails`` is SQL over the measurements, false where there is nothing to judge."""

    name: str
    bit: int
    fails: str


#: Bits never change their meaning; a changed rule gets a new bit.
RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", 2, "10 * n_symbols > n_words"),
    Rule("repeated_lines", 3, "100 * n_dup_lines > 30 * n_lines"),
    Rule("shouting", 4, "n_letters >= 50 AND 100 * n_upper > 40 * n_letters"),
    Rule("exclamations", 5, "10 * n_exclaims > n_words"),
    Rule("odd_word_length", 6, "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)"),
)

BASE = ("few_words", "repeated_windows")
#: Policies by version: the rules whose failure rejects a document.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "repeated_lines"),
    "v2": (*BASE, "many_symbols", "repeated_lines", "shouting", "exclamations", "odd_word_length"),
}


def bits_of(names, rules=RULES) -> int:
    by_name = {r.name: r.bit for r in rules}
    return sum(1 << by_name[n] for n in set(names))


def ledger(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """(doc_id, measurements, fail_bits): the stored result of one evaluation of all rules.

    A NULL or empty text has zero of everything and fails ``few_words`` alone;
    NULL ids and repeated rows keep their own rows; an empty table gives none.
    """
    failed: Column = reduce(lambda a, b: a.bitwiseOR(b), (
        F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")) for r in rules))
    return measured(docs, text).withColumn("fail_bits", failed)


def rejected(policy: str, rules=RULES) -> Column:
    """Whether a ledger row fails a rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(bits_of(POLICIES[policy], rules)).cast("long")) != 0


def ablation(rows: DataFrame, policy: str, rules=RULES) -> DataFrame:
    """(rule, failing, alone, kept_without): per rule of a policy what it rejects and what dropping it would keep.

    The ledger is first counted by its distinct bit patterns, so no text or
    measurement is read again and the rest works on at most 2**rules rows.
    """
    mask = bits_of(POLICIES[policy], rules)
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    used = [r for r in rules if mask >> r.bit & 1]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in used]))
    b = patterns.select("bits", "n", each.alias("r")).select("bits", "n", "r.rule", "r.bit")

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(0))

    return b.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        total(F.col("bits") == F.col("bit")).alias("alone"),
        total(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"))
