"""Toxicity: class-conditional Kneser-Ney word models over one shared lower order."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.components import written
from scorefold.llm.words import WordHashes, batch_of, mixed, slices, text_of_position, utf8

#: Labelled texts that the two models and the calibration may be fitted on, and words in all of them (one text may overrun).
MAX_TEXTS = 8_000
MAX_WORDS = 3_000_000
FOLDS = 3
DISCOUNT = 0.75
#: Pairs of words seen less often in both classes together are left to the lower orders, unless their classes stand out.
CUTOFF = 200
#: Words that follow fewer different words in both classes together are left to the shared order, unless their classes stand out.
WORD_CUTOFF = 8
#: A log ratio that chance alone rarely gives a word; features of a text.
STRONG = 2.0
FEATURES = 3
#: Rows whose texts are filtered at once.
ROWS = 500
#: Marks cut from the ends of words before lower-casing A-Z; a word of marks alone stays.
EDGES = b".,;:!?\"'()[]{}#*$%&|<>"


def model_words(text: bytes) -> list[bytes]:
    return [w.strip(EDGES) or w for w in text.lower().split()]


@dataclass
class Table:
    """Sorted keys with a value each; missing keys have ``default``."""

    keys: np.ndarray
    values: np.ndarray
    default: float = 0.0

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.default)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], self.default)


@dataclass
class Coded:
    """Words of texts as keys, with the key of the word before, of the pair, and the number of the text."""

    keys: np.ndarray
    before: np.ndarray
    pairs: np.ndarray
    text: np.ndarray
    counts: np.ndarray

    def only(self, texts: np.ndarray) -> Coded:
        """The texts marked true, numbered anew."""
        own = texts[self.text]
        number = np.cumsum(texts) - 1
        return Coded(self.keys[own], self.before[own], self.pairs[own], number[self.text[own]], self.counts[texts])


def coded(hashes: WordHashes, texts: list[bytes]) -> Coded:
    split = [hashes.of(model_words(t)) for t in texts]
    keys = np.concatenate([np.empty(0, np.uint64), *split])
    counts = np.fromiter(map(len, split), np.int64, len(split))
    text = text_of_position(counts).astype(np.int32)
    before = np.concatenate([np.zeros(min(1, len(keys)), np.uint64), keys[:-1]])
    before[np.diff(text, prepend=-1) != 0] = 0
    return Coded(keys, before, mixed(before, keys), text, counts)


@dataclass
class Model:
    """log P(word | previous, class) by interpolated Kneser-Ney.

    Each class has its pairs of words, below them its words by the number of
    different words they follow in each text; both classes back off to one distribution of
    words, by the number of different pairs of both together.  Pairs and
    words that are rare, and as often in each class as chance has it, are left
    to the shared order in both classes alike, so an expression seen once says
    little about its class; one that tells the classes apart stays, however rare.
    """

    bigrams: tuple[Table, Table]
    #: How often a word comes first in a class, and the share of that which the pairs kept give up.
    contexts: tuple[tuple[Table, Table], tuple[Table, Table]]
    words: tuple[Table, Table]
    totals: tuple[float, float]
    free: tuple[float, float]
    shared: Table
    shared_total: float
    weights: np.ndarray

    def logs(self, words: np.ndarray, pairs: np.ndarray, before: np.ndarray, c: int) -> np.ndarray:
        d = DISCOUNT
        # The last step gives unknown words a share as large as that of a word seen once.
        base = (self.shared.of(words) + 1.0) / (self.shared_total + len(self.shared.keys) + 1.0)
        lower = (np.maximum(self.words[c].of(words) - d, 0) + self.free[c] * base) / max(self.totals[c], 1.0)
        if not self.totals[c]:
            lower = base
        seen, rest = (t.of(before) for t in self.contexts[c])
        high = (np.maximum(self.bigrams[c].of(pairs) - d, 0) + rest * lower) / np.maximum(seen, 1)
        return np.log(np.where(seen > 0, high, lower))

    def features(self, coded: Coded) -> np.ndarray:
        """Per text: the log-likelihood ratio per word; and the share of it from strong expressions alone,
        per square root of the number of words and, for long texts with few of them, as a logarithm."""
        ratio = self.logs(coded.keys, coded.pairs, coded.before, 1) - self.logs(coded.keys, coded.pairs, coded.before, 0)
        texts, n = len(coded.counts), np.maximum(coded.counts, 1)
        total = np.bincount(coded.text, weights=ratio, minlength=texts)
        strong = np.bincount(coded.text, weights=np.maximum(ratio - STRONG, 0), minlength=texts)
        return np.column_stack([total / n, strong / np.sqrt(n), np.log1p(strong)])

    def scores(self, hashes: WordHashes, texts: list[bytes]) -> np.ndarray:
        x = self.features(coded(hashes, texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -40, 40)))


def sorted_counts(keys: np.ndarray) -> Table:
    k, n = np.unique(keys, return_counts=True)
    return Table(k, n.astype(float))


@dataclass
class Counts:
    """Of each pair of words, in the order of pairs, by group (twice the fold of the text, and its class): how often, and in how many texts."""

    pairs: np.ndarray
    before: np.ndarray
    words: np.ndarray
    groups: np.ndarray
    n: np.ndarray
    texts: np.ndarray


def pair_counts(data: Coded, groups: np.ndarray) -> Counts:
    """The counts of texts with a group each."""
    group = groups.astype(np.uint64)[data.text]
    cells = mixed(group, data.pairs)
    order = np.argsort(cells, kind="stable")  # positions, and so texts, stay in order within a cell
    begins = np.flatnonzero(np.diff(cells[order], prepend=~cells[order[:1]]))
    first, text = order[begins], data.text[order]
    new = np.diff(text, prepend=-1) != 0
    new[begins] = True
    at = lambda x: np.add.reduceat(x.astype(np.int64), begins) if len(begins) else np.empty(0, np.int64)
    return in_order(Counts(data.pairs[first], data.before[first], data.keys[first], group[first].astype(np.int8), at(np.ones(len(order))), at(new)))


def in_order(c: Counts) -> Counts:
    order = np.argsort(c.pairs, kind="stable")
    return Counts(*(getattr(c, k)[order] for k in ("pairs", "before", "words", "groups", "n", "texts")))


def summed(keys: np.ndarray, weights: np.ndarray) -> Table:
    k, at = np.unique(keys, return_inverse=True)
    return Table(k, np.bincount(at, weights=weights, minlength=len(k)))


def model_of(c: Counts, without: int = -1) -> Model:
    """The two models of all counts but those of one fold."""
    own = c.groups >> 1 != without
    pairs, before, words, label, n, texts = (x[own] for x in (c.pairs, c.before, c.words, c.groups & 1, c.n, c.texts))
    new = np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]
    shared = sorted_counts(words[new])
    number = np.cumsum(new) - 1
    # A word is expected in the classes as all words are, a pair as its word is.
    follow = [summed(words[label == k], texts[label == k]) for k in (0, 1)]
    word_texts = np.stack([follow[k].of(shared.keys) for k in (0, 1)])
    usual = word_texts.sum(axis=1, keepdims=True) / max(1.0, word_texts.sum())
    common = (shared.values >= WORD_CUTOFF) | stands_out(word_texts, usual)
    common = Table(shared.keys[common], shared.values[common])
    pair_texts = np.stack([np.bincount(number[label == k], weights=texts[label == k], minlength=int(new.sum())) for k in (0, 1)])
    by_word = np.stack([follow[k].of(words[new]) for k in (0, 1)]) + usual
    by_word /= by_word.sum(axis=0)
    often = np.bincount(number, weights=n, minlength=int(new.sum())) >= CUTOFF
    frequent = (often | stands_out(pair_texts, by_word))[number]
    bigrams, contexts, lower, totals, free = [], [], [], [], []
    for k in (0, 1):
        own = label == k
        # What a context keeps for the lower order: all it has, less the discounted counts of its kept pairs.
        seen, kept = summed(before[own], n[own]), own & frequent
        bigrams.append(summed(pairs[kept], n[kept]))
        once = np.append(True, pairs[kept][1:] != pairs[kept][:-1])[:int(kept.sum())]
        given = np.bincount(np.searchsorted(seen.keys, before[kept]), weights=n[kept] - DISCOUNT * once, minlength=len(seen.keys))
        contexts.append((seen, Table(seen.keys, seen.values - given)))
        follows = follow[k]
        kept = common.of(follows.keys) > 0
        lower.append(Table(follows.keys[kept], follows.values[kept]))
        totals.append(follows.values.sum())
        free.append(totals[k] - (lower[k].values - DISCOUNT).sum())
    return Model(tuple(bigrams), tuple(contexts), tuple(lower), tuple(totals), tuple(free), shared, shared.values.sum(), np.zeros(FEATURES + 1))


def stands_out(texts: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Whether counts (2, n) by class differ from the classes expected, ``share`` (2, n), by more than chance gives among ``n``.

    The likelihood ratio statistic against twice the logarithm of ``n``: no number of occurrences is asked for.
    """
    expected = np.maximum(texts.sum(axis=0) * share, 1e-12)
    return 2 * (texts * np.log(np.maximum(texts, 1) / expected)).sum(axis=0) > 2 * np.log(max(2, texts.shape[1]))


def fitted(data: Coded, labels: np.ndarray) -> Model:
    """The two models of texts with a label each."""
    return model_of(pair_counts(data, np.asarray(labels, int)))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Weights and bias by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibrated(model: Model, x: np.ndarray, labels: np.ndarray) -> Model:
    if len(set(labels.tolist())) == 2:
        model.weights = logistic(x, labels)
    elif len(labels):
        model.weights[-1] = 4.0 if labels[0] else -4.0
    else:
        model.weights[-1] = -4.0
    return model


def train(texts: list[bytes], labels: np.ndarray, folds: int = FOLDS) -> Model:
    """Calibrated on scores of texts that the scoring model has not seen, then fitted on all."""
    labels = np.asarray(labels, int)
    data, fold = coded(WordHashes(), texts), np.arange(len(texts)) % folds
    counts, x = pair_counts(data, 2 * fold + labels), np.zeros((len(texts), FEATURES))
    for f in range(folds):
        x[fold == f] = model_of(counts, f).features(data.only(fold == f))
    return calibrated(model_of(counts), x, labels)


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, max_texts: int, max_words: int) -> tuple[list[tuple], DataFrame]:
    """At most ``max_texts`` labelled texts of any length, in the order of a hash of the id, until they have ``max_words`` words.

    Returns (id, hash of the text, class, fold) of each, and the table (text, class, fold).
    A label NULL is none; an id that is labelled both ways counts as toxic; equal rows count once.
    """
    spark = docs.sparkSession
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("y"))
    plain = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # Ids and labels alone are shuffled; the bounded list of chosen ids goes to the texts.
    chosen = marks.join(plain.select("id"), "id", "left_semi").orderBy(F.xxhash64("id")).limit(max_texts)
    sizes = plain.join(F.broadcast(chosen), "id").select("id", F.xxhash64("t").alias("h"), "y", F.size(F.split("t", r"[\x20\x09-\x0D]+")).alias("n"))
    taken, n = [], 0
    for r in sizes.distinct().orderBy(F.xxhash64("id"), "h").limit(max_texts).collect():
        if n >= max_words:
            break
        taken.append((r["id"], r["h"], r["y"], len(taken) % FOLDS))
        n += r["n"]
    keys = spark.createDataFrame(taken, "id long, h long, y int, fold int")
    some = plain.withColumn("h", F.xxhash64("t")).join(F.broadcast(keys), ["id", "h"]).dropDuplicates(["id", "h"])
    return taken, written(some.select(F.col("t").cast("binary").alias("text"), "y", "fold"), "toxicity_sample")


def counted_pairs(sample: DataFrame) -> DataFrame:
    """(pairs, before, words, fold, y, n, texts) of (text, y, fold): counted in tasks, added up by key and written."""
    names = ["pairs", "before", "words", "groups", "n", "texts"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in slices(batches, "text"):
            c = pair_counts(coded(hashes, texts), 2 * batch.column("fold").to_numpy() + batch.column("y").to_numpy())
            yield batch_of(names, c.pairs.view(np.int64), c.before.view(np.int64), c.words.view(np.int64), c.groups, c.n, c.texts)

    rows = sample.mapInArrow(work, "pairs long, before long, words long, groups tinyint, n long, texts long")
    return written(rows.groupBy("pairs", "before", "words", F.shiftright(F.col("groups").cast("int"), 1).alias("fold"), (F.col("groups") % 2).cast("int").alias("y")).agg(
        F.sum("n").alias("n"), F.sum("texts").alias("texts")), "toxicity_pairs")


def gathered_counts(sample: DataFrame) -> Counts:
    """``counted_pairs`` of a small sample, on the driver."""
    rows = counted_pairs(sample).withColumn("groups", (2 * F.col("fold") + F.col("y")).cast("tinyint")).toArrow()
    columns = [rows[k].to_numpy() for k in ("pairs", "before", "words", "groups", "n", "texts")]
    return in_order(Counts(*(x.view(np.uint64) for x in columns[:3]), *columns[3:]))


def by_class(column: str) -> list[Column]:
    return [F.sum(F.when(F.col("y") == k, F.col(column)).otherwise(0)).alias(f"{column}{k}") for k in (0, 1)]


def model_from(counts: DataFrame, without: int = -1) -> Model:
    """The model of ``model_of``, selected in Spark: the driver gathers the words, the contexts and the pairs that the model keeps."""
    pairs = written(counts.where(F.col("fold") != without).groupBy("pairs", "before", "words").agg(*by_class("n"), *by_class("texts")), "class_pairs")
    columns = lambda df, *names: [df[k].to_numpy() for k in names]
    word_rows = pairs.groupBy("words").agg(F.count("*").alias("follows"), F.sum("texts0").alias("f0"), F.sum("texts1").alias("f1"))
    word_rows = written(word_rows, "class_words")
    words, follows, f0, f1 = columns(word_rows.toArrow(), "words", "follows", "f0", "f1")
    order = np.argsort(words.view(np.uint64))
    words, follows, follow = words.view(np.uint64)[order], follows[order].astype(float), np.stack([f0, f1])[:, order].astype(float)
    totals = follow.sum(axis=1)
    usual = totals / max(1.0, totals.sum())
    common = (follows >= WORD_CUTOFF) | stands_out(follow, usual[:, None])

    number = int(follows.sum())
    share = [(F.col(f"f{k}") + float(usual[k])) / (F.col("f0") + F.col("f1") + 1.0) for k in (0, 1)]
    texts = F.col("texts0") + F.col("texts1")
    gain = sum(F.col(f"texts{k}") * F.log(F.greatest(F.col(f"texts{k}"), F.lit(1)) / F.greatest(texts * share[k], F.lit(1e-12))) for k in (0, 1))
    frequent = (F.col("n0") + F.col("n1") >= CUTOFF) | (2 * gain > 2 * float(np.log(max(2, number))))
    kept = columns(pairs.join(word_rows, "words").where(frequent).select("pairs", "before", "n0", "n1").toArrow(), "pairs", "before", "n0", "n1")
    seen = columns(pairs.groupBy("before").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow(), "before", "n0", "n1")

    bigrams, contexts, lower, free = [], [], [], []
    for k in (0, 1):
        own = kept[2 + k] > 0
        n = kept[2 + k][own].astype(float)
        bigrams.append(summed(kept[0][own].view(np.uint64), n))
        some = seen[1 + k] > 0
        before = summed(seen[0][some].view(np.uint64), seen[1 + k][some].astype(float))
        given = np.bincount(np.searchsorted(before.keys, kept[1][own].view(np.uint64)), weights=n - DISCOUNT, minlength=len(before.keys))
        contexts.append((before, Table(before.keys, before.values - given)))
        some = common & (follow[k] > 0)
        lower.append(Table(words[some], follow[k][some]))
        free.append(totals[k] - (lower[k].values - DISCOUNT).sum())
    return Model(tuple(bigrams), tuple(contexts), tuple(lower), tuple(totals.tolist()), tuple(free), Table(words, follows), follows.sum(), np.zeros(FEATURES + 1))


def sample_features(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Features and class of each text of the sample, computed in tasks."""
    shared, names = sample.sparkSession.sparkContext.broadcast(model), [f"x{i}" for i in range(FEATURES)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in slices(batches, "text"):
            yield batch_of(["y", *names], batch.column("y"), *shared.value.features(coded(hashes, texts)).T)

    rows = sample.mapInArrow(work, ", ".join(["y int", *(f"{k} double" for k in names)])).toArrow()
    shared.destroy()
    return np.column_stack([rows[k].to_numpy() for k in names]), rows["y"].to_numpy()


def toxicity_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text.

    NULL and empty texts get the score of no evidence; NULL ids and repeated
    rows are scored like others; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in slices(batches, "text"):
            yield batch_of(["doc_id", "score"], batch.column("doc_id"), shared.value.scores(hashes, texts))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(text).alias("text")).mapInArrow(work, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The documents, with all columns, that score below ``threshold``; scored and kept in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS):  # some rows at a time: one copy of their texts
                batch = whole.slice(i, ROWS)
                plain = batch.column(text).cast(pa.binary()).fill_null(b"")
                scores = [shared.value.scores(hashes, texts) for _, texts in slices(iter([batch_of(["text"], plain)]), "text")]
                yield batch.filter(pa.array(np.concatenate([*scores, np.empty(0)]) < threshold))

    return docs.mapInArrow(work, docs.schema)


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", max_texts: int = MAX_TEXTS, max_words: int = MAX_WORDS) -> Model:
    """The model of a bounded sample of labelled documents; its tables have at most about ``max_words`` entries each.

    Calibrated like ``train``, with counts and features from tasks.  Without labelled texts no document is toxic.
    """
    _, sample = labelled_sample(docs, labels, text, max_texts, max_words)
    counts = counted_pairs(sample)
    parts = [sample_features(sample.where(F.col("fold") == f), model_from(counts, f)) for f in range(FOLDS)]
    x, y = (np.concatenate(part) for part in zip(*parts))
    return calibrated(model_from(counts), x, y)
