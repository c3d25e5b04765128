import zlib

import numpy as np

from scorefold.llm import queries, toxicity
from scorefold.llm.words import WordHashes

DOCS = "doc_id long, text string, score int, y int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, 0) for i, t in rows], DOCS)


def corpus(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    words = np.array([f"w{i}" for i in range(3000)])
    share = 1 / np.arange(1, 3001)
    rows, labels = [], []
    for i in range(n):
        t = rng.choice(words, size=rng.integers(20, 200), p=share / share.sum()).tolist()
        y = int(rng.random() < 0.15)
        for _ in range(3 * y):
            t[rng.integers(len(t))] = rng.choice(["idiot,", "Moron", "scum."])
        rows.append((i, " ".join(t)))
        labels.append(y)
    return rows, np.array(labels)


def test_held_out_texts_are_told_apart():
    rows, y = corpus()
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in rows])
    texts = [t.encode() for _, t in rows]
    model = toxicity.train([t for t, h in zip(texts, held) if not h], y[~held])
    p = model.scores(WordHashes(), [t for t, h in zip(texts, held) if h])
    assert ((p >= 0.5) == y[held]).mean() > 0.97 and p.min() >= 0 and p.max() <= 1


def test_probabilities_add_up():
    rows, y = corpus(300)
    model = toxicity.fitted(toxicity.coded(WordHashes(), [t.encode() for _, t in rows]), y)
    hashes = WordHashes()
    vocabulary = model.shared.keys
    for previous in (b"w1", b"idiot", b"never-seen"):
        before = np.repeat(hashes.of([previous]), len(vocabulary) + 1)
        words = np.concatenate([vocabulary, hashes.of([b"not a word"])])
        for c in (0, 1):
            total = np.exp(model.logs(words, toxicity.mixed(before, words), before, c)).sum()
            assert abs(total - 1) < 1e-6


def test_query_scores_every_row_and_learns_from_the_training_part_only(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.op4_toxicity(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_odd_rows(spark):
    rows, y = corpus(200)
    docs = frame(spark, rows + [(None, "idiot scum"), (900, None), (901, ""), (0, rows[0][1]), (902, "x" * 100_000)])
    labels = spark.createDataFrame([(i, int(v)) for (i, _), v in zip(rows, y)] + [(None, 1), (900, None), (0, None)], "doc_id long, toxic int")
    model = toxicity.trained(docs, labels)
    got = toxicity.toxicity_scores(docs, model).collect()
    assert len(got) == 205 and all(r["score"] is not None for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (900, 901)}) == 1
    assert toxicity.toxicity_scores(frame(spark, []), model).count() == 0
    none = toxicity.trained(frame(spark, []), labels)
    assert all(r["score"] < 0.5 for r in toxicity.toxicity_scores(docs, none).collect())


def test_the_sample_is_bounded(spark):
    rows, y = corpus(100)
    labels = spark.createDataFrame([(i, int(v)) for (i, _), v in zip(rows, y)], "doc_id long, toxic int")
    assert len(toxicity.labelled_sample(frame(spark, rows), labels, "text", 30, 10**6)[0]) == 30
    assert len(toxicity.labelled_sample(frame(spark, rows), labels, "text", 100, 2_000)[0]) < 40


def test_long_texts_are_learned_from_and_counts_in_tasks_equal_those_of_a_list(spark):
    rows, y = corpus(60)
    long = [(i, t + " plain" * 2000) for i, t in rows]
    labels = spark.createDataFrame([(i, int(v)) for (i, _), v in zip(rows, y)], "doc_id long, toxic int")
    docs = frame(spark, long).repartition(7)
    taken, sample = toxicity.labelled_sample(docs, labels, "text", 100, 10**6)
    assert len(taken) == sample.count() == 60
    got = toxicity.gathered_counts(sample)
    texts, fold = dict(long), np.array([f for *_, f in taken])
    want = toxicity.pair_counts(toxicity.coded(WordHashes(), [texts[i].encode() for i, *_ in taken]), 2 * fold + np.array([v for _, _, v, _ in taken]))

    def rows_of(c):
        return sorted(zip(c.pairs.tolist(), c.groups.tolist(), c.before.tolist(), c.words.tolist(), c.n.tolist(), c.texts.tolist()))

    assert rows_of(got) == rows_of(want)
    model = toxicity.trained(docs, labels)
    assert len(model.shared.keys) and len({r["score"] for r in toxicity.toxicity_scores(docs, model).collect()}) > 1


def test_an_expression_of_ordinary_words_is_found():
    rng = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(300)])
    texts, y = [], np.arange(600) % 6 == 0
    for toxic in y:
        t = rng.choice(words, size=60).tolist()
        # Both words are as frequent in each class; only together, in this order, do they mark toxic texts.
        t[10], t[11 if toxic else 40] = "dirty", "pig"
        texts.append(" ".join(t).encode())
    model = toxicity.train(texts[:450], y[:450].astype(int))
    p = model.scores(WordHashes(), texts[450:])
    assert ((p >= 0.5) == y[450:]).mean() > 0.97


def test_the_model_selected_in_tables_equals_that_of_the_driver(spark):
    rows, y = corpus(300)
    labels = spark.createDataFrame([(i, int(v)) for (i, _), v in zip(rows, y)], "doc_id long, toxic int")
    _, sample = toxicity.labelled_sample(frame(spark, rows).repartition(3), labels, "text", 300, 10**6)
    counts, table = toxicity.gathered_counts(sample), toxicity.counted_pairs(sample)
    coded = toxicity.coded(WordHashes(), [t.encode() for _, t in rows])
    for fold in (-1, 1):
        want, got = toxicity.model_of(counts, fold), toxicity.model_from(table, fold)
        assert len(want.bigrams[1].keys) == len(got.bigrams[1].keys) and len(want.words[0].keys) == len(got.words[0].keys)
        for c in (0, 1):
            args = coded.keys, coded.pairs, coded.before, c
            assert np.allclose(want.logs(*args), got.logs(*args), rtol=0, atol=1e-9)


def test_logs_equal_a_plain_kneser_ney(spark):
    """Interpolated Kneser-Ney by dictionaries, with the pairs and words that the model keeps."""
    rows, y = corpus(40, seed=6)
    hashes, texts = WordHashes(), [t.encode() for _, t in rows]
    model = toxicity.fitted(toxicity.coded(hashes, texts), y)
    d, pairs, follows, shared = toxicity.DISCOUNT, ({}, {}), ({}, {}), set()
    for t, c in zip(texts, y):
        w = toxicity.model_words(t)
        own = list(zip([None, *w], w))
        for p in own:
            pairs[c][p] = pairs[c].get(p, 0) + 1
            shared.add(p)
        for p in set(own):
            follows[c][p[1]] = follows[c].get(p[1], 0) + 1
    continuation = {}
    for _, w in shared:
        continuation[w] = continuation.get(w, 0) + 1
    key = lambda w: hashes.of([w])[0] if w is not None else np.uint64(0)
    kept_pair = lambda p, c: toxicity.mixed(np.array([key(p[0])]), np.array([key(p[1])]))[0] in model.bigrams[c].keys
    for c in (0, 1):
        total = sum(follows[c].values())
        kept_words = {w for w in follows[c] if key(w) in model.words[c].keys}
        free = total - sum(follows[c][w] - d for w in kept_words)
        for t in texts[:6]:
            w = toxicity.model_words(t)
            for p in zip([None, *w], w):
                base = (continuation.get(p[1], 0) + 1) / (len(shared) + len(continuation) + 1)
                low = ((follows[c][p[1]] - d if p[1] in kept_words else 0) + free * base) / total
                context = {q: n for q, n in pairs[c].items() if q[0] == p[0]}
                seen, own = sum(context.values()), {q: n - d for q, n in context.items() if kept_pair(q, c)}
                want = (own.get(p, 0) + (seen - sum(own.values())) * low) / seen if seen else low
                before, word = np.array([key(p[0])]), np.array([key(p[1])])
                assert abs(model.logs(word, toxicity.mixed(before, word), before, c)[0] - np.log(want)) < 1e-9
