import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from scorefold.llm import components, simhash, substrings

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def corpus(seed=1, n=60):
    """Texts over few words with copies, shared passages, near copies, empty and NULL texts."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ä", "É|x", "a b"]
    passage = " ".join(r.choices(words, k=55))
    rows = []
    for i in range(n):
        t = " ".join(r.choices(words, k=r.choice([0, 3, 19, 20, 21, 60, 200])))
        k = i % 6
        if k == 1 and rows:
            t = rows[r.randrange(len(rows))][1]
        elif k == 2:
            t = t + "\n" + passage + " \t" + t
        elif k == 3:
            t = "x " * r.randrange(70)
        elif k == 4 and rows and rows[-1][1]:
            t = rows[-1][1].replace("w1 ", "w2 ", 1)
        rows.append((i, t))
    return rows + [(n, None), (n + 1, "")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substrings_equal_brute_force(spark, seed):
    rows = corpus(seed)
    out = substrings.remove_repeats(frame(spark, rows).repartition(5))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["sha"]) for r in out.withColumn("sha", substrings.sha256("kept")).collect()}
    want = substrings.brute_force(rows)
    assert got == want and sum(v[1] for v in want.values()) > 100


def test_substrings_with_a_full_sketch_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "estimated_repeated", lambda keys, bits, high: np.ones(len(keys), bool))
    rows = corpus(4)
    out = substrings.remove_repeats(frame(spark, rows))
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == {k: v[1] for k, v in substrings.brute_force(rows).items()}


def test_substrings_on_the_small_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = substrings.brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])
    out = substrings.remove_repeats(docs).withColumn("sha", substrings.sha256("kept"))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["sha"]) for r in out.collect()} == want


def test_equal_rows_null_ids_and_empty_tables(spark):
    t = " ".join(f"u{i}" for i in range(30))
    rows = [(5, t), (5, t), (None, t), (9, t), (3, "short")]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in substrings.remove_repeats(frame(spark, rows)).collect())
    assert got == [(False, 3, 0), (False, 5, 30), (False, 5, 30), (False, 9, 30), (True, 0, 0)]
    empty = frame(spark, [])
    assert substrings.remove_repeats(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0
    near = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert near == {(5, 5), (None, 5), (9, 5), (3, 3)}
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(frame(spark, rows)).collect())
    assert kept == [3, 5, 5]


def plain_fingerprint(text):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(prints, radius):
    ids = sorted(prints)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: root(i) for i in ids}


def test_simhash_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = {r["doc_id"]: plain_fingerprint(r["text"] or "") for r in docs.collect()}
    out = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in out} == prints
    assert {r["doc_id"]: r["component_id"] for r in out} == plain_components(prints, 3)


@pytest.mark.parametrize("chunk", [3, 1000])
def test_links_connect_all_close_fingerprints(spark, chunk):
    r = random.Random(5)
    values = [r.getrandbits(64) for _ in range(40)]
    for _ in range(300):
        values.append(r.choice(values[-60:]) ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3, 4]))))
    values = sorted(set(values))
    fps = spark.createDataFrame([Row(fp=simhash.signed(v)) for v in values])
    prints = {simhash.signed(v): v for v in values}
    want = plain_components(prints, 3)
    labels = {r["node"]: r["label"] for r in components.component_labels(simhash.close_links(fps, chunk=chunk)).collect()}
    assert {i: labels.get(i, i) for i in prints} == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["label"] for r in components.component_labels(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


def test_extra_columns_may_clash(spark):
    df = spark.createDataFrame([(1, "a b c d", 9, 9, 9), (2, "A b  c d", 9, 9, 9)], "doc_id int, text string, fp int, component_id int, th int")
    assert {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()} == {(1, 1), (2, 1)}
    assert simhash.one_of_each(df).columns == df.columns
    assert substrings.remove_repeats(df).count() == 2
