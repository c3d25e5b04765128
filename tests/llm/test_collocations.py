import re
from collections import Counter

import numpy as np
import pytest

from scorefold.llm import collocations
from scorefold.llm.collocations import BITS, Node, Trie

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_force(rows, least, top, percent=50):
    """(lang, rank, phrase, a, l, r, n, score), by dictionaries."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            longer = [n for q, n in found.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * n >= percent * a for n in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def corpus(seed, n=120):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(12)] + ["The", "THE", "Ä", "ä", "x\x00y", "new", "york"]
    rows = []
    for i in range(n):
        w = [words[k] for k in rng.integers(0, len(words), rng.integers(0, 60))]
        marks = rng.choice([" ", "  ", "\t", ", ", ".\n", " ? ", "\r\n"], len(w), p=[.7, .06, .05, .05, .05, .05, .04])
        rows.append(([None, "en", "de", "und", ""][i % 5], "".join(a + b for a, b in zip(w, marks))))
    return rows + [("en", None), (None, ""), ("en", " . , \t"), rows[1], rows[1], ("de", "new york city " * 15), ("fr", "one two")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)


def listed(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("seed, least, top", [(1, 3, 2000), (2, 2, 7)])
def test_equals_brute_force(spark, seed, least, top):
    rows = corpus(seed)
    got = listed(collocations.collocations(frame(spark, rows).repartition(3), least=least, top=top))
    assert got == brute_force(rows, least, top) and len(got) > 20


def test_bursts_spills_and_a_full_filter_change_nothing(spark, monkeypatch):
    rows = corpus(3)
    code = collocations.__dict__
    assert {k: code[k] for k in ("BURST", "MAX_ENTRIES", "MAX_WORDS", "BLOCK")}  # read by the tasks
    text = [r for r in rows if r[1]]
    trie = Trie()
    monkeypatch.setattr(collocations, "BURST", 5)
    want, got = Counter(), Counter()
    for lang, t in text:
        ids = trie.ids.of(t.encode().split())
        keys = (ids[:-2] << 2 * BITS) + (ids[1:-1] << BITS) + ids[2:] if len(ids) > 2 else np.empty(0, np.int64)
        want.update((lang or "", k) for k in keys.tolist())
        trie.add(lang or "", keys)
        assert trie.entries == sum(n.size() for n in trie.roots.values())
    names = list(trie.ids.names)
    assert any(isinstance(c, Node) for n in trie.roots.values() for c in n.below)
    runs = [*trie.spilled(trie.entries // 2), *trie.all()]
    for run in runs:
        phrases = run.column("phrase").to_pylist()
        firsts = [p.split(" ")[0] for p in phrases]
        assert len(set(firsts)) == sum(a != b for a, b in zip(firsts, [None, *firsts]))  # one beginning stands together
        got.update({(x, p): n for x, p, n in zip(run.column("lang").to_pylist(), phrases, run.column("n").to_pylist())})
    mask = (1 << BITS) - 1
    named = Counter()
    for (lang, k), n in want.items():
        named[lang, b" ".join(names[i] for i in (k >> 2 * BITS, k >> BITS & mask, k & mask)).decode()] += n
    assert got == named and trie.entries == 0
    # A filter of 2 ** 16 bits that says yes to everything loses nothing.
    monkeypatch.setattr(collocations, "pair_filter", lambda pairs, bits: (16, np.full(1 << 13, 255, np.uint8)))
    assert listed(collocations.collocations(frame(spark, rows), least=3)) == brute_force(rows, 3, 2000)


def test_long_text_in_blocks(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 7)
    monkeypatch.setattr(collocations, "MAX_WORDS", 18)
    words, trie, seen, spills = [b"a%d" % (i % 9) for i in range(100)], Trie(), [], 0
    for ids, n in collocations.blocks(trie, [*words, b""]):
        if ids is None:
            list(trie.all())
            spills += 1
        else:
            part = [trie.ids.names[i] for i in ids]
            seen += [tuple(part[i:i + 3]) for i in range(n)]
    assert spills and seen == [tuple(words[i:i + 3]) for i in range(100)]


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([(4_000_000_000_000, 5_000_000_000_000, 6_000_000_000_007)], "a long, l long, r long")
    a, left, right = rows.first()
    assert rows.select(collocations.ratio("l", "r", 1_000_000)).first()[0] == 1_000_000 * a * a // (left * right)


def test_empty_table(spark):
    assert collocations.collocations(frame(spark, []).limit(0)).collect() == []
