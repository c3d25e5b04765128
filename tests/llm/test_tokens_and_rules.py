import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scorefold.llm import packing, rule_ledger, token_counts, tokens
from scorefold.llm.tokens import encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(WORDS)
DOCS = "doc_id long, text string, offset int, part int, n int"
ODD = ["", None, " \t\n", "a<|endoftext|>b <|STARTOFTEXT|>.", "Don't 'S, it's... ¬ a¬ b", "ΑΣ É 한국 ½ x y z\x1cq", "word### x%%%. #", "é é."]


def plain_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 0, 0, 0) for i, t in enumerate(texts)], DOCS)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abAB's.,#!|<>¬ \t\né한½1́‍　") | st.characters(codec="utf-8"), max_size=40))
def test_word_ids_equal_the_library(text):
    assert np.frombuffer(encoder(WORDS).encode([text.encode()])[0], "<u4").tolist() == plain_ids(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aJHT'é.,|<\u030c\u0331\u0301ÉßİſΣͅѐ \n"), max_size=30))
def test_letters_and_marks_joined_to_them_equal_the_library(text):
    assert np.frombuffer(encoder(WORDS).encode([text.encode()])[0], "<u4").tolist() == plain_ids(text)


def test_a_capital_with_a_mark_that_only_the_small_letter_joins():
    assert np.frombuffer(encoder(WORDS).encode(["J\u030ca".encode()])[0], "<u4").tolist() == plain_ids("J\u030ca")


def test_few_words_are_remembered(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    one = tokens.WordEncoder(WORDS)
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + j % 26)}{'q' * (i // 26)}, Word." for i in range(60)) for j in range(20)]
    assert [np.frombuffer(x, "<u4").tolist() for x in one.encode([t.encode() for t in texts])] == [plain_ids(t) for t in texts]
    assert len(one.known) <= 50 and len(one.known.older) <= 50
    # A word in capitals, or with marks behind it, is not remembered anew.
    one = tokens.WordEncoder(WORDS)
    one.encode([b"some Some SOME some, some. Some!"])
    assert set(one.known) == {b"some", b",", b".", b"!"}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_equal_the_library(spark, tmp_path, name):
    path = public_tokenizers.path(name)
    out = token_counts.token_counts(frame(spark, ODD), str(tmp_path / "c"), path)
    got = {r["doc_id"]: r["n_tokens"] for r in out.collect()}
    if name.endswith(".json"):
        lib = Tokenizer.from_file(path)
        want = {i: len(lib.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(ODD)}
    else:
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        want = {i: len(lib.encode(t or "")) for i, t in enumerate(ODD)}
    assert got == want


def test_counts_and_cache(spark, sf_dir, tmp_path, monkeypatch):
    cache = str(tmp_path / "cache")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = {tuple(r) for r in token_counts.token_counts(docs, cache, WORDS).collect()}
    assert first == {(r["doc_id"], len(r["text"].encode()), len(plain_ids(r["text"]))) for r in docs.collect()}
    n = spark.read.parquet(cache).count()
    more = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).selectExpr("doc_id", "'quite new' text", "lang", "source", "n_chars"))
    assert token_counts.token_counts(more, cache, WORDS).count() == docs.count() + 4
    assert spark.read.parquet(cache).count() == n + 1
    assert token_counts.token_counts(frame(spark, ODD), cache, WORDS).count() == len(ODD)
    assert token_counts.token_counts(frame(spark, []), cache, WORDS).count() == 0


def check_pieces(rows, texts, window):
    ids = {i: [*plain_ids(t), 1] for i, t in texts}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        piece = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert zlib.crc32(piece) == r["ids_crc32"] and r["length"] > 0
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, own in pieces.items():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == len(ids[i])
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert set(pieces) == set(ids)
    return padding


@pytest.mark.parametrize("window", [16, 64, 2048])
def test_packing_places_every_id_once(spark, sf_dir, window):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    rows = packing.pack(docs, WORDS, window=window).collect()
    assert check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], window) == 0


def test_packing_odd_rows(spark):
    rows = packing.pack(frame(spark, ODD), WORDS, window=32).collect()
    assert check_pieces(rows, list(enumerate(ODD)), 32) == 0
    assert packing.pack(frame(spark, []), WORDS).count() == 0


def test_plan_uses_combinations():
    rng = np.random.default_rng(1)
    histogram = np.bincount(rng.integers(1, 64, 100_000), minlength=64)
    plan = packing.make_plan(histogram, 64)
    assert plan.used.sum() > 0.9 * histogram.sum()
    filled = Counter()
    for length in range(1, 64):
        for rank in range(histogram[length]):
            for sequence, _, n in plan.places(length, rank):
                filled[sequence] += n
    assert sum(v == 64 for v in filled.values()) >= len(filled) - 7 and sum(filled.values()) == (histogram * np.arange(64)).sum()


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measurements_equal_brute_force(spark, sf_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ODD + ["a b c d e f g h " * 3, "x\n x\nx\n\n\n", "\x1c \x85   q", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8"]
    rows = rule_ledger.ledger(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_measures(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert bool(r["fail_bits"] & 3) == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert rule_ledger.ledger(frame(spark, [])).count() == 0


def test_policies_and_ablations_agree_with_the_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = rule_ledger.ledger(docs).cache()
    bits = [r["fail_bits"] for r in rows.collect()]
    mask = rule_ledger.bits_of(rule_ledger.POLICIES["v2"])
    for r in rule_ledger.ablation(rows, "v2").collect():
        bit = rule_ledger.bits_of([r["rule"]])
        assert r["failing"] == sum(b & bit > 0 for b in bits) and r["alone"] == sum(b & mask == bit for b in bits)
        assert r["kept_without"] == sum(b & mask & ~bit == 0 for b in bits)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in rows.where(~rule_ledger.rejected("v2")).collect()}
    base = {r["doc_id"] for r in rows.where(~rule_ledger.rejected("base")).collect()}
    good = [i for i, q in labels.items() if q and i in base]
    assert all(i in kept for i in good)
    rows.unpersist()
