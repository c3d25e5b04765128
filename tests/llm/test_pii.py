import hashlib
import random
import re

import pytest

from scorefold.llm import pii

DOCS = "doc_id long, text string, part int, found string"
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_force(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")[:4]) if kind == "ip" else True,
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_patterns_equal_plain_regular_expressions():
    r = random.Random(5)
    pieces = ["a@b.c", "x", "@", ".", "1", "23", "+", "(", ")", "-", " ", "4111111111111111", "1.2.3.4", "999", "a.b%", "é", "\n", "_", "+1 (5", "256.1.1.1"]
    for _ in range(6000):
        text = "".join(r.choices(pieces, k=r.randrange(14)))
        got = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(pii.base_spans(text))]
        assert got == brute_force(text), text


def test_very_long_runs_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 150_000, "a@" * 100_000, "1 " * 200_000, ":" * 200_000):
        pii.loose_spans(text, pii.base_spans(text))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS)


def planted(seed=2):
    """Filler with seeds in contexts, the same contexts with other forms, and plain numbers elsewhere."""
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("th", "er", "on", "re", "st") for b in ("an", "ing", "ed", "ou", "le", "a", "i")]
    fill = lambda n: " ".join(r.choices(words, k=n))
    rows, hidden = [], {}
    for i in range(120):
        kind, value = [
            ("mail me at", f"{r.choice(words)}.{i}@mail{i % 7}.example.com"), ("server address", f"10.{i}.{i % 9}.7"),
            ("call us on", f"+1 ({200 + i}) 555-{1000 + i}"), ("ref", str(10_000_000 + i))][i % 4]
        rows.append((i, f"{fill(30)} {kind} {value} {fill(20)}"))
    for i in range(120, 150):
        kind, context, value = [("email", "mail me at", f"{r.choice(words)}{i} (at) example{i} (dot) org"), ("phone", "call us on", f"0{200 + i} 555-{1000 + i}"),
                                ("email", "mail me at", f"{r.choice(words)}{i} at host{i} dot net")][i % 3]
        head = f"{fill(30)} {context} "
        rows.append((i, f"{head}{value} {fill(20)}"))
        hidden[i] = f"{kind}:{len(head)}:{len(head) + len(value)}"
    for i in range(150, 180):
        rows.append((i, f"{fill(30)} {20_000_000 + i} {fill(20)} {r.choice(words)} at {r.choice(words)} {fill(9)}"))
    return rows, hidden


def test_contexts_discover_hidden_identifiers_and_nothing_else(spark):
    rows, hidden = planted()
    texts = dict(rows)
    for r in pii.personal_data(frame(spark, rows).repartition(4)).collect():
        base = brute_force(texts[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r["spans"] == ",".join(base + [hidden[r["doc_id"]]] if r["doc_id"] in hidden else base)


def test_discovered_values_induce_further_patterns(spark):
    """A value found through one pattern makes another pattern trusted, which finds a third."""
    rows = [(i, f"w{i} call us on +1 (300) 555-{2000 + i} x{i} y{i}") for i in range(12)]
    rows += [(100 + i, f"w{i} call us on 0300 777-{3000 + i} v{i} u{i}") for i in range(12)]
    rows += [(200 + i, f"w{i} office line 0300 777-{3000 + i} t{i} s{i}") for i in range(12)]
    rows += [(300, "w office line 0399 888-4444 r q")]
    found = lambda rounds: {r["doc_id"] for r in pii.personal_data(frame(spark, rows), rounds=rounds).collect() if "phone" in r["spans"]}
    assert found(1) == set(range(12)) | set(range(100, 112))
    assert found(3) == found(1) | set(range(200, 212)) | {300}


def test_odd_rows(spark):
    rows = [(None, None), (None, "a@b.cd"), (1, ""), (2, "x" * 200_000 + " 1.2.3.4"), (2, "x" * 200_000 + " 1.2.3.4"), (3, "é 1.2.3.4")]
    got = sorted((r["doc_id"] or 0, r["spans"]) for r in pii.personal_data(frame(spark, rows)).collect())
    assert got == [(0, ""), (0, "email:0:6"), (1, ""), (2, "ip:200001:200008"), (2, "ip:200001:200008"), (3, "ip:2:9")]
    assert pii.personal_data(frame(spark, rows).limit(0)).collect() == []


def test_base_of_the_small_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pii.personal_data(docs).collect():
        base = brute_force(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(r["spans"].split(",") if r["spans"] else [])


@pytest.mark.parametrize("digits, ok", [("4111111111111111", True), ("4111111111111112", False), ("0000000000000000", True)])
def test_luhn(digits, ok):
    assert pii.passes_luhn(digits) is ok and luhn(digits) is ok
