import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from scorefold.llm import manifest, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, total int, part int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    n = None if r["n_chars"] is None else r["n_chars"] + more
    return h(*map(field, (r["doc_id"], r["source"], r["lang"], n, r["text"])))


def root_of(nodes, arity):
    while len(nodes) > 1:
        nodes = [h(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0]


def proof(nodes, at, arity):
    """[(left, right)] of siblings up to the root."""
    out = []
    while len(nodes) > 1:
        begin = at // arity * arity
        run = nodes[begin:begin + arity]
        out.append((run[:at - begin], run[at - begin + 1:]))
        nodes, at = [h(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)], at // arity
    return out


def brute_force(rows, arity=2):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for k in keys:
        groups[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    subroots = [root_of([leaf(r) for r in groups[k]], arity) for k in keys]
    root, out = root_of(subroots, arity), []
    for g, k in enumerate(keys):
        leaves = [leaf(r) for r in groups[k]]
        for i, r in enumerate(groups[k]):
            path = proof(leaves, i, arity) + proof(subroots, g, arity)
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            value = leaf(r, int(bad))
            for left, right in path:
                value = h(*left, value, *right)
            out.append((r["doc_id"], leaves[i], subroots[g], root, h(*(x for pair in path for side in pair for x in side)), value, value == root))
    return sorted(map(repr, out))


def table(spark, n, langs):
    rows = [(i * 3 % 101, f"text {i} ä" * (i % 4), langs[i % len(langs)], None if i % 5 == 0 else f"s{i % 3}", None if i % 7 == 3 else i, 1, 2, 3)
            for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def listed(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(repr(tuple(r[c] for c in names)) for r in df.collect())


def op12(docs, arity=2):
    other = manifest.digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    bad = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    return manifest.manifest(manifest.leaves_of(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", F.when(bad, other)), arity)


@pytest.mark.parametrize("n, langs, arity, chunk", [
    (90, ["en", "de", "fr", None], 2, 4096), (90, ["en"], 2, 8), (61, ["en", "en", "en", "é", "z", None, ""], 3, 9), (5, list("abcde"), 2, 2), (1, [None], 2, 4096)])
def test_equals_brute_force(spark, monkeypatch, n, langs, arity, chunk):
    monkeypatch.setattr(manifest, "CHUNK", chunk)
    docs = table(spark, n, langs)
    got = listed(op12(docs.repartition(4), arity))
    assert got == brute_force(docs.collect(), arity)
    assert n < 50 or any("False" in r for r in got)


def test_odd_rows(spark):
    """NULL and repeated ids, repeated rows, empty and NULL texts."""
    rows = [(None, None, None, None, None, 1, 2, 3), (None, "", None, "s", 0, 1, 2, 3), (7, "a", "en", "s", 1, 1, 2, 3), (7, "b", "en", "s", 1, 1, 2, 3),
            (8, "c" * 100_000, "en", "s", 1, 1, 2, 3), (9, "d", "en", "s", 1, 1, 2, 3)]
    docs = spark.createDataFrame(rows, DOCS)
    assert listed(op12(docs)) == brute_force(docs.collect())
    twice = op12(docs.unionAll(docs)).collect()
    assert len(twice) == 12 and len({r["root"] for r in twice}) == 1


def test_empty_table(spark):
    assert op12(table(spark, 1, ["en"]).limit(0)).collect() == []


def test_query_on_the_small_table(spark, sf_dir):
    got = listed(queries.QUERIES["op12_merkle_manifest"](spark, sf_dir))
    assert got == brute_force(spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
