import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorefold.llm import decontaminate, queries, revisits, secrets

DOCS = "doc_id long, text string, source string, s int, th int, value int, item_id int, hit_text int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "src/a", 0, 0, 0, 0, 0) for i, t in rows], DOCS)


def shingles(text):
    w = text.lower().split()
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def plain_leaks(docs, items, least=0.8):
    out = {}
    for d, t in docs:
        s = shingles(t or "")
        for i, u in items:
            si = shingles(u or "")
            if not set(si) & set(s):
                continue
            best, span = (0, 0), max(1, len((u or "").split()) - 4)
            for a in range(max(1, len(s) - span + 1)):
                w = s[a:a + span]
                k = sum((Counter(w) & Counter(si)).values())
                best = max(best, (k / (len(w) + len(si) - k), -a))
            if best[0] >= least:
                out[d, i] = best[0]
    return out


def leaky(seed, n=60):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(r.choices(words, k=r.choice([3, 5, 14, 30, 40])))) for i in range(12)] + [(20, ""), (21, None)]
    docs = []
    for d in range(n):
        t = r.choices(words, k=r.choice([0, 2, 10, 60, 150]))
        item = (r.choice(items)[1] or "").split()
        for _ in range(d % 5):
            if item:
                item[r.randrange(len(item))] = r.choice(words)
        at = r.randrange(len(t) + 1)
        docs.append((d, " ".join(t[:at] + (item * (1 + d % 2)) + t[at:])))
    return [*docs, (n, None), (n + 1, "")], items


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_equal_brute_force(spark, seed):
    docs, items = leaky(seed)
    bench = spark.createDataFrame([(i, t, 0, 0) for i, t in items], "item_id long, text string, w int, s int")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_leaks(frame(spark, docs), bench).collect()}
    want = plain_leaks(docs, items)
    assert got.keys() == want.keys() and len(want) > 5
    assert all(abs(got[k] - v) < 1e-12 for k, v in want.items())


def test_leaks_on_the_small_tables_and_by_a_shuffle(spark, sf_dir, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain_leaks([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 10)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == want.keys() and want
    clean = decontaminate.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


def test_leaks_of_odd_rows(spark):
    text = "one two three four five six seven eight nine ten"
    docs = frame(spark, [(1, text), (1, text), (None, "x " + text.upper()), (2, None), (1, "other"), (3, " ".join(["a"] * 30_000))])
    bench = spark.createDataFrame([(7, text), (7, text), (8, "a a a a a a a a")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {(1, 7), (None, 7), (3, 8)}
    kept = [(r["doc_id"], r["text"]) for r in decontaminate.without_leaks(docs, bench).collect()]
    assert sorted(kept, key=str) == [(1, "other"), (2, None)]
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


HEX = "0123456789abcdef"


def findings(n=200, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        key = "".join(r.choices(HEX, k=40))
        rows.append((i, {
            0: f'some é words token = "{key}" then more',
            1: f"card {''.join(r.choices('0123456789', k=16))} was used",
            2: f"see commit {key} of the tree",
            3: f'for example password = "{key}" in the sample',
        }[i % 4]))
    return rows


def test_forest_removes_false_findings(spark):
    rows = findings()
    docs = frame(spark, rows)
    out = {r["doc_id"]: r for r in secrets.scan(docs).collect()}
    assert len(out) == len(rows)
    right = sum(out[i]["is_secret"] == (i % 4 == 0) for i, _ in rows)
    assert right >= 0.98 * len(rows)
    for i, t in rows:
        assert t[out[i]["start"]:out[i]["start"] + len(out[i]["value"])] == out[i]["value"]
    reviewed = spark.createDataFrame([(i, out[i]["start"], int(i % 4 == 2)) for i, _ in rows[:100]], "doc_id long, start long, is_secret int")
    again = {r["doc_id"]: r["is_secret"] for r in secrets.scan(docs, reviewed).collect()}
    assert sum(again[i] == (i % 4 == 2) for i, _ in rows[100:]) >= 90


def test_short_and_digit_free_values_of_named_secrets_are_candidates(spark):
    values = ["hunter2!x", "correct-horse", "Ünïcode#pw", "abcdefghijklmnopqrstuvwx"]
    rows = [(i, f'text password = "{v}" and api_key: \'{v}\' but "{v}" alone, pwd="abc"') for i, v in enumerate(values)]
    got = sorted((r["doc_id"], r["value"]) for r in secrets.candidates(frame(spark, rows)).collect())
    assert got == sorted((i, v) for i, v in enumerate(values) for _ in range(2))
    more = findings() + [(1000 + i, f'login password = "{v}" now') for i, v in enumerate(values)]
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(frame(spark, more)).where("doc_id >= 1000").collect()}
    assert all(t == 'login password = "[SECRET]" now' for t in clean.values()) and len(clean) == 4


def test_texts_without_an_id_are_redacted_by_their_own_findings(spark):
    a, b = "ab12" * 8, "cd34" * 8
    docs = frame(spark, findings(40) + [(None, f'token = "{a}" {b}'), (None, f'token = "{b}"')])
    got = sorted(r["text"] for r in secrets.redacted(docs).where("doc_id IS NULL").collect())
    assert got == ['token = "[SECRET]"', f'token = "[SECRET]" {b}']


def test_the_dictionary_counts_all_texts(spark):
    ids = [r["id"] for r in spark.range(2_100).orderBy(F.xxhash64("id")).collect()]
    rows = [(i, "alpha beta") for i in ids[:2_000]] + [(i, "Omega " * 100) for i in ids[2_000:]] + [(None, "delta " * 5_000), (1, None)]
    assert secrets.dictionary(frame(spark, rows), words=2) == ["delta", "omega"]


def test_redaction_and_odd_rows(spark):
    key = "ab12" * 10
    many = " ".join(f'token = "{i:020d}ffff"' for i in range(300))
    rows = findings(40) + [(None, f'token = "{key}"'), (100, None), (101, ""), (102, "w" * 50_000), (103, many), (104, f'key="{key}" {key}'), (104, f'key="{key}" {key}')]
    docs = frame(spark, rows)
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in clean.collect()), key=str)
    assert len(got) == len(rows)
    texts = {i: t for none, i, t in got if not none}
    assert texts[0].count("[SECRET]") == 1 and 'token = "[SECRET]" then' in texts[0]
    assert texts[1] == rows[1][1] and texts[100] is None and texts[101] == "" and texts[103].count("[SECRET]") == 300
    found = secrets.scan(docs)
    assert found.where("doc_id = 103").count() == 300 and found.where("doc_id = 104").count() == 2
    assert secrets.scan(docs.limit(0)).count() == 0 and secrets.redacted(docs.limit(0)).count() == 0


RECORDS = "record_id long, url string, time long, kind string, digest string, headers map<string,string>, hit int, piece int"


def record(i, url, time, kind, digest="d", **headers):
    return i, url, time, kind, digest, {k.replace("_", "-"): v for k, v in headers.items()}, 0, 0


def test_revisits(spark):
    rows = [
        record(1, "http://www.A.org/x/#f", 10, "response", ETag='"1"', Server="s", Content_Length="5"),
        record(2, "https://a.org/x", 20, "revisit", etag='W/"1"', Content_Length="0", Date="now"),
        record(3, "https://a.org/x?utm_a=1", 30, "response", ETag='"2"'),
        record(4, "https://a.org/x", 40, "revisit", ETag='"1"'),
        record(5, "https://a.org/y", 5, "revisit"),
        record(6, "https://a.org/X", 50, "revisit", ETag='"2"'),
        record(7, "https://a.org/x", 60, "revisit", "d"),
        record(8, "https://a.org/x", None, "revisit"), record(9, None, 9, "revisit"), record(10, "https://a.org/x", 99, None),
        (11, "https://a.org/x", 70, "revisit", "e", None, 0, 0),
    ]
    for slices in (1, 3, 64):
        got = {r["record_id"]: r for r in revisits.resolve_revisits(spark.createDataFrame(rows, RECORDS), slices).collect()}
        assert sorted(got) == [2, 4, 5, 6, 7, 8, 9, 11]
        assert {i: (r["status"], r["referred_id"]) for i, r in got.items()} == {
            2: ("resolved", 1), 4: ("mismatch", 3), 5: ("missing", None), 6: ("missing", None), 7: ("resolved", 3),
            8: ("missing", None), 9: ("missing", None), 11: ("mismatch", 3)}
        assert got[2]["headers"] == {"etag": 'W/"1"', "server": "s", "content-length": "5", "date": "now"}
    empty = spark.createDataFrame([], RECORDS)
    assert revisits.resolve_revisits(empty).count() == 0


def test_revisits_of_one_hot_url_equal_brute_force(spark):
    r = random.Random(2)
    rows = [record(i, r.choice(["http://h.org/a"] * 5 + ["http://h.org/b", "http://h.org/c"]), r.randrange(200), r.choice(["response", "revisit"]), r.choice("xy")) for i in range(500)]
    got = {x["record_id"]: (x["status"], x["referred_id"]) for x in revisits.resolve_revisits(spark.createDataFrame(rows, RECORDS), 8).collect()}
    for i, url, t, kind, digest, *_ in rows:
        if kind == "revisit":
            old = max(((u[2], u[0], u[4]) for u in rows if u[1] == url and u[3] == "response" and (u[2], u[0]) < (t, i)), default=None)
            assert got[i] == (("missing", None) if old is None else ("resolved" if old[2] == digest else "mismatch", old[1]))


def test_revisit_query_equals_its_sql(spark, sf_dir):
    rows = queries.op8_warc_revisits(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    cur = con.execute(queries.ORACLE["op8_warc_revisits"])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(rows.columns)
    want = Counter(map(tuple, cur.fetchall()))
    got = Counter(tuple(r[n] for n in names) for r in rows.collect())
    assert got == want and len(want) > 10
    again = Counter(r["status"] for r in queries.op8_warc_revisits(spark, sf_dir.replace("0.001", "0.01")).collect())
    assert set(again) == {"resolved", "mismatch", "missing"}


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
    stages = dict(corpus_pipeline.STAGES)
    mild = stages["toxicity"](spark, docs, sf_dir)
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in mild.collect()}
    assert mild.columns == docs.columns and gone and len(gone - toxic) <= 2
    one = stages["near_duplicates"](spark, mild, sf_dir)
    clean = stages["decontamination"](spark, one, sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert clean.columns == docs.columns and not plain_leaks(rows, bench) and len(rows) < one.count()
    masked = stages["secrets"](spark, clean, sf_dir)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {i for i, _ in rows}
    assert pieces.agg(F.sum("length")).first()[0] == pieces.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
