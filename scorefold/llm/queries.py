"""One thin query per operator, in the form the result contracts ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.llm import (
    attention_lm, collocations, decontaminate, manifest, packing, pii, revisits, rule_ledger, secrets, simhash, substrings, token_counts,
    toxicity,
)
from scorefold.session import shared_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query
def op2_token_counts(spark, sf_dir):
    # A place of its own, so that a later run finds what this one counted.
    counts = token_counts.token_counts(
        table(spark, sf_dir, "documents"), f"{shared_root(spark)}/token_cache", tokenizer_file("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op3_rule_ledger(spark, sf_dir):
    rows = rule_ledger.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rule_ledger.rejected("base").alias("base_failed"), (~rule_ledger.rejected("v2")).alias("kept"), "fail_bits")


def held_out(folds: int):
    """Whether the CRC-32 of the id as text is divisible by ``folds``; rows without an id are held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(True))


@query
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out(5))
    scores = toxicity.toxicity_scores(docs, toxicity.trained(docs, labels))
    return scores.select("doc_id", held_out(5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_secret_scan(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"),
                        "probability", "is_secret")


@query
def op6_substring_dedup(spark, sf_dir):
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", substrings.sha256("kept").alias("kept_sha256"))


@query
def op7_decontamination(spark, sf_dir):
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", F.col("start").cast("long").alias("start"), "similarity")


def capture_records(pages: DataFrame) -> DataFrame:
    """Pages as captures, in the order of their ids, of the section of the site that they lie in.

    Two captures in three are full responses, the others not-modified answers.
    The path's last figure gives a resource its version, so that some validators
    agree and some do not; each third capture has no entity tag.
    """
    version = F.concat(F.lit('"v'), F.regexp_extract("url", r"([0-9])[^0-9]*$", 1), F.lit('"'))
    kind = F.when(F.col("page_id") % 3 == 2, "revisit").otherwise("response")
    tag = F.when(F.length("html") % 3 == 0, F.lit(None)).when(kind == "revisit", F.concat(F.lit("W/"), version)).otherwise(version)
    headers = F.map_filter(F.create_map(
        F.lit("ETag"), tag, F.lit("Last-Modified"), F.concat(F.lit("day "), F.floor(F.col("page_id") / 1000).cast("string")),
        F.lit("Content-Length"), F.octet_length("html").cast("string"), F.lit("Date"), F.col("page_id").cast("string"),
        F.when(kind == "revisit", F.lit("Age")).otherwise(F.lit("Server")), F.lit("0")), lambda k, v: v.isNotNull())
    section = F.regexp_replace("url", r"/[0-9]+(\.html)?/?", "/")
    return pages.select(F.col("page_id").alias("record_id"), section.alias("url"), F.col("page_id").alias("time"), kind.alias("kind"),
                        F.md5(F.col("html").cast("binary")).alias("digest"), headers.alias("headers"))


@query
def op8_warc_revisits(spark, sf_dir):
    out = revisits.resolve_revisits(capture_records(table(spark, sf_dir, "pages")))
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"])))
    return out.select(F.col("record_id").alias("page_id"), "canonical_url", "status", "referred_id", "payload_digest",
                      F.array_join(pairs, "\n").alias("headers"))


ORACLE["op8_warc_revisits"] = r"""
WITH section AS (
    SELECT page_id, html, url AS whole, trim(regexp_replace(url, '/[0-9]+(\.html)?/?', '/', 'g')) AS url FROM pages),
base AS (
    SELECT *, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)) AS host FROM section),
named AS (
    SELECT page_id, html, whole, host || substr(url, length(host) + 1) AS u FROM base),
r AS (
    SELECT page_id, octet_length(encode(html)) AS size, md5(html) AS digest,
        CASE WHEN page_id % 3 = 2 THEN 'revisit' ELSE 'response' END AS kind,
        CASE WHEN length(html) % 3 = 0 THEN NULL ELSE '"v' || regexp_extract(whole, '([0-9])[^0-9]*$', 1) || '"' END AS tag,
        'day ' || CAST(page_id // 1000 AS VARCHAR) AS modified,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            u, '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '^(www|m)\.', ''), '^([^/?]*):(80|443)([/?]|$)', '\1\3'),
            '([?&])(utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&]*', '\1', 'g'), '[?&]+$', ''), '([?&])&+', '\1', 'g'), '/+$', '') AS cu
    FROM named),
j AS (
    SELECT v.page_id, v.cu, v.tag, v.modified, v.digest, s.page_id AS referred, s.tag AS old_tag, s.modified AS old_modified,
        s.digest AS old_digest, s.size AS old_size
    FROM (SELECT * FROM r WHERE kind = 'revisit') v
    ASOF LEFT JOIN (SELECT * FROM r WHERE kind = 'response') s ON v.cu = s.cu AND v.page_id > s.page_id),
k AS (
    SELECT *, CASE WHEN referred IS NULL THEN 'missing'
        WHEN coalesce(tag = old_tag, modified = old_modified, digest = old_digest) THEN 'resolved' ELSE 'mismatch' END AS status
    FROM j)
SELECT page_id, cu AS canonical_url, status, referred AS referred_id, CASE WHEN status = 'resolved' THEN old_digest END AS payload_digest,
    CASE WHEN status = 'resolved' THEN 'age: 0' || chr(10) || 'content-length: ' || old_size || chr(10) || 'date: ' || page_id
        || coalesce(chr(10) || 'etag: ' || coalesce('W/' || tag, old_tag), '') || chr(10) || 'last-modified: ' || modified
        || chr(10) || 'server: 0' END AS headers
FROM k
"""


@query
def op9_attention_lm(spark, sf_dir):
    scores = attention_lm.lm_scores(
        table(spark, sf_dir, "documents"), ~held_out(10), tokenizer_file("word_bpe_49k.json"))
    return scores.withColumn("held_out", held_out(10))


@query
def op10_simhash(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM documents),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places, (VALUES (1), (2), (3)) sizes(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
parts AS (
    SELECT lang, phrase, k, a, x.cut, array_to_string(w[1:x.cut], ' ') AS first, array_to_string(w[x.cut + 1:], ' ') AS rest
    FROM c, (VALUES (1), (2)) x(cut) WHERE x.cut < k),
many AS (SELECT lang, phrase, f FROM f WHERE f >= 10),
cuts AS (
    SELECT p.lang, p.phrase, p.k, p.a, p.cut, l.f AS l, r.f AS r, 1000000::HUGEINT * p.a * p.a // (l.f * r.f) AS score
    FROM parts p JOIN many l ON l.lang = p.lang AND l.phrase = p.first JOIN many r ON r.lang = p.lang AND r.phrase = p.rest),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
    SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, w, a, unnest([1, 2]) AS i FROM c WHERE k = 3)
    GROUP BY ALL),
kept AS (
    SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE NOT (k = 2 AND coalesce(100 * longer >= 50 * a, false))),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM best JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    other = manifest.digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    leaves = manifest.leaves_of(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", F.when(tampered, other))
    return manifest.manifest(leaves)


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text by its bytes and bits."""
    bits = "list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda crc, c: {bits}))"


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaf AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS grp, head || n1 || tail AS plain,
        CASE WHEN n_chars IS NOT NULL AND coalesce({crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0, false) THEN head || n2 || tail
             ELSE head || n1 || tail END AS changed
    FROM (SELECT doc_id, lang, n_chars,
        {" || ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang"))} AS head,
        {", ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-') AS {name}" for c, name in (("n_chars", "n1"), ("(n_chars + 1)", "n2"), ("text", "tail")))}
        FROM documents)),
base AS (
    SELECT doc_id, grp, sha256(plain) AS d, sha256(changed) AS c, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, plain) - 1 AS pos,
        count(*) OVER (PARTITION BY grp) AS n FROM leaf),
up(grp, lvl, pos, d, n) AS (
    SELECT grp, 0, pos, d, n FROM base
    UNION ALL
    SELECT grp, lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM up WHERE n > 1 GROUP BY grp, lvl, pos // 2, n),
subroot AS (SELECT grp, d, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top(lvl, pos, d, n) AS (
    SELECT 0, pos, d, n FROM subroot
    UNION ALL
    SELECT lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, pos // 2, n),
walk(id, grp, lvl, pos, n, proof, fold) AS (
    SELECT rowid, grp, 0, pos, n, '', c FROM (SELECT *, row_number() OVER () AS rowid FROM base)
    UNION ALL
    SELECT w.id, w.grp, w.lvl + 1, w.pos // 2, (w.n + 1) // 2, w.proof || coalesce(s.d, ''),
        sha256(CASE WHEN w.pos % 2 = 0 THEN w.fold || coalesce(s.d, '') ELSE coalesce(s.d, '') || w.fold END)
    FROM walk w LEFT JOIN up s ON s.grp = w.grp AND s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.n > 1),
climb(id, lvl, pos, n, proof, fold) AS (
    SELECT w.id, 0, s.pos, s.n, w.proof, w.fold FROM walk w JOIN subroot s ON s.grp = w.grp WHERE w.n = 1
    UNION ALL
    SELECT w.id, w.lvl + 1, w.pos // 2, (w.n + 1) // 2, w.proof || coalesce(s.d, ''),
        sha256(CASE WHEN w.pos % 2 = 0 THEN w.fold || coalesce(s.d, '') ELSE coalesce(s.d, '') || w.fold END)
    FROM climb w LEFT JOIN top s ON s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.n > 1)
SELECT b.doc_id, b.d AS leaf, s.d AS subroot, root.d AS root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root, c.fold = root.d AS verified
FROM (SELECT *, row_number() OVER () AS rowid FROM base) b JOIN climb c ON c.id = b.rowid AND c.n = 1 JOIN subroot s ON s.grp = b.grp
    CROSS JOIN (SELECT d FROM top WHERE n = 1) root
"""


@query
def op13_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))
