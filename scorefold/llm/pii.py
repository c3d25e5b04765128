"""Personal data: fixed patterns, and contexts of what they find that discover further identifiers.

Values found by the fixed patterns are seeds.  The words around them are
lexical patterns; patterns and values form a graph, which Spark scores in
rounds: a pattern by the share of its values that are of one kind, a value by
the patterns it stands in.  Patterns of high confidence name the kind of other
identifiers that stand in them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.components import written
from scorefold.llm.words import batch_of, slices

#: Kinds in the order of the results.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Different seeds of a kind that a pattern needs, and the confidence from which it discovers.
LEAST_SEEDS = 3
CONFIDENCE = 0.55
ROUNDS = 3
#: How far a value of no known kind counts against a kind that its form allows.
UNKNOWN = 0.02
#: One-sided deviation of the lower bound of a share; 4 of 4 give 0.60, 10 of 10 give 0.79.
Z = 1.645
#: Code points before and after an identifier that context words are taken from.
LEFT, RIGHT = 160, 100

# The base patterns of the result contract, with possessive groups and a look behind that keep them linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP_FORM = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD_FORM = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE_FORM = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Looser forms: addresses with words or brackets for their marks, groups of digits, of hexadecimal digits, codes with digits.
AT_MARK = re.compile(r"[ ]?(?:[(\[{<]at[)\]}>]|@)[ ]?|[ ]at[ ](?=[A-Za-z0-9-]+[ ]dot[ ])", re.I)
AT_HINTS = ("@", "at)", "at]", "at}", "at>", " dot ", "AT)", "AT]", " DOT ", " Dot ")
LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|[ ]?[(\[{<]dot[)\]}>][ ]?|[ ]dot[ ])[A-Za-z0-9-]+)*", re.I)
DIGIT_GROUPS = re.compile(r"[0-9]++(?:(?:[-./:_]|\)[ .-]?|[ ]\(?|[ ]?\[[.]\][ ]?|[ ]?\([.]\)[ ]?)[0-9]++)*+")
CODE_AFTER = re.compile(r"[0-9A-Za-z]*+(?:[-._][0-9A-Za-z]++)*+")
#: A code has at least so many digits, and at most so many characters.
CODE_DIGITS, CODE_LENGTH = 4, 40
ALL_FORMS = (1 << len(KINDS)) - 1
HEX_HINT = re.compile(r":[0-9A-Fa-f]{0,4}:")
HEX_GROUPS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
EDGES = "\"'()[]{}<>.,;!?"
NUMBER = re.compile(r"[0-9]+")

FOUND = "found array<struct<kind:int,forms:int,start:int,end:int,value:long,patterns:array<long>>>"
ROW = f"part int, row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, {FOUND}"
NAMES = ["part", "row", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "found"]


# ---------------------------------------------------------------- one text


def digits_of(value: str) -> str:
    return "".join(NUMBER.findall(value))


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += 2 * int(d) - (9 if d > "4" else 0)
    return total % 10 == 0


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost e-mail addresses: the longest local part before each mark, not reaching into the address before."""
    at, last = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in LOCAL:
            begin -= 1
        end = DOMAIN.match(text, at + 1) if begin < at else None
        if end:
            yield begin, end.end()
            last = end.end()
            at = text.find("@", last)
        else:
            last = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), ascending; matches that fail their test are dropped."""
    out = [(EMAIL, *s) for s in addresses(text)] if "@" in text else []
    if NUMBER.search(text):
        if "." in text:
            out += [(IP, *m.span()) for m in IP_FORM.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))]
        for m in CARD_FORM.finditer(text):
            if m.end() - m.start() >= 16:
                digits = digits_of(m.group())
                if 16 <= len(digits) <= 19 and passes_luhn(digits):
                    out.append((CARD, *m.span()))
        if "+" in text:
            out += [(PHONE, *m.span()) for m in PHONE_FORM.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return out


def gaps(spans: list[tuple[int, int, int]], n: int) -> Iterator[tuple[int, int]]:
    """What lies between spans."""
    begin = 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start > begin:
            yield begin, start
        begin = max(begin, end)
    if begin < n:
        yield begin, n


def number_forms(value: str) -> int:
    """Kinds, as bits, that the groups of digits might be."""
    groups = NUMBER.findall(value)
    n = sum(map(len, groups))
    return ((len(groups) == 4 and all(len(g) < 4 and int(g) <= 255 for g in groups)) << IP) | ((12 <= n <= 19) << CARD) | ((7 <= n <= 15) << PHONE)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(forms, start, end) of identifier-like strings outside the base spans, apart from each other."""
    out = []
    if any(h in text for h in AT_HINTS):
        for a, b in gaps(base, len(text)):
            last = a
            for m in AT_MARK.finditer(text, a, b):
                begin = m.start()
                while begin > last and text[begin - 1] in LOCAL:
                    begin -= 1
                domain = LOOSE_DOMAIN.match(text, m.end(), b)
                if begin < m.start() and m.start() >= last and domain:
                    out.append((1 << EMAIL, begin, domain.end()))
                    last = domain.end()
    if HEX_HINT.search(text):
        for a, b in list(gaps(base + out, len(text))):
            out += [(1 << IP, *m.span()) for m in HEX_GROUPS.finditer(text, a, b) if NUMBER.search(m.group())]
    if NUMBER.search(text):
        for a, b in list(gaps(base + out, len(text))):
            last = a
            for m in DIGIT_GROUPS.finditer(text, a, b):
                start, end = m.span()
                if start < last:
                    continue
                forms = number_forms(m.group())
                if text[max(a, start - 1):start].isalnum() or text[end:min(b, end + 1)].isalnum():
                    # Letters touch the digits: the whole code, which might be of any kind.
                    while start > last and start > m.start() - CODE_LENGTH and (text[start - 1].isalnum() or text[start - 1] in "-._"):
                        start -= 1
                    end = CODE_AFTER.match(text, end, b).end()
                    code = text[start:end]
                    forms = ALL_FORMS if len(code) <= CODE_LENGTH and len(digits_of(code)) >= CODE_DIGITS else 0
                elif start > last and text[start - 1] in "+(":
                    start -= 1
                last = end
                if forms:
                    out.append((forms, start, end))
    return out


def contexts(text: str, start: int, end: int) -> list[int]:
    """Keys of the lexical patterns around a span: words before, after, and on both sides."""
    norm = lambda w: NUMBER.sub("0", w.strip(EDGES).lower())
    left = [norm(w) for w in text[max(0, start - LEFT):start].split()[-3:]]
    right = [norm(w) for w in text[end:end + RIGHT].split()[:2]]
    out = [("left", *left[-n:]) for n in (1, 2, 3) if len(left) >= n]
    if right:
        out += [("both", *left[-n:], "", right[0]) for n in (1, 2) if len(left) >= n]
    if len(right) == 2:
        out.append(("right", *right))
    return [xxhash.xxh64_intdigest("\x00".join(p).encode("utf-8", "replace")) - (1 << 63) for p in out]


def value_key(text: str, forms: int) -> int:
    """Equal for one identifier written in different ways: its digits, or its letters and digits where its form allows an address."""
    plain = "".join(c for c in text.lower() if c.isalnum()) if forms & (1 << EMAIL) or ":" in text else digits_of(text)
    return xxhash.xxh64_intdigest(plain.encode("utf-8", "replace")) - (1 << 63)


def scanned(docs: DataFrame, text: str) -> DataFrame:
    """Per document: base spans as text, and all identifiers with their patterns; the only pass over the texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("forms", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("value", pa.int64()), ("patterns", pa.list_(pa.int64()))]))
        for batch, texts in slices(batches, "text"):
            columns = [[] for _ in NAMES]
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts):
                t = raw.decode("utf-8", "replace")
                base = base_spans(t)
                found = [(k, 1 << k, a, b) for k, a, b in base] + [(-1, forms, a, b) for forms, a, b in loose_spans(t, base)]
                counts = [sum(k == j for k, _, _ in base) for j in range(len(KINDS))]
                values = [part, row, doc_id, *counts, ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(base)),
                          [{"kind": k, "forms": f, "start": a, "end": b, "value": value_key(t[a:b], f), "patterns": contexts(t, a, b)} for k, f, a, b in found]]
                for column, value in zip(columns, values):
                    column.append(value)
                row += 1
            types = [pa.int32(), pa.int64(), pa.int64(), *[pa.int64()] * 4, pa.string(), kind]
            yield batch_of(NAMES, *[pa.array(c, t) for c, t in zip(columns, types)])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return plain.mapInArrow(work, ROW)


# ---------------------------------------------------------------- the graph


def lower_bound(hits: Column, n: Column) -> Column:
    """Wilson's lower bound of the share ``hits`` of ``n``."""
    p, z2 = hits / n, Z * Z
    return (p + z2 / (2 * n) - Z * F.sqrt(F.greatest(p * (1 - p), F.lit(0.0)) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def pattern_scores(edges: DataFrame, values: DataFrame | None) -> DataFrame:
    """(pattern, kind, confidence) of patterns that reach the confidence.

    ``edges`` has each pair of pattern and value once; ``values`` (value, forms,
    kind, score) are values believed of a kind so far, None in the first round.
    Values of another kind, or of a form that the kind does not have, count
    against it; values of no known kind by ``UNKNOWN``.
    """
    if values is None:
        edges = edges.withColumn("scores", F.array(*[F.lit(0.0)] * len(KINDS)))
    else:
        by_value = values.groupBy("value", "forms").agg(F.array(*[
            F.coalesce(F.max(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)) for k in range(len(KINDS))]).alias("scores"))
        edges = edges.join(by_value, ["value", "forms"], "left").withColumn("scores", F.coalesce("scores", F.array(*[F.lit(0.0)] * len(KINDS))))
    sums = []
    for k in range(len(KINDS)):
        seed, fits = F.col("kind") == k, F.col("forms").bitwiseAND(1 << k) != 0
        known = F.when(F.col("kind") >= 0, seed.cast("double")).when(fits, F.col("scores")[k]).otherwise(0.0)
        against = F.when(F.col("kind") >= 0, (~seed).cast("double")).when(fits, (1 - F.col("scores")[k]) * UNKNOWN).otherwise(1.0)
        sums += [F.sum(known).alias(f"for{k}"), F.sum(against).alias(f"against{k}")]
    totals = edges.groupBy("pattern").agg(*sums)
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"for{k}").alias("hits"), F.col(f"against{k}").alias("misses")) for k in range(len(KINDS))]))
    rows = totals.select("pattern", kinds.alias("x")).select("pattern", "x.*").where(F.col("hits") >= LEAST_SEEDS)
    scored = rows.select("pattern", "kind", lower_bound(F.col("hits"), F.col("hits") + F.col("misses")).alias("confidence"))
    return scored.where(F.col("confidence") >= CONFIDENCE)


def trusted_patterns(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) after ``rounds`` rounds over the graph of patterns and values.

    Copies of a text add no edges, because each value counts once a pattern.
    """
    found = rows.select(F.explode("found").alias("x")).select("x.kind", "x.forms", "x.value", F.explode("x.patterns").alias("pattern"))
    pairs = written(found.groupBy("pattern", "value", "kind", "forms").agg(F.count("*").alias("n")), "pattern_values")
    # A pattern without enough different values has no confidence in any round.
    many = pairs.groupBy("pattern").agg(F.count("*").alias("values")).where(F.col("values") >= LEAST_SEEDS).select("pattern")
    edges = written(pairs.join(many, "pattern", "left_semi"), "pattern_edges")
    patterns = written(pattern_scores(edges, None), "patterns")
    for _ in range(rounds - 1):
        open_edges = edges.where("kind < 0").select("pattern", "value", "forms")
        believed = open_edges.join(patterns, "pattern").where(F.expr("(forms & shiftleft(1, kind)) != 0"))
        values = written(believed.groupBy("value", "forms", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.99)))))).alias("score")), "values")
        patterns = written(pattern_scores(edges, values), "patterns")
    return patterns


# ---------------------------------------------------------------- the operator


def personal_data(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every whole text.

    The counts and the digest are those of the base patterns; ``spans`` has, as
    kind:start:end in code points, also the identifiers that trusted patterns
    discover.  Texts are read once; the graph has a row per identifier and
    pattern.  NULL and empty texts have no spans; NULL ids and repeated rows are
    handled like others; an empty table gives no rows.
    """
    rows = written(scanned(docs, text), "identifiers")
    patterns = trusted_patterns(rows, rounds)
    found = rows.select("part", "row", F.explode("found").alias("x")).where("x.kind < 0").select(
        "part", "row", "x.forms", "x.start", "x.end", F.explode("x.patterns").alias("pattern"))
    hits = found.join(patterns, "pattern").where(F.expr("(forms & shiftleft(1, kind)) != 0"))
    best = hits.groupBy("part", "row", "start", "end").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("kind"))).alias("best"))
    new = best.groupBy("part", "row").agg(F.collect_list(F.struct((-F.col("best.kind")).alias("kind"), "start", "end")).alias("new"))
    base = F.transform(F.filter("found", lambda x: x["kind"] >= 0), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    spans = F.array_sort(F.concat(base, F.coalesce("new", F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)"))))
    names = F.array(*map(F.lit, KINDS))
    listed = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.join(new, ["part", "row"], "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), listed.alias("spans"))
