"""Secret scans: candidate strings, then a random forest that removes the false ones.

DataFrame functions and the JVM's tree ensembles only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorefold.llm.components import written

#: Words that name a secret, and words of examples.
SECRET_WORDS = r"(secret|token|passw|pwd|api.?key|access.?key|auth|bearer|credential|private)"
EXAMPLE_WORDS = r"(example|sample|dummy|test|placeholder|fake|changeme|your)"

#: Sixteen or more characters of keys, hashes and base64, with a digit among them.
CHARACTERS = r"A-Za-z0-9+/=_\-"
KEY = rf"(?<![{CHARACTERS}])(?=[A-Za-z+/=_\-]*+[0-9])[{CHARACTERS}]{{16,}}+"
#: Six or more characters of any kind, in quotes, that a name of a secret is given.
NAMED = rf"(?<=['\"])(?<=(?i:{SECRET_WORDS[1:-1]})[\w.\-]{{0,16}}\s{{0,2}}[=:]\s{{0,2}}['\"])[^\s'\"]{{6,128}}(?=['\"])"
CANDIDATE = f"{NAMED}|{KEY}"
BEFORE, AFTER = 48, 32

#: Labelled findings that the forest is fitted on at most, by a hash of the finding.
MAX_FINDINGS = 20_000
#: Frequent words of letters that make up the dictionary.
DICTIONARY_WORDS = 300

FEATURES = [
    "length", "digits", "uppers", "hexes", "marks", "distinct", "switches", "longest_letters", "dictionary",
    "path_depth", "path_example", "named", "assigned", "quoted", "example_near", "letters_before",
]


def candidates(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, th, start, value, before, after, path): every candidate of every whole text, with its neighbours.

    ``th`` is a hash of the text, which tells texts without an id apart; ``start``
    counts characters from 0; a finding comes once, however often its row.
    NULL and empty texts and texts without a candidate give no rows.
    """
    place = F.coalesce(F.col(path).cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    found = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), place.alias("path"))
        .where(F.col("text").rlike(CANDIDATE))
        .select("doc_id", F.xxhash64("text").alias("th"), "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("values"), F.split("text", CANDIDATE, -1).alias("between")))
    # Lengths before each candidate, summed up once per text.
    steps = F.expr("""aggregate(values, named_struct('at', CAST(0 AS BIGINT), 'i', 0, 'out', CAST(array() AS array<bigint>)),
        (s, v) -> named_struct('at', s.at + length(between[s.i]) + length(v), 'i', s.i + 1, 'out', array_append(s.out, s.at + length(between[s.i]))), s -> s.out)""")
    rows = F.expr(f"""transform(values, (v, i) -> named_struct('value', v, 'start', starts[i],
        'before', right(between[i], {BEFORE}), 'after', left(between[i + 1], {AFTER})))""")
    return (
        found.withColumn("starts", steps).select("doc_id", "th", "path", F.explode_outer(rows).alias("c"))
        .select("doc_id", "th", "c.start", "c.value", "c.before", "c.after", "path").where("value IS NOT NULL").distinct())


def dictionary(docs: DataFrame, text: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of four to twelve letters of all texts."""
    # The outer form: for the inner one Spark tests the size first and splits again.
    split = docs.select(F.explode_outer(F.split(F.lower(F.col(text)), r"[^a-z]+")).alias("word")).where("length(word) BETWEEN 4 AND 12")
    top = split.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return sorted(r["word"] for r in top.collect())


def share(pattern: str) -> Column:
    """The share of the value's characters that match."""
    return (F.col("length") - F.length(F.regexp_replace("value", pattern, ""))) / F.col("length")


def with_features(found: DataFrame, known: list[str]) -> DataFrame:
    """Columns ``FEATURES`` for candidates: the value itself, its transitions, dictionary, path and neighbours."""
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]", "0"), "[A-Z]", "A"), "[a-z]", "a"), "[^0Aa]", "-")
    covered = F.length("value") - F.length(F.regexp_replace(F.lower("value"), "|".join(known), "")) if known else F.lit(0)
    before, after = F.lower("before"), F.lower("after")
    return (
        found.withColumn("length", F.length("value").cast("double"))
        .withColumn("kinds", kinds)
        .withColumns({
            "digits": share("[0-9]"), "uppers": share("[A-Z]"), "hexes": share("[0-9a-fA-F]"), "marks": share("[^A-Za-z0-9]"),
            "distinct": F.size(F.array_distinct(F.split("value", ""))).cast("double"),
            # Runs of one kind of character: the fewer, the more it reads like a word or a number.
            "switches": F.length(F.regexp_replace("kinds", r"(.)\1*", "x")) / F.col("length"),
            "longest_letters": F.array_max(F.transform(F.split("value", "[^A-Za-z]+"), F.length)).cast("double"),
            "dictionary": covered / F.col("length"),
            "path_depth": F.size(F.split("path", "/")).cast("double"),
            "path_example": F.lower("path").rlike(EXAMPLE_WORDS).cast("double"),
            "named": before.rlike(SECRET_WORDS).cast("double"),
            "assigned": F.col("before").rlike(r"[=:]\s*['\"]?$").cast("double"),
            "quoted": (F.col("before").rlike(r"['\"]$") & F.col("after").rlike(r"^['\"]")).cast("double"),
            "example_near": F.concat(before, after).rlike(EXAMPLE_WORDS).cast("double"),
            "letters_before": F.length(F.regexp_extract("before", r"([A-Za-z]*)[^A-Za-z]*$", 1)).cast("double"),
        }).drop("kinds"))


def rule_labels(found: DataFrame) -> DataFrame:
    """Findings labelled by review rules: (doc_id, start, is_secret), where a rule is sure.

    A value assigned in quotes to a name of a secret is one, unless an example is
    named nearby; numbers, and values that nothing names or assigns, are none.
    """
    before, near = F.lower("before"), F.lower(F.concat("before", "after"))
    assigned = before.rlike(SECRET_WORDS + r"\w*\s*[=:]\s*['\"]$") & F.col("after").rlike(r"^['\"]")
    number = ~F.col("value").rlike("[A-Za-z]")
    plain = ~before.rlike(SECRET_WORDS) & ~F.col("before").rlike(r"[=:]\s*['\"]?$")
    sure = F.when(number, 0).when(assigned & ~near.rlike(EXAMPLE_WORDS), 1).when(assigned | plain, 0)
    return found.select("doc_id", "start", sure.alias("is_secret")).where("is_secret IS NOT NULL")


@dataclass
class Forest:
    """A fitted forest with its dictionary; ``model`` is None where one kind of finding is all there was."""

    model: RandomForestClassificationModel | None
    constant: float
    known: list[str]

    def scored(self, found: DataFrame) -> DataFrame:
        """``found`` with the probability of a real secret."""
        if self.model is None:
            return found.withColumn("probability", F.lit(self.constant))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features_").transform(with_features(found, self.known))
        scored = self.model.transform(rows).withColumn("probability", vector_to_array("probability")[1])
        return scored.select(*found.columns, "probability")


def trained(found: DataFrame, labelled: DataFrame, known: list[str], max_findings: int = MAX_FINDINGS, trees: int = 20, depth: int = 6, seed: int = 11) -> Forest:
    """A random forest on at most ``max_findings`` labelled findings, taken by a hash of their place.

    Without labels, or with true ones alone, every candidate is reported; with
    false ones alone, none.
    """
    marks = labelled.groupBy("doc_id", "start").agg(F.max("is_secret").cast("double").alias("label"))
    sample = found.join(marks, ["doc_id", "start"]).orderBy(F.xxhash64("doc_id", "start"), "value").limit(max_findings)
    rows = written(VectorAssembler(inputCols=FEATURES, outputCol="features_").transform(with_features(sample, known)).select("features_", "label"), "findings")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Forest(None, 0.0 if counts.get(0.0) else 1.0, known)
    forest = RandomForestClassifier(featuresCol="features_", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=False)
    return Forest(forest.fit(rows), 0.0, known)


def scan(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text", path: str = "source", threshold: float = 0.5) -> DataFrame:
    """Candidates of all documents with ``probability`` and ``is_secret``.

    ``labelled`` holds reviewed findings (doc_id, start, is_secret); without it
    the review rules of ``rule_labels`` stand in.
    """
    found = written(candidates(docs, text, path), "candidates")
    forest = trained(found, rule_labels(found) if labelled is None else labelled, dictionary(docs, text))
    return forest.scored(found).withColumn("is_secret", F.col("probability") >= threshold)


def redacted(docs: DataFrame, text: str = "text", path: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """The documents, with all columns, in which found secrets are replaced by ``mark``; no document goes."""
    hits = written(scan(docs, None, text, path).where("is_secret").groupBy(F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th")).agg(
        F.collect_set("value").alias("hit_values")), "secrets")
    # Longer values first, so that one inside another leaves no rest.
    clean = F.aggregate(F.array_sort("hit_values", lambda a, b: F.length(b) - F.length(a)), F.col("hit_text"),
                        lambda t, v: F.replace(t, v, F.lit(mark)))
    joined = docs.withColumn("hit_text", F.col(text)).join(hits, docs["doc_id"].cast("long").eqNullSafe(F.col("hit_id")) & (F.xxhash64(F.col("hit_text")) == F.col("hit_th")), "left")
    return joined.withColumn(text, F.when(F.col("hit_values").isNull(), F.col("hit_text")).otherwise(clean)).select(*docs.columns)
