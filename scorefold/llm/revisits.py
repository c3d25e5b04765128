"""WARC revisit records: an as-of join with the latest earlier full response of the canonical URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers of a stored response that a not-modified answer never replaces.
KEPT = ["content-encoding", "content-length", "content-range", "content-type", "transfer-encoding",
        "connection", "keep-alive", "te", "trailer", "upgrade", "proxy-authenticate", "proxy-authorization"]
#: Query parameters that only track.
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid|sessionid)"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.`` or ``m.``, port 80 or 443, fragment, tracking parameters, and a last slash do not count."""
    steps = [
        (r"#.*$", ""), (r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), (r"^(www|m)\.", ""), (r"^([^/?]*):(80|443)([/?]|$)", "$1$3"),
        (rf"([?&]){TRACKING}=[^&]*", "$1"), (r"[?&]+$", ""), (r"([?&])&+", "$1"), (r"/+$", ""),
    ]
    out = F.trim(url)
    host = F.lower(F.regexp_extract(out, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1))
    out = F.concat(host, F.substring(out, F.length(host) + 1, F.length(out)))
    for pattern, new in steps:
        out = F.regexp_replace(out, pattern, new)
    return out


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that then clash the last stays."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(
        n.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"].alias("value"))))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, with those that the revisit brings and may replace or add."""
    old, new = lower_keys(stored), F.map_filter(lower_keys(fresh), lambda k, _: ~k.isin(KEPT))
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.coalesce(F.array_contains(F.map_keys(new), k), F.lit(False))), new)


def strong_tag(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^\s*W/", "")


def resolve_revisits(records: DataFrame, slices: int = 64) -> DataFrame:
    """Revisit records with the response they stand for: referred_id, status, and merged headers.

    ``records``: record_id long, url, time (orderable), kind ('response' or
    'revisit'), digest, headers map<string,string>.  Earlier means a smaller
    (time, record_id).  ``status`` is ``resolved`` if the validators agree: equal
    entity tags (weak marks ignored) where both have one, else equal
    last-modified dates, else equal payload digests; ``mismatch`` if they differ
    or neither side has one; ``missing`` without an earlier response.  A revisit
    with a NULL url or time is ``missing``; a NULL kind is neither.  Equal rows
    are resolved each by itself; an empty table gives none.

    The as-of join runs in time slices cut at quantiles, so that a URL with a
    third of all records is spread over the slices: first within (url, slice),
    then the last response of each slice is carried to the following ones.  Only
    ids, times and validators are shuffled, no payload.
    """
    r = records.where("kind IN ('response', 'revisit')").select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("canonical_url"),
        "time", "kind", "digest", F.coalesce("headers", F.expr("CAST(map() AS map<string,string>)")).alias("headers"))
    cuts = r.agg(F.expr(f"percentile_approx(CAST(time AS DOUBLE), array({', '.join(str(i / slices) for i in range(1, slices))}), 2000)")).first()[0] or []
    cuts = sorted(set(cuts))
    piece = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col("time").cast("double"))) if cuts else F.lit(0)
    r = r.withColumn("piece", F.coalesce(piece, F.lit(-1)))
    full = (F.col("kind") == "response") & F.col("canonical_url").isNotNull() & F.col("time").isNotNull()
    full = F.when(full, F.struct("time", "record_id", "digest", "headers"))
    within = Window.partitionBy("canonical_url", "piece").orderBy("time", "record_id", F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = r.withColumn("near", F.last(full, ignorenulls=True).over(within)).where("kind = 'revisit'")
    lasts = (
        r.where("kind = 'response' AND canonical_url IS NOT NULL AND time IS NOT NULL").groupBy("canonical_url", "piece")
        .agg(F.max_by(F.struct("time", "record_id", "digest", "headers"), F.struct("time", "record_id")).alias("own")))
    places = rows.where("near IS NULL AND canonical_url IS NOT NULL AND time IS NOT NULL").select("canonical_url", "piece").distinct()
    earlier = Window.partitionBy("canonical_url").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        places.join(lasts, ["canonical_url", "piece"], "full")
        .withColumn("far", F.last("own", ignorenulls=True).over(earlier)).where("far IS NOT NULL").select("canonical_url", "piece", "far"))
    found = rows.join(carried, ["canonical_url", "piece"], "left").withColumn("hit", F.when(
        F.col("canonical_url").isNotNull() & F.col("time").isNotNull(), F.coalesce("near", "far")))
    old, new = lower_keys(F.col("hit.headers")), lower_keys(F.col("headers"))
    tags = [strong_tag(F.element_at(h, F.lit("etag"))) for h in (old, new)]
    dates = [F.trim(F.element_at(h, F.lit("last-modified"))) for h in (old, new)]
    agrees = F.coalesce(tags[0] == tags[1], dates[0] == dates[1], F.col("hit.digest") == F.col("digest"), F.lit(False))
    status = F.when(F.col("hit").isNull(), "missing").when(agrees, "resolved").otherwise("mismatch")
    return found.select("record_id", "canonical_url", "time", F.col("hit.record_id").alias("referred_id"), status.alias("status"),
                        F.when(status == "resolved", merged_headers(F.col("hit.headers"), F.col("headers"))).alias("headers"),
                        F.when(status == "resolved", F.col("hit.digest")).alias("payload_digest"))


def with_payload(resolved: DataFrame, records: DataFrame, payload: str) -> DataFrame:
    """Resolved revisits with the payload of the response they refer to."""
    bodies = records.where("kind = 'response'").select(F.col("record_id").cast("long").alias("referred_id"), F.col(payload).alias("payload"))
    return resolved.where("status = 'resolved'").join(bodies.dropDuplicates(["referred_id"]), "referred_id")
