"""Reconciliation of two runs: two price formulas over line items."""

from __future__ import annotations

from scorefold.operators import aggregates, reconcile
from scorefold.plans.reconciliation import write_reconciliation
from scorefold.plans.registry import query, rnd, with_rounded
from scorefold.session import scratch_path
from scorefold.sources import driver_tables as D
from scorefold.sources.readers import read_csv

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
KEYS = ", ".join(KEY)
PAIRS = [("net_price", "net_price_v1"), ("taxed_price", "taxed_price_v1"), ("quantity", "quantity")]
JOINED = reconcile.suffix_pairs(PAIRS)
_NET = "l_extendedprice * (1 - l_discount)"

_CURRENT = {
    **{k: k for k in KEY},
    "net_price": f"CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 10 = 3 THEN {_NET} + 0.5 ELSE {_NET} END",
    "taxed_price": f"{_NET} * (1 + l_tax)",
    "quantity": "CASE WHEN l_suppkey % 50 = 7 THEN l_quantity + 2 ELSE l_quantity END",
}
_LEGACY = {
    **{k: k for k in KEY},
    "net_price_v1": f"CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE {_NET} END",
    "taxed_price_v1": f"{_NET} * (1 + l_tax) + CASE WHEN l_linenumber = 7 THEN 1e-10 ELSE 0e0 END",
    "quantity": "l_quantity",
}


def _select(columns: dict[str, str]) -> str:
    listed = ", ".join(f"CAST({e} AS {'BIGINT' if n in KEY else 'DOUBLE'}) AS {n}" for n, e in columns.items())
    return f"SELECT {listed} FROM lineitem"


def _run(spark, sf_dir, columns: dict[str, str]):
    return D.table(spark, sf_dir, "lineitem").selectExpr(
        *[f"CAST({e} AS {'BIGINT' if n in KEY else 'DOUBLE'}) AS {n}" for n, e in columns.items()]
    )


def _joined(spark, sf_dir, how: str = "inner"):
    """Both runs have one row per line, known by its order, part, supplier and number."""
    return reconcile.join_runs(_run(spark, sf_dir, _CURRENT), _run(spark, sf_dir, _LEGACY), KEY, how)


_JOINED_SQL = (
    f"SELECT {', '.join(f'a.{k}' for k in KEY)}, a.net_price, b.net_price_v1, a.taxed_price, b.taxed_price_v1, "
    "a.quantity AS \"quantity_DB\", b.quantity AS \"quantity_R\" "
    f"FROM ({_select(_CURRENT)}) a JOIN ({_select(_LEGACY)}) b ON {' AND '.join(f'a.{k} = b.{k}' for k in KEY)}"
)


def _close_sql(a: str, b: str, tolerance: str = "1e-8") -> str:
    return f"coalesce(abs({a} - {b}) <= {tolerance}, FALSE)"


@query(
    "DQ-01 DQ-05 JN-08 JN-09",
    " UNION ALL ".join(
        f"SELECT {KEYS}, '{a}' AS score, round({b}, 4) AS legacy, round({a}, 4) AS current FROM ({_JOINED_SQL}) WHERE NOT {_close_sql(a, b)}"
        for a, b in JOINED
    ),
)
def recon_mismatch(spark, sf_dir):
    return with_rounded(reconcile.all_mismatches(_joined(spark, sf_dir), KEY, JOINED))


@query(
    "DQ-01",
    f"SELECT {KEYS}, round(taxed_price_v1, 7) AS taxed_price_v1, round(taxed_price, 7) AS taxed_price FROM ({_JOINED_SQL}) "
    f"WHERE NOT {_close_sql('taxed_price', 'taxed_price_v1', '1e-12')}",
)
def recon_mismatch_tight(spark, sf_dir):
    return with_rounded(reconcile.mismatches(_joined(spark, sf_dir), KEY, JOINED[1], tolerance=1e-12), 7)


def _verdict_sql(equal_nan: bool) -> str:
    def same(a: str, b: str) -> str:
        return f"({_close_sql(a, b)}{f' OR ({a} IS NULL AND {b} IS NULL)' if equal_nan else ''})"

    return " UNION ALL ".join(
        f"SELECT '{a}' AS score, bool_and({same(a, b)}) AS all_close, count(*) FILTER (NOT {same(a, b)}) AS mismatches FROM ({_JOINED_SQL})"
        for a, b in JOINED
    )


@query("DQ-02 DQ-04 DQ-05 AG-12", _verdict_sql(False))
def recon_allclose(spark, sf_dir):
    return reconcile.verdicts(_joined(spark, sf_dir), JOINED)


@query("DQ-02", _verdict_sql(True))
def recon_allclose_equal_nan(spark, sf_dir):
    return reconcile.verdicts(_joined(spark, sf_dir), JOINED, equal_nan=True)


_WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
#: A wide run: each number of a line item multiplied by 1 to 10, 40 columns; the current run differs in some.
_WIDE_COLUMNS = [f"{c}_{i}" for i in range(1, 11) for c in _WIDE]


def _wide_expression(name: str, current: bool) -> str:
    c, i = name.rsplit("_", 1)
    plain = f"{c} * {i}e0"
    if not current:
        return f"CASE WHEN l_suppkey % 43 = 1 AND {i} = 3 THEN NULL ELSE {plain} END"
    return f"CASE WHEN l_partkey % 41 = {i} THEN {plain} + {i}e0 WHEN l_suppkey % 43 = 1 AND {i} = 3 THEN NULL ELSE {plain} END"


def _wide_run(spark, sf_dir, current: bool):
    return D.table(spark, sf_dir, "lineitem").selectExpr(*KEY, *[f"{_wide_expression(c, current)} AS {c}" for c in _WIDE_COLUMNS])


_WIDE_SQL = (
    f"SELECT {', '.join(f'a.{k}' for k in KEY)}, {', '.join(f'a.{c} AS {c}_db, b.{c} AS {c}_r' for c in _WIDE_COLUMNS)} "
    f"FROM (SELECT {KEYS}, {', '.join(f'{_wide_expression(c, True)} AS {c}' for c in _WIDE_COLUMNS)} FROM lineitem) a "
    f"JOIN (SELECT {KEYS}, {', '.join(f'{_wide_expression(c, False)} AS {c}' for c in _WIDE_COLUMNS)} FROM lineitem) b USING ({KEYS})"
)


@query(
    "DQ-05 DQ-04",
    f"WITH j AS ({_WIDE_SQL}) " + " UNION ALL ".join(
        f"SELECT '{c}_DB' AS score, count(*) FILTER (NOT {_close_sql(f'{c}_db', f'{c}_r')}) AS mismatches FROM j" for c in _WIDE_COLUMNS),
)
def recon_all_columns(spark, sf_dir):
    """Mismatches of every column two wide runs share."""
    names = [(c, c) for c in _WIDE_COLUMNS]
    current, legacy = reconcile.without_agreeing(_wide_run(spark, sf_dir, True), _wide_run(spark, sf_dir, False), KEY, names)
    return reconcile.column_mismatches(reconcile.join_runs(current, legacy, KEY), reconcile.suffix_pairs(names))


@query(
    "DQ-03 FN-05",
    f"SELECT {KEYS}, coalesce(round(net_price, 0) = round(net_price_v1, 0), FALSE) AS same FROM ({_JOINED_SQL})",
)
def recon_rounded(spark, sf_dir):
    joined = _joined(spark, sf_dir)
    return joined.select(*KEY, reconcile.rounded_equal("net_price", "net_price_v1", 0).alias("same"))


@query(
    "DQ-03 AG-12",
    f"SELECT bool_and(coalesce(round(taxed_price, 2) = round(taxed_price_v1, 2), FALSE)) AS all_rows FROM ({_JOINED_SQL})",
)
def recon_all_rows_equal(spark, sf_dir):
    condition = reconcile.rounded_equal("taxed_price", "taxed_price_v1", 2)
    return aggregates.holds_for_all(_joined(spark, sf_dir), condition)


def _describe_sql(columns: dict[str, str], names: dict[str, str], prefix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{score}' AS score, count({c}) AS {prefix}count, avg({c}) AS {prefix}mean, stddev_samp({c}) AS {prefix}stddev, "
        f"min({c}) AS {prefix}min, max({c}) AS {prefix}max FROM ({_select(columns)})"
        for score, c in names.items()
    )


_STATS = ("mean", "stddev", "min", "max")


@query(
    "DQ-06 AG-07",
    "SELECT l.score, l.count, r.legacy_count, "
    + ", ".join(rnd(f"{p}{s}", f"{p}{s}", 2) for p in ("", "legacy_") for s in _STATS)
    + f" FROM ({_describe_sql(_CURRENT, {a: a for a, _ in PAIRS}, '')}) l "
    f"JOIN ({_describe_sql(_LEGACY, dict(PAIRS), 'legacy_')}) r ON l.score = r.score",
)
def recon_describe(spark, sf_dir):
    current, legacy = _run(spark, sf_dir, _CURRENT), _run(spark, sf_dir, _LEGACY)
    return with_rounded(reconcile.compare_descriptions(current, legacy, PAIRS), 2)


@query(
    "AG-07",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {', '.join(rnd(f'{f}({c})', s, 2) for s, f in zip(_STATS, ('avg', 'stddev_samp', 'min', 'max')))} FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def describe_columns(spark, sf_dir):
    lines = D.table(spark, sf_dir, "lineitem")
    return with_rounded(aggregates.describe(lines, ["l_quantity", "l_extendedprice", "l_discount"]), 2)


def _bins_sql() -> str:
    """(score, bin) counts of both sides over 100 equal bins of the legacy range."""
    parts = []
    for a, b in PAIRS:
        ranged = (
            f"SELECT min({b}) - 0.0001e0 AS lo, max({b}) + 0.0001e0 AS hi FROM ({_select(_LEGACY)})"
        )
        def binned(c: str, columns: dict[str, str]) -> str:
            return (
                f"SELECT CAST(floor(({c} - lo) / ((hi - lo) / 100)) AS INTEGER) AS bin, count(*) AS n FROM ({_select(columns)}), ({ranged}) "
                f"WHERE {c} IS NOT NULL AND {c} BETWEEN lo AND hi GROUP BY 1"
            )
        parts.append(
            f"SELECT '{a}' AS score, r.bin, l.n AS current_count, r.n AS legacy_count, abs(l.n - r.n) AS diff "
            f"FROM ({binned(a, _CURRENT)}) l RIGHT JOIN ({binned(b, _LEGACY)}) r ON l.bin = r.bin"
        )
    return " UNION ALL ".join(parts)


def _differences(spark, sf_dir):
    return reconcile.bin_differences(_run(spark, sf_dir, _CURRENT), _run(spark, sf_dir, _LEGACY), PAIRS)


@query("DQ-07 DQ-08 JN-12 AG-05 FN-06", _bins_sql())
def recon_bins(spark, sf_dir):
    return _differences(spark, sf_dir)


@query(
    "DQ-09 JN-13",
    "SELECT CAST(k AS INTEGER) AS bin, "
    + ", ".join(f"CAST(max(diff) FILTER (score = '{a}') AS DOUBLE) AS {a}_diff" for a, _ in PAIRS)
    + f" FROM range(100) AS s(k) LEFT JOIN ({_bins_sql()}) ON bin = k GROUP BY k",
)
def recon_bin_matrix(spark, sf_dir):
    return reconcile.bin_matrix(_differences(spark, sf_dir), [a for a, _ in PAIRS])


@query(
    "DQ-09 AG-06 AG-11",
    f"SELECT score, CAST(coalesce(sum(diff), 0) AS BIGINT) AS moved, {rnd('coalesce(sum(diff), 0) * 100 / (SELECT count(*) FROM lineitem)', 'percent')} "
    f"FROM ({_bins_sql()}) GROUP BY score",
)
def recon_moved_share(spark, sf_dir):
    return with_rounded(reconcile.moved_share(_differences(spark, sf_dir), D.table(spark, sf_dir, "lineitem")))


@query(
    "AG-11",
    "SELECT 'l_quantity' AS \"column\", " + rnd("sum(l_quantity) * 100 / count(*)", "percent", 3) + " FROM lineitem UNION ALL "
    "SELECT 'l_linenumber', " + rnd("sum(l_linenumber) * 100 / count(*)", "percent", 3) + " FROM lineitem",
)
def column_share(spark, sf_dir):
    lines = D.table(spark, sf_dir, "lineitem")
    return with_rounded(aggregates.share_of_rows(lines, ["l_quantity", "l_linenumber"]), 3)


@query(
    "DQ-07 SO-02",
    "SELECT CAST(floor(l_quantity - 0.5) AS INTEGER) AS bin, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY 1",
)
def score_distribution(spark, sf_dir):
    return reconcile.distribution(D.table(spark, sf_dir, "lineitem"), "l_quantity", 0.5, 100.5)


@query(
    "SNK-05 DQ-04",
    f"SELECT score, all_close, mismatches FROM ({_verdict_sql(False)})",
)
def recon_report_files(spark, sf_dir):
    """Every report written as CSV, and the verdicts read back."""
    folder = scratch_path(spark, "reconciliation")
    current, legacy = _run(spark, sf_dir, _CURRENT), _run(spark, sf_dir, _LEGACY)
    write_reconciliation(current, legacy, KEY, PAIRS, folder)
    return read_csv(spark, f"{folder}/verdicts", "score STRING, all_close BOOLEAN, mismatches BIGINT")


_DIFF_NAMES = [f"{b.removesuffix('_R')}_diff" for _, b in JOINED]
_DIFFS_SQL = "SELECT " + ", ".join(
    f"abs(coalesce({a}, 0) - coalesce({b}, 0)) AS {d}" for (a, b), d in zip(JOINED, _DIFF_NAMES)
) + f" FROM ({_JOINED_SQL})"


@query(
    "DQ-10 IMP-14 FN-06",
    "SELECT " + ", ".join(rnd(d, d) for d in _DIFF_NAMES) + f" FROM ({_DIFFS_SQL})",
)
def recon_abs_diff(spark, sf_dir):
    return with_rounded(reconcile.absolute_differences(_joined(spark, sf_dir), JOINED, missing_as=0.0))


_CORR_COLUMNS = ["l_quantity", "l_extendedprice", "net_gap"]
_GAP = f"CASE WHEN l_partkey % 10 = 3 THEN l_quantity * 0.5 + l_tax WHEN l_partkey % 97 = 0 THEN NULL ELSE {_NET} END"


@query(
    "AG-09 DQ-10",
    f"WITH x AS (SELECT l_quantity, l_extendedprice, {_GAP} AS net_gap FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({a}, {b})', 'correlation', 6)} FROM x"
        for a in _CORR_COLUMNS for b in _CORR_COLUMNS
    ),
)
def recon_corr(spark, sf_dir):
    lines = D.table(spark, sf_dir, "lineitem").selectExpr("l_quantity", "l_extendedprice", f"{_GAP} AS net_gap")
    return with_rounded(aggregates.correlations(lines, _CORR_COLUMNS), 6)


@query(
    "AG-08 DQ-11",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM ({_select(_CURRENT)})" for c in _CURRENT
    ),
)
def recon_nulls(spark, sf_dir):
    return aggregates.null_counts(_run(spark, sf_dir, _CURRENT))


@query(
    "FLT-06 DQ-11",
    f"SELECT {KEYS}, net_price, round(net_price_v1, 4) AS net_price_v1 FROM ({_JOINED_SQL}) WHERE net_price IS NULL AND net_price_v1 IS NOT NULL",
)
def recon_null_pattern(spark, sf_dir):
    rows = reconcile.null_pattern_rows(_joined(spark, sf_dir), "net_price", "net_price_v1")
    return with_rounded(rows.select(*KEY, "net_price", "net_price_v1"))


@query(
    "DQ-12 FLT-03 AG-10",
    f"SELECT 'net_price' AS score, bool_and({_close_sql('net_price', 'net_price_v1')}) AS all_close, "
    f"count(*) FILTER (NOT {_close_sql('net_price', 'net_price_v1')}) AS mismatches FROM ({_JOINED_SQL}) "
    f"WHERE ({KEYS}) NOT IN (SELECT ({KEYS}) FROM ({_JOINED_SQL}) WHERE NOT {_close_sql('quantity_DB', 'quantity_R')})",
)
def recon_drop_ids(spark, sf_dir):
    rest = reconcile.without_differing(_joined(spark, sf_dir), KEY, JOINED[2])
    return reconcile.verdicts(rest, JOINED[:1])


@query(
    "DQ-13 AG-06 AG-10",
    f"WITH g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS rows, "
    "count(o_custkey) AS distinct_keys, CAST(coalesce(sum(n) FILTER (o_custkey IS NULL), 0) AS BIGINT) AS null_keys, "
    "max(n) FILTER (o_custkey IS NOT NULL) AS most_per_key FROM g",
)
def key_checkpoint(spark, sf_dir):
    return aggregates.key_report(D.table(spark, sf_dir, "orders"), "o_custkey")
