"""All reconciliation reports on a current and a legacy run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from scorefold.operators import reconcile
from scorefold.session import kept
from scorefold.sources.writers import write_reports


def reconciliation_reports(
    current: DataFrame, legacy: DataFrame, key: str | Sequence[str], pairs: reconcile.Pairs, tolerance: float = reconcile.TOLERANCE
) -> dict[str, DataFrame]:
    """Reports by name; ids are expected to be unique in each run.

    Mismatches and verdicts look at ids both runs know; summaries and
    histograms look at each run as a whole.  The joined run and the binned
    differences are computed once and read by all reports on them.
    """
    keys = reconcile.key_list(key)
    joined = kept(reconcile.join_runs(
        current.select(*keys, *[a for a, _ in pairs]), legacy.select(*keys, *[b for _, b in pairs]), keys
    ), "joined_runs")
    names = reconcile.suffix_pairs(pairs)
    differences = kept(reconcile.bin_differences(current, legacy, pairs), "binned_scores")
    return {
        "summaries": reconcile.compare_descriptions(current, legacy, pairs),
        "mismatches": reconcile.all_mismatches(joined, key, names, tolerance),
        "verdicts": reconcile.verdicts(joined, names, tolerance),
        "binned_scores": differences,
        "binned_scores_diff": reconcile.bin_matrix(differences, [a for a, _ in pairs]),
        "moved": reconcile.moved_share(differences, current),
    }


def write_reconciliation(
    current: DataFrame, legacy: DataFrame, key: str | Sequence[str], pairs: reconcile.Pairs, folder: str
) -> list[str]:
    """Write every report as CSV below ``folder`` and return their names."""
    reports = reconciliation_reports(current, legacy, key, pairs)
    write_reports(reports, folder)
    return list(reports)
