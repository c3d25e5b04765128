"""Runs composed of operators, and the named queries over the driver's tables."""


def load_queries() -> dict:
    """All registered queries by name."""
    from scorefold.plans import (  # noqa: F401
        applicant_queries,
        reconcile_queries,
        scoring_queries,
        table_queries,
        trip_queries,
    )
    from scorefold.plans.registry import REGISTRY

    return dict(REGISTRY)
