"""Print the operator index of README.md: operator id -> registered queries."""

from __future__ import annotations

import sys
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from scorefold.plans import load_queries  # noqa: E402

if __name__ == "__main__":
    by_id = defaultdict(list)
    for name, q in load_queries().items():
        for i in q.covers:
            by_id[i].append(name if q.sql is not None else f"{name}*")
    for i in sorted(by_id):
        print(f"| {i} | {', '.join(by_id[i])} |")
