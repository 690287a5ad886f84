"""All registered queries by name."""

from __future__ import annotations

from premia.plans import metrics, models, prep, recommend, results, stability, text, value

FAMILIES = [value, prep, recommend, metrics, stability, text, results, models]


def all_queries() -> dict:
    out: dict = {}
    for family in FAMILIES:
        clash = out.keys() & family.QUERIES.keys()
        if clash:
            raise ValueError(f"query registered twice: {sorted(clash)}")
        out.update(family.QUERIES)
    return out
