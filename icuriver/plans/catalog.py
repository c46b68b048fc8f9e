"""All registered queries."""

from icuriver.plans import catalog_clean, catalog_cohort, catalog_decision  # noqa: F401
from icuriver.plans.registry import ORACLES, QUERIES

flagship = QUERIES["d_flagship_cut_window_fill"]

__all__ = ["ORACLES", "QUERIES", "flagship"]
