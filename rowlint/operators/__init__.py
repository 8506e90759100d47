"""Operators over whole tables: reports from result maps, suite derivation, comparison, quantiles, profiles."""

from . import report
from .profiles import merge_states, profile_state, read_states
from .quantiles import exact_quantiles, outlier_bounds, outlier_rules
from .reconcile import reconcile, reconcile_summary
from .suite import derive_rules, profile_columns, suite_pipeline

__all__ = ["derive_rules", "exact_quantiles", "merge_states", "outlier_bounds", "outlier_rules", "profile_columns", "profile_state", "read_states",
           "reconcile", "reconcile_summary", "report", "suite_pipeline"]
