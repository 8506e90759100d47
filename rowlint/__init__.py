"""rowlint: declarative row checks and cleansing compiled to Spark projections.

Every row is kept and carries PASS or FAIL per rule, as the value stood at
that stage; reports summarise verdicts per rule or list one row per finding.
"""

from .functions import DEFAULT_REGISTRY, Param, Registry, RuleTypeError, register_check, register_cleanser
from .operators import derive_rules, reconcile, reconcile_summary, report, suite_pipeline
from .sources import read_csv, read_table, spread, write_annotated, write_reports, write_split
from .streaming import annotate_stream, matched_within, quality_by_window, unique_within
from .plans import (
    FAIL,
    PASS,
    RESULTS_COL,
    CompiledPipeline,
    Pipeline,
    PipelineSpec,
    Rule,
    SpecError,
    SpecWarning,
    Stage,
)

__all__ = [
    "DEFAULT_REGISTRY",
    "FAIL",
    "PASS",
    "RESULTS_COL",
    "CompiledPipeline",
    "Param",
    "Pipeline",
    "PipelineSpec",
    "Registry",
    "Rule",
    "RuleTypeError",
    "SpecError",
    "SpecWarning",
    "Stage",
    "annotate_stream",
    "derive_rules",
    "matched_within",
    "quality_by_window",
    "read_csv",
    "read_table",
    "reconcile",
    "reconcile_summary",
    "spread",
    "write_annotated",
    "write_reports",
    "write_split",
    "register_check",
    "register_cleanser",
    "report",
    "suite_pipeline",
    "unique_within",
]
