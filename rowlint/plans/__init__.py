"""Specs, validation and compilation to DataFrame projections."""

from .compile import FAIL, PASS, RESULTS_COL, CompiledPipeline, CompiledRule, resolve
from .pipeline import Pipeline
from .spec import PipelineSpec, Rule, SpecError, SpecWarning, Stage

__all__ = [
    "FAIL",
    "PASS",
    "RESULTS_COL",
    "CompiledPipeline",
    "CompiledRule",
    "Pipeline",
    "PipelineSpec",
    "Rule",
    "SpecError",
    "SpecWarning",
    "Stage",
    "resolve",
]
