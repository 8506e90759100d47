"""``Pipeline``: the user-facing handle, a spec plus a rule registry.

    p = Pipeline.load("checks.yaml")
    out = df.transform(p)                 # annotated rows, nothing dropped
    run = p.compile(df)                   # same plan, more outputs:
    run.summary(); run.exploded(["id"]); run.flat(["id", "name"])
"""

from __future__ import annotations

import os
from typing import Any, Mapping

from pyspark.sql import DataFrame

from ..functions.registry import DEFAULT_REGISTRY, Registry
from .compile import RESULTS_COL, CompiledPipeline, invalid_patterns
from .spec import PipelineSpec, SpecError


class Pipeline:
    def __init__(
        self,
        config: PipelineSpec | Mapping[str, Any] | str,
        *,
        registry: Registry | None = None,
        on_unknown: str = "warn",
        results_col: str = RESULTS_COL,
    ):
        """``config`` is a spec, a dict, a path to a YAML file or YAML text."""
        self.registry = registry or DEFAULT_REGISTRY
        self.results_col = results_col
        if isinstance(config, PipelineSpec):
            self.spec = config
        elif isinstance(config, Mapping):
            self.spec = PipelineSpec.from_dict(config, self.registry, on_unknown)
        elif isinstance(config, str) and "\n" not in config and os.path.exists(config):
            self.spec = PipelineSpec.load(config, registry=self.registry, on_unknown=on_unknown)
        elif isinstance(config, str) and "\n" not in config and config.endswith((".yaml", ".yml")):
            raise FileNotFoundError(f"no spec file {config!r} (use Pipeline.load(path, spark=...) for remote paths)")
        elif isinstance(config, str):
            self.spec = PipelineSpec.from_yaml(config, self.registry, on_unknown)
        else:
            raise TypeError(f"cannot build a pipeline from {type(config).__name__}")

    @classmethod
    def from_dict(cls, data: Mapping[str, Any], **kw) -> "Pipeline":
        return cls(data, **kw)

    @classmethod
    def from_yaml(cls, text: str, **kw) -> "Pipeline":
        reg = kw.get("registry")
        return cls(PipelineSpec.from_yaml(text, reg, kw.pop("on_unknown", "warn")), **kw)

    @classmethod
    def load(cls, path: str, spark=None, **kw) -> "Pipeline":
        reg = kw.get("registry")
        return cls(PipelineSpec.load(path, spark, reg, kw.pop("on_unknown", "warn")), **kw)

    @classmethod
    def from_rule_table(cls, rules: DataFrame, **kw) -> "Pipeline":
        """A spec from a rule table (``operators.suite``), one row per rule.

        The rule table is spec-sized (rules, not data), so it is ordered and
        brought to the driver once, like any configuration.  A table of several
        tables' rules (a ``table`` column) is refused: filter it first."""
        if "table" in rules.columns:
            tables = [r["table"] for r in rules.select("table").distinct().limit(2).collect()]
            if len(tables) > 1:
                raise SpecError([f"the rule table holds several tables' rules ({sorted(map(str, tables))} ...): filter it by table"])
        order = [c for c in ("stage_no", "ordinal", "rule_pos") if c in rules.columns]
        rows = [r.asDict(recursive=True) for r in rules.collect()]
        rows.sort(key=lambda r: tuple(r[c] for c in order))  # rules, not data: no distributed sort
        reg = kw.get("registry")
        return cls(PipelineSpec.from_rule_rows(rows, reg, kw.pop("on_unknown", "warn")), **kw)

    def compile(self, df: DataFrame, tables: Mapping[str, DataFrame] | None = None, *, map_form: str = "entries",
                on_recheck: str = "replace") -> CompiledPipeline:
        """Bind to ``df``; ``tables`` names the reference tables of
        ``check_in_table`` rules (otherwise looked up in the catalog)."""
        return CompiledPipeline(self.spec, df, self.registry, self.results_col, tables, map_form, on_recheck)

    def run(self, df: DataFrame, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Stages in order; returns the annotated DataFrame (lazy, no action)."""
        return self.compile(df, tables).annotated()

    __call__ = run  # df.transform(pipeline)

    def then(self, other: "Pipeline") -> "Pipeline":
        """The stages of both; each keeps its own rule types (names that both
        registries define differently are refused)."""
        registry = self.registry if self.registry is other.registry else self.registry.merged(other.registry)
        return Pipeline(self.spec.then(other.spec), registry=registry, results_col=self.results_col)

    def check_patterns(self, spark) -> list[str]:
        """Problems with the regex patterns, found by Spark's own (Java) regex
        engine on an inline table: no Spark job runs."""
        pats = [(r.id, r.kwargs()["pattern"]) for s in self.spec.stages if s.type == "dq"
                for r in s.rules if r.type == "check_regex"]
        return invalid_patterns(spark, pats)

    @property
    def rule_ids(self) -> list[str]:
        return self.spec.rule_ids()

    def __repr__(self) -> str:
        parts = ", ".join(f"{s.name}:{s.type}[{len(s.rules)}]" for s in self.spec.stages)
        return f"Pipeline({parts})"
