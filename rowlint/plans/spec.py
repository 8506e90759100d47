"""Pipeline specs: load, validate (all problems at once), export.

A spec is an ordered list of stages; a stage is ``dq`` (checks, each under a
rule id) or ``cleanse`` (column rewrites).  Specs come from a dict, YAML text
or file, or from rows of a rule table (``operators.suite``).  Validation
reports every problem in one ``SpecError`` instead of failing on the first
missing key; unknown rule and stage types are skipped with a warning by
default (``on_unknown="error"`` makes them problems, ``"ignore"`` silences).
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import warnings
from decimal import Decimal
from dataclasses import dataclass
from typing import Any, Iterable, Mapping

from ..functions.registry import DEFAULT_REGISTRY, Registry, RuleDef

STAGE_KINDS = ("dq", "cleanse")
ON_UNKNOWN = ("warn", "error", "ignore")


class SpecError(ValueError):
    """A spec that cannot run; ``problems`` lists every reason found."""

    def __init__(self, problems: list[str]):
        self.problems = list(problems)
        super().__init__("invalid pipeline spec:\n  - " + "\n  - ".join(self.problems))


class SpecWarning(UserWarning):
    """A spec part that was skipped or will behave surprisingly."""


class _Pairs(tuple):
    """A frozen mapping: its sorted items."""


def _freeze(v: Any) -> Any:
    if isinstance(v, Mapping):
        return _Pairs(sorted((k, _freeze(x)) for k, x in v.items()))
    if isinstance(v, list):
        return tuple(_freeze(x) for x in v)
    return v


def _thaw(v: Any) -> Any:
    if isinstance(v, _Pairs):
        return {k: _thaw(x) for k, x in v}
    if isinstance(v, tuple):
        return [_thaw(x) for x in v]
    return v


@dataclass(frozen=True)
class Rule:
    type: str
    column: str
    id: str | None = None
    params: tuple[tuple[str, Any], ...] = ()

    def kwargs(self) -> dict[str, Any]:
        return {k: _thaw(v) for k, v in self.params}

    def to_dict(self) -> dict[str, Any]:
        d: dict[str, Any] = {}
        if self.id is not None:
            d["id"] = self.id
        d["type"] = self.type
        d["column"] = self.column
        d.update(self.kwargs())
        return d


@dataclass(frozen=True)
class Stage:
    name: str
    type: str
    rules: tuple[Rule, ...] = ()

    def to_dict(self) -> dict[str, Any]:
        return {"name": self.name, "type": self.type, "rules": [r.to_dict() for r in self.rules]}


@dataclass(frozen=True)
class PipelineSpec:
    stages: tuple[Stage, ...]
    warnings: tuple[str, ...] = ()

    # -- loading ---------------------------------------------------------
    @classmethod
    def from_dict(
        cls,
        data: Mapping[str, Any],
        registry: Registry | None = None,
        on_unknown: str = "warn",
    ) -> "PipelineSpec":
        return _Validator(registry or DEFAULT_REGISTRY, on_unknown).spec(data)

    @classmethod
    def from_yaml(cls, text: str, registry: Registry | None = None, on_unknown: str = "warn") -> "PipelineSpec":
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - PyYAML is a dependency
            raise ImportError("YAML specs need PyYAML; pass a dict instead") from e
        return cls.from_dict(yaml.safe_load(text), registry, on_unknown)

    @classmethod
    def load(cls, path: str, spark=None, registry: Registry | None = None, on_unknown: str = "warn") -> "PipelineSpec":
        """Read a YAML spec from a local path, or through Spark from any
        Hadoop file system (``s3a://``, ``hdfs://``...) when ``spark`` is given."""
        if spark is not None and not os.path.exists(path):
            rows = spark.read.text(path, wholetext=True).limit(2).collect()  # one small file
            if len(rows) != 1:
                raise SpecError([f"{'no spec' if not rows else 'more than one file'} found at {path}: a spec is one file"])
            return cls.from_yaml(rows[0][0], registry, on_unknown)
        with open(path, encoding="utf-8") as f:
            return cls.from_yaml(f.read(), registry, on_unknown)

    @classmethod
    def from_rule_rows(
        cls, rows: Iterable[Mapping[str, Any]], registry: Registry | None = None, on_unknown: str = "warn"
    ) -> "PipelineSpec":
        """Build from rule-table rows already in run order.

        Each row has ``stage_no``, ``stage_name``, ``stage_type``, ``type``,
        ``column``, optional ``id`` and parameter fields; NULL parameters are
        absent parameters.
        """
        stages: list[dict[str, Any]] = []
        current = None
        meta = {"stage_no", "stage_name", "stage_type", "table", "ordinal", "rule_pos", "type", "column", "id"}
        for row in rows:
            row = dict(row)
            key = row["stage_no"]
            if current is None or current[0] != key:
                current = (key, {"name": row["stage_name"], "type": row["stage_type"], "rules": []})
                stages.append(current[1])
            rule = {"type": row["type"], "column": row["column"]}
            if row.get("id") is not None:
                rule["id"] = row["id"]
            for k, v in row.items():
                if k not in meta and v is not None:
                    rule[k] = v
            current[1]["rules"].append(rule)
        return cls.from_dict({"stages": stages}, registry, on_unknown)

    # -- views -----------------------------------------------------------
    def to_dict(self) -> dict[str, Any]:
        return {"stages": [s.to_dict() for s in self.stages]}

    def to_yaml(self) -> str:
        import yaml

        return yaml.safe_dump(self.to_dict(), sort_keys=False)

    def rule_ids(self) -> list[str]:
        return [r.id for s in self.stages if s.type == "dq" for r in s.rules]

    def then(self, other: "PipelineSpec") -> "PipelineSpec":
        """The stages of ``self`` followed by those of ``other``."""
        merged = PipelineSpec(self.stages + other.stages, self.warnings + other.warnings)
        dupes = _duplicates(merged.rule_ids())
        if dupes:
            raise SpecError([f"duplicate rule id {d!r}" for d in dupes])
        return merged


def _duplicates(ids: list[str]) -> list[str]:
    seen, dupes = set(), []
    for i in ids:
        if i in seen and i not in dupes:
            dupes.append(i)
        seen.add(i)
    return dupes


def _scalar(v: Any) -> bool:
    return v is None or isinstance(v, (str, int, float, bool, _dt.date, _dt.datetime))


class _Validator:
    def __init__(self, registry: Registry, on_unknown: str):
        if on_unknown not in ON_UNKNOWN:
            raise ValueError(f"on_unknown must be one of {ON_UNKNOWN}")
        self.registry = registry
        self.on_unknown = on_unknown
        self.problems: list[str] = []
        self.notes: list[str] = []

    def unknown(self, msg: str) -> None:
        if self.on_unknown == "error":
            self.problems.append(msg)
        elif self.on_unknown == "warn":
            self.notes.append(msg + "; skipped")

    def spec(self, data: Any) -> PipelineSpec:
        if not isinstance(data, Mapping):
            raise SpecError([f"spec must be a mapping with 'stages', got {type(data).__name__}"])
        raw = data.get("stages")
        if not isinstance(raw, list):
            raise SpecError(["spec needs a 'stages' list"])
        stages = []
        for i, st in enumerate(raw, start=1):
            s = self.stage(i, st)
            if s is not None:
                stages.append(s)
        ids = [r.id for s in stages if s.type == "dq" for r in s.rules]
        for d in _duplicates(ids):
            self.problems.append(f"duplicate rule id {d!r}: each verdict needs its own id")
        if self.problems:
            raise SpecError(self.problems)
        for n in self.notes:
            warnings.warn(n, SpecWarning, stacklevel=4)
        return PipelineSpec(tuple(stages), tuple(self.notes))

    def stage(self, i: int, st: Any) -> Stage | None:
        where = f"stage {i}"
        if not isinstance(st, Mapping):
            self.problems.append(f"{where}: must be a mapping")
            return None
        name = st.get("name")
        if name is None or name == "":
            self.problems.append(f"{where}: missing 'name'")
            name = f"stage_{i}"
        where = f"stage {i} ({name})"
        kind = st.get("type")
        rules = st.get("rules")
        if kind is None:
            self.problems.append(f"{where}: missing 'type'")
        if rules is None:
            self.problems.append(f"{where}: missing 'rules'")
            rules = []
        elif not isinstance(rules, list):
            self.problems.append(f"{where}: 'rules' must be a list")
            rules = []
        if kind is None:
            return None
        if kind not in STAGE_KINDS:
            self.unknown(f"{where}: unknown stage type {kind!r}")
            return None
        out = []
        for j, r in enumerate(rules, start=1):
            rule = self.rule(i, j, str(name), kind, r)
            if rule is not None:
                out.append(rule)
        return Stage(str(name), kind, tuple(out))

    def rule(self, i: int, j: int, stage_name: str, kind: str, r: Any) -> Rule | None:
        where = f"stage {i} ({stage_name}) rule {j}"
        if not isinstance(r, Mapping):
            self.problems.append(f"{where}: must be a mapping")
            return None
        rtype = r.get("type")
        if not isinstance(rtype, str) or not rtype:
            self.problems.append(f"{where}: missing 'type'")
            return None
        where += f" ({rtype})"
        rdef = self.registry.lookup(kind, rtype)
        if rdef is None:
            self.unknown(f"{where}: unknown {kind} rule type {rtype!r}")
            return None
        column = r.get("column")
        if not isinstance(column, str) or not column.strip():
            self.problems.append(f"{where}: missing 'column'")
            column = ""
        rid = r.get("id")
        if rid is None or rid == "":
            rid = f"{i}_{j}_{rtype}_{column}" if kind == "dq" else None
        elif isinstance(rid, (Mapping, list)):
            self.problems.append(f"{where}: 'id' must be text")
            rid = None
        else:
            rid = str(rid).lower() if isinstance(rid, bool) else str(rid)
        params = self.params(where, rdef, {k: v for k, v in r.items() if k not in ("type", "column", "id")})
        return Rule(rtype, column, rid, tuple(sorted((k, _freeze(v)) for k, v in params.items())))

    def params(self, where: str, rdef: RuleDef, given: dict[str, Any]) -> dict[str, Any]:
        known = rdef.param_names()
        out: dict[str, Any] = {}
        for k in given:
            if k not in known:
                self.problems.append(f"{where}: unexpected parameter {k!r}")
        ok = True
        for p in rdef.params:
            names = [n for n in (p.name, *p.aliases) if n in given]
            if len(names) > 1:
                self.problems.append(f"{where}: {' and '.join(names)} both given")
                ok = False
                continue
            v = given[names[0]] if names else None
            if v is None:
                if p.required:
                    self.problems.append(f"{where}: missing parameter {p.name!r}")
                    ok = False
                continue
            v, err = _coerce(p.kind, v)
            if err:
                self.problems.append(f"{where}: parameter {p.name!r} {err}")
                ok = False
                continue
            if p.kind == "list":
                kinds = {type(x).__name__ for x in v if x is not None}
                if len(kinds) > 1:
                    self.notes.append(f"{where}: values mix types {sorted(kinds)}; quote YAML words like no/yes")
            out[p.name] = v
        if ok and rdef.check is not None:
            self.problems.extend(f"{where}: {m}" for m in rdef.check(out))
        return out


def _coerce(kind: str, v: Any) -> tuple[Any, str | None]:
    if kind == "any":
        return v, None
    if kind == "str":
        return (v, None) if isinstance(v, str) else (v, f"must be text, got {v!r}")
    if kind == "list":
        if not isinstance(v, (list, tuple)):
            return v, f"must be a list, got {v!r}"
        if not all(_scalar(x) for x in v):
            return v, "must list scalar values"
        return list(v), None
    if isinstance(v, bool):
        return v, f"must be a number, got {v!r}"
    if isinstance(v, str):  # editor exports keep non-numeric text as text
        try:
            v = float(v) if any(ch in v.lower() for ch in ".en") else int(v)
        except ValueError:
            return v, f"must be a number, got {v!r}"
    if isinstance(v, Decimal):
        v = int(v) if v == v.to_integral_value() else v
    if not isinstance(v, (int, float, Decimal)):
        return v, f"must be a number, got {v!r}"
    if isinstance(v, int) and abs(v) >= 10 ** 38:
        return v, "must be below 10^38"
    if kind == "int":
        if isinstance(v, (float, Decimal)):
            if v != v or v in (math.inf, -math.inf) or v != int(v):
                return v, f"must be a whole number, got {v!r}"
            v = int(v)
        return v, None
    if isinstance(v, float) and math.isnan(v):
        return v, "must not be NaN"
    return v, None
