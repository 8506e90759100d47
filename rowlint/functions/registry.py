"""Rule registries: the extension point of the engine.

A *check* turns a column into a boolean ``Column``; a *cleanser* turns a
column into its cleaned replacement.  Both are plain functions over Spark
``Column`` expressions, so anything registered here stays inside Catalyst
and whole-stage codegen: no Python runs per row.

    from rowlint import register_check, Param

    @register_check("check_starts_with", params=[Param("prefix", "str")])
    def starts_with(c, dtype, prefix):
        return c.startswith(prefix)
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Callable, Iterable

from pyspark.sql import Column
from pyspark.sql.types import DataType

# Parameter kinds understood by spec validation.
KINDS = ("number", "int", "str", "list", "any")


@dataclass(frozen=True)
class Param:
    """One parameter of a rule type as it appears in a spec."""

    name: str
    kind: str = "any"
    required: bool = True
    aliases: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown parameter kind {self.kind!r}; use one of {KINDS}")


@dataclass(frozen=True)
class RuleDef:
    """A registered rule type.

    ``build(column, dtype, **params)`` returns a Column: a boolean predicate
    for checks, the replacement value for cleansers.  ``check`` may return
    extra problems about a parameter set (e.g. "give at least one bound").
    ``result_type`` is the type a cleanser produces, ``None`` if it keeps the
    input type.
    """

    name: str
    kind: str  # "dq" or "cleanse"
    build: Callable[..., Column]
    params: tuple[Param, ...] = ()
    check: Callable[[dict[str, Any]], list[str]] | None = None
    result_type: DataType | None = None
    # a check that needs more than the row itself: ``attach(binding)`` returns the
    # rows with what it joins in, and the predicate (see ``plans.attach``)
    attach: Callable[..., Any] | None = None

    def param_names(self) -> set[str]:
        names = set()
        for p in self.params:
            names.add(p.name)
            names.update(p.aliases)
        return names


@dataclass
class Registry:
    """Rule types by name, one table per stage kind."""

    checks: dict[str, RuleDef] = field(default_factory=dict)
    cleansers: dict[str, RuleDef] = field(default_factory=dict)

    def copy(self) -> "Registry":
        return Registry(dict(self.checks), dict(self.cleansers))

    def merged(self, other: "Registry") -> "Registry":
        """Both registries' rule types; a name with two definitions is an error."""
        out = self.copy()
        for kind in ("dq", "cleanse"):
            for name, rule in other.table(kind).items():
                if out.table(kind).setdefault(name, rule) is not rule:
                    raise ValueError(f"both registries define the {kind} rule type {name!r}, differently")
        return out

    def table(self, kind: str) -> dict[str, RuleDef]:
        if kind == "dq":
            return self.checks
        if kind == "cleanse":
            return self.cleansers
        raise ValueError(f"no rules for stage kind {kind!r}")

    def lookup(self, kind: str, name: str) -> RuleDef | None:
        return self.table(kind).get(name)

    def add(self, rule: RuleDef) -> RuleDef:
        self.table(rule.kind)[rule.name] = rule
        return rule


DEFAULT_REGISTRY = Registry()


def _params(params: Iterable[Param | str] | None) -> tuple[Param, ...]:
    out = []
    for p in params or ():
        out.append(Param(p) if isinstance(p, str) else p)
    return tuple(out)


def register_check(
    name: str,
    params: Iterable[Param | str] | None = None,
    check: Callable[[dict[str, Any]], list[str]] | None = None,
    registry: Registry | None = None,
):
    """Decorator: register ``fn(column, dtype, **params) -> boolean Column``."""

    def deco(fn: Callable[..., Column]) -> Callable[..., Column]:
        (registry or DEFAULT_REGISTRY).add(RuleDef(name, "dq", fn, _params(params), check))
        return fn

    return deco


def register_cleanser(
    name: str,
    params: Iterable[Param | str] | None = None,
    result_type: DataType | None = None,
    check: Callable[[dict[str, Any]], list[str]] | None = None,
    registry: Registry | None = None,
):
    """Decorator: register ``fn(column, dtype, **params) -> Column``."""

    def deco(fn: Callable[..., Column]) -> Callable[..., Column]:
        (registry or DEFAULT_REGISTRY).add(
            RuleDef(name, "cleanse", fn, _params(params), check, result_type)
        )
        return fn

    return deco
