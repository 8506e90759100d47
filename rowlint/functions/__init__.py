"""Rule functions: checks (boolean Columns) and cleansers (replacement Columns)."""

from . import checks, cleansers  # noqa: F401  (registers the built-ins)
from .checks import RuleTypeError
from .registry import DEFAULT_REGISTRY, Param, Registry, RuleDef, register_check, register_cleanser

__all__ = [
    "DEFAULT_REGISTRY",
    "Param",
    "Registry",
    "RuleDef",
    "RuleTypeError",
    "register_check",
    "register_cleanser",
]
