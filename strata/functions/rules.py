"""Range rules: load them on the driver and compile them to Column predicates.

Rules look like ``{"numeric_ranges": {field: {"min": lo, "max": hi}}}``. A
value breaks a rule when it is below ``min`` or above ``max``; the bounds
themselves are valid, NULL never breaks a rule, NaN breaks ``max`` (Spark
orders NaN above every number), and a missing bound disables that side.
"""

from __future__ import annotations

import logging
import numbers
import os
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

DEFAULT_RULES_PATH = os.path.join(os.path.dirname(os.path.dirname(__file__)), "config", "quality_rules.yaml")


def load_rules(path: str | os.PathLike | None = None, *, strict: bool = False, fields: Iterable[str] | None = None) -> dict:
    """Read a rules YAML file. A missing file gives ``{}`` with a warning
    (or raises when ``strict``). Bounds are checked with :func:`check_rules`,
    and with ``fields`` the names of the rules too: a misspelt rule would
    otherwise be skipped as one on an absent field."""
    import yaml

    path = os.fspath(path) if path is not None else DEFAULT_RULES_PATH
    if not os.path.exists(path):
        if strict:
            raise FileNotFoundError(path)
        log.warning("quality rules file not found: %s", path)
        return {}
    with open(path, encoding="utf-8") as fh:
        rules = yaml.safe_load(fh) or {}
    check_rules(rules, fields)
    return rules


def _ranges(rules: Mapping | None) -> Mapping:
    return (rules or {}).get("numeric_ranges", {}) or {}


def check_rules(rules: Mapping, fields: Iterable[str] | None = None) -> None:
    """Raise ``ValueError`` unless every bound is a real number, ``min <= max``
    and (when ``fields`` is given) every rule names a known field."""
    known = set(fields) if fields is not None else None
    for name, spec in _ranges(rules).items():
        spec = spec or {}
        for side in ("min", "max"):
            bound = spec.get(side)
            if bound is None:
                continue
            if isinstance(bound, bool) or not isinstance(bound, numbers.Real):
                raise ValueError(f"rule {name}.{side} must be numeric, got {bound!r}")
        lo, hi = spec.get("min"), spec.get("max")
        if lo is not None and hi is not None and lo > hi:
            raise ValueError(f"rule {name}: min {lo} > max {hi}")
        if known is not None and name not in known:
            raise ValueError(f"rule {name} names no field of the schema")


def range_predicate(column: str | Column, lo=None, hi=None) -> Column:
    """True where the value is outside ``[lo, hi]``; NULL for a NULL value."""
    c = F.col(column) if isinstance(column, str) else column
    parts = []
    if lo is not None:
        parts.append(c < F.lit(lo))
    if hi is not None:
        parts.append(c > F.lit(hi))
    if not parts:
        return F.lit(False)
    pred = parts[0]
    for p in parts[1:]:
        pred = pred | p
    return pred


def rule_predicates(rules: Mapping | None, columns: Iterable[str]) -> dict[str, Column]:
    """``{field: violation predicate}`` for the rules whose field is present."""
    present = set(columns)
    out: dict[str, Column] = {}
    for name, spec in _ranges(rules).items():
        if name in present:
            spec = spec or {}
            out[name] = range_predicate(name, spec.get("min"), spec.get("max"))
    return out


def any_violation(predicates: Mapping[str, Column]) -> Column:
    """True when any rule is broken; NULL (treated as false by ``filter``)
    when no rule is broken but some value is NULL. Kept a plain OR of
    comparisons so Spark pushes it into the Parquet scan; wrap it in
    ``coalesce(..., false)`` before negating."""
    if not predicates:
        return F.lit(False)
    preds = list(predicates.values())
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def violated_rules(predicates: Mapping[str, Column]) -> Column:
    """Array of the names of the broken rules, in rule order."""
    if not predicates:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in predicates.items()]))
