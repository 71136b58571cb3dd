"""Column-level building blocks (no actions, no I/O beyond reading config)."""

from strata.functions.rules import (  # noqa: F401
    DEFAULT_RULES_PATH,
    any_violation,
    check_rules,
    load_rules,
    range_predicate,
    rule_predicates,
    violated_rules,
)
from strata.functions.timefmt import event_time, iso_millis  # noqa: F401
