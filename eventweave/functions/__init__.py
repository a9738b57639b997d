"""Column-level helpers: pure expressions that stay inside whole-stage codegen."""

from .columns import (
    compose_date,
    date_part,
    is_blank,
    literal_pattern,
    literal_replacement,
    pad_counter,
    regex_trim,
    remove_first,
    replace_first,
)
from .rules import Rule, apply_rules

__all__ = [
    "compose_date",
    "date_part",
    "is_blank",
    "literal_pattern",
    "literal_replacement",
    "pad_counter",
    "regex_trim",
    "remove_first",
    "replace_first",
    "Rule",
    "apply_rules",
]
