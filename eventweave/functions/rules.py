"""Ordered rewrite rules.

A rule list is applied in order, each rule on the previous rule's output
(state spellings, token stripping, hazard dictionaries).  Rules are data: a
list of ``Rule`` objects, or a DataFrame with ``rule_no, pattern, replacement,
literal`` columns for lists kept as tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import literal_pattern, literal_replacement


@dataclass(frozen=True)
class Rule:
    pattern: str
    replacement: str = ""
    literal: bool = False  # pattern and replacement are plain text
    first_only: bool = False  # replace the first match only
    whole_word: bool = False  # add word boundaries around the pattern

    def regex(self) -> str:
        p = literal_pattern(self.pattern) if self.literal else self.pattern
        if self.whole_word:
            p = f"\\b(?:{p})\\b"
        return p

    def repl(self) -> str:
        return literal_replacement(self.replacement) if self.literal else self.replacement


def apply_rules(col: Column, rules: list[Rule]) -> Column:
    """Fold ``rules`` over ``col``.

    Each rule is a ``regexp_replace`` with a literal pattern, so the pattern is
    compiled once per task and the whole chain stays in one codegen'd
    expression.  For long rule lists applied to a low-cardinality column, call
    the operator-level ``rewrite`` which folds over the distinct values only.
    """
    out = col
    for r in rules:
        if r.first_only:
            out = F.regexp_replace(out, f"(?s)^(.*?)(?:{r.regex()})", "$1" + r.repl())
        else:
            out = F.regexp_replace(out, r.regex(), r.repl())
    return out
