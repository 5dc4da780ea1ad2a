"""Predicates of the validation rules.

Each returns a boolean Column that is never null, so that a filter on it and a
filter on its negation split a frame into two complementary parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rulestream.plans.spec import RuleKind, ValidationRule

# The accepted number formats.
#
# Integer: blanks, a sign, digits, blanks - any part may be missing, but not all of
# them. Possessive quantifiers keep long blank or digit runs linear.
INTEGER = r"^(?=[\s\d+-])\s*+[-+]?\d*+\s*+$"
INTEGER_STRICT = r"\A\s*+[-+]?\d++\s*+\z"
# Float: a decimal number somewhere in the text, its sign, leading digits and
# exponent all optional, which comes down to a point followed by a digit.
FLOAT = r"\.\d"
FLOAT_STRICT = r"\A[-+]?\d*+\.\d++(?:[eE][-+]?\d++)?\z"


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def is_mandatory(column: str | Column) -> Column:
    """Not null."""
    return (F.col(column) if isinstance(column, str) else column).isNotNull()


def is_integer(column: str | Column, strict: bool = False) -> Column:
    """Null or an integer. ``strict`` asks for at least one digit."""
    text = _text(column)
    return text.isNull() | text.rlike(INTEGER_STRICT if strict else INTEGER)


def is_float(column: str | Column, strict: bool = False) -> Column:
    """Null or a number with a decimal point. ``strict`` allows nothing around it."""
    text = _text(column)
    return text.isNull() | text.rlike(FLOAT_STRICT if strict else FLOAT)


def is_enum(column: str | Column, values: Sequence[str | None]) -> Column:
    """In the list. Null passes only if the list holds None."""
    text = _text(column)
    listed = [v for v in values if v is not None]
    found = F.coalesce(text.isin(listed), F.lit(False)) if listed else F.lit(False)
    return found | text.isNull() if None in values else found


def is_date(column: str | Column, pattern: str) -> Column:
    """Null or a date in the given pattern."""
    value = F.col(column) if isinstance(column, str) else column
    return value.isNull() | F.try_to_date(value, pattern).isNotNull()


def condition(rule: ValidationRule) -> Column:
    """The predicate of one rule."""
    match rule.kind:
        case RuleKind.MANDATORY:
            return is_mandatory(rule.column)
        case RuleKind.INTEGER:
            return is_integer(rule.column, rule.strict)
        case RuleKind.FLOAT:
            return is_float(rule.column, rule.strict)
        case RuleKind.ENUM:
            return is_enum(rule.column, rule.enum)
        case RuleKind.DATE:
            return is_date(rule.column, rule.date_format)
    raise ValueError(f"Unknown rule: {rule.kind}")
