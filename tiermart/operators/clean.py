"""Declarative cleaning: string rules -> cast groups -> row filters.

A ``CleanSpec`` lists, per column, one string rule and then one or more
cast groups. Each group is one ``withColumns`` call, so a group sees only
the output of the previous group (never its own siblings), and filters
run after all casts and roundings: a premium of 0.004 first rounds to 0.00
and is then dropped. Everything is a narrow projection; the plan is
scan -> project -> filter with no shuffle. A title-case column keeps its
projection outside whole-stage codegen (see ``functions.text``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermart.functions.numeric import round_half_up
from tiermart.functions.text import digits_only, strip, title_case
from tiermart.operators.quality import validate

# String rule codes.
TITLE, UPPER, LOWER, STRIP, DIGITS = "T", "U", "L", "S", "D"

_RULES: dict[str, Callable[[Column], Column]] = {
    TITLE: lambda c: title_case(strip(c)),
    UPPER: lambda c: F.upper(strip(c)),
    LOWER: lambda c: strip(F.lower(c)),
    STRIP: strip,
    DIGITS: lambda c: strip(digits_only(c)),
}


@dataclass(frozen=True)
class Cast:
    """Strict cast (ANSI: a bad value raises) with optional HALF_UP rounding.

    With ``fmt`` (a strftime pattern) text is parsed instead: ``date`` or
    ``timestamp_ntz``; a value not matching the pattern raises.
    """

    dtype: str
    digits: int | None = None
    fmt: str | None = None

    def apply(self, c: Column) -> Column:
        if self.fmt is not None:
            from tiermart.operators.frames import to_date, to_datetime

            return to_date(c, self.fmt) if self.dtype == "date" else to_datetime(c, self.fmt)
        out = c.cast(self.dtype)
        return out if self.digits is None else round_half_up(out, self.digits)


@dataclass(frozen=True)
class CleanSpec:
    name: str
    required: tuple[str, ...]
    strings: dict[str, str] = field(default_factory=dict)
    cast_groups: tuple[dict[str, Cast], ...] = ()
    filters: tuple[Callable[[], Column], ...] = ()
    post: tuple[dict[str, Callable[[], Column]], ...] = ()


def apply_spec(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Every column that a rule names must be there; columns that no rule names go through as they are."""
    validate(df, spec.required)
    validate(df, [*spec.strings, *(c for group in spec.cast_groups for c in group)])
    if spec.strings:
        df = df.withColumns({c: _RULES[r](F.col(c)) for c, r in spec.strings.items()})
    for group in spec.cast_groups:
        df = df.withColumns({c: cast.apply(F.col(c)) for c, cast in group.items()})
    for predicate in spec.filters:
        df = df.where(predicate())
    for group in spec.post:
        df = df.withColumns({c: make() for c, make in group.items()})
    return df
