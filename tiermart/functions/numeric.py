"""Exact numeric semantics for money, rounding and ratios.

Design decision: money is aggregated in DECIMAL, never in floating point.
A double sum depends on the order of additions, i.e. on how the data is
partitioned across executors; a decimal sum does not. Rounding is HALF_UP
(ties away from zero) on the exact decimal value, and every
"aggregate then round" and "ratio then round" step is computed with integer
arithmetic on exact operands, so the result is the same on 1 or 1000
executors and in any engine that follows the same rule.

Null/zero rules kept from the reference semantics:
* a sum over no values is 0 (``sum0`` / ``sum_money``);
* a mean over no values is null;
* x / 0 is NaN when x == 0, otherwise +/-infinity (IEEE division);
* ``n_unique`` counts null as one distinct value;
* NaN and infinities are values, not gaps. DECIMAL has none, so beside the exact sum of the finite values an aggregate
  carries which others it met (``special``: bits for NaN, +inf, -inf). Both merge: partial sums add, bits are or-ed,
  in any order and however often, so a pre-aggregate holds all that its rows would say. At the end
  (``with_special``) the result is IEEE's: inf with finite values is inf, inf with -inf is NaN, and ratios of
  such totals divide as doubles do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Money carries up to 6 decimals exactly (cents and sub-cent amounts).
MONEY = DecimalType(24, 6)
# Working type for exact ratio arithmetic on aggregated values.
EXACT = DecimalType(38, 6)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


NAN, PLUS_INF, MINUS_INF = 1, 2, 4  # bits of ``special``
_NAN, _INF = float("nan"), float("inf")


def _finite(c) -> Column:
    """False for NaN (greater than any number) and infinities; null for null."""
    return F.abs(_c(c).cast("double")) < _INF


def special_of(c) -> Column:
    """Row-level bit of a value that DECIMAL has no form for; 0 for finite values and null."""
    col = _c(c).cast("double")
    return (F.when(_finite(c), F.lit(0)).when(F.isnan(col), F.lit(NAN)).when(col > 0, F.lit(PLUS_INF))
            .when(col < 0, F.lit(MINUS_INF)).otherwise(F.lit(0)))


def special(c) -> Column:
    """Aggregate: which values without a DECIMAL form the group holds (0: none, also over an empty group)."""
    return merge_special(special_of(c))


def merge_special(c) -> Column:
    """Aggregate of bits that were aggregated before; missing ones count as none."""
    return F.coalesce(F.bit_or(_c(c)), F.lit(0))


def _bits(c) -> Column:
    return F.coalesce(_c(c), F.lit(0))


def with_special(bits, value) -> Column:
    """``value`` (the exact sum of the finite values) as double, or what the special values make of it."""
    b = _bits(bits)
    return (F.when((b.bitwiseAND(NAN) != 0) | (b.bitwiseAND(PLUS_INF | MINUS_INF) == PLUS_INF | MINUS_INF), F.lit(_NAN))
            .when(b.bitwiseAND(PLUS_INF) != 0, F.lit(_INF)).when(b.bitwiseAND(MINUS_INF) != 0, F.lit(-_INF))
            .otherwise(_c(value).cast("double")))


def ieee_div(n, d) -> Column:
    """n / d of doubles as IEEE has it, but that zero has no sign (under ANSI, ``/`` raises at 0)."""
    n, d = _c(n).cast("double"), _c(d).cast("double")
    by_zero = F.when(F.isnan(n) | (n == 0), F.lit(_NAN)).when(n > 0, F.lit(_INF)).otherwise(F.lit(-_INF))
    return F.when(d == 0, by_zero).otherwise(n / d + F.lit(0.0))


def pct_special(part_bits, part, whole_bits, whole, digits: int = 2) -> Column:
    """round(part / whole * 100, digits): exactly where both totals are finite, else as doubles divide."""
    ratio = ieee_div(with_special(part_bits, part), with_special(whole_bits, whole)) * 100
    return F.when(_bits(part_bits).bitwiseOR(_bits(whole_bits)) == 0, pct_half_up(part, whole, digits)).otherwise(
        F.round(ratio, digits))


def money(c) -> Column:
    """Exact form of a money column; NaN and infinities have none and become null (see ``special``)."""
    return F.when(_finite(c), _c(c).cast(MONEY))


def round_half_up(c, digits: int) -> Column:
    """Row-level rounding of a double: HALF_UP on its shortest decimal form."""
    return F.round(_c(c), digits)


def sum0(c) -> Column:
    """Sum that yields 0 (not null) over an empty or all-null group."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def sum_money(c) -> Column:
    """Exact decimal sum of a money column; 0 over an empty group."""
    return F.coalesce(F.sum(money(c)), F.lit(0).cast(MONEY))


def total_or_nan(c, digits: int = 2) -> Column:
    """Rounded sum of a money column as double: exact over finite values, IEEE's beyond; 0 if it is empty."""
    return with_special(special(c), F.round(sum_money(c), digits))


def sum_exact(c) -> Column:
    """Sum of an already-exact (decimal) expression, e.g. a weighted money
    value; keeps the expression's own precision; 0 over an empty group."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def div_half_up(num, den, digits: int) -> Column:
    """round(num / den, digits) HALF_UP, computed exactly; returns double.

    ``num`` and ``den`` must be exact (decimal or integral) columns.
    """
    n = _c(num).cast(EXACT) * F.lit(10**digits)
    d = _c(den).cast(EXACT)
    q = F.call_function("div", F.abs(n) * F.lit(2) + F.abs(d), F.abs(d) * F.lit(2))
    # Sign applied in integers, so a negative value rounding to 0 is 0.0, never -0.0.
    signed = F.signum(n).cast("long") * F.signum(d).cast("long") * q
    value = signed.cast("double") / F.lit(float(10**digits))
    return (
        F.when(d == 0, F.when(n == 0, F.lit(float("nan"))).when(n > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
        .otherwise(value)
    )


def pct_half_up(part, whole, digits: int = 2) -> Column:
    """round(part / whole * 100, digits) exactly."""
    return div_half_up(_c(part).cast(EXACT) * F.lit(100), whole, digits)


def mean_half_up(c, digits: int) -> Column:
    """round(mean(c), digits) exactly over non-null values; null when none; NaN and infinities go by ``with_special``."""
    col = _c(c)
    count = F.count(col)
    return F.when(count == 0, F.lit(None).cast("double")).otherwise(
        with_special(special(col), div_half_up(sum_money(col), count, digits)))


def n_unique(c) -> Column:
    """Distinct count where null counts as one more value."""
    col = _c(c)
    return F.count_distinct(col) + F.coalesce(F.max(col.isNull().cast("int")), F.lit(0))
