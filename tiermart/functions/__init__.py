"""Column -> Column building blocks (all built-in Spark expressions)."""

from tiermart.functions.numeric import (  # noqa: F401
    MONEY,
    div_half_up,
    mean_half_up,
    merge_special,
    money,
    n_unique,
    pct_half_up,
    pct_special,
    round_half_up,
    special,
    sum0,
    sum_exact,
    sum_money,
    total_or_nan,
    with_special,
)
from tiermart.functions.text import digits_only, lower_strip, strip, title_case, upper_strip  # noqa: F401
