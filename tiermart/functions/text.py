"""String normalisation with Unicode-aware semantics.

* ``strip`` removes every Unicode White_Space character at both ends
  (Spark's one-argument ``trim`` removes ASCII spaces only).
* ``title_case`` upper-cases the first character of every run of letters and
  digits and lower-cases the rest; any non-alphanumeric character starts a
  new word ("cr-v" -> "Cr-V", "o'brien" -> "O'Brien"). Spark's ``initcap``
  splits at spaces only, so it is not used.
* ``digits_only`` keeps Unicode decimal digits (Nd), not just ASCII 0-9.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space code points (Unicode PropList.txt).
UNICODE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A word boundary sits right after any character that is not alphanumeric in
# the Unicode sense (Alphabetic property, which also covers letter-like marks,
# or a Numeric category).
_WORD_START = r"(?<=[^\p{IsAlphabetic}\p{N}])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    return F.trim(_c(c), F.lit(UNICODE_WHITESPACE))


def title_case(c) -> Column:
    words = F.split(F.lower(_c(c)), _WORD_START)
    capitalised = F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2))))
    return F.array_join(capitalised, "")


def digits_only(c) -> Column:
    return F.regexp_replace(_c(c), r"[^\p{Nd}]", "")


def upper_strip(c) -> Column:
    return F.upper(strip(c))


def lower_strip(c) -> Column:
    return strip(F.lower(_c(c)))
