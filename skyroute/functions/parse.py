"""Column expressions that turn raw CSV strings into typed values.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a date is year, month and day in digits, the whole token.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hhmm_minutes(c) -> Column:
    """'hhmm' -> minutes after midnight (int), '2400' -> 0, anything else -> null.

    Hours are 0-23 and minutes 0-59, one or two digits each, no sign or spaces
    (hour: 2[0-3] | [0-1]d | d, then minute: [0-5]d | d, whole token), written
    as fixed-position character tests so no regular expression runs per row:
      2 digits: h = 1st, m = 2nd
      3 digits: h = first two if they form an hour (2[0-3] or [01]d), m = 3rd;
                else h = 1st and m = last two when the 2nd is 0-5
      4 digits: h = first two (an hour) and m = last two when the 3rd is 0-5
    """
    s = _col(c)
    n = F.length(s)
    digits = (F.translate(s, "0123456789", "") == F.lit("")) & n.between(2, 4)
    c1, c2, c3 = (F.substring(s, i, 1) for i in (1, 2, 3))
    two_digit_hour = (c1 < F.lit("2")) | ((c1 == F.lit("2")) & (c2 <= F.lit("3")))
    minute_tens_ok = lambda ch: ch <= F.lit("5")
    hh = F.substring(s, 1, 2).cast("int")
    h1 = c1.cast("int")
    mins = (F.when(n == 2, h1 * 60 + c2.cast("int"))
             .when((n == 3) & two_digit_hour, hh * 60 + c3.cast("int"))
             .when((n == 3) & minute_tens_ok(c2), h1 * 60 + F.substring(s, 2, 2).cast("int"))
             .when((n == 4) & two_digit_hour & minute_tens_ok(c3),
                   hh * 60 + F.substring(s, 3, 2).cast("int")))
    return F.when(s == F.lit("2400"), F.lit(0)).when(digits, mins).cast("int")


def lenient_double(c) -> Column:
    """Float field: unparsable or empty text -> null.

    Only decimal notation with an optional exponent and the words for not-a-number
    and infinity count; type suffixes and hexadecimal do not.
    """
    s = F.trim(_col(c))
    plain = F.translate(s, "0123456789+-.eE", "") == F.lit("")
    word = F.lower(F.ltrim(s, F.lit("+-"))).isin("nan", "inf", "infinity")
    return F.when(plain | word, _try_cast(F.nullif(s, F.lit("")), "double"))


def parse_long(c) -> Column:
    """Mandatory integer field (id, flight number); bad text -> null (rejected later)."""
    return _try_cast(F.trim(_col(c)), "bigint")


def parse_date(c) -> Column:
    """'yyyy-MM-dd' -> date; anything before or after it, or a part left out -> null (rejected later)."""
    s = F.trim(_col(c))
    return F.when(s.rlike(DATE_PATTERN), _try_cast(s, "date"))


def flag(c) -> Column:
    """0/1 flag -> boolean; archives write it as '0.00'/'1.00', filtered files as
    '0'/'1'; any non-zero number is true, unparsable text -> null."""
    return _try_cast(F.trim(_col(c)), "double") != F.lit(0.0)


def null_if_lone_quote(c) -> Column:
    """A cancellation code of a lone double quote means 'no code'."""
    return F.nullif(_col(c), F.lit('"'))


def _try_cast(c: Column, to: str) -> Column:
    return c.try_cast(to)
