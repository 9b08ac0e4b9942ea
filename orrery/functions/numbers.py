"""Doubles as text that reads back as the same double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Significant digits that tell all doubles apart.
DIGITS = 17
#: Decimal exponents from and below which a number is written without one.
PLAIN_FROM, PLAIN_BELOW = -4, 16


def number_text(c: Column) -> Column:
    """The shortest decimal text that reads back as ``c``.

    Plain from 1e-4 up to below 1e16, with a digit after the point (``0.5``, ``10.0``);
    else with an exponent of at least two digits and its sign (``1e-07``, ``2.5e+16``).
    NULL stays NULL; what is not finite is ``NaN``, ``Infinity`` or ``-Infinity``.
    """
    tries = [F.format_string(f"%.{k}e", F.abs(c)) for k in range(DIGITS)]
    shortest = F.coalesce(*[F.when(t.try_cast("double") == F.abs(c), t) for t in tries])
    parts = F.split(shortest, "e")
    digits, e = F.regexp_replace(parts[0], r"\.", ""), parts[1].cast("int")
    n = F.length(digits)
    tail = F.substring(digits, F.lit(2), n)
    whole = F.concat(digits, F.repeat(F.lit("0"), e - n + 1), F.lit(".0"))
    split = F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, n))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    power = F.concat(F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
    far = F.concat(F.substring(digits, 1, 1), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)), F.lit("e"), power)
    plain = (e >= PLAIN_FROM) & (e < PLAIN_BELOW)
    text = F.when(~plain, far).when(e < 0, small).when(e >= n - 1, whole).otherwise(split)
    sign = F.when(c.cast("string").startswith("-"), "-").otherwise("")  # of zero, too
    odd = F.when(F.isnan(c), "NaN").when(c == float("inf"), "Infinity").when(c == float("-inf"), "-Infinity")
    return F.when(c.isNotNull(), F.coalesce(odd, F.concat(sign, F.when(c == 0, "0.0").otherwise(text))))
