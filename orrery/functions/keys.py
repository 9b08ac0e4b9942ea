"""Entity keys as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.functions.cleaning import MISSING_KEYS, strip

#: The forms of designations.
PROVISIONAL = r"^((?:18|19|20)\d{2})\s+([A-HJ-Ya-hj-y][A-HJ-Za-hj-z]\d*)$"
SURVEY = r"^(\d{4})\s+([Pp]-[Ll]|[Tt]-[123])$"
NUMBER = r"^\s*([1-9]\d*)(?:\.0+)?\s*$"
FLOAT_NUMBER = r"^(\d+)\.0+$"
BRACKETED = r"^\(\s*(\d+)\s*\)"
NAMED_NUMBER = r"^(\d+)\s+(?:[A-Z][a-z]|[A-Za-z]{3,}$)"
NO_CYCLE = r"^(\d{4} [A-Z]{2})0$"
SHAPE = r"^(\d{4} [A-Z]{2}\d*|\d{4} (P-L|T-[123]))$"
#: What the rules leave as it is: a designation as it should be written, and one word of
#: ASCII letters and digits (which may mean "missing").
AS_IT_IS = r"^(?:(?:18|19|20)\d{2} [A-HJ-Y][A-HJ-Z](?:[1-9]\d*)?|[A-Za-z][A-Za-z0-9]*)\z"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _group(c: Column, pattern: str, k: int = 1) -> Column:
    """Group ``k`` of the match, NULL where there is none."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, k))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used.

    A lambda variable stands for the value, so the expression grows with the
    number of steps rather than with the product of their uses.
    """
    return F.get(F.transform(F.array(value), then), 0)


def _shaped(s: Column) -> Column:
    """A provisional or survey designation written out, else NULL."""

    def written(p: str) -> Column:
        text = F.concat_ws(" ", F.regexp_extract(s, p, 1), F.upper(F.regexp_extract(s, p, 2)))
        return F.regexp_replace(text, NO_CYCLE, "$1")

    return F.when(s.rlike(PROVISIONAL), written(PROVISIONAL)).when(s.rlike(SURVEY), written(SURVEY))


def _plain(s: Column) -> Column:
    """The number that a name follows, else the text."""
    return F.coalesce(_group(s, NAMED_NUMBER), F.regexp_replace(s, NO_CYCLE, "$1"))


def _finish(out: Column) -> Column:
    """Digits lose leading zeros; markers of "missing" become NULL."""
    bare = F.when(out.rlike(r"^0+$"), "0").when(out.rlike(r"^\d+$"), F.regexp_replace(out, "^0+", "")).otherwise(out)
    return F.when(~out.isin(MISSING_KEYS), bare)


def canonical(c: Column) -> Column:
    """The canonical form of a designation; NULL where it means missing.

    Most keys are plain numbers or their float renderings, designations as they should be
    written, or single words. They are told by two patterns, and only other keys go
    through the rules.
    """
    rest = lambda t: let(F.regexp_replace(t, FLOAT_NUMBER, "$1"), lambda s: F.coalesce(_shaped(s), _plain(s)))
    rules = lambda t: let(F.coalesce(_group(t, BRACKETED), rest(t)), _finish)
    text = c.cast("string")
    number = F.regexp_extract(text, NUMBER, 1)
    kept = F.when(~text.isin(MISSING_KEYS), text)
    return F.when(number != "", number).when(text.rlike(AS_IT_IS), kept).otherwise(let(strip(text), rules))


def number_or_text(c: Column) -> Column:
    """The number that a key writes, else its text: the canonical form of most keys, by
    one pattern."""
    return F.regexp_replace(c.cast("string"), NUMBER, "$1")


def matched_form(canon: Column) -> Column:
    """For matching only: a canonical key, upper-cased and stripped."""
    return strip(F.upper(canon))


def comparison_key(c: Column) -> Column:
    return matched_form(canonical(c))


def looks_like_designation(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(SHAPE), F.lit(False))


def unpack_number(c: Column) -> Column:
    """The number in a packed five-character form, else NULL."""

    def digit(k: int) -> Column:
        return (F.instr(F.lit(BASE62), F.substring(c, k, 1)) - 1).cast("long")

    plain = digit(1) * 10_000 + F.substring(c, 2, 4).try_cast("long")
    tilde = 620_000 + ((digit(2) * 62 + digit(3)) * 62 + digit(4)) * 62 + digit(5)
    return (
        F.when(c.rlike(r"^~[0-9A-Za-z]{4}$"), tilde)
        .when(c.rlike(r"^[0-9A-Za-z]\d{4}$"), plain)
        .cast("string")
    )


def in_parentheses(c: Column) -> Column:
    """The text of the closing parentheses, NULL if there is none."""
    return F.nullif(strip(F.regexp_extract(c, r"\(([^)]+)\)\s*$", 1)), F.lit(""))


def number_or_name(number: Column, name: Column) -> Column:
    """A key from a number column, written as an integer, else from the name."""
    return canonical(F.coalesce(number.try_cast("double").cast("bigint").cast("string"), strip(name)))


def name_unless_key(name: Column) -> Column:
    """A name that has the form of a designation is no name."""
    return F.when(~looks_like_designation(name), name)
