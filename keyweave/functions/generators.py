"""Value generators: every generated cell is a pure function of its base value.

No random numbers and no ids that depend on partitioning, so the same seed gives the same row
whatever the number of tasks, and a lost executor recomputes the same values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_TEXT = "yyyyMMdd"

# Small vocabularies for free-form text.
FIRST_NAMES = ["Ada", "Bela", "Chidi", "Dora", "Emil", "Farah", "Goran", "Hana", "Ines", "Jonas", "Kira", "Luis"]
LAST_NAMES = ["Abara", "Berg", "Castro", "Dietz", "Eriksen", "Fontaine", "Gupta", "Horvat", "Ito", "Jansen", "Kowal"]
MAIL_DOMAINS = ["example.com", "example.net", "example.org"]
STREETS = ["Birch Lane", "Canal Street", "Dock Road", "Elm Court", "Forge Way", "Garden Row", "Hill Street"]
TOWNS = ["Arden", "Brookfield", "Camden", "Dunmore", "Eastvale", "Fairport", "Glenwood", "Harlow"]
WORDS = ["anchor", "bridge", "cobalt", "dawn", "ember", "fjord", "grove", "harbor", "island", "juniper", "kernel"]


def range_size(min_value: int, max_value: int, step: int = 1) -> int:
    """Number of values in the closed range."""
    if step < 1:
        raise ValueError(f"step must be at least 1, got {step}")
    if max_value < min_value:
        raise ValueError(f"maxVal {max_value} is below minVal {min_value}")
    return (max_value - min_value) // step + 1


def range_position(base: Column, min_value: int, max_value: int, step: int = 1) -> Column:
    """Zero-based position of ``base`` in the range, wrapping around."""
    return F.pmod(base.cast("bigint"), F.lit(range_size(min_value, max_value, step)).cast("bigint"))


def range_at(position: Column, min_value: int, step: int = 1) -> Column:
    """Range value at a position."""
    return F.lit(min_value).cast("bigint") + position * F.lit(step).cast("bigint")


def ranged(base: Column, min_value: int, max_value: int, step: int = 1) -> Column:
    """Integer of the closed range picked by ``base``."""
    return range_at(range_position(base, min_value, max_value, step), min_value, step)


def prefixed(value: Column, prefix: str | None) -> Column:
    """Text of ``value`` behind ``prefix``; unchanged without one."""
    return value if prefix is None else F.concat(F.lit(str(prefix)), value.cast("string"))


def hash_number(base: Column, part: int = 0) -> Column:
    """Non-negative 32-bit number number ``part`` (0 to 3) from the md5 of the text of ``base``."""
    digits = F.substring(F.md5(base.cast("string").cast("binary")), 1 + 8 * part, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def pick_position(base: Column, size: int, part: int = 0) -> Column:
    """Position in a list of ``size`` options, steady for a given base value."""
    return F.pmod(hash_number(base, part), F.lit(size).cast("bigint"))


def option_at(position: Column, options: list) -> Column:
    """Option at a zero-based position."""
    if not options:
        raise ValueError("the option list is empty")
    return F.element_at(F.array(*[F.lit(str(o)) for o in options]), (position + 1).cast("int"))


def first_equal_option(position: Column, options: list) -> Column:
    """Position of the first option equal to the one at ``position``."""
    texts = [str(o) for o in options]
    if len(set(texts)) == len(texts):
        return position
    return F.element_at(F.array(*[F.lit(texts.index(t)).cast("bigint") for t in texts]), (position + 1).cast("int"))


def pick(base: Column, options: list, part: int = 0) -> Column:
    """One of ``options``, steady for a given base value."""
    return option_at(pick_position(base, len(options), part), options)


def _name(base: Column) -> Column:
    return F.concat_ws(" ", pick(base, FIRST_NAMES, 0), pick(base, LAST_NAMES, 1))


def _email(base: Column) -> Column:
    user = F.lower(F.concat_ws(".", pick(base, FIRST_NAMES, 0), pick(base, LAST_NAMES, 1)))
    return F.concat(user, F.pmod(hash_number(base, 3), F.lit(1000)).cast("string"), F.lit("@"),
                    pick(base, MAIL_DOMAINS, 2))


def _address(base: Column) -> Column:
    number = (F.pmod(hash_number(base, 3), F.lit(200)) + 1).cast("string")
    return F.concat(number, F.lit(" "), pick(base, STREETS, 0), F.lit(", "), pick(base, TOWNS, 1))


def _word(base: Column) -> Column:
    return pick(base, WORDS, 0)


FAKE_TEXT = {"name": _name, "email": _email, "address": _address, "word": _word}


def fake_text(provider: str, base: Column, salt: str = "") -> Column:
    """Life-like text of a provider (name, email, address, word). Not meant for join keys."""
    if provider not in FAKE_TEXT:
        raise ValueError(f"unknown text provider {provider!r}; known: {sorted(FAKE_TEXT)}")
    return FAKE_TEXT[provider](F.concat_ws(":", F.lit(salt), base.cast("string")))


def parse_day(text) -> dt.date:
    """Day written as yyyyMMdd or yyyy-MM-dd (or a date object, as a YAML reader gives it)."""
    if isinstance(text, dt.date):
        return text
    return dt.datetime.strptime(str(text).replace("-", ""), "%Y%m%d").date()


def day_count(first, last) -> int:
    """Days in the closed range."""
    days = (parse_day(last) - parse_day(first)).days + 1
    if days < 1:
        raise ValueError(f"date range ends before it starts: {first} .. {last}")
    return days


def day_at(position: Column, first) -> Column:
    """Day text at a zero-based position after ``first``."""
    return F.date_format(F.date_add(F.lit(parse_day(first)), position.cast("int")), DAY_TEXT)


def as_timestamp(as_of) -> Column:
    """The moment a job counts from: now when ``as_of`` is None, else the given time. A text is taken as it reads, without a time
    zone, so that results are the same in every session zone."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")


def days_from(moment: Column, days: int) -> Column:
    """Day text ``days`` after a moment."""
    return F.date_format(F.date_add(moment, int(days)), DAY_TEXT)


def days_after_text(day_text: Column, days: int) -> Column:
    """Day text ``days`` after another day text."""
    return F.date_format(F.date_add(F.to_date(day_text, DAY_TEXT), int(days)), DAY_TEXT)


def constant_day(text) -> Column:
    """A fixed day as day text."""
    return F.lit(parse_day(text).strftime("%Y%m%d"))
