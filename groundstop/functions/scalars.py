"""Column expressions built only from Spark's built-in functions.

All of them stay inside whole-stage codegen: no Python UDF anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_from_parts(year: ColumnOrName, month: ColumnOrName, day: ColumnOrName) -> Column:
    """Date from three numeric parts (``2008.0, 1.0, 3.0`` -> 2008-01-03).

    ``make_date`` on integer parts; a ``yyyy.0-MM.0-dd.0`` text pattern
    fails on one-digit months with Spark 4's date parser.
    """
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), _c(day).cast("int"))


def number_text(c: ColumnOrName) -> Column:
    """HHMM time or flight number held as a double -> text without decimals.

    ``1530.0`` -> ``"1530"``.  Casting the double to text directly would
    give ``"1530.0"``, which breaks the union with the modern layout and
    every hour derived from it.
    """
    return _c(c).cast("long").cast("string")


def hour_of_departure(hhmm: ColumnOrName) -> Column:
    """Hour (0-24) of an HHMM time given as text or number: ``floor(t / 100)``."""
    return F.floor(_c(hhmm).cast("int") / F.lit(100)).cast("int")


def hour_padded_ref(hhmm: ColumnOrName) -> Column:
    """The pad-one-zero-then-take-two form kept for comparison.

    Pads a single ``0`` unless the text has four characters, then takes the
    first two characters: right for 3- and 4-digit times, wrong for times
    of one or two digits (``"45"`` -> 4, ``"5"`` -> 5).
    """
    t = _c(hhmm)
    padded = F.when(F.length(t) == 4, t).otherwise(F.concat(F.lit("0"), t))
    return F.substring(padded, 1, 2).cast("int")


def hour_text(hhmm: ColumnOrName) -> Column:
    """Two-digit hour text: ``left(lpad(t, 4, '0'), 2)`` on integer text."""
    return F.left(F.lpad(_c(hhmm).cast("int").cast("string"), 4, "0"), F.lit(2))


def iso_week(date: ColumnOrName) -> Column:
    """ISO-8601 week number, 1-53 (2008-12-29 is week 1 of 2009)."""
    return F.weekofyear(_c(date)).cast("int")


def route_key(origin: ColumnOrName, dest: ColumnOrName, sep: str = "<>") -> Column:
    """Direction-free route label ``A<>B`` with A <= B.

    Replaces a sum of two 32-bit hashes, which can collide and overflows
    under ANSI arithmetic, and a label picked by ``first()``, which depends
    on row order.
    """
    o, d = _c(origin), _c(dest)
    # least and greatest skip nulls; a route with an unknown end has no label.
    return F.when(o.isNotNull() & d.isNotNull(), F.concat(F.least(o, d), F.lit(sep), F.greatest(o, d)))


def directed_route(origin: ColumnOrName, dest: ColumnOrName) -> Column:
    return F.concat(_c(origin), _c(dest))


def flight_id(*parts: ColumnOrName, sep: str = "*") -> Column:
    """Natural flight key joined with ``*`` (nulls are skipped, as concat_ws does)."""
    return F.concat_ws(sep, *[_c(p).cast("string") for p in parts])


def blank_to_null(c: ColumnOrName) -> Column:
    """A value that is exactly one whitespace character becomes null."""
    v = _c(c)
    # The pattern matches three characters at most (``$`` also stands before a final line end); longer texts need no matcher.
    return F.when((F.length(v) <= 3) & v.rlike(r"^\s$"), F.lit(None).cast("string")).otherwise(v)


def flag_text(flag: ColumnOrName) -> Column:
    """0/1 flag (double) -> ``"0"`` / ``"1"`` (not ``"1.0"``)."""
    return _c(flag).cast("int").cast("string")


def yes_no(flag: ColumnOrName) -> Column:
    return F.when(_c(flag) == 1, F.lit("YES")).otherwise(F.lit("NO"))


def epoch_ms_to_timestamp(ms: ColumnOrName) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ, independent of the session time zone."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def rate_percent(part: ColumnOrName, total: ColumnOrName) -> Column:
    """``part / total * 100`` as a double."""
    return _c(part).cast("double") / _c(total).cast("double") * F.lit(100.0)
