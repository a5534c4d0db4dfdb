"""Column rules used to standardise feed records and compare day stamps.

Every rule is a native Catalyst expression (``when`` / ``trim`` /
``regexp_replace`` / ``instr`` ...), so it stays inside whole-stage codegen
and needs no Python worker. Each takes and returns a ``Column``; string
arguments are treated as column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: the marker appended to non-blank identifiers.
ID_SUFFIX = "D"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_prefix(c: ColumnOrName) -> Column:
    """First ten characters of the value as text (``yyyy-MM-dd`` of a stamp).

    ``SUBSTR(c, 0, 10)`` in Spark SQL treats position 0 as 1, so this is the
    same day prefix; dates and timestamps are rendered as text first.
    """
    return F.substring(_col(c).cast("string"), 1, 10)


def suffix_key(c: ColumnOrName) -> Column:
    """Append the id suffix unless the trimmed value is blank.

    The untrimmed value gets the suffix (padded ids stay padded); a blank
    value becomes its trimmed (empty) form; NULL stays NULL.
    """
    c = _col(c)
    return F.when(F.trim(c) != "", F.concat(c, F.lit(ID_SUFFIX))).otherwise(F.trim(c))


def _blank_without_zeros(c: Column) -> Column:
    return F.length(F.trim(F.regexp_replace(c, "0", ""))) == 0


def suffix_nonzero(c: ColumnOrName) -> Column:
    """Append the suffix unless the value is blank or made of zeros only.

    Blank, all-zero and NULL values all become ``''``.
    """
    c = _col(c)
    keep = (F.trim(c) != "") & ~_blank_without_zeros(c)
    return F.when(keep, F.concat(c, F.lit(ID_SUFFIX))).otherwise(F.lit(""))


def zero_to_blank(c: ColumnOrName) -> Column:
    """``''`` for a value made of zeros (and spaces) only, else the trimmed value."""
    c = _col(c)
    return F.when(_blank_without_zeros(c), F.lit("")).otherwise(F.trim(c))


def strip_letters(c: ColumnOrName) -> Column:
    """Remove ASCII letters from a non-blank value; blank values are trimmed."""
    c = _col(c)
    return F.when(F.trim(c) != "", F.regexp_replace(c, "[A-Za-z]", "")).otherwise(F.trim(c))


def trim_keep_ws(c: ColumnOrName) -> Column:
    """Trim, unless trimming would leave nothing: whitespace-only stays as is."""
    c = _col(c)
    return F.when(F.length(F.trim(c)) != 0, F.trim(c)).otherwise(c)


def remove_first(field: ColumnOrName, search: ColumnOrName | None = None, *, literal: str | None = None) -> Column:
    """Drop the single character at the first position where ``search`` occurs.

    * ``search`` absent from ``field`` -> ``''`` (not ``field``);
    * present -> exactly one character is removed at that position, even when
      ``search`` is longer than one character (``"SC123456"`` / ``"123456"``
      gives ``"SC23456"``);
    * NULL in either argument -> NULL.

    Pass the search text as a column (``search``) or as a constant (``literal``).
    """
    f = _col(field)
    if literal is not None:
        s = F.lit(literal)
    elif search is not None:
        s = _col(search)
    else:
        raise ValueError("remove_first needs a search column or a literal")
    # SQL instr takes two columns (F.instr only a literal needle); 0 = absent.
    pos = F.call_function("instr", f, s)
    removed = F.concat(f.substr(F.lit(1), pos - 1), f.substr(pos + 1, F.length(f)))
    return F.when(pos == 0, F.lit("")).otherwise(removed)


def trim_text(c: ColumnOrName) -> Column:
    """``trim`` of the value rendered as text (the default rule for a column)."""
    return F.trim(_col(c).cast("string"))
