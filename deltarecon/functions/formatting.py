"""Text renderings used at the sink / report edge.

Counts stay typed (bigint, NULL = not available) inside every plan; these
helpers turn them into the reference's text forms only when writing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text for an unavailable metric, the record delimiter of the
# reject / diff sinks and how NULL prints inside a delimited record.
NA_TEXT = "NA"
RECORD_DELIMITER = "\u0001"
NULL_TEXT = "null"

# Fixed value: job-time layout (calendar year, 24h clock).
JOB_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Markup of one report table row and cell.
HTML_ROW_OPEN = "<tr>"
HTML_ROW_CLOSE = "</tr>"
HTML_CELL_OPEN = "<td style='text-align:center';'color:DarkBlue';'background-color:white'>"
HTML_CELL_CLOSE = "</td>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_job_time(ts: Column | str) -> Column:
    """Render a timestamp as ``yyyy-MM-dd HH:mm:ss``.

    Uses the calendar year ``yyyy``; the week-based ``YYYY`` would print the
    wrong year in the last days of December (Spark 4 rejects it anyway).
    """
    return F.date_format(_col(ts), JOB_TIME_FORMAT)


def na_text(c: Column | str) -> Column:
    """Value as text, ``NA`` where it is NULL (metric not available)."""
    return F.coalesce(_col(c).cast("string"), F.lit(NA_TEXT))


def delimited_line(cols: Sequence[Column | str], sep: str = RECORD_DELIMITER, null_text: str = NULL_TEXT) -> Column:
    """Join every field into one line, NULL printed as ``null_text``.

    ``concat_ws`` alone would silently skip NULL fields and shift the columns,
    hence the ``coalesce`` per field. Delimiters inside values are not escaped.
    """
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit(null_text)) for c in cols])


def html_row(cols: Sequence[Column | str]) -> Column:
    """One ``<tr>`` of the count report with one styled ``<td>`` per field."""
    parts: list[Column] = [F.lit(HTML_ROW_OPEN)]
    for c in cols:
        parts += [F.lit(HTML_CELL_OPEN), _col(c).cast("string"), F.lit(HTML_CELL_CLOSE)]
    parts.append(F.lit(HTML_ROW_CLOSE))
    return F.concat(*parts)
