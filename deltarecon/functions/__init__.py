"""Native column rules (``rules``) and text renderings (``formatting``)."""

from .formatting import delimited_line, format_job_time, html_row, na_text
from .rules import (
    day_prefix,
    remove_first,
    strip_letters,
    suffix_key,
    suffix_nonzero,
    trim_keep_ws,
    trim_text,
    zero_to_blank,
)
