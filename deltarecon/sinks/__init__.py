from .counts import append_history, replace_current, replace_history_day, write_count_rows
from .delimited import to_delimited, write_delimited
from .tables import write_bucketed
