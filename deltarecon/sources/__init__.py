from .counts import read_count_rows, read_count_tree, read_history_by_day
from .fixed_width import parse_fixed_width, read_fixed_width
from .registry import parse_registry, read_registry
from .tables import catalog_resolver, mapping_resolver, parquet_resolver, scan_filtered
from .text import preview, read_lines
