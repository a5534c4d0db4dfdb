from .history import append_new_counts, count_file_stream, read_history
