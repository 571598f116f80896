from stayframe.sources.io import (  # noqa: F401
    read_table, scan_typed, cohort_ids, item_dictionary, read_stage, write_stage,
    write_report, register_frame, require_columns, value_counts, conform,
)
