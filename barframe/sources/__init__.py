"""Readers, writers and the stand-in bar fixtures."""

from barframe.sources.fixtures import FIXTURES, bars_events, bars_lineitem, bars_supplier, expected_suppliers  # noqa: F401
from barframe.sources.readers import (  # noqa: F401
    checked_records,
    copy_from_path,
    file_report,
    normalize_landed,
    read_bars_json,
    read_bars_parquet,
    read_wrapped_json,
)
from barframe.sources.writers import (  # noqa: F401
    to_json_records,
    write_bucketed_bars,
    write_json_arrays,
    write_line_json,
    write_parquet,
    write_text,
    write_wrapped_json,
)
