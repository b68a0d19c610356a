"""Writers: TSV / key–list text, versioned tables with an atomic current pointer."""

from marquee.sinks.files import read_current, write_key_lists, write_tsv, write_version, write_window_log
from marquee.sinks.tables import create_table

__all__ = ["create_table", "read_current", "write_key_lists", "write_tsv", "write_version", "write_window_log"]
