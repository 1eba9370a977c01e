"""Column expressions shared by the jobs."""

from spanloom.functions.ids import hex_id, ipv4_to_int, parse_hex_id, trace_id_string
from spanloom.functions.text import has_text, is_empty, split_on_spaces
from spanloom.functions.times import day_start, minute_start, to_seconds

__all__ = [
    "day_start", "has_text", "hex_id", "ipv4_to_int", "is_empty", "minute_start",
    "parse_hex_id", "split_on_spaces", "to_seconds", "trace_id_string",
]
