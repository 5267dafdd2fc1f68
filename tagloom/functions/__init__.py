"""Column expressions: all JVM-side, none needs a Python worker."""

from tagloom.functions.digital import digital_code, digital_set_id, digital_state_id, server_key
from tagloom.functions.identity import event_id
from tagloom.functions.messages import event_json, message_attributes
from tagloom.functions.text import decode_state_name, normalise_tag, python_strip, safe_int, value_text
from tagloom.functions.timestamps import (
    floor_to_interval,
    in_range,
    iso_utc,
    iso_zulu,
    parse_timestamp,
    partition_date,
    source_local_text,
)

__all__ = [
    "decode_state_name", "digital_code", "digital_set_id", "digital_state_id", "event_id",
    "event_json", "floor_to_interval", "in_range", "iso_utc", "iso_zulu", "message_attributes",
    "normalise_tag", "parse_timestamp", "partition_date", "python_strip", "safe_int",
    "server_key", "source_local_text", "value_text",
]
