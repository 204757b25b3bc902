"""Column-level functions (no Python UDFs)."""

from recordlink.functions.expr import (  # noqa: F401
    truthy, truthy_of, strip, digits, clean_key, valid_key, valid_zip, format_zip,
    valid_phone, format_phone, valid_email, first_truthy, stripped_key, str_len,
    percentage, safe_int, safe_float, clamp, qcol, as_string, blank_to_null,
)
from recordlink.functions.text import extract, find_all  # noqa: F401
from recordlink.functions.dates import (  # noqa: F401
    parse_datetime, valid_date, format_datetime, timestamp_to_datetime, datetime_to_timestamp,
)
