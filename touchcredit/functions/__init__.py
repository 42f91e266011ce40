"""Native column functions (keys, dialect-exact arithmetic, sort keys)."""

from touchcredit.functions.normalize import (  # noqa: F401
    asc_nulls_last,
    concat_skip_nulls,
    day_diff,
    email_key,
    email_lower,
    lower_trim,
    phone_digits,
    second_diff,
    time_chunk,
    typed_null,
)
