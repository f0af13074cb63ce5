"""Column-level helpers; all built-in Spark expressions (JVM side, codegen)."""

from .scalars import (  # noqa: F401
    binarize, json_field, l1_distance, not_sentinel, parse_date, strftime_to_java,
    strip_ws, to_number, typed_null,
)
