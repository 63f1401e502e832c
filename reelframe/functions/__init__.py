"""Column-expression helpers; all JVM-side built-ins, no Python UDFs."""

from reelframe.functions.exprs import (
    dealt,
    decade_floor,
    decade_intdiv,
    decade_label,
    escape_like,
    header_clean,
    histogram_bucket,
    name_contains,
    name_matches,
    one_row,
    pct,
    repeat_each,
    safe_ratio,
)

__all__ = [
    "dealt", "decade_floor", "decade_intdiv", "decade_label", "escape_like", "header_clean",
    "histogram_bucket", "name_contains", "name_matches", "one_row", "pct", "repeat_each", "safe_ratio",
]
