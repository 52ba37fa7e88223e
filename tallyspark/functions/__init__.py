"""Column-level helpers: every function returns a built-in Spark ``Column``."""

from tallyspark.functions.numeric import money, pct, ratio, round_half_away
from tallyspark.functions.parse import to_date_lenient, to_number, to_bool_exact
from tallyspark.functions.text import nullify_tokens, strip_ws, title_case
from tallyspark.functions.hashing import row_hash
from tallyspark.functions.calendar import date_id

__all__ = [
    "money", "pct", "ratio", "round_half_away",
    "to_date_lenient", "to_number", "to_bool_exact",
    "nullify_tokens", "strip_ws", "title_case", "row_hash", "date_id",
]
