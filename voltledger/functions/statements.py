"""Read-only classification of SQL statement texts, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statement keywords that are never read-only.
FORBIDDEN = (
    "insert", "update", "delete", "drop", "create", "alter", "truncate", "attach",
    "detach", "copy", "export", "install", "load", "pragma", "set", "call",
)
MULTIPLE = "Only one statement is allowed per query."
NOT_A_SELECT = "Only SELECT (or WITH ... SELECT) queries are allowed."

_BLANKS = "[\\s\\x1c-\\x1f]"


def classify_sql(sql: Column) -> Column:
    """struct<allowed, reason>; reason is null for an allowed statement."""
    text = F.regexp_replace(sql, r"--[^\n]*", " ")
    text = F.regexp_replace(text, r"(?s)/\*.*?\*/", " ")
    text = F.regexp_replace(text, rf"(?U)^{_BLANKS}+", "")
    text = F.regexp_replace(text, rf"(?U){_BLANKS}+\z", "")
    text = F.regexp_replace(text, r";+\z", "")
    keyword = F.regexp_extract(text, rf"(?iU)\b({'|'.join(FORBIDDEN)})\b", 1)
    reason = (
        F.when(F.contains(text, F.lit(";")), F.lit(MULTIPLE))
        .when(~text.rlike(r"(?isU)^\s*(select|with)\b"), F.lit(NOT_A_SELECT))
        .when(keyword != "", F.concat(F.lit("Statement type '"), keyword, F.lit("' is not permitted.")))
    )
    return F.struct(reason.isNull().alias("allowed"), reason.alias("reason"))
