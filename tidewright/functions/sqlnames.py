"""The column builders under SQL names, for users who write ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

_TS = r"^\\d{4}/\\d{2}/\\d{2} \\d{2}:\\d{2}:\\d{2}$"

# Each entry is a SQL function body; Catalyst inlines it, so no UDF call remains in the plan.
SQL_FUNCTIONS = {
    "log_ts": (
        "t STRING", "TIMESTAMP_NTZ",
        f"CASE WHEN trim(t) RLIKE '{_TS}' "
        "THEN try_cast(translate(trim(t), '/', '-') AS TIMESTAMP_NTZ) END",
    ),
    "log_day": ("t STRING", "STRING", "split_part(t, ' ', 1)"),
    "same_log_day": (
        "a STRING, b STRING", "BOOLEAN",
        "coalesce(try_cast(translate(left(a, 10), '/', '-') AS DATE)"
        " = try_cast(translate(left(b, 10), '/', '-') AS DATE), false)",
    ),
    "log_seconds": (
        "later STRING, earlier STRING", "BIGINT",
        "timestampdiff(SECOND, try_cast(translate(trim(earlier), '/', '-') AS TIMESTAMP_NTZ),"
        " try_cast(translate(trim(later), '/', '-') AS TIMESTAMP_NTZ))",
    ),
    "number_text_diff": (
        "a STRING, b STRING", "BIGINT",
        "coalesce(try_cast(b AS BIGINT) - try_cast(a AS BIGINT), 0)",
    ),
    "child_file": (
        "p STRING", "STRING",
        "CASE WHEN size(split(trim(p), '/')) = 2 THEN nullif(get(split(trim(p), '/'), 1), '') END",
    ),
    "log_counter": (
        "detail STRING, name STRING", "BIGINT",
        "CASE WHEN (contains(detail, '完成处理') OR contains(detail, 'Finished processing')) "
        "AND detail RLIKE '[(] *I=[0-9]+ *, *O=[0-9]+ *, *R=[0-9]+ *, *W=[0-9]+ *,"
        " *U=[0-9]+ *, *E=[0-9]+ *[)]' THEN coalesce(try_cast(regexp_extract(detail, concat('[(, ]', name, '=([0-9]+)'), 1)"
        " AS BIGINT), 0) ELSE 0 END",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions in this session and return their names."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}"
        )
    return list(SQL_FUNCTIONS)
