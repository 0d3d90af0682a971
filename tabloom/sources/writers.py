"""Writing tables and nested reports."""

from __future__ import annotations

import json
import math
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tabloom.errors import ValidationError
from tabloom.functions.local import local_table


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a table as Parquet, CSV (with header) or JSON lines."""
    writer = df.write.mode(mode)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.options(header=True, quote='"', escape='"').csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        raise ValidationError(f"unsupported file format: {fmt}")
    return path


def plain(value: Any) -> Any:
    """Rows, numpy values and tuples as plain JSON values; NaN and infinities as null."""
    if hasattr(value, "asDict"):
        return plain(value.asDict(recursive=True))
    if hasattr(value, "tolist"):
        return plain(value.tolist())
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [plain(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value


def write_report(spark: SparkSession, report: dict[str, Any] | DataFrame, path: str) -> str:
    """Write a small nested report as one JSON document, or a report table as JSON lines.

    Spark does the writing, so any storage the cluster knows will do.
    """
    if isinstance(report, DataFrame):
        return write_table(report, path, "json")
    text = json.dumps(plain(report), indent=4, ensure_ascii=False, default=str)
    local_table(spark, [(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path
