"""The chain that turns a balanced table into a feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabloom.defaults import ID_NAME_PARTS, MAX_ONE_HOT
from tabloom.functions.columns import col, string_columns
from tabloom.operators.encoding import one_hot, one_hot_values
from tabloom.operators.profiling import id_like_profile
from tabloom.operators.scaling import StandardScaler, fit_standard


@dataclass
class Features:
    """``table`` holds the scaled features and, where asked for, the target as last column."""

    table: DataFrame
    columns: list[str]
    scaler: StandardScaler
    dropped: list[str]
    left_out: list[str]
    """Columns of types that are no features: dates, timestamps, nested and binary ones."""
    one_hot_values: dict[str, list[str]]


def prepare_features(
    df: DataFrame,
    target: str,
    *,
    id_name_parts: Sequence[str] = tuple(ID_NAME_PARTS),
    keep: Sequence[str] = (),
    one_hot_limit: int = MAX_ONE_HOT,
) -> Features:
    """Drop target and ID-like columns, one-hot the text columns, scale the continuous ones.

    Columns that are neither numbers, text nor truth values are left out and named in the result.

    The target and the columns in ``keep`` stay behind the features, untouched.
    """
    kept = [target, *keep]
    usable = (T.NumericType, T.StringType, T.BooleanType)
    left_out = [f.name for f in df.schema.fields if f.name not in kept and not isinstance(f.dataType, usable)]
    plain = df.drop(*kept, *left_out)
    roles = id_like_profile(plain, id_name_parts).collect()
    dropped = [r["column"] for r in roles if r["id_like"]]
    names = [c for c in plain.columns if c not in dropped]
    categorical = [c for c in string_columns(plain) if c in names]
    values = one_hot_values(df, categorical, one_hot_limit, {r["column"]: r["distinct_estimate"] for r in roles})
    wide = one_hot(df.select(*[col(c) for c in names], *[col(c) for c in kept]), categorical, values)
    columns = [c for c in wide.columns if c not in kept]
    wide = wide.select(*[col(c) for c in columns], *[col(c) for c in kept])
    scaler = fit_standard(wide.select(*[col(c) for c in columns]))
    return Features(scaler.transform(wide), columns, scaler, dropped, left_out, values)
