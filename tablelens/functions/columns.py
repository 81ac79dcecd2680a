"""Column-expression helpers shared by all operators (JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
# Nested and binary columns are neither numeric nor categorical features.
EXCLUDED_TYPES = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)


def feature_kind(dtype: T.DataType) -> str | None:
    """'numeric' for numbers and booleans, 'categorical' for everything flat, None if excluded."""
    if isinstance(dtype, EXCLUDED_TYPES):
        return None
    if isinstance(dtype, NUMERIC_TYPES) or isinstance(dtype, T.BooleanType):
        return "numeric"
    return "categorical"


def is_object_like(dtype: T.DataType) -> bool:
    """Text-like or boolean columns count as object-like when testing a target."""
    return not isinstance(dtype, NUMERIC_TYPES)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise NaN to NULL so every later aggregate sees one missing notion."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, FLOAT_TYPES):
            cols.append(F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def pyround(c: Column, digits: int) -> Column:
    """Round the scaled double half away from zero.

    Spark's ``round`` rounds the shortest decimal text (0.00015 -> 0.0002)
    whereas the binary value 1.4999...e-4 rounds to 0.0001, here as in Python.
    Scaled values that are exact ties (0.125 to two digits) or round up to one
    (1.115) go up here; Python rounds those to 0.12 and 1.11.
    """
    scale = float(10 ** digits)
    scaled = F.abs(c) * F.lit(scale)
    return (F.signum(c) * F.floor(scaled + F.lit(0.5)) / F.lit(scale)).cast("double")


def r6(c: Column) -> Column:
    """Round to 6 decimals: engines sum floats in different orders."""
    return pyround(c, 6)


def seeded_md5(seed, key: Column | str) -> Column:
    """Deterministic, partition-independent hex hash of ``'<seed>:<key>'``."""
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.coalesce(col.cast("string"), F.lit(""))))


def hash_unit(md5_hex: Column) -> Column:
    """Map an md5 hex string to [0, 1) using its first 32 bits."""
    return F.conv(F.substring(md5_hex, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def ordered_labels(pairs) -> Column:
    """Array of the labels whose condition holds, in rule order (NULLs removed)."""
    return F.array_compact(F.array(*[F.when(cond, label if isinstance(label, Column) else F.lit(label)) for cond, label in pairs]))


def floor_int(c: Column) -> Column:
    """Python ``int()`` of a non-negative float: truncation."""
    return F.floor(c).cast("long")
