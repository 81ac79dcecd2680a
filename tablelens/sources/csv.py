"""CSV scan with header and type inference (S1) and missing-token normalisation.

Spark's CSV reader takes a single ``nullValue`` token, so text is read as
strings, every missing token becomes NULL, and each column's type is decided by
one aggregate pass that counts values failing ``try_cast`` (per column:
integer if every present value is an integer and none is missing, else double
if every present value is a number, boolean if all are true/false, else text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default missing tokens of the common CSV reader the reference uses.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
_BOOL = ["True", "False", "true", "false", "TRUE", "FALSE"]


def normalise_missing_tokens(df: DataFrame, columns=None) -> DataFrame:
    """Missing tokens in text columns become NULL; NaN in floating columns becomes NULL."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if (columns is None or f.name in columns) and isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(MISSING_TOKENS), F.lit(None)).otherwise(c)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns to long / double / boolean when every present value allows it (one pass)."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return df
    checks = []
    for c in text:
        v = F.col(c)
        checks += [
            F.count(F.when(v.isNotNull() & F.expr(f"try_cast(`{c}` AS BIGINT)").isNull(), 1)).alias(f"{c}__l"),
            F.count(F.when(v.isNotNull() & F.expr(f"try_cast(`{c}` AS DOUBLE)").isNull(), 1)).alias(f"{c}__d"),
            F.count(F.when(v.isNotNull() & ~v.isin(_BOOL), 1)).alias(f"{c}__b"),
            F.count(F.when(v.isNull(), 1)).alias(f"{c}__m"),
            F.count(v).alias(f"{c}__n"),
        ]
    row = df.agg(*checks).first()  # one row of counts
    out = []
    for f in df.schema.fields:
        c = f.name
        if c not in text:
            out.append(F.col(c))
            continue
        if row[f"{c}__n"] == 0:  # nothing but missing values: a number column
            out.append(F.lit(None).cast("double").alias(c))
            continue
        if row[f"{c}__l"] == 0 and row[f"{c}__m"] == 0:
            out.append(F.expr(f"try_cast(`{c}` AS BIGINT)").alias(c))
        elif row[f"{c}__d"] == 0:
            out.append(F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c))
        elif row[f"{c}__b"] == 0 and row[f"{c}__m"] == 0:
            out.append((F.lower(F.col(c)) == "true").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = True) -> DataFrame:
    """Header CSV; an explicit schema wins, else one-pass inference.

    Doubled quotes and newlines inside quotes are read as part of the value;
    ``multiline=False`` lets Spark split files whose values hold no newline.
    Missing tokens count as missing under an explicit schema too; any other text
    that does not fit its type fails the read.
    """
    raw = spark.read.options(header=True, mode="FAILFAST", inferSchema=False, escape='"', multiLine=multiline).csv(path)
    clean = normalise_missing_tokens(raw)
    if schema is None:
        return infer_types(clean)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return clean.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])
