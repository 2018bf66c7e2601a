"""Table previews and column profiles, re-aimed as data scans.

The source exported five sample rows and the column/type inventory of every
table to spreadsheets.  Here the inventory is extended with row and NULL
counts so it is a real scan: one aggregate pass per table, reshaped with
``stack`` into (table, ordinal, column, type, rows, nulls) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendmatch.functions.hashing import python_float


def profile_table(name: str, df: DataFrame) -> DataFrame:
    """R4 for one table: one row per column with its type, row count and NULL count."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(f.name).isNull()).alias(f"_n{i}") for i, f in enumerate(fields)]
    one = df.agg(*aggs)
    stack = ", ".join(f"{i + 1}, '{f.name}', '{f.dataType.simpleString()}', _n{i}" for i, f in enumerate(fields))
    return one.selectExpr(f"'{name}' AS table_name", "_rows AS row_count",
                          f"stack({len(fields)}, {stack}) AS (ordinal, column_name, data_type, null_count)") \
              .select("table_name", F.col("ordinal").cast("int").alias("ordinal"), "column_name", "data_type",
                      "row_count", "null_count")


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """The inventory of several tables, ordered by table and ordinal."""
    parts = [profile_table(n, df) for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name", "ordinal")


def preview_tables(tables: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """The first ``n`` rows of every table as (table, row, ordinal, column, cell text).

    Rows are ordered by their scalar columns, so the sample is the same on every
    run; each table's pick is a top-k, and only the picked rows are rendered.
    Timestamps are zone-less, as the source strips time zones before export; an
    array shows its length.
    """
    from pyspark.sql import Window

    out = None
    for name, df in tables.items():
        order = [F.col(f.name).asc_nulls_first() for f in df.schema.fields if not isinstance(f.dataType, T.ArrayType)]
        few = df.orderBy(*order).limit(n).withColumn("_row", F.row_number().over(Window.orderBy(*order)))  # n rows
        cells = [F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"), _cell(f).alias("cell"))
                 for i, f in enumerate(df.schema.fields)]
        part = few.select(F.lit(name).alias("table_name"), F.col("_row").alias("row_no"), F.inline(F.array(*cells)))
        out = part if out is None else out.unionByName(part)
    return out


def _cell(f: T.StructField):
    c = F.col(f.name)
    if isinstance(f.dataType, T.TimestampType):
        c = c.cast("timestamp_ntz")
    elif isinstance(f.dataType, T.ArrayType):
        c = F.size(c)
    elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return python_float(c)
    return c.cast("string")
