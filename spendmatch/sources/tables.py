"""Table sources and sinks.

Tables are Parquet (path or catalog).  Spark's JDBC source is a drop-in
alternative format for a relational target; none is used here because the
container ships no driver.
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stored table of the test-data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_tables(spark: SparkSession, sources: dict[str, str], wanted: list[str] | None = None,
                fmt: str = "parquet", options: dict | None = None) -> dict[str, DataFrame]:
    """Read several named inputs; a missing one is logged and skipped.

    An empty input is skipped too (the check reads at most one row).
    """
    out: dict[str, DataFrame] = {}
    for name in (wanted or list(sources)):
        path = sources.get(name)
        if path is None:
            log.warning("input %r not found; skipped", name)
            continue
        try:
            df = spark.read.format(fmt).options(**(options or {})).load(path)
        except AnalysisException as exc:
            log.warning("input %r unreadable (%s); skipped", name, exc)
            continue
        if df.isEmpty():
            log.warning("input %r is empty; skipped", name)
            continue
        out[name] = df
    return out


def _typed_columns(schema: T.StructType, cols: list[str] | None, parse_text: bool) -> tuple[list[str], list[str]]:
    """(floating columns, text columns) whose values decide their type."""
    wanted = [f for f in schema.fields if cols is None or f.name in cols]
    return ([f.name for f in wanted if isinstance(f.dataType, (T.DoubleType, T.FloatType))],
            [f.name for f in wanted if parse_text and isinstance(f.dataType, T.StringType)])


def type_checks(schema: T.StructType, cols: list[str] | None = None, parse_text: bool = False) -> list[Column]:
    """The aggregates that :func:`infer_types` decides by; empty when no column is in doubt.

    They can be observed while the rows are written, so that the input is read once.
    """
    floats, texts = _typed_columns(schema, cols, parse_text)
    checks = []
    for c in floats:
        v = F.col(c)
        checks += [F.bool_and(v.isNull() | F.isnan(v) | ((v == F.floor(v)) & (F.abs(v) < 2.0 ** 63))).alias(f"{c}__int"),
                   F.bool_or(v.isNotNull() & ~F.isnan(v)).alias(f"{c}__any")]
    for c in texts:
        v = F.trim(F.col(c))
        blank = F.col(c).isNull() | (v == "")
        number = v.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$")
        checks += [F.bool_and(blank | (number & v.try_cast("bigint").isNotNull() & ~v.contains("."))).alias(f"{c}__int"),
                   F.bool_and(blank | number).alias(f"{c}__dbl"),
                   F.bool_and(blank | F.lower(v).isin("true", "false")).alias(f"{c}__bool"),
                   F.bool_or(~blank).alias(f"{c}__any")]
    return checks


def apply_types(df: DataFrame, fit: dict, cols: list[str] | None = None, parse_text: bool = False) -> DataFrame:
    """Cast by the results of :func:`type_checks`."""
    floats, texts = _typed_columns(df.schema, cols, parse_text)
    exprs = []
    for f in df.schema.fields:
        c = f.name
        v = F.nullif(F.trim(F.col(c)), F.lit("")) if c in texts else F.when(~F.isnan(c), F.col(c)) if c in floats else F.col(c)
        if c not in floats + texts or not fit[f"{c}__any"]:
            exprs.append(F.col(c))
        elif fit[f"{c}__int"]:
            exprs.append(v.cast("bigint").alias(c))
        elif c in texts and fit[f"{c}__dbl"]:
            exprs.append(v.cast("double").alias(c))
        elif c in texts and fit[f"{c}__bool"]:
            exprs.append((F.lower(v) == "true").alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def infer_types(df: DataFrame, cols: list[str] | None = None, parse_text: bool = False) -> DataFrame:
    """Best-fit nullable types (``convert_dtypes``).

    A floating column whose values are all whole numbers (or missing) becomes
    bigint, with NaN as NULL; text stays text.  ``parse_text=True`` also types
    text columns whose non-blank values all read as integers, numbers or
    booleans; a leading zero or sign marks an id and keeps the column text.
    One aggregate pass decides.
    """
    checks = type_checks(df.schema, cols, parse_text)
    return apply_types(df, df.agg(*checks).first().asDict(), cols, parse_text) if checks else df


def table_exists(spark: SparkSession, name: str) -> bool:
    if "/" in name:
        try:
            spark.read.parquet(name).schema
            return True
        except AnalysisException:
            return False
    return spark.catalog.tableExists(name)


def ensure_target(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    """Create an empty target from a schema when it does not exist; never drop.

    Returns True when the target was created.
    """
    if table_exists(spark, name):
        return False
    empty = spark.createDataFrame([], schema)
    if "/" in name:
        empty.write.mode("errorifexists").parquet(name)
    else:
        empty.write.mode("errorifexists").saveAsTable(name)
    return True


def refresh_mart(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Full refresh (DROP + CREATE TABLE AS) of a materialised mart."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in name:
        w.parquet(name)
    else:
        w.saveAsTable(name)


def initial_load(df: DataFrame, target: str) -> bool:
    """Bulk append when the target is empty (the COPY path).

    Returns True when the bulk path was taken.
    """
    spark = df.sparkSession
    existing = spark.read.parquet(target) if "/" in target else spark.table(target)
    if not existing.isEmpty():
        return False
    if "/" in target:
        df.write.mode("append").parquet(target)
    else:
        df.write.mode("append").insertInto(target)
    return True


def write_rejects(df_bad: DataFrame, path: str, limit: int = 100, order_by: list[str] | None = None) -> None:
    """Every rejected row as Parquet under ``path/all``, and a header CSV of the first ``limit`` under ``path/sample``.

    The sample is ordered by ``order_by``, or by all columns.
    """
    df_bad.write.mode("overwrite").parquet(f"{path}/all")
    write_reject_sample(df_bad.sparkSession.read.schema(df_bad.schema).parquet(f"{path}/all"), path, limit, order_by)


def write_reject_sample(stored: DataFrame, path: str, limit: int = 100, order_by: list[str] | None = None) -> None:
    """A header CSV of the first ``limit`` of the stored rejects under ``path/sample``."""
    stored.orderBy(*(order_by or stored.columns)).limit(limit).write.mode("overwrite").option("header", True).csv(f"{path}/sample")
