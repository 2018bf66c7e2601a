"""Sheet ingestion cleaning."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendmatch.functions.text import strip


def normalize_column_name(name: str, readme_variant: bool = False) -> str:
    """P1 for one header: strip, each space -> '_', lower-case.

    ``readme_variant`` additionally removes special characters and collapses
    runs of whitespace first, as the project documentation describes (the
    code does not, and the code is the default).
    """
    n = name.strip()
    if readme_variant:
        n = re.sub(r"[^0-9A-Za-z_\s]", "", n)
        n = re.sub(r"\s+", " ", n)
    return n.replace(" ", "_").lower()


def normalize_columns(df: DataFrame, readme_variant: bool = False) -> DataFrame:
    """Rename every column (metadata only; no data is touched)."""
    return df.toDF(*[normalize_column_name(c, readme_variant) for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip every string column (Python ``strip`` semantics, T5)."""
    return df.withColumns({f.name: strip(f.name) for f in df.schema.fields
                           if isinstance(f.dataType, T.StringType)})


def clean_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key columns as stripped text; integral doubles lose their '.0' (T4)."""
    out = {}
    for k in keys:
        dt = df.schema[k].dataType
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            c = F.when(F.col(k) == F.floor(F.col(k)), F.col(k).cast("decimal(38,0)").cast("string")) \
                 .otherwise(F.col(k).cast("string"))
        else:
            c = F.col(k).cast("string")
        out[k] = strip(c)
    return df.withColumns(out)


def valid_keys_predicate(keys: list[str]):
    cond = None
    for k in keys:
        e = F.col(k).isNotNull() & (F.col(k) != "")
        cond = e if cond is None else cond & e
    return cond


def split_valid_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key present and non-empty, rejected rows)."""
    ok = valid_keys_predicate(keys)
    return df.filter(ok), df.filter(~ok | ok.isNull())


def nan_to_null(df: DataFrame) -> DataFrame:
    """P5: NaN -> NULL on floating columns before load."""
    return df.withColumns({f.name: F.when(~F.isnan(f.name), F.col(f.name))
                           for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))})
