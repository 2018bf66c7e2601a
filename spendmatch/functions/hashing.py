"""Row fingerprints for change detection.

The fingerprint of a row is the MD5 hex digest of its canonical column values
joined by ``'|'`` in column order.  Everything is a built-in expression, so
hashing runs inside whole-stage codegen on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendmatch.functions.text import strip

# Separator between canonical values, and the audit columns that
# never take part in the fingerprint.
HASH_SEPARATOR = "|"
AUDIT_COLUMNS = ("created_at", "updated_at", "row_hash")
# Text the canonical form gives to missing values (NULL, NaN, NaT).
MISSING = ""
# Formats of timestamps and dates inside the fingerprint (second precision).
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def float10g(c) -> Column:
    """Python ``f"{v:.10g}"`` as a column expression (F16).

    Ten significant digits; fixed notation when the decimal exponent is in
    [-4, 10), scientific otherwise; trailing zeros (and a bare point) removed.
    ``format_string('%.9e')`` gives the mantissa and exponent, rounded half up
    on the shortest digits; where those digits are a tie, :func:`_untied`
    compares the stored binary value with it, as Python does.  The
    fixed branch reads the rounded literal back as an exact decimal.  NaN
    maps to NULL (the caller's missing-value rule applies), infinities to
    ``inf``/``-inf`` and negative zero to ``-0``.
    """
    return _let(_untied(_c(c).cast("double")), _ten_digits)


def _ten_digits(v: Column) -> Column:
    e = F.format_string("%.9e", v)
    mant = F.regexp_extract(e, r"^(-?[0-9.]+)e", 1)
    exp_txt = F.regexp_extract(e, r"e([+-][0-9]+)$", 1)
    exp = exp_txt.try_cast("int")
    fixed = F.regexp_replace(F.regexp_replace(e.try_cast("decimal(38,20)").cast("string"), r"0+$", ""), r"\.$", "")
    sci_mant = F.regexp_replace(F.regexp_replace(mant, r"0+$", ""), r"\.$", "")
    sci = F.concat(sci_mant, F.lit("e"), exp_txt)
    return (F.when(v.isNull() | F.isnan(v), F.lit(None).cast("string"))
            .when(v == F.lit(float("inf")), F.lit("inf"))
            .when(v == F.lit(float("-inf")), F.lit("-inf"))
            .when(v == 0, F.when(e.startswith("-"), F.lit("-0")).otherwise(F.lit("0")))
            .when((exp >= -4) & (exp < 10), fixed)
            .otherwise(sci))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` written, and evaluated, once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _two_product(a: Column, b: Column) -> tuple[Column, Column]:
    """(p, r) with p + r exactly the product of two doubles (Dekker)."""
    def halves(x: Column) -> tuple[Column, Column]:
        c = x * F.lit(134217729.0)
        high = c - (c - x)
        return high, x - high
    (ah, al), (bh, bl) = halves(a), halves(b)
    p = a * b
    return p, al * bl - (((p - ah * bh) - al * bh) - ah * bl)


def _untied(v: Column) -> Column:
    """``v``, or the ten-digit number towards zero where Python rounds a tie down.

    A tie is a value whose shortest digits are halfway between two ten-digit
    numbers: eleven digits N and an exponent.  The exact difference of the
    stored value to N * 10^(exponent - 10) decides, an even tenth digit where
    it is zero.  Exponents outside [-12, 32] keep rounding half up.
    """
    digits = F.format_string("%.16e", v)
    tie = r"^(-?)([0-9])\.([0-9]{9})50*e([+-][0-9]+)$"

    def lower(d: Column) -> Column:
        def part(k: int) -> Column:
            return F.regexp_extract(d, tie, k)
        facts = F.struct(F.concat(part(2), part(3)).cast("double").alias("ten"), part(4).cast("int").alias("exp"),
                         F.concat(part(1), part(2), F.lit("."), part(3), F.lit("e"), part(4)).cast("double").alias("low"),
                         F.abs(d.cast("double")).alias("x"))
        return _let(facts, decide)

    def decide(f: Column) -> Column:
        # below the tie's scale the value is scaled up, above it the tie; powers of ten to 10^22 are exact
        up, up_rest = _two_product(f["x"], F.pow(F.lit(10.0), F.greatest(10 - f["exp"], F.lit(0))))
        half, half_rest = _two_product(f["ten"] * 10 + 5, F.pow(F.lit(10.0), F.greatest(f["exp"] - 10, F.lit(0))))
        off = (up - half) + (up_rest - half_rest)
        down = f["exp"].between(-12, 32) & ((off < 0) | ((off == 0) & (f["ten"] % 2 == 0)))
        return F.when(down, f["low"])
    return F.when(digits.rlike(tie), F.coalesce(_let(digits, lower), v)).otherwise(v)


def python_float(c) -> Column:
    """Python ``str(v)`` of a double: shortest digits, fixed for exponents in [-4, 16), else like ``1e-05``."""
    v = _c(c).cast("double")
    text = v.cast("string")
    fixed = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    mant = F.regexp_replace(F.regexp_extract(text, r"^(.*)E", 1), r"\.0$", "")
    sci = F.concat(mant, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(power).cast("string"), 2, "0"))
    small = (F.abs(v) < 1e16) & ((F.abs(v) >= 1e-4) | (v == 0))
    return (F.when(F.isnan(v), F.lit("nan")).when(v == float("inf"), F.lit("inf")).when(v == float("-inf"), F.lit("-inf"))
            .when(v == 0, F.when(text.startswith("-"), F.lit("-0.0")).otherwise(F.lit("0.0")))
            .when(small, fixed).when(power < 100, sci)
            .otherwise(F.concat(mant, F.lit("e+"), power.cast("string"))))


def canonical_value(c, dtype: T.DataType) -> Column:
    """the text a value contributes to the fingerprint; never NULL."""
    c = _c(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        txt = F.date_format(c, TIMESTAMP_FORMAT)
    elif isinstance(dtype, T.DateType):
        txt = F.date_format(c, DATE_FORMAT)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        txt = float10g(c)
    elif isinstance(dtype, T.BooleanType):
        txt = F.when(c, F.lit("True")).when(~c, F.lit("False"))
    else:
        txt = strip(c.cast("string"))
    return F.coalesce(txt, F.lit(MISSING))


def _raw_value(c, dtype: T.DataType) -> Column:
    """F18 legacy: ``str(v)`` without trimming; missing values print ``<NA>``."""
    c = _c(c)
    if isinstance(dtype, T.BooleanType):
        txt = F.when(c, F.lit("True")).when(~c, F.lit("False"))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        txt = python_float(c)
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit("<NA>"))


def _vectorized_value(c, dtype: T.DataType) -> Column:
    """every numeric column (integers too) rendered with ``%.10g``."""
    if isinstance(dtype, T.NumericType) and not isinstance(dtype, T.BooleanType):
        return F.coalesce(float10g(_c(c).cast("double")), F.lit(MISSING))
    return canonical_value(c, dtype)


def hash_columns(df: DataFrame, exclude=AUDIT_COLUMNS) -> list[str]:
    """Data columns in frame order, audit columns left out (key columns stay in)."""
    return [f.name for f in df.schema.fields if f.name not in exclude]


def row_hash(df: DataFrame, cols: list[str] | None = None, mode: str = "canonical") -> Column:
    """``md5('|'.join(canonical(v) for v in row))`` in column order."""
    cols = cols if cols is not None else hash_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    render = {"canonical": canonical_value, "raw": _raw_value, "vectorized": _vectorized_value}[mode]
    parts = [render(F.col(c), types[c]) for c in cols]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def with_row_hash(df: DataFrame, cols: list[str] | None = None, mode: str = "canonical",
                  name: str = "row_hash") -> DataFrame:
    return df.withColumn(name, row_hash(df, cols, mode))
