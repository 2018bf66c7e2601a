"""Surrogate keys from spreadsheet formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the district key formula: zip codes are left-padded to five
# characters with '0'; the seed joins district, zip and split/whole with '|';
# the id keeps the first 12 base64 characters, lower-cased, after the district
# and a '-'.
ZIP_WIDTH = 5
ZIP_PAD = "0"
SEED_SEPARATOR = "|"
ID_SEPARATOR = "-"
HASH_CHARS = 12


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_start(c, width: int = ZIP_WIDTH, pad: str = ZIP_PAD) -> Column:
    """F21 left-pad to ``width``; longer values are kept whole (``lpad`` would cut)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, pad)).otherwise(s)


def surrogate_id(district, zipcode, split) -> Column:
    """F20 ``district-<12 lower-case base64 chars of UPPER(district|zip5|split)>``.

    A NULL district makes the whole id NULL (``concat`` propagates NULL, as the
    spreadsheet's ``&`` does); a NULL split counts as ''.  Lower-casing base64
    can collide (T11) — reproduced on purpose.
    """
    d = _c(district).cast("string")
    seed = F.upper(F.concat(d, F.lit(SEED_SEPARATOR), pad_start(zipcode), F.lit(SEED_SEPARATOR),
                            F.coalesce(_c(split).cast("string"), F.lit(""))))
    b64 = F.regexp_replace(F.base64(F.encode(seed, "UTF-8")), r"[\r\n=]", "")
    return F.concat(d, F.lit(ID_SEPARATOR), F.lower(F.substring(b64, 1, HASH_CHARS)))
