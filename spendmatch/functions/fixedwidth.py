"""Fixed-width college payment lines -> typed fields.

The whole parser is one projection of regex expressions (no Python UDF), so a
folder of text files is parsed by a single distributed scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the line layout.
FED_ID_FOLLOWED_BY_CODE = r"\d{9}(?=\s*[A-Z]{2})"   # first 9 digits before a 2-letter code
FED_ID_ANY = r"\d{9}"                                 # fallback: first 9-digit run
SUB_OBJECT_AT_START = r"^\s*([A-Z]{2})"
SUB_OBJECT_ANYWHERE = r"([A-Z]{2})"
AMOUNT_WITH_CENTS = r"(\d+\.\d{2})"
AMOUNT_IMPLIED_CENTS = r"(\d{5,})"
YEAR_AT_END = r"(\d{4})$"
FISCAL_MONTH = "13"
FIELD_ORDER = ["report_part", "college_number", "firm_name", "firm_fed_id", "sub_object",
               "dollar_amount", "fiscal_year", "fiscal_month"]
# Output headers of the converted CSV, in this order.
CSV_HEADERS = ["Report Part", "College Number", "Firm Name", "Firm Fed ID", "Sub-object",
               "Dollar Amount", "Fiscal Year", "Fiscal Month"]

_REST = 1 << 30  # "to the end of the string" for substring


ASCII_WHITESPACE = " \t\n\r\x0b\x0c"


def _strip_ascii(c: Column) -> Column:
    """Python ``strip`` for the ASCII report text (T19: the layout is ASCII)."""
    return F.btrim(c, F.lit(ASCII_WHITESPACE))


def parse_columns(value: Column | str = "value") -> dict[str, Column]:
    """Column expressions for every field plus ``is_blank`` / ``is_parsed``.

    The federal id is located once with ``regexp_instr`` (first 9-digit run
    followed by a two-letter code, else the first 9-digit run); firm name and
    remainder are plain substrings around it.
    """
    v = F.col(value) if isinstance(value, str) else value
    line = _strip_ascii(v)
    rest = F.substring(line, 6, _REST)                       # line[5:]
    pos1 = F.regexp_instr(rest, F.lit(FED_ID_FOLLOWED_BY_CODE))
    pos = F.when(pos1 > 0, pos1).otherwise(F.regexp_instr(rest, F.lit(FED_ID_ANY)))
    found = pos > 0
    fed_id = F.when(found, F.substring(rest, pos, 9))
    prefix = F.when(found, F.substring(rest, F.lit(1), pos - 1)).otherwise(F.lit(""))
    after = _strip_ascii(F.substring(rest, pos + 9, F.lit(_REST)))
    sub1 = F.regexp_extract(after, SUB_OBJECT_AT_START, 1)
    sub2 = F.regexp_extract(after, SUB_OBJECT_ANYWHERE, 1)
    sub_object = F.when(~found, F.lit(None)).when(sub1 != "", sub1).when(sub2 != "", sub2)
    cents = F.regexp_extract(after, AMOUNT_WITH_CENTS, 1)
    digits = F.regexp_extract(after, AMOUNT_IMPLIED_CENTS, 1)
    # implied cents: "0001234502513" -> "00012345025.13" (always >= 5 digits, T20)
    implied = F.concat(F.left(digits, F.length(digits) - 2), F.lit("."), F.right(digits, F.lit(2)))
    dollar = F.when(~found, F.lit(None)).when(cents != "", cents).when(digits != "", implied)
    year = F.regexp_extract(line, YEAR_AT_END, 1)
    is_blank = line == ""
    parsed = (~is_blank) & found & sub_object.isNotNull() & dollar.isNotNull()
    return {
        "report_part": F.substring(line, 1, 1),
        "college_number": F.when(F.length(line) > 4, F.substring(line, 2, 4)).otherwise(F.lit("")),
        "firm_name": _strip_ascii(prefix),
        "firm_fed_id": fed_id,
        "sub_object": sub_object,
        "dollar_amount": dollar,
        "fiscal_year": F.substring(year, 1, 2),
        "fiscal_month": F.lit(FISCAL_MONTH),
        "is_blank": is_blank,
        "is_parsed": parsed,
    }
