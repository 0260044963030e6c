"""Whitespace and quote handling over the full Unicode whitespace set.

Spark's ``trim`` removes spaces only and Java's ``\\s`` is ASCII, so the set is
named in full. Trimming looks at the ends of a text only, which makes it far
cheaper than an anchored regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: characters that count as whitespace ----------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ----------------------------------------------------------------------------

SPACE = f"[{WHITESPACE}]"


def strip(text: Column) -> Column:
    """Remove whitespace of any kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def printed_double(value: Column) -> Column:
    """A double as Python prints it: plain from 0.0001 up to 16 digits, else with an exponent."""
    text = value.cast("string")
    size = F.abs(value)
    plain = F.regexp_replace(value.cast("decimal(38,20)").cast("string"), r"(?<!\.)0++\z", "")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0\z", "")
    power = F.substring_index(text, "E", -1)
    digits = F.regexp_replace(power, "-", "")
    exponent = F.concat(
        F.when(power.startswith("-"), "-").otherwise("+"),
        F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits),
    )
    return (
        F.when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, F.lit("e"), exponent))
    )


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def squeeze(text: Column) -> Column:
    """Collapse each run of whitespace to one space and drop it at the ends."""
    # Java's Unicode class is faster than the list but lacks four separators.
    return F.btrim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]++", " "))


def normalise(text: Column) -> Column:
    """Strip, drop outer double then single quotes, collapse whitespace."""
    return squeeze(F.btrim(F.btrim(strip(text), F.lit('"')), F.lit("'")))


def unescape_csv(value: Column) -> Column:
    """Drop one pair of outer double quotes and halve doubled ones."""
    quoted = value.startswith('"') & value.endswith('"') & (F.length(value) >= 2)
    inner = F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return F.replace(inner, F.lit('""'), F.lit('"'))
