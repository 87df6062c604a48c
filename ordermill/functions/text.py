"""Text clean-up expressions with Unicode white space and letter rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and the four ASCII separators that also count as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same characters in a regular expression that starts with (?U).
BLANK = r"[\s\x1c-\x1f]"
# Letters that have case. Anything else starts a new word.
CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def collapse(text: Column) -> Column:
    """Turn each run of white space into one space."""
    return F.regexp_replace(text, f"(?U){BLANK}+", " ")


def title_case(text: Column) -> Column:
    """Capital first letter and small rest for every run of letters.

    ``initcap`` alone only starts a word after a space: it would give ``Non-fiction``. Plain words
    take it as a short cut.
    """
    runs = F.regexp_extract_all(text, F.lit(f"([{CASED}]+|[^{CASED}]+)"), F.lit(1))
    return F.when(text.rlike(r"^[A-Za-z ]*\z"), F.initcap(text)).otherwise(
        F.array_join(F.transform(runs, F.initcap), "")
    )


def upper_code(text: Column) -> Column:
    """Stripped upper-case code such as a status or region."""
    return F.upper(strip(text))
