"""Text columns: trimming, answer sections and citations."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from precedent.schemas import CITATION_PATTERN

# Every character that counts as white space at the ends of a
# text (Unicode White_Space plus the four ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Both ends trimmed of any white space, not only of blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | (strip(text) == "")


def literal_count(text: Column, needle: str) -> Column:
    """How often ``needle`` occurs, without overlaps."""
    removed = F.length(text) - F.length(F.replace(text, F.lit(needle)))
    return (removed / F.lit(len(needle))).cast("int")


def section(answer: Column, heading: str, following: str | None = None) -> Column:
    """Text below ``heading``, up to the next heading if there is one."""
    start = F.locate(heading, answer)
    body = F.substring(answer, start + F.lit(len(heading)), F.length(answer))
    if following is not None:
        end = F.locate(following, body)
        body = F.when(end > 0, F.substring(body, F.lit(1), end - 1)).otherwise(body)
    return F.when(start > 0, strip(body)).otherwise(F.lit(""))


def citations(answer: Column, pattern: str = CITATION_PATTERN) -> Column:
    """Distinct ticket ids named anywhere in the answer, sorted; alternatives in ``pattern`` are one group."""
    found = F.regexp_extract_all(answer, F.lit(rf"(?U)\b(?:{pattern})\b"), F.lit(0))
    return F.sort_array(F.array_distinct(found))


def retrieval_text(product: Column, issue: Column) -> Column:
    """What a ticket is matched on: the symptom, not the cure."""
    return F.concat(F.lit("Product: "), product, F.lit("\nIssue: "), issue)
