"""Text shaping for messages and for stored lines."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringledger.values import BLANKS, PREVIEW_CHARS


def title_case(c: Column) -> Column:
    """Underscores become blanks; every run of letters gets a capital first and small letters after it."""
    runs = F.regexp_extract_all(F.replace(c, F.lit("_"), F.lit(" ")), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    # text other than letters has no case, so every run can be treated alike
    return F.array_join(F.transform(runs, F.initcap), "")


def preview(role: Column, content: Column, chars: int = PREVIEW_CHARS) -> Column:
    """'- role: first characters...' for one message."""
    return F.concat(F.lit("- "), role, F.lit(": "), F.substring(content, 1, chars), F.lit("..."))


def trimmed(c: Column, *, also: str = "") -> Column:
    """Without blanks, and characters of `also`, at both ends.

    The pattern runs to the end of the text and back over the blanks there, which is faster than `btrim` with a set.
    """
    return F.regexp_extract(c, rf"(?s)\A[{BLANKS}{also}]*+(.*[^{BLANKS}{also}])?", 1)


def strip_fences(c: Column) -> Column:
    """Code fences removed, with an optional `sql` tag and the blanks after it; ends trimmed."""
    opened = F.regexp_replace(c, f"```(?:sql)?[{BLANKS}]*", "")
    return trimmed(F.replace(opened, F.lit("```"), F.lit("")))


def field_of_line(line: Column, index: int, splits: int = 2) -> Column:
    """Field `index` (from 0) of a comma-separated line cut at most `splits` times; NULL if there are fewer."""
    return F.get(F.split(line, ",", splits + 1), F.lit(index))


def iso_text(ts: Column) -> Column:
    """UTC timestamp as ISO text with microseconds and Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def filled(c: Column) -> Column:
    """False for NULL and for empty text."""
    return F.coalesce(c.cast("string"), F.lit("")) != ""
