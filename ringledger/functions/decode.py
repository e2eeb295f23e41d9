"""Decode the composite text values of the raw tables; text of another form gives NULL."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.values import EVENT_DATE_FORMAT, MISSING


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _part(text: Column, pattern: str, group: int, kind: str = "int") -> Column:
    # regexp_extract gives '' without a match, which try_cast turns into NULL
    return F.regexp_extract(text, pattern, group).try_cast(kind)


def landed_attempted(c: Column | str) -> Column:
    """'33 of 56' -> struct(landed 33, attempted 56); NULL struct for other text."""
    text = F.trim(_col(c))
    pattern = r"^(\d+) of (\d+)$"
    landed = _part(text, pattern, 1, "bigint")
    attempted = _part(text, pattern, 2, "bigint")
    return F.when(landed.isNotNull(), F.struct(landed.alias("landed"), attempted.alias("attempted")))


def percent(c: Column | str) -> Column:
    """'58%' -> 58."""
    return _part(F.trim(_col(c)), r"^(\d+)%$", 1)


def clock_seconds(c: Column | str) -> Column:
    """'5:11' -> 311."""
    text = F.trim(_col(c))
    pattern = r"^(\d+):([0-5]\d)$"
    return _part(text, pattern, 1) * 60 + _part(text, pattern, 2)


def height_inches(c: Column | str) -> Column:
    """6' 3" -> 75; the closing mark may be missing."""
    text = F.trim(_col(c))
    pattern = r"""^(\d+)' *(\d+)"?$"""
    return _part(text, pattern, 1) * 12 + _part(text, pattern, 2)


def weight_pounds(c: Column | str) -> Column:
    """'205 lbs.' -> 205."""
    return _part(F.trim(_col(c)), r"^(\d+) lbs\.?$", 1)


def drop_one_mark(c: Column | str, mark: str = '"') -> Column:
    """Remove one trailing mark."""
    text = _col(c)
    return F.when(text.endswith(mark), F.left(text, F.length(text) - len(mark))).otherwise(text)


def drop_marks(c: Column | str, mark: str = '"', missing: Iterable[str] = ("", "--")) -> Column:
    """Remove every trailing mark; what is left of a missing value is NULL."""
    text = F.rtrim(_col(c), F.lit(mark))
    return F.when(~text.isin(*missing), text)


def missing_to_null(df: DataFrame, tokens: Iterable[str] = MISSING) -> DataFrame:
    """Whole-cell tokens become NULL in every string column."""
    tokens = list(tokens)

    def clean(field: T.StructField) -> Column:
        cell = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return cell
        return F.when(~cell.isin(*tokens), cell).alias(field.name)

    return df.select(*[clean(f) for f in df.schema.fields])


def event_date(c: Column | str) -> Column:
    """'March 11, 1994' -> date."""
    return F.try_to_date(_col(c), EVENT_DATE_FORMAT) if hasattr(F, "try_to_date") else F.to_date(
        F.try_to_timestamp(_col(c), F.lit(EVENT_DATE_FORMAT))
    )


# all text that a cast takes for a whole number, and some more; other text is not given to it, since a failing cast costs
# an exception
_WHOLE = r"\A[\x00-\x20\x7f]*+[+-]?[0-9.]++[\x00-\x20\x7f]*+\z"


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw text columns to the types of `schema`; a cell that does not fit is NULL, the row stays.

    An empty text is NULL, as it is after a round trip through CSV.
    """

    def convert(field: T.StructField) -> Column:
        cell = F.col(f"`{field.name}`")
        if dict(df.dtypes).get(field.name) == "string":
            cell = F.nullif(cell, F.lit(""))
            if isinstance(field.dataType, T.DateType):
                return F.coalesce(event_date(cell), cell.try_cast("date")).alias(field.name)
            if isinstance(field.dataType, T.IntegralType):
                return F.when(cell.rlike(_WHOLE), cell.try_cast(field.dataType)).alias(field.name)
        return cell.try_cast(field.dataType).alias(field.name)

    return df.select(*[convert(f) for f in schema.fields])
