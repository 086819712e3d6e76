"""Date text to date, year, month and month name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The twelve month labels, January first.
MONTH_NAMES = (
    "JAN", "FEB", "MARCH", "APRIL", "MAY", "JUNE",
    "JULY", "AUG", "SEPT", "OCT", "NOV", "DEC",
)

DAY_FIRST = "dd-MM-yyyy"


def parse_date(col: Column | str, fmt: str) -> Column:
    """Date in the given format; text that does not fit becomes null.

    The format is required: guessing it from the first row makes the meaning
    of ``04-01-2015`` depend on row order.
    """
    text = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def month_name(month: Column | str) -> Column:
    """Label of a month number, null outside 1..12."""
    number = F.col(month) if isinstance(month, str) else month
    return F.get(F.array(*[F.lit(m) for m in MONTH_NAMES]), number - 1)


def calendar_columns(
    df: DataFrame,
    date_col: str = "Date",
    fmt: str = DAY_FIRST,
    year: str = "sold_year",
    month: str = "sold_month",
    drop: bool = True,
) -> DataFrame:
    """Add year and month numbers of a date text column and drop the text.

    Spark column names ignore case, so the default names differ from a
    ``year`` column that market tables already have.
    """
    date = parse_date(date_col, fmt)
    out = df.withColumns({month: F.month(date), year: F.year(date)})
    return out.drop(date_col) if drop else out
