"""Column expressions that turn the raw loan strings into typed values."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.schema import BAD_STATUS, DATE_FORMATS, EMP_LENGTH_YEARS, GOOD_STATUS


def default_flag(status: Column) -> Column:
    """1 for a defaulted loan, 0 for a good one, null for any other status."""
    return F.when(status.isin(BAD_STATUS), F.lit(1)).when(status.isin(GOOD_STATUS), F.lit(0))


def percent(text: Column) -> Column:
    """``'13.56%'`` -> 0.1356; text that is no number gives null."""
    return F.rtrim(text, F.lit("%")).try_cast("double") / F.lit(100.0)


def term_months(text: Column) -> Column:
    """``' 36 months'`` -> 36."""
    return F.replace(F.trim(text), F.lit(" months"), F.lit("")).try_cast("int")


def employment_years(text: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in EMP_LENGTH_YEARS.items() for x in pair])
    return F.try_element_at(lookup, text)


def any_date(text: Column) -> Column:
    """The first of the known formats that reads the value."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])


def years_before(as_of: date | str, moment: Column) -> Column:
    """Whole days from ``moment`` to ``as_of``, in years of 365.25 days."""
    return F.datediff(F.lit(str(as_of)).cast("date"), moment.cast("date")) / F.lit(365.25)
