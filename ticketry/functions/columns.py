"""Column expressions shared by the jobs. All stay inside Spark's own functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_default(c: str | Column, label: str) -> Column:
    """NULL or '' becomes ``label``. A string of blanks is a value and stays."""
    c = _col(c)
    return F.when(c.isNull() | (c == ""), F.lit(label)).otherwise(c)


def lenient_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Wall-clock timestamp, NULL when the text is none."""
    c = _col(c)
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def lenient_number(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def stripped(c: str | Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def yes_no(c: str | Column) -> Column:
    """'SIM' / 'NAO' in any case, with any white space around, to boolean; anything else is NULL."""
    word = F.upper(stripped(c))
    return F.when(word == "SIM", F.lit(True)).when(word == "NAO", F.lit(False))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return micros / F.lit(1e6)


def monday_zero(c: str | Column) -> Column:
    return F.weekday(_col(c))


def is_weekend(c: str | Column) -> Column:
    return (F.weekday(_col(c)) >= 5).cast("int")


def month_label(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def month_start(c: str | Column) -> Column:
    return F.trunc(_col(c).cast("date"), "month")


def year_free_date(c: str | Column) -> Column:
    """The same month and day in 2000, a leap year, so years can be laid over each other."""
    c = _col(c)
    return F.make_date(F.lit(2000), F.month(c), F.dayofmonth(c))


def relative_week(day: str | Column, first_day: str | Column) -> Column:
    return (F.floor(F.datediff(_col(day), _col(first_day)) / 7) + 1).cast("int")


def two_buckets(c: str | Column, special: str, other: str) -> Column:
    c = _col(c)
    return F.when(c == special, c).otherwise(F.lit(other))


def contains_ignore_case(c: str | Column, needle: str) -> Column:
    return F.coalesce(F.lower(_col(c)).contains(needle.lower()), F.lit(False))


def after_cut_flag(c: str | Column, cut: str) -> Column:
    return (_col(c) >= F.lit(cut).cast("date")).cast("int")


def regime_label(c: str | Column, cut: str, before: str = "pré", after: str = "pós") -> Column:
    return F.when(_col(c) >= F.lit(cut).cast("date"), F.lit(after)).otherwise(F.lit(before))


def recode(c: str | Column, mapping: dict) -> Column:
    """Value map; a value outside the map becomes NULL."""
    c = _col(c)
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def presence(c: str | Column) -> Column:
    return _col(c).isNotNull().cast("int")


def split_by_cuts(c: str | Column, train_end: str, val_end: str) -> Column:
    """'TRAIN' before the first cut, 'VAL' before the second, 'TEST' from there on."""
    c = _col(c)
    return (
        F.when(c < F.lit(train_end).cast("date"), "TRAIN")
        .when(c < F.lit(val_end).cast("date"), "VAL")
        .otherwise("TEST")
    )


def split_by_months(c: str | Column, train: Iterable[str], val: Iterable[str], test: Iterable[str]) -> Column:
    """Split by calendar month; a month in none of the sets gives NULL."""
    month = month_label(c)
    return (
        F.when(month.isin(*train), "TRAIN").when(month.isin(*val), "VAL").when(month.isin(*test), "TEST")
    )


def clip_at_zero(c: str | Column) -> Column:
    return F.greatest(_col(c), F.lit(0.0))


def outcome_label(flag: str | Column, hit: str, miss: str) -> Column:
    """NULL counts as a miss, like a SQL CASE without a NULL branch."""
    return F.when(_col(flag), F.lit(hit)).otherwise(F.lit(miss))


def between_days(c: str | Column, low: str | None, high: str | None) -> Column:
    """Inclusive day range; an open end is no bound."""
    c = _col(c)
    test = F.lit(True)
    if low is not None:
        test = test & (c >= F.lit(low).cast("date"))
    if high is not None:
        test = test & (c <= F.lit(high).cast("date"))
    return test


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL when the whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
