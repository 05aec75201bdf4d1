"""Week arithmetic as Column expressions.

A sales week is keyed by the calendar year and the ISO week number of its days, so
days at a year edge can land in week 1, 52 or 53 of the year they are dated in.
"""

from pyspark.sql import functions as F


def absolute_week(year, week, base_year):
    """Sort key of a (year, week) bucket. Orders buckets; gaps in it mean nothing."""
    return (year - F.lit(base_year)) * 53 + week


def approximate_week_start(year, week):
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (week - 1) * 7)


def season_month(week):
    """Month of a week when the year is cut into twelve equal parts of 52 weeks."""
    return F.greatest(F.lit(1), F.least(F.lit(12), F.floor((week - 1) * 12 / 52) + 1)).cast("int")


def iso_monday(year, week):
    """Monday of an ISO week.

    A week 53 its year does not have is looked up in the year before; whatever is
    still invalid becomes 1 January plus whole weeks.
    """

    def monday(y):
        first = F.trunc(F.make_date(y, F.lit(1), F.lit(4)), "week")
        return F.date_add(first, (week - 1) * 7)

    def valid(day, y):
        return F.extract(F.lit("YEAROFWEEK"), day) == y

    own, prior = monday(year), monday(year - 1)
    return (
        F.when(valid(own, year), own)
        .when((week == 53) & valid(prior, year - 1), prior)
        .otherwise(approximate_week_start(year, week))
    )
