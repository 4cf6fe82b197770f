"""Repair of shift start and end times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.functions import clock, text
from fieldprep.functions.recode import holds
from fieldprep.operators.joins import null_safe_join

DAY = "INTERVAL 1 DAY"


def roll_over_midnight(start: Column, end: Column) -> Column:
    """An end before its start belongs to the next day."""
    return F.when(end < start, end + F.expr(DAY)).otherwise(end)


def repair_shift_simple(
    df: DataFrame, start: str = "Start_Time", end: str = "End_Time", offset_hours: int = 7
) -> DataFrame:
    """Roll the end over midnight, then move both by a fixed number of hours. One narrow pass."""
    move = F.expr(f"INTERVAL {int(offset_hours)} HOUR")
    return df.withColumn(end, roll_over_midnight(F.col(start), F.col(end)) + move).withColumn(start, F.col(start) + move)


def end_from_comment(start: Column, comment: Column) -> Column:
    """End time from a comment such as ``0600-18``: that hour on the start's day.

    Hour 24 or 00 is the midnight that ends the day; no hour gives NULL.
    """
    hour = text.extract(comment, "(?<=-)[0-9]{2}").try_cast("int")
    day = F.date_trunc("DAY", start).cast("timestamp_ntz")
    late = F.when(hour.isin(0, 24), 24).when(hour < 24, hour)
    return clock.add_seconds(day, late * 3600)


def repair_shift_full(
    df: DataFrame,
    start: str = "Start_Time",
    end: str = "End_Time",
    seen: str = "raw_timestamp",
    comment: str = "Shift_Start_Comment",
    workflow: str = "Workflow_ID",
    group: Sequence[str] = ("Year", "Station"),
) -> DataFrame:
    """Repair shifts by the times at which their inspections were taken.

    * no end: taken from the start comment;
    * a shift all of whose judged inspections lie inside it stays as it is;
    * otherwise, start not after end: both move by the row's own whole hours;
    * otherwise: from the hour of the first inspection to the full hour after the last.

    A missing workflow id is replaced by the inspection date. In a shift that needs repair a row
    whose start is unknown fits no rule and is left out. Per-shift facts are aggregated and joined
    back, so a shift of any size is one small row when it is shuffled.
    """
    s, e, t = F.col(start), F.col(end), F.col(seen)
    has_end = e.isNotNull()
    shift = F.when(has_end, F.coalesce(F.col(workflow), F.date_format(t, "yyyy-MM-dd"))).otherwise(F.col(workflow))
    rows = df.withColumn(workflow, shift).withColumn("__in", F.when(has_end, (t >= s) & (t <= e)))
    reversed_row = s > e
    unknown = F.count_if(reversed_row & t.isNull()) > 0
    keys = [*group, workflow]
    facts = (
        rows.filter(has_end)
        .groupBy(*keys)
        .agg(
            F.count_if(~F.col("__in")).alias("__outside"),
            F.when(~unknown, F.min(F.when(reversed_row, t))).alias("__first"),
            F.when(~unknown, F.max(F.when(reversed_row, t))).alias("__last"),
        )
    )
    known = null_safe_join(rows, facts, keys)
    needs_repair = has_end & (F.col("__outside") > 0)
    gap = F.ceil(clock.hours_between(s, t))
    by_row, by_group = needs_repair & (s <= e), needs_repair & (s > e)
    new_start = (
        F.when(by_row, clock.add_seconds(s, (gap - 1) * 3600)).when(by_group, clock.floor_hour(F.col("__first"))).otherwise(s)
    )
    new_end = (
        F.when(~has_end, end_from_comment(s, F.col(comment)))
        .when(by_row, clock.add_seconds(e, gap * 3600))
        .when(by_group, clock.ceil_hour(F.col("__last")))
        .otherwise(e)
    )
    kept = known.filter(~(holds(needs_repair) & s.isNull()))
    return kept.withColumns({start: new_start, end: new_end}).drop("__in", "__outside", "__first", "__last")


def move_back_outside_shift(
    df: DataFrame, at: str, start: str, end: str, buffer_minutes: int = 30, hours: int = 8
) -> DataFrame:
    """Times outside the buffered shift are moved back by a fixed number of hours."""
    slack = F.expr(f"INTERVAL {int(buffer_minutes)} MINUTE")
    inside = F.col(at).between(F.col(start) - slack, F.col(end) + slack)
    return df.withColumn(at, F.when(~inside, F.col(at) - F.expr(f"INTERVAL {int(hours)} HOUR")).when(inside, F.col(at)))
