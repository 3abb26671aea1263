"""Trailing row frames over very long series.

A frame such as "the 24 rows before this one" per series would sort a whole series
in one task. Here a series is cut into spans of about equally many rows, each span is
its own task group, and a span also gets copies of the earlier rows its frames reach
back to. Which rows those are follows from a small table of counts, so rows and
copies are made before the one shuffle that serves all frames, and frames are exact
however many empty or thin stretches lie in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SERIES = ["city", "footfall_location"]
SPAN_DAYS = 731
CELLS_PER_SPAN, MOST_CELL_DAYS = 32, 7

# The lengths of the two frames, in rows. The names of the three features
# made of them (see below) are fixed too, as the views' readers know them.
HOUR_ROWS = 24
SAME_HOUR_ROWS = 90


def _cell_of(moment: Column, span_days: int) -> Column:
    """Number of the few days that ``moment`` falls in; spans are made of whole cells."""
    days = min(MOST_CELL_DAYS, max(1, span_days // CELLS_PER_SPAN))
    return F.floor(F.unix_date(F.to_date(moment)) / F.lit(days)).cast("int")


def span_table(rows: DataFrame, span_rows: int) -> DataFrame:
    """The span of each cell of a series, and the last span that needs its rows, by hour of day.

    ``rows`` has the series, ``cell`` and ``hour``; the result has one row for each cell of
    a series: ``_own`` and the map ``_reach``. A span is closed once it has ``span_rows``
    rows, so it holds less than those and one cell. A row is needed up to the span of the
    last row whose frame holds it: the 24th after its cell, or the 90th of its hour.
    The windows here sort the counts of a series, 24 for each cell.
    """
    counts = rows.groupBy(*SERIES, "cell", "hour").agg(F.count(F.lit(1)).alias("n"))
    series, hourly = Window.partitionBy(*SERIES), Window.partitionBy(*SERIES, "hour")
    before = Window.unboundedPreceding
    counts = counts.withColumn("a", F.coalesce(F.sum("n").over(series.orderBy("cell").rangeBetween(before, -1)), F.lit(0)))
    counts = counts.withColumn("_own", F.dense_rank().over(series.orderBy(F.floor(F.col("a") / F.lit(span_rows)))))
    counts = counts.withColumn("m", F.max("_own").over(series.orderBy("a").rangeBetween(before, HOUR_ROWS - 1)))
    # what the next cell's first row says of the 23 after it holds for this cell's last row; spans only grow, so
    # that is the least of all later cells (read backwards, as a frame that only grows costs least)
    counts = counts.withColumn("_reach_day", F.min("m").over(series.orderBy(F.desc("cell")).rangeBetween(before, -1)))
    counts = counts.withColumn("a", F.coalesce(F.sum("n").over(hourly.orderBy("cell").rangeBetween(before, -1)), F.lit(0)))
    counts = counts.withColumn("m", F.max("_own").over(hourly.orderBy("a").rangeBetween(before, SAME_HOUR_ROWS - 1)))
    counts = counts.withColumn("_reach_hour", F.lead("m").over(hourly.orderBy("cell")))
    # without a later cell there is nothing to reach
    reach = F.greatest("_own", F.coalesce("_reach_day", "_own"), F.coalesce("_reach_hour", "_own"))
    by_hour = F.map_from_entries(F.collect_list(F.struct("hour", reach)))
    return counts.groupBy(*SERIES, "cell").agg(F.first("_own").alias("_own"), by_hour.alias("_reach"))


def with_trailing_features(hourly: DataFrame, span_days: int = SPAN_DAYS) -> DataFrame:
    """Add the trailing features to hourly counts joined with weather.

    ``footfall_90_day_average``: mean count of the 90 rows before, same hour of day;
    ``snow_24_hour_total`` and ``rain_24_hour_total``: sums over the 24 rows before.
    A first row has no frame and takes its own value. ``copies`` is the number of rows
    with the same city, location and timestamp.

    Rows of a series have one order for all frames: by timestamp, count and then every
    other column, so only rows equal in all columns are interchangeable, and one
    of them has the same place in each frame.

    Also keeps ``span``; the result is partitioned by city, location and span, so an
    aggregate whose keys include those needs no further shuffle, and a day is never in
    two spans. A span has the rows of ``span_days`` days of hours (17,544 of 731 days)
    and less than a cell more, whatever the grain; a cell is a week at most. The table
    of spans, a row for each cell of a series, is broadcast if Spark finds it small;
    otherwise both sides move by series and cell, which are never hot.
    Rows without a location are no series: they must be set apart before, as the views
    do, for they would meet in one task.
    """
    columns = hourly.columns
    hourly = hourly.filter(F.col("footfall_location").isNotNull()).withColumns(
        {"hour": F.hour("timestamp"), "cell": _cell_of(F.col("timestamp"), span_days)}
    )
    spans = span_table(hourly.select(*SERIES, "cell", "hour"), span_days * 24)
    framed = (
        hourly.join(spans, [*SERIES, "cell"])
        .withColumn("span", F.explode(F.sequence(F.col("_own"), F.element_at("_reach", F.col("hour")))))
        .select(*columns, "hour", "span", (F.col("span") != F.col("_own")).alias("_copy"))
        .repartition(*SERIES, "span")
    )

    first = [*SERIES, "timestamp", "total_footfall"]
    order = ["timestamp", "total_footfall", *(c for c in columns if c not in first)]
    whole = Window.partitionBy(*SERIES, "span").orderBy(*order)
    day_before = whole.rowsBetween(-HOUR_ROWS, -1)

    def total(column: str) -> Column:
        frame = F.sum(F.coalesce(column, F.lit(0.0))).over(day_before)
        return F.coalesce(frame, F.col(column), F.lit(0.0))

    same_moment = Window.partitionBy(*SERIES, "span").orderBy("timestamp").rangeBetween(Window.currentRow, Window.currentRow)
    framed = framed.withColumns(
        {f"{name}_24_hour_total": total(name) for name in ["snow", "rain"]} | {"_place": F.row_number().over(whole)}
    ).withColumn("copies", F.count(F.lit(1)).over(same_moment))

    # counts are whole numbers, so differences of running sums equal the frame's own
    # sum exactly and cost the same for any frame length
    same_hour = Window.partitionBy(*SERIES, "span", "hour").orderBy("_place")
    so_far = same_hour.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def trailing(column: str) -> Column:
        ahead = F.lag(column, 1).over(same_hour)
        return ahead - F.coalesce(F.lag(column, SAME_HOUR_ROWS + 1).over(same_hour), F.lit(0).cast("bigint"))

    framed = (
        framed.withColumn("_sum", F.coalesce(F.sum("total_footfall").over(so_far), F.lit(0).cast("bigint")))
        .withColumn("_rows", F.count("total_footfall").over(so_far))
        .withColumn("_sum", trailing("_sum"))
        .withColumn("_rows", trailing("_rows"))
    )
    mean = F.col("_sum").cast("double") / F.nullif("_rows", F.lit(0).cast("bigint"))
    return (
        framed.withColumn("footfall_90_day_average", F.coalesce(mean, F.col("total_footfall").cast("double")))
        .filter(~F.col("_copy"))
        .select(
            *columns, "hour", "span", "footfall_90_day_average", "snow_24_hour_total", "rain_24_hour_total", "copies"
        )
    )
