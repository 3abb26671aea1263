"""Trailing frames, the two views and scoring against SQL with the self-join spelled out."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import oracle
from checks.compare import differences
from checks.queries import zoneless
from kerbside.operators import joins
from kerbside.operators.trailing import with_trailing_features
from kerbside.plans import reporting, scoring
from kerbside.schemas import FOOTFALL, FORECASTS, HOLIDAYS, WEATHER_HISTORY, conform

START = dt.datetime(1996, 12, 1)


def hours(rng, days, share):
    return [START + dt.timedelta(hours=h) for h in range(days * 24) if rng.random() < share]


def make_world(seed=1, copies=False):
    """One dense long series, a sparse one, one with a rare hour and long gaps, a nameless one."""
    rng = random.Random(seed)
    foot = []

    def add(city, location, moments):
        foot.extend((city, location, m, rng.randrange(500)) for m in moments)

    add("A", "long", hours(rng, 420, 0.9))
    add("A", "sparse", hours(rng, 800, 0.02))
    add("A", "gaps", [START + dt.timedelta(days=37 * i, hours=rng.choice([3, 3, 9])) for i in range(30)])
    add("B", "short", hours(rng, 5, 0.8))
    add("B", None, hours(rng, 5, 0.5))
    weather = []
    for city in "AB":
        for m in hours(rng, 1200, 0.97):
            weather.append((
                city, m, float(rng.randrange(-5, 30)), rng.randrange(1000), rng.randrange(100), rng.randrange(100),
                float(rng.randrange(20)), rng.choice([None, 0.0, 2.0, 5.0]), rng.choice([None, 0.0, 1.0]),
            ))
    if copies:
        # conflicting counts for an hour, and weather delivered twice
        foot += [(c, loc, m, n + 1) for c, loc, m, n in rng.sample(foot, 300)]
        weather += rng.sample(weather, 300)
    days = [START.date() + dt.timedelta(days=d) for d in range(0, 1100, 9)]
    holidays = [(d, f"holiday {i % 7}") for i, d in enumerate(days)]
    holidays += [(days[3], "second"), (days[4], None), (days[5], "holiday 5"), (days[5], "holiday 5")]
    return foot, weather, holidays


@pytest.fixture(scope="module", params=[False, True], ids=["unique", "copies"])
def world(request, spark):
    rows = make_world(copies=request.param)
    frames = [spark.createDataFrame(r, s) for r, s in zip(rows, [FOOTFALL, WEATHER_HISTORY, HOLIDAYS])]
    con = duckdb.connect()
    for name, frame in zip(["footfall", "weather", "holidays"], frames):
        con.register(f"{name}_in", zoneless(frame).toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_in")
    return *frames, con


# equal hours in one order in both engines
ROLLING = oracle.ROLLING.replace('ORDER BY "timestamp"', 'ORDER BY "timestamp", total_footfall')


def by_city(footfall):
    return footfall.filter("city = 'A'"), footfall.filter("city = 'B'")


@pytest.mark.parametrize("span_days", [3, 40, 731])
def test_frames_do_not_depend_on_spans(world, span_days):
    footfall, weather, _, con = world
    got = with_trailing_features(joins.with_hourly_weather(footfall, weather), span_days).select(
        "city", "footfall_location", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "total_footfall",
        "footfall_90_day_average", "snow_24_hour_total", "rain_24_hour_total",
    )
    columns = ", ".join(f'"{c}"' for c in got.columns)
    # wholly equal rows remain, of which one has the same place in every frame
    sql = f"WITH {ROLLING} SELECT {columns} FROM rolling WHERE footfall_location IS NOT NULL"
    assert differences(got, con, sql) == []


@pytest.mark.parametrize("span_days", [40, 731])
def test_reporting_view_equals_the_self_join(world, span_days):
    footfall, weather, holidays, con = world
    got = reporting.footfall_complete_weather(*by_city(footfall), weather, holidays, span_days)
    assert differences(got, con, f"WITH {ROLLING} {oracle.REPORTING}") == []


def test_training_view_equals_the_self_join(world):
    footfall, weather, holidays, con = world
    got = reporting.model_input_data_daily(*by_city(footfall), weather, holidays, "1997-01-01", "1998-12-31", 40)
    assert differences(got, con, f"WITH {ROLLING} {oracle.TRAINING}") == []


def test_excluded_stretch_ends_at_midnight_of_its_last_day(spark):
    at = [dt.datetime(2022, 12, 31, h) for h in (0, 1)]
    foot = spark.createDataFrame([("A", "x", m, 10 + m.hour) for m in at], FOOTFALL)
    weather = spark.createDataFrame([("A", m, 1.0, 1, 1, 1, 1.0, None, None) for m in at], WEATHER_HISTORY)
    none = spark.createDataFrame([], HOLIDAYS)
    row = reporting.model_input_data_daily(foot, foot.limit(0), weather, none).first()
    assert (row.total_footfall, row.bank_holiday, row.weekday, row.month) == (11, 0, "Saturday", "Dec")


def test_two_holidays_count_a_day_twice_unless_told_otherwise(spark):
    at = dt.datetime(2023, 5, 1, 9)
    foot = spark.createDataFrame([("A", "x", at, 10)], FOOTFALL)
    weather = spark.createDataFrame([("A", at, 1.0, 1, 1, 1, 1.0, 1.0, None)], WEATHER_HISTORY)
    days = spark.createDataFrame([(at.date(), "one"), (at.date(), "two")], HOLIDAYS)
    view = reporting.model_input_data_daily
    assert view(foot, foot.limit(0), weather, days).first().total_footfall == 20
    assert view(foot, foot.limit(0), weather, days, dedupe_holidays=True).first().total_footfall == 10


def test_scoring_input_with_repeats_and_gaps(spark):
    day = dt.date(2024, 3, 10)
    foot = [("A", "x", dt.datetime(2024, 3, 9, h), 10) for h in range(3)]
    foot += [("A", "x", dt.datetime(2024, 3, 1), 4), ("A", "x", dt.datetime(2023, 12, 10), 99), ("A", "x", dt.datetime(2024, 3, 10), 99)]
    foot += [("C", "no forecast", dt.datetime(2024, 3, 9), 7)]
    rows = [("A", day, 1.0, 4.0, 1, 2, 3, 4.0, 0.5, 0.0), ("A", day + dt.timedelta(3), 1.0, 2.0, 1, 2, 3, 4.0, 0.0, 0.0)]
    past = [("A", dt.datetime(2024, 3, 9, h), 1.0, 1, 1, 1, 1.0, 1.25, None) for h in (1, 2)]
    got = scoring.scoring_input(
        spark.createDataFrame(foot, FOOTFALL),
        spark.createDataFrame(rows, FORECASTS),
        spark.createDataFrame(past, WEATHER_HISTORY),
        spark.createDataFrame([(day, "fair")], HOLIDAYS),
        day,
    ).orderBy("city", "date").collect()
    assert [(r.city, r.date, r.bank_holiday, r.rolling_footfall) for r in got] == [
        ("A", day, 1, 17.0), ("A", day + dt.timedelta(3), 0, 17.0), ("C", None, 0, 7.0),
    ]
    # the first day takes what was observed, the next the row before it, however long ago
    assert [(r.rain_24_hour, r.snow_24_hour, r.temp) for r in got[:2]] == [(2.5, None, 2.5), (0.5, 0.0, 1.5)]
    twice = spark.createDataFrame(rows[:1] * 2, FORECASTS)
    assert scoring.weather_carry(twice, spark.createDataFrame(past, WEATHER_HISTORY)).first().rain_24_hour == 5.0


def test_union_keeps_rows_both_cities_have(spark):
    rows = [("A", "x", START, 1), ("A", "x", START, 1), ("A", "x", START, 2)]
    df = conform(spark.createDataFrame(rows, FOOTFALL), FOOTFALL)
    assert joins.footfall_complete(df, df).count() == 4


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_view_plan(spark, world):
    footfall, weather, holidays, _ = world
    view = reporting.footfall_complete_weather(*by_city(footfall), weather, holidays)
    view.collect()
    plan = plan_of(view).split("== Initial Plan ==")[0]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the hourly rows move once for all windows and for the daily sums above them
    assert "ReusedExchange" in plan
    moved = [line.split("hashpartitioning(")[1].split(")")[0] for line in plan.splitlines()
             if "Exchange hashpartitioning(" in line and "ReusedExchange" not in line]
    # the rows and the copies that spans reach back to move together
    assert sum("span#" in keys for keys in moved) == 1


def test_one_hot_series_is_spread_over_tasks(spark):
    """A location with most of all rows: its windows run as many groups, none of them large."""
    moments = spark.range(6 * 365 * 24).select(
        F.lit("A").alias("city"),
        F.lit("hot").alias("footfall_location"),
        (F.lit("2015-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        (F.col("id") % 97).alias("total_footfall"),
    )
    hourly = moments.withColumns({m: F.lit(1.0) for m in joins.WEATHER_MEASURES})
    out = with_trailing_features(hourly, span_days=60)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # so little data would run as one task
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset(key)
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 2
    assert out.groupBy("span").count().agg(F.max("count")).first()[0] <= 60 * 24
    last = out.orderBy(F.desc("timestamp")).first()
    assert last.rain_24_hour_total == 24.0
    assert last.footfall_90_day_average == sum((6 * 365 * 24 - 1 - 24 * k) % 97 for k in range(1, 91)) / 90


def test_copies_and_weather_share_one_shuffle(spark, tmp_path):
    """With no side small, each table moves once for the removal of copies and the weather join."""
    rows = spark.range(500).select(
        F.lit("A").alias("city"), F.lit("x").alias("footfall_location"),
        (F.lit("2020-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        F.col("id").alias("total_footfall"),
    )
    rows.write.parquet(str(tmp_path / "f"))
    rows.select("city", F.col("timestamp").alias("date"), *[F.lit(1.0).alias(m) for m in joins.WEATHER_MEASURES]).write.parquet(str(tmp_path / "w"))
    footfall, weather = spark.read.parquet(str(tmp_path / "f")), spark.read.parquet(str(tmp_path / "w"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        both = joins.with_hourly_weather(joins.footfall_complete(footfall.filter("total_footfall % 2 = 0"), footfall), weather)
        assert both.count() == 750
        plan = plan_of(both)
    finally:
        spark.conf.set(key, before)
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 2


def test_rows_without_a_location_go_round_the_windows(spark):
    """Most rows have no location: no window sees them, and their days are summed by task first."""
    rows = spark.range(20_000).select(
        F.lit("A").alias("city"),
        F.when(F.col("id") % 50 == 0, "x").alias("footfall_location"),
        (F.lit("2020-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        F.lit(2).cast("bigint").alias("total_footfall"),
    )
    measures = {m: F.lit(1.0) for m in joins.WEATHER_MEASURES}
    weather = rows.select("city", F.col("timestamp").alias("date")).withColumns(measures)
    known, unknown = reporting.weighted_hours(rows, weather)
    assert "Window" not in plan_of(unknown) and known.filter("footfall_location IS NULL").isEmpty()
    days = reporting.daily_partials(known, unknown)
    got = days.groupBy("footfall_location").agg(F.sum("total_footfall").alias("n"), F.count("rolling").alias("rolled")).collect()
    assert {r.footfall_location: r.n for r in got} == {None: 39_200, "x": 800}
    assert {r.footfall_location: r.rolled for r in got}[None] == 0


@pytest.fixture
def no_broadcast(spark):
    """As when no side is small: joins sort and merge."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def assert_no_broadcast(view):
    plan = plan_of(view)
    assert "Broadcast" not in plan and "SortMergeJoin" in plan and "CartesianProduct" not in plan


def test_view_without_any_broadcast(no_broadcast, world):
    footfall, weather, holidays, con = world
    view = reporting.footfall_complete_weather(*by_city(footfall), weather, holidays, 40)
    assert differences(view, con, f"WITH {ROLLING} {oracle.REPORTING}") == []
    assert_no_broadcast(view)


def test_training_view_without_any_broadcast(no_broadcast, world):
    footfall, weather, holidays, con = world
    view = reporting.model_input_data_daily(*by_city(footfall), weather, holidays, "1997-01-01", "1998-12-31")
    assert differences(view, con, f"WITH {ROLLING} {oracle.TRAINING}") == []
    assert_no_broadcast(view)


def test_frames_without_any_broadcast(no_broadcast, world):
    """Rows move by series and cell for the table of spans, then by span; no task holds a whole series for either."""
    footfall, weather, _, con = world
    got = with_trailing_features(joins.with_hourly_weather(footfall, weather), 40)
    assert got.count() == con.execute("SELECT count(*) FROM footfall f JOIN weather w ON f.timestamp = w.date AND f.city = w.city WHERE footfall_location IS NOT NULL").fetchone()[0]
    rows = [line for line in plan_of(got).split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning(" in line and "total_footfall" not in line]
    assert any("cell#" in line for line in rows) and sum("span#" in line for line in rows) == 1


def test_equal_rows_have_one_place_in_all_frames(spark):
    """Rows equal in all columns: every run, however dealt, gives the same rows in all columns at once."""
    rng = random.Random(5)
    rows = []
    for h in range(24 * 130):
        row = ("A", "x", START + dt.timedelta(hours=h), rng.randrange(4), *[1.0] * 5, rng.choice([None, 0.0, 2.0]), rng.choice([None, 1.0]))
        rows += [row] * rng.choice([1, 1, 1, 2, 3])
    schema = "city string, footfall_location string, timestamp timestamp, total_footfall long, temp double, pressure double, humidity double, clouds double, wind double, rain double, snow double"
    frame = spark.createDataFrame(rows, schema)
    key, found = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(key)
    for parts, span_days in [("8", 731), ("3", 731), ("8", 11), ("5", 2)]:
        spark.conf.set(key, parts)
        try:
            got = with_trailing_features(frame.repartition(int(parts), "total_footfall", "rain"), span_days).drop("span")
            found.append(sorted(map(repr, got.collect())))
        finally:
            spark.conf.set(key, before)
    assert len(found[0]) == len(rows) and all(f == found[0] for f in found[1:])


@pytest.mark.parametrize("step", [60, 7], ids=["minutes", "seven seconds"])
def test_finer_grain_keeps_groups_bounded(spark, step):
    """The rows of a span are bounded by their number, not by days: other grains need no other setting."""
    rows = spark.range(150_000).select(
        F.lit("A").alias("city"), F.lit("x").alias("footfall_location"),
        F.timestamp_seconds(F.lit(849398400) + F.col("id") * step).alias("timestamp"), (F.col("id") % 7).alias("total_footfall"),
    ).withColumns({m: F.lit(1.0) for m in joins.WEATHER_MEASURES})
    got = with_trailing_features(rows, 40)
    cell = 86400 // step + 1  # a day
    sizes = [r["count"] for r in got.groupBy("span").count().collect()]
    assert sum(sizes) == 150_000 and max(sizes) < 40 * 24 + cell and len(sizes) > 10
    last = got.orderBy(F.desc("timestamp")).first()
    hour = lambda i: i * step // 3600 % 24
    before = [i % 7 for i in range(149_998, 0, -1) if hour(i) == hour(149_999)][:90]
    assert (last.rain_24_hour_total, last.footfall_90_day_average) == (24.0, sum(before) / 90)
