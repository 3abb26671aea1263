"""JSON documents, landing, history refresh, sinks and the model."""

import contextlib
import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from kerbside.operators import history
from kerbside.plans import loads, model, scoring
from kerbside.schemas import FOOTFALL, FORECASTS, HOLIDAYS, WEATHER_HISTORY
from kerbside.session import setting, staging_path
from kerbside.sources import json_docs, tables

HOUR = dt.datetime(2023, 7, 15)


def docs(spark, *bodies):
    return spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "body string")


def epoch(moment):
    return int(moment.replace(tzinfo=dt.timezone.utc).timestamp())


def test_forecast(spark):
    day = {"dt": epoch(HOUR), "temp": {"min": 283.15, "max": 293.15}, "pressure": 1, "humidity": 2, "clouds": 3, "speed": 4.5}
    body = {"Leeds": {"list": [day, {**day, "rain": 1.5, "snow": None}]}, "York": {"list": []}}
    rows = json_docs.flatten_forecast(docs(spark, body)).collect()
    assert [(r.city, r.date, r.min_temp, r.rain, r.snow) for r in rows] == [
        ("Leeds", HOUR.date(), 283.15 - 273.15, 0.0, 0.0), ("Leeds", HOUR.date(), 283.15 - 273.15, 1.5, 0.0),
    ]


def history_entry(moment, kelvin=288.4, **more):
    return {"dt": epoch(moment), "main": {"temp": kelvin, "pressure": 1, "humidity": 2}, "clouds": {"all": 3}, "wind": {"speed": 4.0}, **more}


def test_history(spark):
    body = {"Leeds": {"list": [history_entry(HOUR, rain={"1h": 0.3}), history_entry(HOUR, snow={})]}}
    rows = json_docs.flatten_history(docs(spark, body)).collect()
    assert [(r.date, r.temp, r.rain, r.snow) for r in rows] == [(HOUR, 15.2, 0.3, 0.0), (HOUR, 15.2, 0.0, 0.0)]
    local = json_docs.flatten_history(docs(spark, body), "Europe/London").first()
    assert local.date == HOUR + dt.timedelta(hours=1)


def test_temperatures_round_like_the_service_clients(spark):
    kelvins = [273.15 + t for t in (0.25, 15.25, -3.45, 7.35, 20.05)] + [288.4, 270.0, 291.79]
    body = {"Leeds": {"list": [history_entry(HOUR + dt.timedelta(hours=i), k) for i, k in enumerate(kelvins)]}}
    rows = json_docs.flatten_history(docs(spark, body)).orderBy("date").collect()
    assert [r.temp for r in rows] == [round(k - 273.15, 1) for k in kelvins]


def test_broken_documents_fail(spark):
    with pytest.raises(Exception):
        json_docs.flatten_history(docs(spark, "{'Leeds': oops")).collect()


def test_holidays(spark):
    def day(date, name, counties):
        return {"date": date, "name": name, "localName": name.lower(), "counties": counties}

    year = [
        day("2023-01-02", "New Year", None),
        day("2023-03-17", "Saint Patrick's Day", ["GB-NIR"]),
        day("2023-05-01", "May Day", ["GB-ENG", "GB-WLS"]),
        day("2023-07-12", "Orangemen", ["GB-NIR"]),
    ]
    kept = json_docs.flatten_holidays(docs(spark, [year, [day("2024-01-01", "New Year", None)]])).orderBy("date").collect()
    assert [(str(r.date), r.name) for r in kept] == [
        ("2023-01-02", "new year"), ("2023-03-17", "saint patrick's day"), ("2023-05-01", "may day"), ("2024-01-01", "new year"),
    ]


def test_landing_keeps_documents_whole(spark, tmp_path):
    body = json.dumps({"Leeds": {"list": [history_entry(HOUR)]}}, indent=2)
    path = tables.land_json_run(docs(spark, body, body), str(tmp_path), "2023-07-16 01-00-00")
    landed = tables.read_json_runs(spark, path)
    assert landed.count() == 2 and json_docs.flatten_history(landed).count() == 2


def weather(spark, hours, temp):
    rows = [(c, h, temp, 1, 1, 1, 1.0, 0.0, None) for c in ("Leeds", "York") for h in hours]
    return spark.createDataFrame(rows, WEATHER_HISTORY)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_both_refreshes_agree_and_repeat_without_change(spark, tmp_path):
    hours = [HOUR + dt.timedelta(hours=h) for h in range(-60 * 24, 60 * 24, 5)]
    late = [h for h in hours if HOUR <= h < HOUR + dt.timedelta(days=4)][::2] + [HOUR + dt.timedelta(hours=1)]
    old, new = weather(spark, hours, 1.0), weather(spark, late, 2.0)
    whole = tables.VersionedTable(spark, str(tmp_path / "whole"), WEATHER_HISTORY)
    whole.replace(old)
    history.refresh_table(whole, new)
    expected = rows_of(whole.read())
    assert len(expected) == 2 * (len(hours) + 1)
    history.refresh_table(whole, new)
    assert rows_of(whole.read()) == expected
    for unit in ("month", "day"):
        parts = tables.PeriodTable(spark, str(tmp_path / unit), WEATHER_HISTORY, unit)
        if unit == "day":
            old = old.filter(F.col("date") >= "2023-07-10")  # few folders are enough
            expected = [r for r in expected if r[1] >= dt.datetime(2023, 7, 10)]
        parts.write_periods(old)
        for _ in range(2):
            history.refresh_days(parts, new, "2023-07-15", "2023-07-19")
            assert rows_of(parts.read()) == expected


def test_slice_replaces_whole_days_only(spark, tmp_path):
    hours = [HOUR + dt.timedelta(hours=h) for h in range(72)]
    table = tables.PeriodTable(spark, str(tmp_path / "slices"), WEATHER_HISTORY)
    table.replace_days(weather(spark, hours, 1.0), "2023-07-15", "2023-07-18")
    table.replace_days(weather(spark, hours[24:30], 2.0), "2023-07-16", "2023-07-17")
    kept = table.read()
    assert kept.filter("temp = 2").count() == 12 and kept.count() == 2 * (48 + 6)
    assert table.read_periods("2023-08-01", "2023-09-01").count() == 0


def test_versions(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"), WEATHER_HISTORY)
    with pytest.raises(FileNotFoundError):
        table.read()
    for temp in (1.0, 2.0, 3.0):
        table.replace(weather(spark, [HOUR], temp))
    assert {r.temp for r in table.read().collect()} == {3.0}
    before = table.read()
    table.drop_superseded()
    assert before.count() == 2 and len(table.versions()) == 3
    assert {r.temp for r in table.read().collect()} == {3.0}


def test_a_write_that_dies_leaves_the_table_whole(spark, tmp_path, monkeypatch):
    whole = tables.VersionedTable(spark, str(tmp_path / "t"), WEATHER_HISTORY)
    parts = tables.PeriodTable(spark, str(tmp_path / "p"), WEATHER_HISTORY)
    old, new = weather(spark, [HOUR], 1.0), weather(spark, [HOUR], 2.0)
    whole.replace(old)
    parts.write_periods(old)

    def die(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables.Versions, "_commit", die)  # after the data, before the swap
    for write in (lambda: whole.replace(new), lambda: parts.write_periods(new)):
        with pytest.raises(KeyboardInterrupt):
            write()
    monkeypatch.undo()
    bad = new.withColumn("temp", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        whole.replace(bad)
    assert {r.temp for r in whole.read().collect()} == {r.temp for r in parts.read().collect()} == {1.0}
    whole.replace(new)
    assert {r.temp for r in whole.read().collect()} == {2.0}


def test_no_update_is_lost(spark, tmp_path):
    for kind in (tables.VersionedTable, tables.PeriodTable):
        one, two = (kind(spark, str(tmp_path / kind.__name__), WEATHER_HISTORY) for _ in range(2))
        write = "replace" if kind is tables.VersionedTable else "write_periods"
        getattr(one, write)(weather(spark, [HOUR], 1.0))
        one.read(), two.read()
        getattr(one, write)(weather(spark, [HOUR], 2.0))
        with pytest.raises(tables.ConcurrentUpdateError):
            getattr(two, write)(weather(spark, [HOUR], 3.0))
        assert {r.temp for r in two.read().collect()} == {2.0}


def test_rows_outside_the_range_are_refused(spark, tmp_path):
    table = tables.PeriodTable(spark, str(tmp_path / "t"), WEATHER_HISTORY)
    table.write_periods(weather(spark, [dt.datetime(2023, 6, 2)], 1.0))
    with pytest.raises(Exception, match="not in 2023-07-01"):
        table.replace_days(weather(spark, [dt.datetime(2023, 6, 1)], 2.0), "2023-07-01", "2023-07-02")
    assert table.read().count() == 2


def test_sources_land_in_turn(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1, "a.csv"), ("B", 2, "b.csv")], "name string, n int, source_file string")
    for name in ("a.csv", "b.csv", "b.csv"):
        tables.write_csv_by_source(rows.filter(F.col("source_file") == name), str(tmp_path / "raw"))
    kept = tables.read_csv(spark, str(tmp_path / "raw"), rows.schema)
    assert rows_of(kept) == rows_of(rows)


def test_sources_of_one_task_beyond_the_open_files(spark, tmp_path):
    """More sources than a task keeps open come through whole, with rows of no source, and no setting stays."""
    n = 3 * tables.OPEN_SOURCES
    source = F.when(F.col("id") % n != 7, F.concat(F.lit("s "), (F.col("id") % n).cast("string"), F.lit(".csv")))
    rows = spark.range(0, 20 * n, 1, 1).select("id", F.lit("a, \"b\"").alias("text"), source.alias("source_file"))
    key = "spark.sql.maxConcurrentOutputFileWriters"
    for before in (None, "3"):
        with setting(spark, key, before) if before else contextlib.nullcontext():
            tables.write_csv_by_source(rows.coalesce(1), str(tmp_path / "raw"))
            assert spark.conf.get(key, None) == before
        assert rows_of(tables.read_csv(spark, str(tmp_path / "raw"), rows.schema)) == rows_of(rows)
    assert spark.conf.get(key, None) is None


def test_memory_of_landing_one_source_does_not_grow_with_its_rows(tmp_path):
    """The rows of a source that one input task has go to one task; that must not hold them."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession, functions as F
from kerbside.session import configure
from kerbside.sources import tables
conf = {{"spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": {(tmp_path / 'log').as_uri()!r},
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}}
spark = configure(SparkSession.builder.master("local[2]").config(map=conf).getOrCreate())
for n in (1_000, 2_000_000):
    at = {str(tmp_path)!r} + f"/{{n}}"
    spark.range(0, n, 1, 1).withColumn("source_file", F.when(F.col("id") >= 0, "y.csv")).write.parquet(at + "-staged")
    tables.write_csv_by_source(spark.read.parquet(at + "-staged"), at + "-landed")
    print("ROWS", spark.read.option("header", "true").csv(at + "-landed").count())
spark.stop()
"""
    (tmp_path / "log").mkdir()
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_ENV_LOADED")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["ROWS", "1000", "ROWS", "2000000"], done.stderr[-2000:]
    (log,) = (tmp_path / "log").iterdir()
    ends = [e for e in map(json.loads, log.read_text().splitlines()) if e["Event"] == "SparkListenerTaskEnd"]
    written = [e["Task Metrics"]["Output Metrics"]["Records Written"] for e in ends]
    assert sum(written) == 2 * 2_001_000, written  # staged and landed
    assert max(e["Task Metrics"]["Peak Execution Memory"] for e in ends) < 32 * 2**20


def test_csv_cells_that_do_not_fit_fail(spark, tmp_path):
    (tmp_path / "x.csv").write_text("date,name\nsoon,x\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path / "x.csv"), HOLIDAYS).collect()


def test_line_breaks_come_through(spark, tmp_path):
    day = {"date": "2023-01-02", "name": "x", "localName": "New\nYear", "counties": None}
    path = tables.land_json_run(docs(spark, [[day]]), str(tmp_path / "raw"), "r1")
    at = [str(tmp_path / n) for n in ("csv", "table")]
    for _ in range(2):  # a run can be repeated
        assert [r.name for r in loads.load_holidays(spark, path, *at, "r1").collect()] == ["New\nYear"]
    assert [r.name for r in tables.read_csv(spark, f"{at[0]}/run_ts=r1", HOLIDAYS).collect()] == ["New\nYear"]


def test_history_load_over_several_days(spark, tmp_path):
    days = [HOUR + dt.timedelta(days=d) for d in range(4)]
    bodies = [{"Leeds": {"list": [history_entry(d + dt.timedelta(hours=h)) for h in range(24)]}} for d in days]
    path = tables.land_json_run(docs(spark, *bodies), str(tmp_path / "raw"), "r1")
    at = [str(tmp_path / n) for n in ("csv", "slices", "complete")]
    table = loads.load_history(spark, path, *at, "r1", "2023-07-15", "2023-07-18")
    assert table.count() == 72
    again = loads.load_history(spark, path, *at, "r2", "2023-07-17", "2023-07-19")
    assert again.count() == 96


def test_typed_sink_rejects_what_does_not_fit(spark, tmp_path):
    bad = spark.createDataFrame([("A", "x", "2023-07-15 00:00:00", "many")], "city string, footfall_location string, timestamp string, total_footfall string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        tables.write_table(bad, str(tmp_path / "t"), FOOTFALL)


def test_staging_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = staging_path(spark, "x")
    assert path.startswith(root or spark.conf.get("spark.checkpoint.dir"))
    assert FORECASTS.names[:2] == ["city", "date"]


@pytest.fixture(scope="module")
def training(spark):
    rows = [
        ("A", f"l{i % 4}", day, "Jan", i % 2, 100 * (i % 4) + i % 7, float(i % 5), float(i % 3) if i % 6 else None)
        for i, day in enumerate(["Monday", "Tuesday", "Sunday"] * 40)
    ]
    return spark.createDataFrame(
        rows, "city string, footfall_location string, weekday string, month string, bank_holiday int, "
        "total_footfall long, rolling_footfall double, snow_24_hour double")


def test_model(spark, training, tmp_path):
    fitted = model.train(training)
    model.save(fitted, str(tmp_path / "m"))
    new = training.drop("total_footfall").limit(20).withColumn("date", F.lit("2024-01-01").cast("date"))
    new = new.withColumn("footfall_location", F.when(F.col("bank_holiday") == 1, "unseen").otherwise(F.col("footfall_location")))
    scored = model.predict(model.load(spark, str(tmp_path / "m")), new)
    assert scored.columns == [*new.columns, "predicted_footfall"] and dict(scored.dtypes)["bank_holiday"] == "int"
    values = [r.predicted_footfall for r in scored.collect()]
    assert len(values) == 20 and all(v == round(v) for v in values)
    same = model.predict(model.train(training), new)
    assert [r.predicted_footfall for r in same.collect()] == values


def test_model_fits_and_reports_it(spark):
    rows = spark.range(560).select(
        F.lit("A").alias("city"), F.concat(F.lit("l"), F.col("id") % 20).alias("footfall_location"),
        F.element_at(F.array(*map(F.lit, "abcdefg")), (F.floor(F.col("id") / 20) % 7 + 1).cast("int")).alias("weekday"),
        F.concat(F.lit("m"), F.floor(F.col("id") / 140)).alias("month"), F.lit(0).alias("bank_holiday"),
        (100 * (F.col("id") % 20) + F.col("id") % 7).alias("total_footfall"), F.lit(1.0).alias("temp"),
    )
    report = model.fit_report(rows).first()
    assert 80 < report.n < 220 and report.explained > 0.75
    assert report.mean_absolute_error < 0.4 * report.mean_absolute_error_of_mean


def test_encoding_is_one_at_any_size(spark):
    """Many values and few are encoded alike, and unseen ones get the overall mean."""
    rows = spark.range(3000).select(
        F.lit("A").alias("city"), F.concat(F.lit("l"), F.col("id") % 1500).alias("footfall_location"), F.lit("Monday").alias("weekday"),
        F.lit("Jan").alias("month"), F.lit(0).alias("bank_holiday"), (F.col("id") % 1500).alias("total_footfall"), F.lit(1.0).alias("temp"),
    )
    fitted = model.train(rows, num_trees=5)
    assert fitted.encoding.filter("column = 'footfall_location' AND mean = cast(substr(value, 2) AS double) AND n = 2").count() == 1500
    new = rows.limit(1).withColumn("footfall_location", F.lit("new")).drop("total_footfall")
    assert 500 < model.predict(fitted, new).first().predicted_footfall < 1000


def test_a_long_log_is_read_from_its_last_whole_commit(spark, tmp_path, monkeypatch):
    """Whoever comes anew reads few commits, and those who know some read the later ones, with the same parts."""
    monkeypatch.setattr(tables.Versions, "WHOLE_EVERY", 4)
    root, asked, told = str(tmp_path / "t"), [], {}
    plain = tables.Versions._commit_path
    writers = [tables.PeriodTable(spark, root, WEATHER_HISTORY) for _ in range(2)]
    for n in range(1, 12):
        month = dt.datetime(2023, 1 + n * n % 5, 2)
        writers[n % 3 == 0].write_periods(weather(spark, [month], float(n)))
        told[str(month.date().replace(day=1))] = float(n)
        if n in (1, 3, 4, 7, 8, 11):
            late = tables.PeriodTable(spark, root, WEATHER_HISTORY)
            monkeypatch.setattr(tables.Versions, "_last", lambda self, n=n: n)
            monkeypatch.setattr(tables.Versions, "_commit_path", lambda self, seq: asked.append(seq) or plain(self, seq))
            assert late.snapshot() == writers[0].snapshot() == writers[1].snapshot()
            monkeypatch.undo()
            monkeypatch.setattr(tables.Versions, "WHOLE_EVERY", 4)
            assert min(asked) >= n - n % 4 and late.snapshot().seq == n
            asked.clear()
            assert {(str(r.date.date().replace(day=1)), r.temp) for r in late.read().collect()} == set(told.items())
    assert len(told) > 2


def test_the_last_commit_is_found(spark, tmp_path):
    """By a few questions, from any commit before it."""
    for last in (0, 1, 2, 3, 7, 8, 9, 40):
        table = tables.Versions(spark, str(tmp_path / str(last)), WEATHER_HISTORY)
        for seq in range(1, last + 1):
            (tmp_path / str(last) / "commits" / f"{seq:020d}").mkdir(parents=True)
        for known in range(last + 1):
            table._known = tables.Snapshot(known, {})
            assert table._last() == last


@pytest.mark.parametrize("kind", ["VersionedTable", "PeriodTable"])
@pytest.mark.parametrize("first", ["one", "two"])
def test_of_two_commits_at_one_moment_one_succeeds(spark, tmp_path, monkeypatch, kind, first):
    """The second writer commits between the first one's last look and its rename."""
    one, two = (getattr(tables, kind)(spark, str(tmp_path / "t"), WEATHER_HISTORY) for _ in range(2))
    write = "replace" if kind == "VersionedTable" else "write_periods"
    getattr(one, write)(weather(spark, [HOUR], 1.0))
    one.read(), two.read()
    early, late = (one, two) if first == "one" else (two, one)
    publish, inner = tables.publish, []

    def between(*args):
        if not inner:
            inner.append(True)
            getattr(early, write)(weather(spark, [HOUR], 2.0))
        return publish(*args)

    monkeypatch.setattr(tables, "publish", between)
    with pytest.raises(tables.ConcurrentUpdateError):
        getattr(late, write)(weather(spark, [HOUR], 3.0))
    monkeypatch.undo()
    assert {r.temp for r in late.read().collect()} == {2.0} and late.snapshot().seq == 2
    getattr(late, write)(weather(spark, [HOUR], 4.0))
    assert {r.temp for r in early.read().collect()} == {4.0}


def test_look_back_reads_few_files(spark, tmp_path):
    """Files of a table by time hold ranges of it: a look-back of 90 days finds rows in few of them."""
    rows = spark.range(6 * 365 * 24).select(
        F.lit("A").alias("city"), F.concat(F.lit("x"), F.col("id") % 5).alias("footfall_location"),
        (F.lit("2018-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        (F.col("id") % 97).alias("total_footfall"),
    ).repartition(6)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # so little data would be one file
    try:
        table = tables.VersionedTable(spark, str(tmp_path / "t"), FOOTFALL, by="timestamp")
        table.replace(rows)
    finally:
        spark.conf.unset(key)
    files = table.read().select("_metadata.file_path", "_metadata.row_index", "timestamp")
    every = files.select("file_path").distinct().count()
    wanted = scoring.last_days(files, "2023-12-01")
    assert every >= 8 and wanted.select("file_path").distinct().count() <= 2
    assert wanted.count() == 90 * 24
    bounds = files.groupBy("file_path").agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high")).orderBy("low").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(bounds, bounds[1:]))


def test_no_task_holds_a_city(spark):
    """Locations of one city, and no side broadcast: the join with the days is spread."""
    foot = spark.range(20_000).select(
        F.lit("A").alias("city"), F.concat(F.lit("place "), F.col("id").cast("string")).alias("footfall_location"),
        F.lit("2024-03-09 10:00:00").cast("timestamp").alias("timestamp"), F.lit(5).cast("long").alias("total_footfall"),
    )
    days = [("A", dt.date(2024, 3, 10 + i), 1.0, 4.0, 1, 2, 3, 4.0, 0.5, 0.0) for i in range(2)]
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        rows = scoring.scoring_input(
            foot, spark.createDataFrame(days, FORECASTS), spark.createDataFrame([], WEATHER_HISTORY), spark.createDataFrame([], HOLIDAYS), "2024-03-10"
        )
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 40_000 and max(sizes) < 12_000


def test_no_label_is_in_its_own_mean(spark):
    """Cross-fitted means: changing a row's label leaves the means it is encoded by as they were."""
    schema = "city string, footfall_location string, weekday string, month string, bank_holiday int, total_footfall long"
    rows = [("A", f"x{i % 3}", f"day {i % 7}", f"month {i % 12}", i % 2, 10 * i) for i in range(60)] + [(None, "only", "day 0", "month 0", 0, 5)]
    means = lambda own: {(r["column"], r["value"], r["fold"]): r["mean"] for r in model.cross_means(spark.createDataFrame(own, schema)).collect()}
    plain = means(rows)
    frame = spark.createDataFrame(rows, schema).withColumn("fold", model.fold())
    folds = [r["fold"] for r in frame.collect()]
    changed = means([(*r[:5], r[5] + 1000) if f == 2 else r for r, f in zip(rows, folds)])
    assert {k: v for k, v in plain.items() if k[2] == 2} == {k: v for k, v in changed.items() if k[2] == 2}
    assert all(plain[k] < changed[k] for k in plain if k[2] != 2)
    others = [r[5] for r, f in zip(rows, folds) if f != folds[-1]]
    assert abs(plain["city", None, folds[-1]] - sum(others) / len(others)) < 1e-9  # no other fold has it
