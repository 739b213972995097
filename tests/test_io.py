from __future__ import annotations

import glob
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from stopweave.schemas import STOP_VISITS_CSV
from stopweave.session import job_tables, settings, shared_folder, stored
from stopweave.sources import readers, writers

HEADER = (
    "cardNum,route,busCode,tripNum,stopPointId,timestamp,date,shapeId,shapeSequence,shapeLat,"
    "shapeLon,distanceTraveledShape,cardTimestamp,problem,numPassengers"
)


def write_day(base, day, *lines):
    folder = base / day
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture
def days(tmp_path):
    for day in ("2024_01_01", "2024_01_02", "2024_01_04"):
        write_day(
            tmp_path,
            day,
            f"77,020,B1,1,5,06:12:33,{day},7,3,-25.4,-49.2,100.5,06:12:30,NO_PROBLEM,3",
            f"-,A22,B1,x,-,25:00:00,{day},-,3,-25.4,-49.2,,-,BETWEEN,-",
        )
    return tmp_path


def test_stop_visits_are_typed_by_name(spark, days):
    df = readers.read_stop_visits(spark, f"{days}/2024_01_01")
    kinds = dict(df.dtypes)
    assert kinds["date"] == "date" and kinds["timestamp_s"] == "bigint" and kinds["tripNum"] == "int"
    first, second = df.orderBy("timestamp_s").collect()
    assert (first.cardNum, first.route, first.tripNum, first.stopPointId) == ("77", "020", 1, 5)
    assert (first.date, first.timestamp_s, first.cardTimestamp_s) == (date(2024, 1, 1), 22353, 22350)
    assert (second.cardNum, second.stopPointId, second.shapeId, second.cardTimestamp_s) == (None,) * 4
    assert (second.distanceTraveledShape, second.tripNum, second.timestamp_s) == (None, None, 90000)


def test_wrong_type_stops_a_strict_read(spark, days):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_stop_visits(spark, f"{days}/2024_01_01", mode="FAILFAST").collect()


def test_numeric_route(spark, days):
    df = readers.read_stop_visits(spark, f"{days}/2024_01_01", numeric_route=True)
    assert {r.route for r in df.collect()} == {20, None}


def test_record_keeps_its_id(spark, days):
    one = readers.read_stop_visits(spark, f"{days}/2024_01_01").select("visit_id")
    many = readers.read_stop_visits(spark, [f"{days}/2024_01_02", f"{days}/2024_01_01"])
    assert set(one.collect()) <= set(many.select("visit_id").collect())
    assert many.select("visit_id").distinct().count() == 4


def test_days_in_a_range_without_missing_ones(spark, days):
    df = readers.read_days(spark, str(days), date(2024, 1, 2), date(2024, 1, 31))
    assert {r.date.day for r in df.select("date").collect()} == {2, 4}
    with pytest.raises(ValueError):
        readers.day_folders("x", date(2024, 1, 2), date(2024, 1, 1))


def test_loads_of_the_older_form(spark, tmp_path):
    (tmp_path / "loads.csv").write_text(
        "route,date,busCode,tripNum,stopPointId,timestamp,shapeId,ext_num_pass\n"
        "020,1704153600,B1,1,5,06:12:33,7,2.5\n"
        "020,1704240000,B1,1,6,25:12:33,7,\n"
    )
    rows = {r.busStopId: r for r in readers.read_crowdedness(spark, str(tmp_path), "csv").collect()}
    assert (rows[5].date, rows[5].timestamp_s, rows[5].ext_num_pass) == (date(2024, 1, 2), 22353, 2.5)
    assert (rows[6].date, rows[6].timestamp_s, rows[6].ext_num_pass) == (date(2024, 1, 3), 90753, None)
    assert rows[5].visit_id != rows[6].visit_id
    late = readers.read_crowdedness(spark, str(tmp_path), "csv", start=date(2024, 1, 3))
    assert [r.busStopId for r in late.collect()] == [6]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_day_run_again_replaces_its_rows(spark, tmp_path, fmt):
    path = str(tmp_path / "table")
    table = spark.createDataFrame(
        [(date(2024, 1, d), n) for d in (1, 2) for n in range(5)], "date date, n int"
    )
    writers.write_table(table, path, sort_by=["n"], fmt=fmt)
    again = table.where("date = '2024-01-02' and n < 2").withColumn("n", F.col("n") + 100)
    writers.write_table(again, path, fmt=fmt)
    writers.write_table(again, path, fmt=fmt)
    back = readers.read_table(spark, path, table.schema, fmt)
    got = sorted((r.date.day, r.n) for r in back.collect())
    assert got == [(1, n) for n in range(5)] + [(2, 100), (2, 101)]
    only = readers.read_table(spark, path, table.schema, fmt, start=date(2024, 1, 2))
    assert only.count() == 2


def test_date_range_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "table")
    writers.write_table(spark.range(10).withColumn("date", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int"))), path)
    df = readers.read_table(spark, path, start=date(2024, 1, 3), end=date(2024, 1, 4))
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_report_lines(spark, tmp_path):
    metrics = spark.createDataFrame([(3, 1.5, 1.0, 0.25)], "n long, rmse double, mae double, r2 double")
    writers.write_report(metrics, str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines == ["Model:", "Model info", "RMSE: 1.500000", "MAE: 1.000000", "r2: 0.250000"]


def test_stored_table_lies_in_the_shared_folder(spark):
    df = stored(spark.range(5))
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 3, 4]
    assert all(shared_folder(spark) in f for f in df.inputFiles())


def test_settings_grow_with_the_input():
    small, large = settings(10**6, 8), settings(100 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "100000"
    assert large["spark.sql.files.maxPartitionBytes"] == str(10**9)


def test_schema_of_the_delivered_files_is_text_where_times_are():
    kinds = {f.name: f.dataType.simpleString() for f in STOP_VISITS_CSV}
    assert kinds["timestamp"] == kinds["cardTimestamp"] == kinds["route"] == "string"


COLUMNS = ("tripNum", "stopPointId", "timestamp", "date", "route", "busCode", "shapeLat", "shapeLon", "cardNum", "cardTimestamp")
RECORD = dict(zip(COLUMNS, ("7.0", "1", "06:00:00", "2024_01_01", "020", "B1", "-25.4", "-49.2", "77", "06:00:00")))


def write_columns(folder, names, *records):
    folder.mkdir(parents=True)
    lines = [",".join(names), *(",".join(r.get(n, "-") for n in names) for r in records)]
    (folder / "part-0.csv").write_text("\n".join(lines) + "\n")


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    turned = ("stopPointId", "tripNum", "shapeLon", "shapeLat", *(c for c in reversed(COLUMNS) if c not in ("stopPointId", "tripNum", "shapeLon", "shapeLat")))
    no_cards = tuple(c for c in COLUMNS if not c.startswith("card"))
    write_columns(tmp_path / "2024_01_01", COLUMNS, RECORD)
    write_columns(tmp_path / "2024_01_02", turned, RECORD | {"date": "2024_01_02"})
    write_columns(tmp_path / "2024_01_03", no_cards, RECORD | {"date": "2024_01_03"})
    together = readers.read_days(spark, str(tmp_path), date(2024, 1, 1), date(2024, 1, 3))
    names = sorted(together.columns)
    alone = [readers.read_stop_visits(spark, f"{tmp_path}/2024_01_0{k}").select(names) for k in (1, 2, 3)]
    rows = together.select(names).collect()
    assert sorted(map(str, rows)) == sorted(str(r) for df in alone for r in df.collect())
    assert {(r.tripNum, r.stopPointId, r.shapeLat, r.shapeLon) for r in rows} == {(7, 1, -25.4, -49.2)}
    assert {r.date.day: r.cardNum for r in rows} == {1: "77", 2: "77", 3: None}


def test_ids_follow_names_and_nulls(spark, tmp_path):
    write_columns(tmp_path / "a", COLUMNS, RECORD)
    write_columns(tmp_path / "b", (*reversed(COLUMNS), "extra"), RECORD | {"extra": "1"})
    write_columns(tmp_path / "c", COLUMNS, RECORD | {"tripNum": "-", "stopPointId": "7"}, RECORD | {"tripNum": "7", "stopPointId": "-"})
    ids = {d: [r.visit_id for r in readers.read_stop_visits(spark, f"{tmp_path}/{d}").collect()] for d in "abc"}
    assert ids["a"] == ids["b"] and len({*ids["a"], *ids["c"]}) == 3


def test_rejected_values_are_counted(spark, tmp_path):
    write_columns(tmp_path / "a", COLUMNS, RECORD, RECORD | {"tripNum": "7.5"}, RECORD | {"tripNum": "x", "shapeLat": "y"})
    got = {(r.date, r.column): r.rejected for r in readers.rejected_values(spark, f"{tmp_path}/a").collect()}
    assert got == {("2024_01_01", "tripNum"): 2, ("2024_01_01", "shapeLat"): 1}


def test_emptied_days_and_tables_disappear(spark, tmp_path):
    days = spark.range(10).withColumn("date", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")))
    path = str(tmp_path / "t")
    writers.write_table(days, path)
    writers.write_table(days.where("id in (2, 3)"), path, days=(date(2024, 1, 3), date(2024, 1, 6)))
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 6, 7, 8, 9]
    writers.write_table(days.where("id = 1"), path, replace="table")
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]


def test_tables_of_a_job_are_removed(spark):
    with pytest.raises(ZeroDivisionError), job_tables(spark) as folder:
        assert stored(spark.range(3)).count() == 3
        assert glob.glob(f"{folder.removeprefix('file:')}/table-*")
        raise ZeroDivisionError
    assert not glob.glob(f"{folder.removeprefix('file:')}*")


def lines_of(folder, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"part-{len(list(folder.iterdir()))}.csv").write_text("\n".join(lines) + "\n")


def test_blank_lines_before_a_header_lose_nothing(spark, tmp_path):
    record = ",".join(RECORD[c] for c in COLUMNS)
    lines_of(tmp_path / "a", ",".join(COLUMNS), record)
    lines_of(tmp_path / "odd name %41", "", " \t ", ",".join(COLUMNS), "", record, record)
    lines_of(tmp_path / "b", "", ",".join(reversed(COLUMNS)), ",".join(RECORD[c] for c in reversed(COLUMNS)))
    (tmp_path / "b" / "empty.csv").write_text("")
    (tmp_path / "b" / "blank.csv").write_text(" \n\n")
    found = readers.read_stop_visits(spark, f"{tmp_path}/*")
    assert found.count() == 4 and found.select("visit_id").distinct().count() == 1
    own = spark.read.option("header", True).csv(f"{tmp_path}/odd name %41")
    assert own.count() == 2
    assert readers.rejected_values(spark, f"{tmp_path}/*").isEmpty()


def test_a_file_without_a_header_is_refused(spark, tmp_path):
    lines_of(tmp_path / "a", ",".join(COLUMNS), ",".join(RECORD[c] for c in COLUMNS))
    lines_of(tmp_path / "b", "", ",".join(RECORD[c] for c in COLUMNS))
    with pytest.raises(ValueError, match="without a header"):
        readers.read_stop_visits(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "blank.csv").write_text("\n")
    with pytest.raises(ValueError, match="no CSV file with a header"):
        readers.read_stop_visits(spark, f"{tmp_path}/c")


def test_repeated_and_empty_names_are_told_apart(spark, tmp_path):
    lines_of(tmp_path / "a", 'route,Route,,"bus,Code",busCode', "020,1,2,3,B1")
    own = spark.read.option("header", True).csv(f"{tmp_path}/a")
    raw = readers._raw_csv(spark, f"{tmp_path}/a", "PERMISSIVE")
    assert raw.columns == own.columns and raw.collect() == own.collect()


def jobs_of(spark, action):
    tracker, group = spark.sparkContext.statusTracker(), f"group-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_take_as_many_jobs_for_many_files_as_for_two(spark, tmp_path):
    record = ",".join(RECORD[c] for c in COLUMNS)
    for k in range(25):
        lines_of(tmp_path / f"2024_01_{k + 1:02d}", "", ",".join(COLUMNS), record)
    few = jobs_of(spark, lambda: readers.read_days(spark, str(tmp_path), date(2024, 1, 1), date(2024, 1, 2)))
    many = jobs_of(spark, lambda: readers.read_days(spark, str(tmp_path), date(2024, 1, 1), date(2024, 1, 31)))
    assert 1 <= few == many <= 3


def test_one_scan_serves_records_and_rejected_values(spark, tmp_path):
    write_columns(tmp_path / "a", COLUMNS, RECORD, RECORD | {"tripNum": "x", "shapeLat": "y"})
    write_columns(tmp_path / "b", tuple(reversed(COLUMNS)), RECORD | {"date": "2024_01_02"})
    records = readers.read_stop_visits(spark, f"{tmp_path}/*", rejected=True)
    assert records._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    kept = stored(records)
    assert {(r.date, r.column): r.rejected for r in readers.count_rejected(kept).collect()} == {
        ("2024_01_01", "tripNum"): 1, ("2024_01_01", "shapeLat"): 1
    }
    plain = readers.read_stop_visits(spark, f"{tmp_path}/*")
    assert sorted(map(str, kept.drop(readers.REJECTED).collect())) == sorted(map(str, plain.collect()))


def test_a_failing_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(6).withColumn("date", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")))
    writers.write_table(days, path)
    broken = days.withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id") + 100))
    for how in ({"days": (date(2024, 1, 1), date(2024, 1, 31))}, {"replace": "table"}):
        with pytest.raises(Exception, match="broken"):
            writers.write_table(broken, path, **how)
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(6))
        assert not glob.glob(f"{path}/_*-*")


def test_a_write_runs_its_plan_once_and_may_read_what_it_replaces(spark, tmp_path):
    path, passed = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def counting(rows):
        for batch in rows:
            passed.add(batch.num_rows)
            yield batch

    days = spark.range(40).withColumn("date", F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 8).cast("int")))
    writers.write_table(days.mapInArrow(counting, days.schema), path, days=(date(2024, 1, 1), date(2024, 1, 31)))
    assert passed.value == 40
    old = spark.read.parquet(path)
    writers.write_table(old.where("id % 8 < 3").withColumn("id", F.col("id") + 1000), path, days=(date(2024, 1, 1), date(2024, 1, 5)))
    got = sorted(r.id for r in spark.read.parquet(path).collect())
    assert got == [k for k in range(40) if k % 8 > 4] + [1000 + k for k in range(40) if k % 8 < 3]


def test_what_a_killed_run_set_aside_returns(spark, tmp_path):
    path = tmp_path / "t"
    days = spark.range(4).withColumn("date", F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")))
    writers.write_table(days, str(path))
    (path / "_former-x").mkdir()
    (path / "date=2024-01-02").rename(path / "_former-x" / "date=2024-01-02")
    assert spark.read.parquet(str(path)).count() == 3
    writers.write_table(days.where("id = 3"), str(path))
    assert sorted(r.id for r in spark.read.parquet(str(path)).collect()) == [0, 1, 2, 3]
    assert not list(path.glob("_former*"))


def test_partitions_of_two_columns_change_places_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(d, r, 0) for d in (1, 2) for r in "ab"], "d int, r string, n int")
    writers.write_table(rows, path, partition_by=("d", "r"))
    writers.write_table(rows.where("d = 2 and r = 'b'").withColumn("n", F.lit(9)), path, partition_by=("d", "r"))
    assert {(x.d, x.r, x.n) for x in spark.read.parquet(path).collect()} == {(1, "a", 0), (1, "b", 0), (2, "a", 0), (2, "b", 9)}
