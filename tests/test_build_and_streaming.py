import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from weektide.functions import calendar
from weektide.operators import aggregate, quality, snapshot
from weektide.plans import build
from weektide.sources import reports
from weektide.sources.catalog import Catalog
from weektide.sources.versions import Versions
from weektide.streaming import refresh

OLD = "prefecture string, year int, week int, date date, disease string, category string, count long, source string"
NEW = "prefecture string, disease string, count long, year int, week int, date date, source string"
SITES = "prefecture string, disease string, year int, week int, date date, count double, per_sentinel double, source string"
SUNDAY, MONDAY = dt.date(2024, 1, 7), dt.date(2024, 1, 1)


def historical(spark):
    return spark.createDataFrame(
        [
            ("Tokyo", 2023, 1, SUNDAY, "HIV/AIDS", "total", 3, "Confirmed cases"),
            ("Tokyo", 2023, 1, SUNDAY, "HIV/AIDS", "male", 2, "Confirmed cases"),
            ("Tokyo", 2024, 1, SUNDAY, "Measles", "total", 99, "Confirmed cases"),
        ],
        OLD,
    )


def confirmed(spark):
    return spark.createDataFrame(
        [
            ("Tokyo", "Measles", 4, 2024, 1, MONDAY, "All-case reporting"),
            ("Tokyo", "Measles", 5, 2024, 1, MONDAY, "All-case reporting"),
        ],
        NEW,
    )


def sites(spark):
    return spark.createDataFrame(
        [
            ("Tokyo", "RSV", 2023, 1, MONDAY, 7.0, 1.5, "Sentinel surveillance"),
            ("Tokyo", "Measles", 2024, 1, MONDAY, 8.0, 1.0, "Sentinel surveillance"),
        ],
        SITES,
    )


def test_unified_table(spark):
    out = build.build_unified(historical(spark), confirmed(spark), sites(spark))
    got = {(r["year"], r["disease"], r["category"], r["count"], r["per_sentinel"]) for r in out.collect()}
    assert got == {
        (2023, "AIDS", "total", 3.0, None),
        (2024, "Measles", "total", 4.0, None),
        (2023, "RSV", "total", 7.0, 1.5),
    }
    quality.validate(out)


def test_unified_table_on_one_week_day(spark):
    out = build.build_unified(historical(spark), None, None, monday_dates=True)
    assert {r["date"] for r in out.collect()} == {dt.date(2023, 1, 2), MONDAY}


def test_unified_table_of_single_sources(spark):
    assert build.build_unified(None, None, sites(spark)).count() == 2
    assert build.build_unified(historical(spark), None, None).count() == 2
    with pytest.raises(ValueError, match="No tables"):
        build.build_unified(None, None, None)


def test_sex_and_place_tables(spark):
    df = historical(spark)
    assert build.build_place(df, df).count() == 6
    got = {(r["category"], r["count"]) for r in build.build_sex(df.where("year = 2023")).collect()}
    assert got == {("total", 3), ("male", 2), ("female", 1)}


def test_bullet_table(spark):
    new = confirmed(spark).withColumn("source", F.lit("raw")).unionByName(
        spark.createDataFrame([("Tokyo", "", 1, 2024, 1, MONDAY, "raw")], NEW)
    )
    out = build.build_bullet(new, None, 2024)
    assert out.count() == 2 and {r["source"] for r in out.collect()} == {"All-case reporting"}
    kept = new.where("disease <> ''").withColumn("year", F.lit(2020))
    assert {r["year"] for r in build.build_bullet(new, kept, 2024).collect()} == {2020, 2024}


def raw(spark, year, totals):
    rows = [("Tokyo", "RSV", year, w, SUNDAY, float(n), None, "x") for w, n in enumerate(totals, start=1)]
    return spark.createDataFrame(rows, SITES)


def test_sentinel_refresh_is_stable(spark):
    first = build.build_sentinel(raw(spark, 2023, [1, 3, 6]), None, 2023)
    reports = raw(spark, 2023, [1, 3, 6]).unionByName(raw(spark, 2024, [5, 9]))
    second = build.build_sentinel(reports, first, 2024)
    third = build.build_sentinel(reports, second, 2024)
    for out in (second, third):
        got = {(r["year"], r["week"], r["count"], r["date"]) for r in out.collect()}
        assert got == {
            (2023, 1, 1.0, dt.date(2023, 1, 2)),
            (2023, 2, 2.0, dt.date(2023, 1, 9)),
            (2023, 3, 3.0, dt.date(2023, 1, 16)),
            (2024, 1, 5.0, dt.date(2024, 1, 1)),
            (2024, 2, 4.0, dt.date(2024, 1, 8)),
        }


def test_nothing_is_written_when_a_check_fails(spark, tmp_path):
    path = tmp_path / "t"
    bad = build.build_unified(None, None, sites(spark)).withColumn("week", F.lit(60))
    with pytest.raises(ValueError, match="week out of range"):
        build.publish(bad, str(path))
    assert not path.exists()
    good = build.build_unified(None, None, sites(spark))
    build.publish(good, str(path))
    build.publish(good.where("year = 2024"), str(path), refresh=True)
    assert snapshot.read_table(spark, str(path)).count() == 2


REPORT = """Sentinel weekly report,,
{w}th week, 2025,
,RSV,
,Current week,per sentinel
Total No.,1,1
Tokyo,{n},{r}
,,
"""


def landing(spark, tmp_path, kind="sentinel"):
    """Functions that let a file arrive, and read the table, and the paths of state and quarantine."""
    folder, raw, table, bad, state = (str(tmp_path / n) for n in ("in", "raw", "table", "bad", "state"))
    (tmp_path / "in").mkdir()

    def arrive(name, text):
        (tmp_path / "in" / name).write_text(text)
        query = refresh.start_refresh(spark, folder, raw, table, bad, state, kind)
        query.awaitTermination(120)
        assert query.exception() is None
        return {r["week"]: r["count"] for r in snapshot.read_table(spark, table).collect()}

    return arrive, raw, table, bad


def report(week, n, rate=None):
    return REPORT.format(w=week, n=n, r=n / 10 if rate is None else rate)


def test_arriving_reports_refresh_the_table(spark, tmp_path):
    arrive, raw, table, _ = landing(spark, tmp_path)
    assert arrive("teitenrui01.csv", report(1, 10)) == {1: 10.0}
    assert arrive("teitenrui02.csv", report(2, 25)) == {1: 10.0, 2: 15.0}
    assert arrive("teitenrui03.csv", report(3, 40)) == {1: 10.0, 2: 15.0, 3: 15.0}
    assert arrive("again-teitenrui02.csv", report(2, 30)) == {1: 10.0, 2: 20.0, 3: 10.0}
    one = snapshot.read_table(spark, table).where("week = 1").select(calendar.period_label("year", "week")).first()
    assert one[0] == "2025-W01"
    assert {r["week"]: r["count"] for r in refresh.current_rows(spark, raw).collect()} == {1: 10.0, 2: 30.0, 3: 40.0}


def test_a_bad_report_does_not_poison_the_state(spark, tmp_path):
    arrive, raw, _, bad = landing(spark, tmp_path)
    assert arrive("teitenrui01.csv", report(1, 10)) == {1: 10.0}
    assert arrive("teitenrui02.csv", report(2, -5, 1)) == {1: 10.0}
    assert arrive("zensu02.csv", report(2, 70)) == {1: 10.0}  # another layout is not taken for this one
    assert arrive("teitenrui03.csv", "x,current week\n") == {1: 10.0}
    assert arrive("teitenrui02b.csv", report(2, 25)) == {1: 10.0, 2: 15.0}
    reasons = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in spark.read.parquet(bad).collect()}
    assert reasons == {"teitenrui02.csv": "impossible values", "teitenrui03.csv": "too few rows"}
    assert snapshot.read_table(spark, raw).where("count < 0").isEmpty()


def batch_of(spark, week, n):
    rows = [r.split(",") for r in report(week, n).splitlines()]
    rows[1] = [f"{week}th week, 2025"]
    schema = "file string, rows array<array<string>>, error string"
    return spark.createDataFrame([(f"x/teitenrui{week:02d}.csv", rows, None)], schema)


def test_batches_run_again_after_a_crash(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / n) for n in ("raw", "table", "bad")]
    for _ in range(2):
        refresh.apply_batch(batch_of(spark, 1, 3), *paths, batch_id=0)
        assert snapshot.read_table(spark, paths[1]).count() == 1
    with monkeypatch.context() as broken:
        broken.setattr(refresh.snapshot, "refresh_years", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh.apply_batch(batch_of(spark, 2, 8), *paths, batch_id=1)
    refresh.apply_batch(batch_of(spark, 2, 8), *paths, batch_id=1)
    assert {r["week"]: r["count"] for r in snapshot.read_table(spark, paths[1]).collect()} == {1: 3.0, 2: 5.0}
    assert refresh.current_rows(spark, paths[0]).count() == 2


def test_a_batch_opens_its_own_years_and_folders_stay_few(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / n) for n in ("raw", "table", "bad")]
    state = Versions(spark, paths[0])

    def arrived(year, week, n):
        rows = [r.split(",") for r in report(week, n).splitlines()]
        rows[1] = [f"{week}th week, {year}"]
        return spark.createDataFrame([(f"x/teitenrui{week:02d}.csv", rows, None)], "file string, rows array<array<string>>, error string")

    refresh.apply_batch(arrived(2024, 1, 5), *paths, batch_id=0)
    opened = []
    read = Versions.read
    monkeypatch.setattr(Versions, "read", lambda self, *a, **k: opened.append(read(self, *a, **k)) or opened[-1])
    for batch in range(1, 22):
        refresh.apply_batch(arrived(2025, 1 + batch % 3, 10 * batch), *paths, batch_id=batch)
        assert len(state.current().commits[2025]) <= refresh.MAX_FOLDERS
    files = {f for df in opened if "batch" in df.columns for f in df.inputFiles()}
    assert files and not any("year=2024" in f for f in files)
    monkeypatch.undo()
    folders = glob.glob(f"{paths[0]}/year=2025/commit=*")
    assert len(folders) <= refresh.MAX_FOLDERS + 1 and len(glob.glob(f"{paths[0]}/_versions/*.json")) == 2
    assert {r["week"]: r["count"] for r in refresh.current_rows(spark, paths[0]).where("year = 2025").collect()} == {1: 210.0, 2: 190.0, 3: 200.0}
    assert snapshot.read_table(spark, paths[1]).count() == 4
    # The same batch again, with other contents: its last run counts.
    refresh.apply_batch(arrived(2025, 1, 100), *paths, batch_id=21)
    assert {r["week"]: r["count"] for r in refresh.current_rows(spark, paths[0]).where("year = 2025").collect()}[1] == 100.0


BULLET = """a
b
c
Area,Mumps,
,Current week,Cum
Total No.,9,9
Mie,{n},90
"""


def test_bullet_reports_arrive(spark, tmp_path):
    arrive, *_ = landing(spark, tmp_path, "bullet")
    assert arrive("2021-05-zensu.csv", BULLET.format(n=4)) == {5: 4}
    assert arrive("2021-06-zensu.csv", BULLET.format(n=7)) == {5: 4, 6: 7}
    assert arrive("new-2021-05-zensu.csv", BULLET.format(n=1)) == {5: 1, 6: 7}


def test_reports_to_published_tables(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()

    def arrive(name, text):
        (landing / name).write_text(text)

    def values(name):
        return {(r["year"], r["week"], r["disease"]): r["count"] for r in snapshot.read_table(spark, f"{root}/{name}.parquet").collect()}

    arrive("2021-05-zensu.csv", BULLET.format(n=4))
    arrive("2025-01-teitenrui.csv", report(1, 10))
    arrive("2025-02-teitenrui.csv", report(2, 25))
    arrive("2025-03-teitenrui.csv", "x,current week\n")
    bad = build.build_tables(spark, str(landing), root, 2025)
    assert [r["reason"] for r in bad.collect()] == ["too few rows"]
    assert values("bullet") == {(2021, 5, "Mumps"): 4}
    assert values("unified") == {(2021, 5, "Mumps"): 4, (2025, 1, "RSV"): 10, (2025, 2, "RSV"): 15}
    # A closed year stays, the current one is rebuilt, and only what is asked for is written.
    arrive("2021-05-zensu.csv", BULLET.format(n=9))
    arrive("2025-02-teitenrui.csv", report(2, 30))
    build.build_tables(spark, str(landing), root, 2025, ["bullet", "sentinel"])
    assert values("bullet") == {(2021, 5, "Mumps"): 4} and values("sentinel")[2025, 2, "RSV"] == 20
    assert values("unified")[2025, 2, "RSV"] == 15
    with pytest.raises(ValueError, match="Unknown tables"):
        build.build_tables(spark, str(landing), root, 2025, ["other"])


def workbooks(spark, *years):
    """Cell grids of a sex and a place workbook for each year: one sheet of its first week."""
    rows = []
    for y in years:
        for name, marks in ((f"{y}_Syu_01_1.xlsx", ["Total", "Male", "Female"]), (f"{y}_Syu_02_1.xlsx", ["Total", "Japan", "Others"])):
            cells = [["title"], ["", "Cholera", "", ""], ["", *marks], ["Total No.", "9", "9", "9"], ["Ehime", "5", "3", "2"], ["Mie", "4", "4", ""]]
            rows += [(f"books/{name}", 2, k, c) for k, c in enumerate(cells)]
    return spark.createDataFrame(rows, "file string, sheet int, row_idx int, cells array<string>")


def test_all_tables_from_one_parse(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    (landing / "2021-05-zensu.csv").write_text(BULLET.format(n=4))
    (landing / "2025-01-teitenrui.csv").write_text(report(1, 10))
    (landing / "2025-02-teitenrui.csv").write_text(report(2, 25))
    (landing / "2025-03-teitenrui.csv").write_text("x,current week\n")
    decoded = spark.sparkContext.accumulator(0)
    parse = reports.parse_contents

    def counted(files, *args):
        def look(batches):
            for batch in batches:
                decoded.add(len(batch))
                yield batch

        return parse(files.mapInPandas(look, "path string, content binary"), *args)

    monkeypatch.setattr(reports, "parse_contents", counted)
    bad = build.build_tables(spark, str(landing), root, 2025, workbooks=workbooks(spark, 2018, 2019))
    assert decoded.value == 4
    assert [r["reason"] for r in bad.collect()] == ["too few rows"]
    catalog = Catalog(spark, root)
    assert catalog.load("sex").count() == catalog.load("place").count() == 12
    assert {r["category"] for r in catalog.load("sex").collect()} == {"total", "male", "female"}
    assert {(r["disease"], r["source"]) for r in catalog.load("unified").collect()} == {
        ("Cholera", "Confirmed cases"), ("Mumps", "All-case reporting"), ("RSV", "Sentinel surveillance"),
    }
    covered = {r["disease"]: (r["first_period"], r["last_period"], r["total_cases"], r["rows"]) for r in build.read_coverage(spark, root).collect()}
    assert covered == {"Cholera": ("2018-W01", "2019-W01", 18.0, 4), "Mumps": ("2021-W05", "2021-W05", 4.0, 1), "RSV": ("2025-W01", "2025-W02", 25.0, 2)}
    # Again, with one more workbook: years that are there are not parsed, and their files stay.
    old = catalog.versions("sex").current()
    build.build_tables(spark, str(landing), root, 2025, ["sex_prefecture", "unified"], workbooks=workbooks(spark, 2018, 2019, 2020))
    new = catalog.versions("sex").current()
    assert new.changed_years(old) == {2020}
    unified = catalog.versions("unified")
    assert unified.current().changed_years(unified.at(1)) == {2020}
    assert {r["disease"]: r["rows"] for r in build.read_coverage(spark, root).collect()} == {"Cholera": 6, "Mumps": 1, "RSV": 2}


def test_coverage_reads_changed_years_only(spark, tmp_path, monkeypatch):
    table, parts = Versions(spark, str(tmp_path / "t")), Versions(spark, str(tmp_path / "c"))
    rows = historical(spark).unionByName(historical(spark).withColumn("year", F.lit(2020)))
    table.overwrite(rows)
    first = build.refresh_coverage(table, parts)
    assert build.refresh_coverage(table, parts).number == first.number  # nothing to count
    table.refresh(rows.where("year = 2024").withColumn("count", F.col("count") + 1), drop=[2020])
    build.refresh_coverage(table, parts)
    assert parts.current().commits[2023] == first.commits[2023] and 2020 not in parts.current().commits
    whole = aggregate.coverage(table.read())
    assert sorted(map(tuple, aggregate.coverage_of(parts.read()).collect())) == sorted(map(tuple, whole.collect()))
