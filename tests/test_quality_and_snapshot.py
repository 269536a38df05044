import datetime as dt
import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.model import Cols
from weektide.operators import quality, snapshot
from weektide.sources.versions import ConcurrentWrite, Versions

SCHEMA = "prefecture string, year int, week int, disease string, category string, count double, per_sentinel double"


def table(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def one(year=2024, week=1, category="total", count=1.0, rate=None, area="Tokyo", disease="Measles"):
    return (area, year, week, disease, category, count, rate)


def found(df, **kwargs):
    return {r["check"]: r["violations"] for r in quality.violations(df, **kwargs).collect()}


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        quality.require_columns(spark.createDataFrame([("x",)], "prefecture string"))
    quality.require_columns(table(spark, one()))


def test_duplicates(spark):
    quality.validate_no_duplicates(table(spark, one(category="male"), one(category="female")))
    with pytest.raises(ValueError, match="Found 1 duplicate records"):
        quality.validate_no_duplicates(table(spark, one(), one(count=2.0)))
    quality.validate_no_duplicates(table(spark, one(), one(count=2.0)), ["prefecture", "count"])


def test_null_keys_are_equal(spark):
    assert found(table(spark, one(area=None), one(area=None)))["duplicate records"] == 1


def test_ranges(spark):
    quality.validate_date_ranges(table(spark, one(week=53), one(year=1999)))
    with pytest.raises(ValueError, match="year out of range 1999-2030: found 1998-2024"):
        quality.validate_date_ranges(table(spark, one(year=1998), one()))
    with pytest.raises(ValueError, match="week out of range 1-53: found 1-54"):
        quality.validate_date_ranges(table(spark, one(week=54), one()))
    quality.validate_date_ranges(spark.range(1))


def test_negative_values(spark):
    quality.validate_non_negative(
        table(spark, one(count=0.0), one(count=1.0, rate=0.5), one(count=None, rate=2.0))
    )
    with pytest.raises(ValueError, match="Found 1 rows with negative count"):
        quality.validate_non_negative(table(spark, one(count=-1.0)))


def test_all_checks_at_once(spark):
    df = table(spark, one(), one(), one(week=60), one(year=1900, count=-3.0, rate=-1.0), one(year=None, week=None))
    assert found(df) == {
        "year out of range": 1,
        "week out of range": 1,
        "negative count": 1,
        "negative per_sentinel": 1,
        "duplicate records": 1,
    }
    with pytest.raises(ValueError, match="year out of range"):
        quality.validate(df)
    good = table(spark, one())
    assert quality.validate(good) is good


def test_preview_is_short(spark):
    df = table(spark, *[one(area=f"a{i}", count=-1.0) for i in range(50)])
    with pytest.raises(ValueError) as problem:
        quality.validate(df)
    assert str(problem.value).count("prefecture") == quality.PREVIEW_ROWS


def test_unknown_areas(spark):
    dim = spark.createDataFrame([("Tokyo",)], "prefecture string")
    got = quality.unknown_areas(table(spark, one(), one(area="Total No.")), dim).collect()
    assert [r[0] for r in got] == ["Total No."]


# -- snapshots ----------------------------------------------------------------------------------


def files_of(path, year=None):
    return [f for f in glob.glob(f"{path}/year={year or '*'}/commit=*/*.parquet")]


def test_written_table_is_split_by_year_and_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    df = table(spark, *[one(year=y, week=w) for y in (2022, 2023, 2024) for w in (3, 1, 2)])
    snapshot.write_table(df, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("year=")) == ["year=2022", "year=2023", "year=2024"]
    assert [r["week"] for r in spark.read.parquet(*files_of(path, 2023)).collect()] == [1, 2, 3]
    assert snapshot.read_table(spark, path).count() == 9
    assert snapshot.read_table(spark, path).schema == df.schema


def test_a_hot_year_is_spread_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).select(
        F.format_string("a%05d", "id").alias("prefecture"), F.lit(2024).alias("year"), F.lit(1).alias("week"),
        F.lit("M").alias("disease"), F.lit("total").alias("category"), F.lit(1.0).alias("count"),
    )
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        snapshot.write_table(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(files_of(path, 2024)) > 1


def test_refresh_replaces_only_the_given_years_and_can_run_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshot.write_table(table(spark, one(year=2023), one(year=2024)), path)
    new = table(spark, one(year=2024, count=9.0), one(year=2025))
    for _ in range(2):
        snapshot.refresh_years(new, path)
        got = {(r["year"], r["count"]) for r in snapshot.read_table(spark, path).collect()}
        assert got == {(2023, 1.0), (2024, 9.0), (2025, 1.0)}
        assert snapshot.read_table(spark, path).count() == 3


def test_a_broken_overwrite_leaves_the_old_table(spark, tmp_path):
    """The job dies while it writes; what was published stays readable, and its leavings can be cleared away."""
    path = str(tmp_path / "t")
    versions = Versions(spark, path)
    snapshot.write_table(table(spark, one(year=2023), one(year=2024)), path)
    old = set(files_of(path))
    dies = F.udf(lambda week: 1 // (week - 2), "int")
    many = table(spark, *[one(year=y, week=w) for y in (2023, 2025) for w in (1, 2, 3)])
    with pytest.raises(Exception, match="(?i)zero"):
        snapshot.write_table(many.withColumn("week", dies("week")), path)
    assert versions.current().number == 1
    assert {(r["year"], r["count"]) for r in snapshot.read_table(spark, path).collect()} == {(2023, 1.0), (2024, 1.0)}
    # The data of another one is complete, but its version is never published.
    versions._add(table(spark, one(year=2026)), versions._next(versions.current())[1], True)
    assert snapshot.read_table(spark, path).count() == 2 and files_of(path, 2026)
    snapshot.refresh_years(table(spark, one(year=2025)), path)
    snapshot.refresh_years(table(spark, one(year=2025, count=2.0)), path)
    versions.vacuum(keep=1)
    assert not files_of(path, 2026) and len(files_of(path, 2025)) == 1 and old <= set(files_of(path))
    assert snapshot.read_table(spark, path).count() == 3
    with pytest.raises(Exception, match="(?i)not exist|no such file"):
        versions.at(1)


def test_one_of_two_writers_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshot.write_table(table(spark, one(year=2023)), path)
    first, second = Versions(spark, path), Versions(spark, path)
    seen = second.current()
    first.refresh(table(spark, one(year=2024)))
    monkeypatch.setattr(second, "current", lambda: seen)
    with pytest.raises(ConcurrentWrite):
        second.refresh(table(spark, one(year=2025)))
    assert {r["year"] for r in snapshot.read_table(spark, path).collect()} == {2023, 2024}


def test_versions_of_odd_tables(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))
    assert versions.current() is None and not versions.exists()
    with pytest.raises(ValueError, match="No version"):
        versions.read()
    versions.overwrite(table(spark, one(year=None), one(year=2023, area=None)))
    assert {(r["year"], r["prefecture"] is None) for r in versions.read().collect()} == {(None, False), (2023, True)}
    assert [r["year"] for r in versions.read(years=[None]).collect()] == [None]
    wide = table(spark, one(year=2024)).withColumn("note", F.lit("x"))
    versions.refresh(wide)  # a new column: null in the years before
    assert {(r["year"], r["note"]) for r in versions.read().collect()} == {(None, None), (2023, None), (2024, "x")}
    with pytest.raises(ValueError, match="Column note"):
        versions.refresh(wide.withColumn("note", F.lit(1)))
    versions.overwrite(table(spark, one()).where("false"))
    assert versions.read().count() == 0


def test_equal_years_keep_their_folders(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))
    rows = [one(year=y, week=w, area=a) for y in (2022, 2023, 2024) for w in (1, 2) for a in ("Nara", "Gifu")]
    first = versions.overwrite(table(spark, *rows))
    second = versions.overwrite(table(spark, *reversed(rows)))
    assert second.commits == first.commits and second.changed_years(first) == set()
    third = versions.overwrite(table(spark, *rows[:-1], one(year=2024, week=2, area="Gifu", count=7.0)))
    assert third.changed_years(second) == {2024}
    parts = [tuple(r) for r in versions.changed_parts(second, third).collect()]
    assert parts == [(2024, "Gifu")]


def test_a_diff_reads_the_changed_year_only(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))
    rows = [one(year=y, week=w, area=a) for y in (2022, 2023, 2024) for w in (1, 2) for a in ("Nara", "Gifu")]
    before = versions.overwrite(table(spark, *rows))
    edited = [r for r in rows if r[:3] != ("Nara", 2023, 1)]
    after = versions.refresh(table(spark, *[r for r in edited if r[1] >= 2023], one(year=2023, week=9, area="Nara")))
    assert after.changed_years(before) == {2023, 2024}  # 2024 was written anew, with the same rows
    diff = snapshot.version_diff(versions, before, after)
    assert {p.split("year=")[1][:4] for p in diff.inputFiles() if "/_digests/" not in p} == {"2023"}
    assert {(r["prefecture"], r["year"], r["week"], r["status"]) for r in diff.collect()} == {
        ("Nara", 2023, 1, "removed"), ("Nara", 2023, 9, "added"),
    }
    assert snapshot.version_diff(versions, after, after).collect() == []


def test_closed_years_are_kept(spark):
    old = table(spark, one(year=2022, count=1.0), one(year=2024, count=1.0))
    new = table(spark, *[one(year=y, count=5.0) for y in (2022, 2023, 2024)])
    got = {(r["year"], r["count"]) for r in snapshot.merge_refresh(old, new, 2024).collect()}
    assert got == {(2022, 1.0), (2023, 5.0), (2024, 5.0)}


def test_fingerprint_ignores_order_and_sees_every_change(spark):
    df = table(spark, *[one(week=w) for w in range(1, 50)])
    assert not snapshot.has_changed(df, df.repartition(7))
    assert not snapshot.has_changed(df, df.select(*reversed(df.columns)))
    assert snapshot.has_changed(df, df.union(df))
    assert snapshot.has_changed(df, df.where("week < 49"))
    assert snapshot.has_changed(df, df.withColumn("count", F.when(F.col("week") != 5, F.col("count"))))
    assert snapshot.has_changed(
        table(spark, one(count=None, rate=1.0)), table(spark, one(count=1.0, rate=None))
    )
    assert snapshot.fingerprint(df.where("false")).first()["rows"] == 0


def test_snapshot_diff(spark):
    before = table(spark, one(week=1), one(week=2), one(week=3), one(week=4), one(week=4))
    after = table(spark, one(week=2), one(week=3, count=None), one(week=4), one(week=9))
    got = {r["week"]: r["status"] for r in snapshot.snapshot_diff(before, after).collect()}
    assert got == {1: "removed", 2: "same", 3: "changed", 4: "changed", 9: "added"}
    with pytest.raises(ValueError, match="different columns"):
        snapshot.snapshot_diff(before, after.drop("count"))


def test_profile_falls_back_from_date_to_week_to_year(spark):
    df = table(spark, one(year=2023, week=52), one(year=2024, week=2))
    dated = df.withColumn("date", F.lit(dt.date(2024, 5, 1)))
    assert tuple(snapshot.profile(dated).first()) == (2, "2024-05-01", "2024-05-01")
    assert tuple(snapshot.profile(df).first()) == (2, "2023-12-25", "2024-01-08")
    assert tuple(snapshot.profile(df.drop("week")).first()) == (2, "2023-01-01", "2024-12-31")
    assert tuple(snapshot.profile(spark.range(3)).first()) == (3, None, None)
    assert tuple(snapshot.profile(df, Cols(year="x", week="y")).first()) == (2, None, None)


def test_schema_rows(spark):
    schema = T.StructType(
        [
            T.StructField("z", T.DateType()),
            T.StructField("a", T.ShortType()),
            T.StructField("b", T.FloatType()),
            T.StructField("c", T.BooleanType()),
            T.StructField("d", T.StringType()),
            T.StructField("e", T.TimestampType()),
            T.StructField("f", T.BinaryType()),
        ]
    )
    rows = [tuple(r) for r in snapshot.schema_rows(spark.createDataFrame([], schema)).collect()]
    assert [(n, t) for n, t, _ in rows] == [
        ("a", "int64"), ("b", "float64"), ("c", "bool"), ("d", "string"), ("e", "datetime"), ("f", "string"), ("z", "date"),
    ]
    assert [n for n, _, note in rows if note] == ["f"]


def test_file_checks(spark, tmp_path):
    for name, content in (("a.parquet", b"one"), ("b.parquet", b"two" * 10_000), ("extra.parquet", b"x")):
        (tmp_path / name).write_bytes(content)
    inventory = snapshot.file_inventory(spark, str(tmp_path))
    got = {r["file"]: (r["size_bytes"], r["sha256"]) for r in inventory.collect()}
    assert got["b.parquet"] == (30_000, hashlib.sha256(b"two" * 10_000).hexdigest())

    listed = [
        ("a", "a.parquet", 3, hashlib.sha256(b"one").hexdigest()),
        ("b", "b.parquet", 30_000, "0" * 64),
        ("c", "c.parquet", 1, "1" * 64),
    ]
    schema = "tables array<struct<name:string,file:string,size_bytes:bigint,sha256:string>>"
    manifest = snapshot.manifest_files(spark.createDataFrame([(listed,)], schema))
    status = {r["file"]: r["status"] for r in snapshot.verify_files(inventory, manifest).collect()}
    assert status == {
        "a.parquet": "ok",
        "b.parquet": "checksum mismatch",
        "c.parquet": "missing",
        "extra.parquet": "unlisted",
    }
    missing = snapshot.missing_tables(inventory, ["a.parquet", "c.parquet"]).collect()
    assert [r["file"] for r in missing] == ["c.parquet"]


def test_keys_that_are_published_already(spark):
    keys = ["prefecture", "year", "week", "disease", "category"]
    published = table(spark, *[one(week=w, area=a) for w in range(1, 40) for a in ("Nara", "Gifu", None)], one(week=1, area="Nara"))
    batch = table(spark, one(week=3, area="Nara"), one(week=3, area=None), one(week=60, area="Nara"), one(week=3, area=""), one(week=3, area="Nara", count=2.0))
    got = quality.existing_keys(batch, published, keys)
    assert {(r["prefecture"], r["week"]) for r in got.collect()} == {("Nara", 3), (None, 3)}
    assert got.count() == 2
    found = {r["check"]: r["violations"] for r in quality.violations_of_batch(batch, published, keys).collect()}
    assert found["existing records"] == 2 and found["duplicate records"] == 1 and found["week out of range"] == 1
    assert quality.existing_keys(batch.where("false"), published, keys).collect() == []
    assert quality.existing_keys(batch, published.where("false"), keys).collect() == []
    longs = published.withColumn("week", F.col("week").cast("long"))  # another width of the same number
    assert quality.existing_keys(batch, longs, keys).count() == 2


def test_the_published_table_is_not_shuffled(spark):
    """A batch against a table a hundred times as large: a few of its rows are left to compare."""
    published = spark.range(200_000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    batch = spark.range(199_500, 201_500).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    found = quality.existing_keys(batch, published, ["a", "b"])
    assert found.count() == 500
    words = quality.FILTER_WORDS
    plan = found._jdf.queryExecution().executedPlan().toString()
    maybe = plan.index("BroadcastHashJoin [_word")
    assert "Range (0, 200000" in plan[maybe:] and words * 8 == 2 << 20
    # Between the scan of the published keys and the filter there is no exchange.
    below = plan[maybe : plan.index("Range (0, 200000")]
    assert "hashpartitioning" not in below


def rows_scanned(df):
    """Rows that the file scans of a query hand on, by their metrics."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "FileSourceScanExec" in node.getClass().getName():
            out.append(node.metrics().apply("numOutputRows").value())
        if "AdaptiveSparkPlanExec" in node.getClass().getName():
            walk(node.executedPlan())
        if "QueryStageExec" in node.getClass().getName():
            walk(node.plan())
        children = node.children().iterator()
        while children.hasNext():
            walk(children.next())

    walk(plan)
    return sum(out)


def test_a_lookup_skips_row_groups(spark, tmp_path):
    """One condition in one area, of rows that are clustered by both, or by the output order alone."""
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    rows = spark.range(60_000).select(
        F.concat(F.lit("area "), draw(1, 40)).alias("prefecture"), F.lit(2024).alias("year"), (draw(2, 50) + 1).cast("int").alias("week"),
        F.concat(F.lit("condition "), draw(3, 50)).alias("disease"), F.lit("total").alias("category"), F.rand(1).alias("count"),
    )
    small = {"parquet.block.size": "32768", "parquet.block.size.row.check.min": "500", "parquet.block.size.row.check.max": "1000"}
    scanned = {}
    for name, cluster in (("plain", ()), ("near", ("disease", "prefecture"))):
        versions = Versions(spark, str(tmp_path / name), cluster=cluster, options=small)
        versions.overwrite(rows)
        found = versions.read().where("disease = 'condition 7' AND prefecture = 'area 9'")
        scanned[name] = rows_scanned(found)
        assert found.count() == rows.where("disease = 'condition 7' AND prefecture = 'area 9'").count() > 0
    assert 0 < scanned["near"] < scanned["plain"] / 5


def test_a_join_prunes_years_at_run_time(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))
    versions.overwrite(table(spark, *[one(year=y, week=w) for y in range(2000, 2020) for w in range(1, 20)]))
    chosen = spark.createDataFrame([(2003, "a"), (2004, "b")], "year int, label string").where("label = 'b'")
    joined = versions.read().join(F.broadcast(chosen), "year")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 19
