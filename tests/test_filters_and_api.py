import pytest
from pyspark.sql import functions as F

import weektide as wt
from weektide.model import Cols
from weektide.operators import aggregate, filters


def diseases(df):
    return sorted(r["disease"] for r in df.collect())


def test_no_filter_returns_everything(mini):
    assert wt.get_data(mini).count() == 7


def test_condition_is_matched_ignoring_case(mini):
    assert diseases(wt.get_data(mini, disease="PERT")) == ["Pertussis"] * 4


def test_several_conditions(mini):
    assert wt.get_data(mini, disease=["rubella", "HERP"]).count() == 3


def test_empty_list_of_conditions_gives_nothing(mini):
    assert wt.get_data(mini, disease=[]).count() == 0


def test_condition_is_a_regular_expression_unless_literal(spark):
    df = spark.createDataFrame([("AIDS (HIV)",), ("AIDS HIV",), (None,)], "disease string")
    assert diseases(filters.match_conditions(df, "aids (hiv)")) == ["AIDS HIV"]
    assert diseases(filters.match_conditions(df, "aids (hiv)", literal=True)) == ["AIDS (HIV)"]


def test_dimension_gives_the_same_rows(spark):
    df = spark.createDataFrame([("Measles", 1), ("Mumps", 2), ("Rubella", 3)], "disease string, n int")
    plain = filters.match_conditions(df, ["^m", "x"])
    fast = filters.match_conditions(df, ["^m", "x"], dimension=df)
    assert sorted(plain.collect()) == sorted(fast.collect())


def test_dimension_is_a_lazy_semi_join(mini):
    table = mini.load("unified")
    plan = filters.match_conditions(table, ["^p", "^r"], dimension=table)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan


def test_null_is_missing_and_nan_is_not(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "a int, b double")
    assert {r["a"] for r in filters.with_value(df, "b").collect()} == {1, 3}


def test_made_up_headers(spark):
    df = spark.range(1).selectExpr("1 AS _c0", "2 AS _count", "3 AS field_1", "4 AS x")
    assert filters.named_columns(df).columns == ["_count", "x"]


def test_areas_are_exact(mini):
    assert wt.get_data(mini, prefecture="Aichi").count() == 3
    assert wt.get_data(mini, prefecture=["Aichi", "Nara"]).count() == 4
    assert wt.get_data(mini, prefecture="aichi").count() == 0


def test_years_and_weeks(mini):
    assert wt.get_data(mini, year=2017).count() == 4
    assert wt.get_data(mini, year=(2010, 2016)).count() == 3
    assert wt.get_data(mini, week=51).count() == 2
    assert wt.get_data(mini, week=(2, 51)).count() == 5
    assert wt.get_data(mini, year=2017, week=(2, 3), prefecture="Kagawa", disease="tussis").count() == 1


def test_sources(mini):
    assert wt.get_data(mini, source="confirmed").count() == 6
    assert wt.get_data(mini, source="sentinel").count() == 1
    assert wt.get_data(mini, source="all").count() == 7
    assert wt.get_data(mini, source="other").count() == 7


def test_lists_are_sorted(mini):
    assert wt.list_diseases(mini) == ["Herpangina", "Pertussis", "Rubella"]
    assert wt.list_diseases(mini, source="sentinel") == ["Herpangina"]
    assert wt.list_prefectures(mini) == ["Aichi", "Gifu", "Kagawa", "Nara"]


def test_latest_week(mini, spark, tmp_path):
    assert wt.get_latest_week(mini) == (2017, 4)
    assert wt.get_latest_week(wt.Catalog(spark, str(tmp_path))) is None


def test_fallback_only_for_missing_tables(spark, mini, tmp_path):
    (tmp_path / "unified.parquet").mkdir()
    (tmp_path / "unified.parquet" / "part.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic"):
        wt.get_data(wt.Catalog(spark, str(tmp_path))).count()
    files = {**mini.files, "unified": "gone.parquet"}
    assert wt.Catalog(spark, mini.root, files).observations().count() == 24
    assert wt.Catalog(spark, str(tmp_path / "none")).observations().columns == wt.observation_schema().names


def test_names_and_aliases(mini):
    assert wt.load(mini, "sex").count() == 12
    assert wt.load(mini, "place").count() == 3
    assert sorted(r["per_sentinel"] for r in mini.scan("sentinel").collect()) == [0.75, 1.5, 3.0]
    assert [r[0] for r in mini.areas().collect()] == ["Aichi", "Gifu", "Kagawa", "Nara"]
    with pytest.raises(ValueError, match="Unknown dataset: nope"):
        wt.load(mini, "nope")


def test_views_and_metadata(spark, mini):
    views = mini.register_views("weekly", "v2026.6.27", "2026-06-27T00:00:00Z")
    assert {"sex", "sex_prefecture", "unified", "metadata"} <= set(views)
    got = spark.sql("SELECT year, week, count(*) AS rows FROM unified GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC LIMIT 1")
    assert tuple(got.first()) == (2017, 4, 1)
    meta = {r["key"]: r["value"] for r in spark.table("metadata").collect()}
    assert meta == {"dataset_id": "weekly", "data_version": "2026.6.27", "built_at": "2026-06-27T00:00:00Z"}


def test_year_filter_prunes_partitions(spark, mini, tmp_path):
    path = str(tmp_path / "t")
    mini.load("unified").write.partitionBy("year").parquet(path)
    plan = filters.in_period(spark.read.parquet(path), 2017)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_area_filter_is_pushed_to_the_scan(mini):
    plan = wt.get_data(mini, prefecture=["Gifu", "Nara"])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(prefecture" in plan


def test_exclude_years(spark):
    df = spark.createDataFrame([(2020, 1), (2021, 2), (None, 3)], "year int, n int")
    other = spark.createDataFrame([(2021,), (None,)], "year int")
    assert [r["n"] for r in filters.exclude_years(df, other).collect()] == [1]
    assert filters.exclude_years(df, other.where("false")).count() == 2


def test_drop_rows(spark):
    df = spark.createDataFrame(
        [("Tokyo", "a", "x"), (" ", "b", "x"), (None, "c", "x"), ("Total No.", "d", "x"), ("Osaka", "", None)],
        "prefecture string, disease string, category string",
    )
    assert diseases(filters.drop_totals(df)) == ["", "a"]
    assert filters.drop_unnamed(df).count() == 4
    assert filters.in_categories(df, "x").count() == 4
    assert filters.with_value(df, "category").count() == 4


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "keep int, _duplicated_0 int, field_3 int, `  ` int")
    assert filters.named_columns(df).columns == ["keep"]
    out = filters.project(df, ["keep"], {"keep": "kept"}, {"source": "s"})
    assert out.columns == ["kept", "source"]


def test_null_safe_sum(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("b", None)], "prefecture string, count double")
    assert {tuple(r) for r in aggregate.sum_by(df, ["prefecture"]).collect()} == {("a", 0.0), ("b", 2.0)}


def test_peak_takes_the_earliest_of_equal_weeks(spark):
    df = spark.createDataFrame([(2020, 5, 7.0), (2020, 3, 7.0), (2020, 9, 1.0)], "year int, week int, count double")
    assert [tuple(r) for r in aggregate.yearly_peak(df).collect()] == [(2020, 7.0, 3)]


def test_recent_change(spark):
    import datetime as dt

    last = dt.date(2024, 3, 31)
    rows = [("A", last - dt.timedelta(days=d), 1.0) for d in range(0, 70)] + [("B", last - dt.timedelta(days=60), 5.0)]
    rows += [("A", None, 9.0)]
    df = spark.createDataFrame(rows, "prefecture string, date date, count double")
    assert [tuple(r) for r in aggregate.recent_change(df).collect()] == [
        ("A", 28.0, 28.0, 0.0),
        ("B", 0.0, 0.0, 0.0),
    ]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(2020, "male", 3.0), (2020, "female", 0.0)], "year int, category string, count double")
    row = aggregate.category_ratio(df).first()
    assert row["male_female_ratio"] is None and row["total"] is None


def test_top_burden_keeps_ties(spark):
    df = spark.createDataFrame(
        [(2020, "a", 5.0), (2020, "b", 5.0), (2020, "c", 3.0), (2020, "d", 1.0)],
        "year int, disease string, count double",
    )
    got = [(r["disease"], r["rank_within_year"]) for r in aggregate.top_burden(df, 2).collect()]
    assert got == [("a", 1), ("b", 1), ("c", 2)]


def test_coverage(mini):
    rows = {r["disease"]: r for r in aggregate.coverage(mini.load("unified")).collect()}
    one = rows["Pertussis"]
    assert (one["first_period"], one["last_period"], one["sources"], one["total_cases"], one["rows"]) == (
        "2016-W51", "2017-W02", "All-case reporting, Confirmed cases", 433.0, 4,
    )


def test_other_column_names(spark):
    cols = Cols(area="region", condition="kind", count="n")
    df = spark.createDataFrame([("x", "k", 2020, 1, 4)], "region string, kind string, year int, week int, n int")
    assert filters.select_observations(df, "K", "x", 2020, 1, cols=cols).count() == 1
    assert aggregate.area_ranking(df, cols).first()["cases"] == 4


def test_output_order_puts_nulls_last(spark):
    df = spark.createDataFrame([(None, 1), (2020, 2), (2019, 3)], "year int, week int")
    assert [r["week"] for r in aggregate.order_for_output(df).collect()] == [3, 2, 1]
    other = spark.range(2).select(F.col("id").alias("x"))
    assert aggregate.order_for_output(other) is other
