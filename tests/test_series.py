import random

import pytest
from pyspark.sql import functions as F

from weektide.operators import series
from weektide.operators.series import cumulative_to_weekly

SCHEMA = "prefecture string, disease string, year int, week int, date date, count double, per_sentinel double"


def run(spark, rows, **kwargs):
    """rows: (year, week, count[, rate]) of one series, result in period order."""
    full = [
        ("Tokyo", "RSV", r[0], r[1], None, None if r[2] is None else float(r[2]), r[3] if len(r) > 3 else None)
        for r in rows
    ]
    out = cumulative_to_weekly(spark.createDataFrame(full, SCHEMA), **kwargs)
    return [(r["count"], r["per_sentinel"]) for r in out.orderBy("year", "week").collect()]


def counts(spark, rows, **kwargs):
    return [c for c, _ in run(spark, rows, **kwargs)]


@pytest.mark.parametrize("unique", [True, False])
class TestWeekly:
    def test_differences(self, spark, unique):
        assert counts(spark, [(2024, 1, 10), (2024, 2, 25), (2024, 3, 40)], unique=unique) == [10, 15, 15]

    def test_each_year_starts_again(self, spark, unique):
        rows = [(2024, 1, 100), (2024, 2, 130), (2025, 1, 12), (2025, 2, 30)]
        assert counts(spark, rows, unique=unique) == [100, 30, 12, 18]

    def test_late_start_has_no_value(self, spark, unique):
        assert counts(spark, [(2024, 3, 22), (2024, 4, 31)], unique=unique) == [None, 9]

    def test_gap_gives_the_difference_over_the_gap(self, spark, unique):
        assert counts(spark, [(2024, 1, 5), (2024, 4, 20)], unique=unique) == [5, 15]

    def test_missing_total(self, spark, unique):
        assert counts(spark, [(2024, 1, 5), (2024, 2, None), (2024, 3, 9)], unique=unique) == [5, None, None]

    def test_correction_downwards(self, spark, unique):
        rows = [(2024, 1, 20, 2.0), (2024, 2, 15, 1.5), (2024, 3, 30, 3.0)]
        assert run(spark, rows, unique=unique) == [(20, 2.0), (None, None), (15, 1.5)]

    def test_rate_follows_the_number_of_sites(self, spark, unique):
        rows = [(2024, 1, 10, 1.0), (2024, 2, 25, 5.0)]
        assert run(spark, rows, unique=unique) == [(10, 1.0), (15, 3.0)]

    def test_zero_week_has_zero_rate_and_no_sites_no_rate(self, spark, unique):
        rows = [(2024, 1, 10, 1.0), (2024, 2, 10, 1.0), (2024, 3, 12, 0.0)]
        assert run(spark, rows, unique=unique) == [(10, 1.0), (0, 0.0), (2, None)]


def test_copies_of_a_report_add_nothing(spark):
    rows = [(2024, 1, 10), (2024, 2, 25), (2024, 2, 25), (2024, 2, 25), (2024, 3, 40)]
    assert sorted(counts(spark, rows)) == [0, 0, 10, 15, 15]


def test_copies_match_a_row_by_row_walk(spark):
    random.seed(7)
    rows = []
    for area in ("A", "B"):
        for week in (1, 2, 4, 5, 9):
            total = random.choice([None, 5.0, 10.0, 10.0, 20.0])
            rows += [(area, "RSV", 2024, week, None, total, None)] * random.choice([1, 1, 3])
    out = cumulative_to_weekly(spark.createDataFrame(rows, SCHEMA))

    want, previous = [], {}
    for area, _, _, week, _, total, _ in sorted(rows, key=lambda r: (r[0], r[3], r[5] is None, r[5] or 0)):
        before = previous.get(area)
        if total is None:
            value = None
        elif week == 1:
            value = total
        else:
            value = None if before is None or total < before else total - before
        want.append((area, week, value))
        previous[area] = total
    got = [(r["prefecture"], r["week"], r["count"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_runs_of_copies_unfold_in_steps(spark):
    one = spark.createDataFrame([("A", "RSV", 2024, 2, None, 7.0, None)], SCHEMA)
    many = one.crossJoin(spark.range(25_001)).drop("id")
    out = cumulative_to_weekly(many)
    assert {(r["count"], r["n"]) for r in out.groupBy("count").agg(F.count("*").alias("n")).collect()} == {
        (None, 1),
        (0.0, 25_000),
    }


def test_columns_and_types_stay(spark):
    df = spark.createDataFrame([(2024, "A", "x", 1, 3, "extra")], "year int, prefecture string, disease string, week int, count long, note string")
    out = cumulative_to_weekly(df)
    assert out.columns == df.columns
    assert dict(out.dtypes)["count"] == "bigint"
    assert out.first()["note"] == "extra"


def test_table_without_the_columns_is_returned(spark):
    df = spark.range(3)
    assert cumulative_to_weekly(df) is df


@pytest.mark.parametrize("partitions", [1, 7])
def test_inverts_a_running_sum(spark, partitions):
    random.seed(1)
    weekly = {(a, w): random.randint(0, 9) for a in "ABC" for w in range(1, 54)}
    rows = []
    for a in "ABC":
        total = 0
        for w in range(1, 54):
            total += weekly[a, w]
            rows.append((a, "RSV", 2020, w, None, float(total), None))
    random.shuffle(rows)
    out = cumulative_to_weekly(spark.createDataFrame(rows, SCHEMA).repartition(partitions))
    assert {(r["prefecture"], r["week"]): r["count"] for r in out.collect()} == weekly


@pytest.mark.parametrize("seed", range(4))
def test_arrivals_in_any_order_give_the_batch_result(spark, seed):
    """Reports arrive shuffled, some twice with corrections, some without a value; weeks may be missing."""
    pick = random.Random(seed)
    schema = "prefecture string, year int, week int, date date, disease string, count double, per_sentinel double"
    rows = {}
    arrivals = []
    for area in ("Nara", "Gifu"):
        for year in (2023, 2024):
            weeks, total = [w for w in range(1, 13) if pick.random() < 0.85], 0
            for w in weeks:
                total += pick.randrange(0, 9)
                arrivals.append((area, year, w, None, "RSV", None if pick.random() < 0.1 else float(total), total / 4))
    arrivals += [(*r[:5], (r[5] or 0.0) + pick.choice([-3, 1]), r[6]) for r in pick.sample(arrivals, 8)]
    pick.shuffle(arrivals) if seed % 2 else None
    empty = spark.createDataFrame([], schema)
    state, current = series.last_values(empty), {}
    for at in range(0, len(arrivals), 11):
        batch = {(r[0], r[1], r[2]): r for r in arrivals[at : at + 11]}  # one row per week
        history = spark.createDataFrame(list(rows.values()), schema)
        changed, state = series.weekly_on_arrival(spark.createDataFrame(list(batch.values()), schema), history, state)
        current |= {tuple(r[:3]): tuple(r) for r in changed.collect()}
        state = spark.createDataFrame(state.collect(), state.schema)
        rows |= batch
    whole = series.cumulative_to_weekly(spark.createDataFrame(list(rows.values()), schema), unique=True)
    assert current == {tuple(r[:3]): tuple(r) for r in whole.collect()}
    assert sorted(state.collect()) == sorted(series.last_values(spark.createDataFrame(list(rows.values()), schema)).collect())


def test_a_series_that_goes_on_is_not_read(spark):
    schema = "prefecture string, year int, week int, disease string, count double"
    history = spark.createDataFrame([("Nara", 2024, w, "RSV", 2.0 * w) for w in (1, 2)], schema)
    state = series.last_values(history)
    gone = history.withColumn("count", F.lit(None).cast("double"))  # what the history says must not matter
    new = spark.createDataFrame([("Nara", 2024, 3, "RSV", 9.0), ("Nara", 2024, 5, "RSV", 12.0), ("Gifu", 2024, 4, "RSV", 1.0)], schema)
    changed, after = series.weekly_on_arrival(new, gone, state)
    assert {(r["prefecture"], r["week"], r["count"]) for r in changed.collect()} == {("Nara", 3, 5.0), ("Nara", 5, 3.0), ("Gifu", 4, None)}
    assert {(r["prefecture"], r["last_week"], r["last_count"]) for r in after.collect()} == {("Nara", 5, 12.0), ("Gifu", 4, 1.0)}
