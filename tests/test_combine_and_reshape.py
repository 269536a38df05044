import datetime as dt

import pytest
from pyspark.sql import functions as F

import weektide as wt
from weektide.operators import combine, reshape

DAY = dt.date(2024, 1, 1)
WIDE = "prefecture string, year int, week int, date date"


def wide(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join([WIDE, *[f"`{n}` double" for n in names]]))


def test_prefer_primary(spark):
    primary = spark.createDataFrame([("Influenza", 100), ("Tuberculosis", 10)], "disease string, count long")
    secondary = spark.createDataFrame(
        [("Influenza", 120.0, 1.0), ("RSV", 50.0, 2.0), (None, 1.0, 1.0)],
        "disease string, count double, per_sentinel double",
    )
    got = {tuple(r) for r in combine.prefer_primary(primary, secondary).collect()}
    assert got == {("Influenza", 100.0, None), ("Tuberculosis", 10.0, None), ("RSV", 50.0, 2.0)}


def test_prefer_primary_with_null_conditions_in_primary(spark):
    primary = spark.createDataFrame([("A", 1), (None, 2)], "disease string, count long")
    secondary = spark.createDataFrame([("A", 3), ("B", 4)], "disease string, count long")
    got = sorted(combine.prefer_primary(primary, secondary).collect(), key=str)
    assert [tuple(r) for r in got] == [("A", 1), ("B", 4), (None, 2)]


def test_merge_needs_two_tables(spark):
    with pytest.raises(ValueError, match="at least two tables"):
        wt.merge(spark.range(1))


def test_merge_joins_on_the_period(spark):
    a = wide(spark, [("Tokyo", 2024, 1, DAY, 1.0, 2.0, 3.0)], ["M total", "M male", "M female"])
    b = wide(spark, [("Tokyo", 2024, 1, DAY, 4.0, 5.0, 6.0, 7.0)], ["M x", "M Inside", "M Others", "M Unknown"])
    out = wt.merge(a, b)
    assert out.count() == 1
    assert {"M Other places", "M Unknown place"} <= set(out.columns)


def test_merge_keeps_rows_with_null_keys_and_suffixes_clashes(spark):
    a = wide(spark, [("Tokyo", 2024, 1, DAY, 1.0), (None, 2024, 1, DAY, 2.0)], ["n"])
    b = wide(spark, [("Tokyo", 2024, 1, DAY, 3.0), (None, 2024, 1, DAY, 4.0)], ["n"])
    got = {(r["prefecture"], r["n"], r["n_right"]) for r in wt.merge(a, b).collect()}
    assert got == {("Tokyo", 1.0, 3.0), (None, 2.0, None), (None, None, 4.0)}


def test_merge_of_unique_tables_needs_no_join(spark):
    a = wide(spark, [("Nara", 2024, 1, DAY, 1.0), ("Mie", 2024, 1, DAY, None), (None, 2024, 1, DAY, 2.0)], ["n"])
    b = wide(spark, [("Nara", 2024, 1, DAY, 3.0), ("Oita", 2024, 2, DAY, 5.0), (None, 2024, 1, DAY, 4.0)], ["n"])
    out = wt.merge(a, b, unique=True)
    assert "Join" not in out._jdf.queryExecution().toString()
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, wt.merge(a, b).select(out.columns).collect()), key=str)
    assert wt.merge(a.where("false"), b.where("false"), unique=True).collect() == []


def test_a_hot_key_is_folded_before_the_shuffle_and_refused(spark):
    """A third of all rows under one key: a task sends one row of it, and the key is named."""
    rows = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "Nara").otherwise(F.concat(F.lit("a"), "id")).alias("prefecture"),
        F.lit(2024).alias("year"), F.lit(1).alias("week"), F.lit(DAY).alias("date"), F.col("id").alias("n"),
    )
    other = wide(spark, [("Nara", 2024, 1, DAY, 3.0)], ["m"])
    with pytest.raises(Exception, match="More than one row for a key: Nara, 2024, 1"):
        wt.merge(rows, other, unique=True).collect()
    out = wt.merge(rows.where("id % 3 > 0 OR id = 0"), other, unique=True)
    assert out.count() == 40_001
    with pytest.raises(ValueError, match="share value columns"):
        combine.fold_per_key(other, other, keys=["prefecture", "year", "week", "date"])


def test_merge_appends_further_tables(spark):
    a = wide(spark, [("Tokyo", 2024, 1, DAY, 1.0)], ["p"])
    b = wide(spark, [("Osaka", 2024, 1, DAY, 2.0)], ["q"])
    c = wide(spark, [("Nara", 2024, 1, DAY, 3.0)], ["z"])
    assert {(r["prefecture"], r["p"], r["q"], r["z"]) for r in wt.merge(a, b, c).collect()} == {
        ("Tokyo", 1.0, None, None),
        ("Osaka", None, 2.0, None),
        ("Nara", None, None, 3.0),
    }


def test_table_kinds():
    keys = ["prefecture", "year", "week", "date"]
    assert combine.table_kind(["disease", "cases"]) == "long"
    assert combine.table_kind([*keys, "Rubella weekly"]) == "bullet"
    assert combine.table_kind([*keys, "Rubella total", "Rubella Male weekly"]) == "sex"
    assert combine.table_kind([*keys, *(f"{d} {c}" for d in "abc" for c in ("Japan", "Others", "Unknown", "x"))]) == "place"
    assert combine.table_kind([*keys, "a", "b", "c"]) is None
    assert combine.table_kind([*keys, "a male", "a unknown"]) is None


def test_names_are_aligned(spark):
    df = wide(spark, [("Nara", 2024, 1, DAY, 1.0, 2.0)], ["Mumps weekly", "biweekly x"])
    assert combine.align_names(df).columns[-2:] == ["Mumps total", "biweekly x"]
    place = wide(spark, [("Nara", 2024, 1, DAY, 1.0, 2.0)], ["Mumps Unknown", "Mumps Others"])
    assert combine.align_names(place).columns[-2:] == ["Mumps Unknown place", "Mumps Other places"]
    assert combine.align_names(place, kind="sex").columns == place.columns


def test_area_codes(spark):
    df = spark.createDataFrame([("Tokyo",), ("Hokkaido",), ("Atlantis",)], "prefecture string")
    got = {r[0]: r[1] for r in wt.attach_prefecture_id(df).collect()}
    assert got == {"Tokyo": "JP-13", "Hokkaido": "JP-01", "Atlantis": None}
    codes = wt.prefecture_map()
    assert len(codes) == 47 and codes["Okinawa"] == "JP-47" and codes["Osaka"] == "JP-27"
    codes["Tokyo"] = "changed"
    assert wt.prefecture_map()["Tokyo"] == "JP-13"


def test_alias_join(spark):
    df = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "disease string, n int")
    aliases = spark.createDataFrame([("a", "A")], "raw string, canonical string")
    got = {tuple(r) for r in combine.alias_join(df, aliases, "disease").collect()}
    assert got == {("A", 1), ("z", 2), (None, 3)}


def test_relaxed_union(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2.5, 7)], "n double, s int")
    got = combine.union_relaxed(a, b).collect()
    assert {tuple(r) for r in got} == {(1.0, "x"), (2.5, "7")}
    with pytest.raises(ValueError, match="different columns"):
        combine.union_strict(a, a.drop("s"))


def test_default_category(spark):
    df = spark.createDataFrame([("male",), (None,)], "category string")
    assert sorted(r[0] for r in combine.default_category(df).collect()) == ["male", "total"]
    assert combine.default_category(spark.range(1)).columns == ["id"]


KEYED = "prefecture string, year int, week int, disease string, category string, source string, count double"


def test_first_source_wins(spark):
    key = ("Tokyo", 2024, 1, "Measles", "total")
    old = spark.createDataFrame([(*key, "old", 9.0)], KEYED)
    new = spark.createDataFrame([(*key, "new", 1.0)], KEYED)
    last = spark.createDataFrame([(*key, "last", 0.0), ("Osaka", *key[1:], "last", 5.0)], KEYED)
    got = {(r["prefecture"], r["source"], r["count"]) for r in combine.ordered_sources(old, new, last).collect()}
    assert got == {("Tokyo", "old", 9.0), ("Osaka", "last", 5.0)}


@pytest.mark.parametrize("partitions", [1, 17])
def test_dedup_does_not_depend_on_partitions(spark, partitions):
    rows = [("Tokyo", 2024, 1, "M", "total", f"s{i % 7}", float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, KEYED).repartition(partitions)
    assert [tuple(r) for r in combine.dedup_first(df).collect()] == [("Tokyo", 2024, 1, "M", "total", "s0", 0.0)]


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([("Tokyo", 2024, 1, "M", "total", "s", 1.0)], KEYED)
    plan = combine.dedup_first(df)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pivot_round_trip(spark):
    df = spark.createDataFrame(
        [("Tokyo", 2024, 1, DAY, "Influenza", 18.0), ("Osaka", 2024, 1, DAY, "Influenza", 7.0)],
        WIDE + ", disease string, cases double",
    )
    flat = wt.pivot(df)
    assert "Influenza" in flat.columns
    back = wt.pivot(flat)
    assert sorted(back.columns) == sorted(df.columns)
    assert sorted(back.select(df.columns).collect()) == sorted(df.collect())


def test_pivot_of_an_unknown_shape(spark):
    with pytest.raises(ValueError, match="missing: prefecture, year, week, date"):
        wt.pivot(spark.range(1))


def test_pivot_refuses_two_values_for_one_cell(spark):
    df = spark.range(2).select(F.lit("a").alias("prefecture"), F.lit(1).alias("year"), F.lit(1).alias("week"),
                               F.lit(DAY).alias("date"), F.lit("Mumps").alias("disease"), F.col("id").alias("cases"))
    assert wt.pivot(df.where("id = 1")).first()["Mumps"] == 1
    with pytest.raises(Exception, match="More than one value of Mumps"):
        wt.pivot(df).collect()


def test_unpivot_of_mixed_types(spark):
    df = spark.createDataFrame([("T", 2024, 1, DAY, 1, "x")], WIDE + ", a int, b string")
    got = {(r["disease"], r["cases"]) for r in wt.pivot(df).collect()}
    assert got == {("a", "1"), ("b", "x")}


def test_split_headers(spark):
    df = spark.createDataFrame(
        [("T", 2024, 1, DAY, 1, 2, 3)],
        WIDE + ", `HIV/AIDS||total` int, `HIV/AIDS||male` int, `HIV/AIDS||male_1` int",
    )
    got = {(r["disease"], r["category"], r["count"]) for r in reshape.split_headers(df).collect()}
    assert got == {("AIDS", "total", 1), ("AIDS", "male", 2)}
    plain = spark.range(1)
    assert reshape.split_headers(plain) is plain


SEX = WIDE + ", disease string, category string, count long"


def sexes(spark, rows):
    df = spark.createDataFrame([("T", 2024, w, DAY, "TB", c, n) for w, c, n in rows], SEX)
    return {(r["week"], r["category"], r["count"]) for r in reshape.derive_complement(df).collect()}


def test_complement_is_derived(spark):
    rows = [(1, "total", 10), (1, "male", 6), (2, "total", 5), (3, "male", 1)]
    assert sexes(spark, rows) == {*rows, (1, "female", 4)}


def test_complement_is_not_derived_when_present_anywhere(spark):
    rows = [(1, "total", 10), (1, "male", 6), (2, "female", 1)]
    assert sexes(spark, rows) == set(rows)


def test_complement_needs_both_parts(spark):
    assert sexes(spark, [(1, "total", 10)]) == {(1, "total", 10)}


def test_pivot_category(spark):
    df = spark.createDataFrame([("T", "male", 1.0), ("T", "male", None), ("O", "total", 3.0)],
                               "prefecture string, category string, count double")
    got = {tuple(r) for r in reshape.pivot_category(df, ["prefecture"], ["male", "total"]).collect()}
    assert got == {("T", 1.0, None), ("O", None, 3.0)}


def test_pairs(spark):
    df = spark.createDataFrame([("T", 1, 0.5, 9)], "prefecture string, c1 int, r1 double, c2 int")
    got = {tuple(r) for r in reshape.unpivot_pairs(df, ["prefecture"], [("A", "c1", "r1"), ("B", "c2", None)]).collect()}
    assert got == {("T", "A", 1.0, 0.5), ("T", "B", 9.0, None)}


def test_pivot_without_reading_the_table_for_names(spark):
    rows = [("Nara", 2024, 1, DAY, c, float(n)) for n, c in enumerate(["Mumps", "Measles", "Cholera"])]
    rows += [("Gifu", 2024, 1, DAY, "Mumps", 9.0), ("Gifu", 2024, 1, DAY, None, 8.0)]
    df = spark.createDataFrame(rows, "prefecture string, year int, week int, date date, disease string, cases double")
    names = spark.createDataFrame([("Mumps",), ("Measles",), ("Rubella",), (None,)], "disease string")
    boom = F.udf(lambda x: 1 / 0, "double")
    reshape.pivot_map(df.withColumn("cases", boom("cases")))  # nothing runs
    broken = df.withColumn("disease", F.concat("disease", F.raise_error(F.lit("the table was read"))))
    assert reshape.pivot_long(broken, dimension=names).columns[4:] == ["Measles", "Mumps", "Rubella"]
    cells = {r["prefecture"]: r["cells"] for r in reshape.pivot_map(df).collect()}
    assert cells == {"Nara": {"Cholera": 2.0, "Measles": 1.0, "Mumps": 0.0}, "Gifu": {"Mumps": 9.0}}
    got = reshape.map_columns(reshape.pivot_map(df), names)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, reshape.pivot_long(df, dimension=names).collect()), key=str)
    with pytest.raises(Exception, match="More than one value of Mumps"):
        reshape.pivot_map(df.unionByName(df.where("disease = 'Mumps'"))).collect()
