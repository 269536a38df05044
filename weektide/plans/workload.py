"""Registered queries over the given tables, each with the SQL that must give the same rows.

Orders are read as case reports: area = nation of the customer, period = ISO week of the order
date, condition = priority, source = status, count = number of orders.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weektide.functions import calendar, numbers, text
from weektide.model import CONDITION_ALIASES, DATASET_FILES, Cols
from weektide.operators import aggregate, combine, filters, grid, quality, reshape, series, snapshot
from weektide.plans import build, report_grids
from weektide.session import remove_folder, shared_folder
from weektide.sources import reports
from weektide.sources.catalog import Catalog
from weektide.sources.versions import Versions

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

COLS = Cols(area="area", condition="cond", count="cnt", rate="rate")
GROUPS = {"confirmed": ("F", "O"), "sentinel": ("P",)}
URGENT = ("1-URGENT", "2-HIGH")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def catalog(spark: SparkSession, folder: str) -> Catalog:
    return Catalog(spark, folder, {t: f"{t}.parquet" for t in TABLES}, {"cases": "orders"}, COLS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with area, date and period."""
    orders = table(spark, folder, "orders").select(
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("date"),
        calendar.iso_year("o_orderdate").alias("year"),
        calendar.iso_week("o_orderdate").alias("week"),
        F.col("o_orderpriority").alias("cond"),
        F.col("o_orderstatus").alias("source"),
    )
    people = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("area"))
    return (
        orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("area", F.col("n_nationkey").alias("nationkey"), "year", "week", "date", "cond", "source")
    )


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Cases per area, week, condition and source."""
    keys = ["area", "year", "week", "cond", "source"]
    return cases(spark, folder).groupBy(*keys).agg(F.count("*").alias("cnt"))


def weekly(spark: SparkSession, folder: str) -> DataFrame:
    """Cases per area, week and condition."""
    keys = ["area", "nationkey", "year", "week", "cond"]
    return cases(spark, folder).groupBy(*keys).agg(F.count("*").alias("cnt"))


def cumulative(spark: SparkSession, folder: str) -> DataFrame:
    """Year-to-date counts per series; a series has one row per week."""
    return _year_to_date(weekly(spark, folder))


def _year_to_date(counts: DataFrame) -> DataFrame:
    w = Window.partitionBy("year", "area", "cond").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("cnt", F.sum("cnt").over(w))


def grid_obs(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["area", "nationkey", "year", "week", "cond", "source"]
    return cases(spark, folder).groupBy(*keys).agg(F.count("*").alias("cnt"))


def _book_obs(spark: SparkSession, folder: str) -> DataFrame:
    return grid_obs(spark, folder).withColumn("year", F.col("year") + 28)


_CASES = """cases AS (
  SELECT n_name AS area, n_nationkey AS nationkey, CAST(isoyear(o_orderdate) AS INTEGER) AS year,
         CAST(weekofyear(o_orderdate) AS INTEGER) AS week, CAST(o_orderdate AS DATE) AS date,
         o_orderpriority AS cond, o_orderstatus AS source
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
_OBS = f"""WITH {_CASES}, obs AS (
  SELECT area, year, week, cond, source, count(*) AS cnt FROM cases GROUP BY ALL)"""
_WEEKLY = f"""WITH {_CASES}, weekly AS (
  SELECT area, nationkey, year, week, cond, count(*) AS cnt FROM cases GROUP BY ALL)"""
_CUM = f"""{_WEEKLY}, cum AS (
  SELECT area, nationkey, year, week, cond, CAST(sum(cnt) OVER (
    PARTITION BY year, area, cond ORDER BY week ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cnt FROM weekly)"""
_STEP = """CASE WHEN cnt IS NULL THEN NULL WHEN week = 1 THEN cnt
  WHEN cnt - prev < 0 THEN NULL ELSE cnt - prev END"""


def _monday(year: str, week: str) -> str:
    jan4 = f"make_date({year}, 1, 4)"
    day = f"CAST({jan4} + CAST(({week} - 1) * 7 - (isodow({jan4}) - 1) AS INTEGER) AS DATE)"
    return f"CASE WHEN {week} BETWEEN 1 AND 53 AND isoyear({day}) = {year} THEN {day} END"


# -- aggregations -------------------------------------------------------------------------------


@query(
    "burden_topk",
    f"""{_OBS}, t AS (SELECT year, cond, CAST(sum(cnt) AS BIGINT) AS cases FROM obs GROUP BY ALL)
SELECT * FROM (SELECT year, cond, cases, CAST(dense_rank() OVER (PARTITION BY year ORDER BY cases DESC) AS INTEGER)
  AS rank_within_year FROM t) WHERE rank_within_year <= 2""",
)
def _(spark, folder):
    return aggregate.top_burden(observations(spark, folder), 2, COLS)


@query(
    "sum_by_condition",
    f"""{_OBS} SELECT cond, CAST(sum(CASE WHEN week % 7 <> 0 THEN cnt ELSE 0 END) AS BIGINT) AS cases
FROM obs GROUP BY cond""",
)
def _(spark, folder):
    gaps = observations(spark, folder).withColumn("cnt", F.when(F.col("week") % 7 != 0, F.col("cnt")))
    return aggregate.sum_by(gaps, ["cond"], cols=COLS)


@query(
    "null_group_sum",
    f"""{_OBS} SELECT week, CAST(sum(CASE WHEN week % 7 <> 0 THEN cnt ELSE 0 END) AS BIGINT) AS cases
FROM obs GROUP BY week""",
)
def _(spark, folder):
    gaps = observations(spark, folder).withColumn("cnt", F.when(F.col("week") % 7 != 0, F.col("cnt")))
    return aggregate.sum_by(gaps, ["week"], cols=COLS)


@query(
    "dup_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("latest_period", f"{_OBS} SELECT year, week FROM obs ORDER BY year DESC, week DESC LIMIT 1")
def _(spark, folder):
    return aggregate.latest_period(observations(spark, folder), COLS)


@query(
    "coverage",
    f"""{_OBS} SELECT cond, min(year) AS first_year, CAST(min(year * 100 + week) % 100 AS INTEGER) AS first_week,
  max(year) AS last_year, CAST(max(year * 100 + week) % 100 AS INTEGER) AS last_week,
  string_agg(DISTINCT source, ', ' ORDER BY source) AS sources, CAST(sum(cnt) AS BIGINT) AS total_cases,
  count(*) AS rows,
  printf('%d-W%02d', min(year), CAST(min(year * 100 + week) % 100 AS INTEGER)) AS first_period,
  printf('%d-W%02d', max(year), CAST(max(year * 100 + week) % 100 AS INTEGER)) AS last_period
FROM obs GROUP BY cond""",
)
def _(spark, folder):
    return aggregate.coverage(observations(spark, folder), COLS)


@query(
    "table_totals",
    f"""{_OBS} SELECT count(*) AS rows, min(year) AS min_year, max(year) AS max_year,
  count(DISTINCT cond) AS conditions, count(DISTINCT area) AS areas FROM obs""",
)
def _(spark, folder):
    return aggregate.table_totals(observations(spark, folder), COLS)


@query(
    "period_bounds",
    f"""{_OBS}, b AS (SELECT CAST(min(year * 100 + week) AS BIGINT) AS lo, CAST(max(year * 100 + week) AS BIGINT) AS hi
  FROM obs)
SELECT lo AS min_period, hi AS max_period, {_monday("CAST(lo // 100 AS INTEGER)", "CAST(lo % 100 AS INTEGER)")} AS date_min,
  {_monday("CAST(hi // 100 AS INTEGER)", "CAST(hi % 100 AS INTEGER)")} AS date_max FROM b""",
)
def _(spark, folder):
    return aggregate.period_bounds(observations(spark, folder), COLS)


@query(
    "peak_week",
    f"""{_OBS}, w AS (SELECT year, week, CAST(sum(cnt) AS BIGINT) AS cases FROM obs GROUP BY ALL)
SELECT year, max(cases) AS peak_cases, first(week ORDER BY cases DESC, week) AS peak_week FROM w GROUP BY year""",
)
def _(spark, folder):
    return aggregate.yearly_peak(observations(spark, folder), COLS)


@query(
    "weekly_totals",
    f"{_OBS} SELECT year, week, CAST(sum(cnt) AS BIGINT) AS cases FROM obs GROUP BY ALL",
)
def _(spark, folder):
    return aggregate.weekly_totals(observations(spark, folder), COLS)


@query(
    "early_warning",
    f"""WITH {_CASES}, m AS (SELECT max(date) AS latest FROM cases), t AS (
  SELECT area, count(*) FILTER (date >= latest - 27) AS recent_4w,
    count(*) FILTER (date BETWEEN latest - 55 AND latest - 28) AS previous_4w
  FROM cases, m GROUP BY area)
SELECT area, recent_4w, previous_4w, recent_4w - previous_4w AS absolute_change FROM t""",
)
def _(spark, folder):
    daily = cases(spark, folder).groupBy("area", "date").agg(F.count("*").alias("cnt"))
    return aggregate.recent_change(daily, 28, COLS)


@query(
    "category_ratio",
    f"""{_OBS}, p AS (SELECT year, CAST(sum(cnt) FILTER (source = 'F') AS BIGINT) AS "F",
  CAST(sum(cnt) FILTER (source = 'O') AS BIGINT) AS "O", CAST(sum(cnt) FILTER (source = 'P') AS BIGINT) AS "P"
  FROM obs GROUP BY year)
SELECT year, "F", "O", "P", round("F" / nullif("O", 0), 6) AS "F_O_ratio" FROM p""",
)
def _(spark, folder):
    by_source = observations(spark, folder).withColumnRenamed("source", "category")
    out = aggregate.category_ratio(by_source, "F", "O", ("F", "O", "P"), COLS)
    return out.withColumn("F_O_ratio", F.round("F_O_ratio", 6))


@query("area_rank", f"{_OBS} SELECT area, CAST(sum(cnt) AS BIGINT) AS cases FROM obs GROUP BY area")
def _(spark, folder):
    return aggregate.area_ranking(observations(spark, folder), COLS)


@query(
    "area_week_profile",
    f"{_OBS} SELECT year, area, week, CAST(sum(cnt) AS BIGINT) AS weekly_cases FROM obs GROUP BY ALL",
)
def _(spark, folder):
    return aggregate.area_week_profile(observations(spark, folder), COLS, by=("year",))


@query(
    "sum_numeric_with_code",
    f"""{_OBS}, t AS (SELECT year, area, CAST(sum(cnt) AS BIGINT) AS cnt FROM obs GROUP BY ALL)
SELECT year, area, cnt, CASE WHEN n_nationkey % 5 <> 0 THEN 'X-' || n_nationkey END AS area_code
FROM t JOIN nation ON area = n_name""",
)
def _(spark, folder):
    dim = (
        table(spark, folder, "nation")
        .where("n_nationkey % 5 <> 0")
        .select(F.col("n_name").alias("area"), F.concat(F.lit("X-"), "n_nationkey").alias("area_code"))
    )
    rows = observations(spark, folder).select("year", "area", "cnt")
    return aggregate.sum_numeric_by(rows, ["year", "area"]).transform(combine.attach_dimension, dim, "area")


@query(
    "rows_per_week",
    f"{_OBS} SELECT year, week, count(*) AS rows FROM obs GROUP BY ALL ORDER BY year DESC, week DESC LIMIT 5",
)
def _(spark, folder):
    return aggregate.newest_period_counts(observations(spark, folder), 5, COLS)


@query(
    "projection_limit",
    f"WITH {_CASES} SELECT date, area, cond, source FROM cases ORDER BY date, area, cond, source LIMIT 20",
)
def _(spark, folder):
    columns = ["date", "area", "cond", "source"]
    return aggregate.first_rows(cases(spark, folder), columns, columns)


@query(
    "burden_two_measures",
    f"""{_OBS} SELECT area, CAST(sum(cnt) AS BIGINT) AS cases, count(*) AS reports FROM obs GROUP BY area
ORDER BY cases DESC, reports DESC, area LIMIT 10""",
)
def _(spark, folder):
    return (
        observations(spark, folder)
        .groupBy("area")
        .agg(aggregate.null_safe_sum("cnt").alias("cases"), F.count("*").alias("reports"))
        .orderBy(F.desc("cases"), F.desc("reports"), "area")
        .limit(10)
    )


# -- series -------------------------------------------------------------------------------------


@query(
    "cum_to_weekly",
    f"""{_CUM}, l AS (SELECT *, lag(cnt) OVER (PARTITION BY year, area, cond ORDER BY week) AS prev FROM cum)
SELECT area, year, week, cond, {_STEP} AS cnt FROM l""",
)
def _(spark, folder):
    raw = cumulative(spark, folder).drop("nationkey")
    return series.cumulative_to_weekly(raw, COLS, unique=True)


@query(
    "cum_to_weekly_corrections",
    f"""{_CUM}, c AS (SELECT area, year, week, cond, CASE WHEN week % 7 = 0 THEN cnt // 2 WHEN week % 13 = 0 THEN NULL
  ELSE cnt END AS cnt FROM cum WHERE week % 11 <> 3),
l AS (SELECT *, lag(cnt) OVER (PARTITION BY year, area, cond ORDER BY week) AS prev FROM c)
SELECT area, year, week, cond, {_STEP} AS cnt FROM l""",
)
def _(spark, folder):
    raw = (
        cumulative(spark, folder)
        .drop("nationkey")
        .where("week % 11 <> 3")
        .withColumn("cnt", F.expr("CASE WHEN week % 7 = 0 THEN cnt DIV 2 WHEN week % 13 = 0 THEN NULL ELSE cnt END"))
    )
    return series.cumulative_to_weekly(raw, COLS, unique=True)


@query(
    "cum_to_weekly_copies",
    f"""{_CUM}, c AS (SELECT area, year, week, cond, cnt FROM cum
  UNION ALL SELECT area, year, week, cond, cnt FROM cum WHERE week % 5 = 0
  UNION ALL SELECT area, year, week, cond, cnt + 1 FROM cum WHERE week % 10 = 0),
l AS (SELECT *, lag(cnt) OVER (PARTITION BY year, area, cond ORDER BY week, cnt) AS prev FROM c)
SELECT area, year, week, cond, {_STEP} AS cnt FROM l""",
)
def _(spark, folder):
    raw = cumulative(spark, folder).drop("nationkey")
    corrected = raw.where("week % 10 = 0").withColumn("cnt", F.col("cnt") + 1)
    copies = raw.unionByName(raw.where("week % 5 = 0")).unionByName(corrected)
    return series.cumulative_to_weekly(copies, COLS)


@query(
    "implied_rate",
    f"""{_CUM}, c AS (SELECT area, year, week, cond, CAST(cnt AS DOUBLE) AS cnt,
  CASE WHEN week % 9 = 0 THEN 0.0 ELSE cnt / (10.0 + nationkey) END AS rate FROM cum),
l AS (SELECT *, lag(cnt) OVER (PARTITION BY year, area, cond ORDER BY week) AS prev FROM c),
s AS (SELECT *, {_STEP} AS w, CASE WHEN cnt > 0 AND rate > 0 THEN cnt / rate END AS sites FROM l)
SELECT area, year, week, cond, w AS cnt, round(CASE WHEN w IS NULL THEN NULL WHEN w = 0 THEN 0.0
  WHEN sites IS NULL OR sites <= 0 THEN NULL ELSE w / sites END, 6) AS rate FROM s""",
)
def _(spark, folder):
    raw = cumulative(spark, folder).select(
        "area",
        "year",
        "week",
        "cond",
        F.col("cnt").cast("double").alias("cnt"),
        F.expr("CASE WHEN week % 9 = 0 THEN 0D ELSE cnt / (10D + nationkey) END").alias("rate"),
    )
    return series.cumulative_to_weekly(raw, COLS, unique=True).withColumn("rate", F.round("rate", 6))


@query(
    "weekly_on_arrival",
    f"""{_CUM}, c AS (SELECT area, year, week, cond, CASE WHEN week % 9 = 4 THEN cnt + 2 ELSE cnt END AS cnt FROM cum),
l AS (SELECT *, lag(cnt) OVER (PARTITION BY year, area, cond ORDER BY week) AS prev FROM c)
SELECT area, year, week, cond, {_STEP} AS cnt FROM l""",
)
def _(spark, folder):
    """Two thirds of the weeks first, then the others with corrections of what was there: the last word on each
    week is the result of all rows at once."""
    rows = cumulative(spark, folder).drop("nationkey")
    now = rows.withColumn("cnt", F.when(F.col("week") % 9 == 4, F.col("cnt") + 2).otherwise(F.col("cnt")))
    early, late = "week < 20", "week >= 20 OR week % 9 = 4"
    changed, state = series.weekly_on_arrival(rows.where(early), rows.where("false"), series.last_values(rows.where("false"), COLS), COLS)
    again, _ = series.weekly_on_arrival(now.where(late), rows.where(early), state, COLS)
    both = changed.withColumn("run", F.lit(1)).unionByName(again.withColumn("run", F.lit(2)))
    last = F.max_by("cnt", "run").alias("cnt")
    return both.groupBy("area", "year", "week", "cond").agg(last)


# -- joins and sets -----------------------------------------------------------------------------


@query(
    "prefer_primary",
    f"""{_OBS}, a AS (SELECT * FROM obs WHERE source <> 'O' AND cond < '4'),
b AS (SELECT area, year, week, CASE WHEN week % 10 = 0 THEN NULL ELSE cond END AS cond, source, cnt FROM obs
  WHERE source = 'O' OR cond >= '4')
SELECT * FROM a UNION ALL SELECT * FROM b WHERE cond IS NOT NULL AND NOT EXISTS (SELECT 1 FROM a WHERE a.cond = b.cond)""",
)
def _(spark, folder):
    obs = observations(spark, folder)
    primary = obs.where("source <> 'O' AND cond < '4'")
    secondary = obs.where("source = 'O' OR cond >= '4'").withColumn("cond", F.when(F.col("week") % 10 != 0, F.col("cond")))
    return combine.prefer_primary(primary, secondary, COLS)


@query(
    "dedup_first",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, l_partkey NULLS LAST, l_suppkey NULLS LAST,
  l_quantity NULLS LAST, l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST,
  l_returnflag NULLS LAST, l_linestatus NULLS LAST, l_shipdate NULLS LAST) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(spark, folder):
    priority = F.expr("CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END")
    return combine.dedup_first(table(spark, folder, "lineitem"), priority, ["l_orderkey", "l_linenumber"])


@query(
    "merge_full",
    f"""WITH {_CASES}, d AS (SELECT area, year, week, {_monday("year", "week")} AS date, source FROM cases),
a AS (SELECT area, year, week, date, count(*) AS n_f FROM d WHERE source = 'F' GROUP BY ALL),
b AS (SELECT area, year, week, date, count(*) FILTER (source = 'O') AS n_o, count(*) FILTER (source = 'P') AS n_p
  FROM d WHERE source <> 'F' GROUP BY ALL)
SELECT area, year, week, date, n_f, n_o, n_p FROM a FULL JOIN b USING (area, year, week, date)""",
)
def _(spark, folder):
    open_or_partial = (
        cases(spark, folder)
        .where("source <> 'F'")
        .withColumn("date", calendar.iso_monday("year", "week"))
        .groupBy("area", "year", "week", "date")
        .agg(F.count_if(F.col("source") == "O").alias("n_o"), F.count_if(F.col("source") == "P").alias("n_p"))
    )
    return combine.merge(_wide(spark, folder, "F", "n_f"), open_or_partial, cols=COLS, unique=True)


def _wide(spark, folder, source, name, null_area_week=None):
    part = cases(spark, folder).where(F.col("source") == source)
    if null_area_week is not None:
        part = part.withColumn("area", F.when(F.col("week") != null_area_week, F.col("area")))
    part = part.withColumn("date", calendar.iso_monday("year", "week"))
    return part.groupBy("area", "year", "week", "date").agg(F.count("*").alias(name))


@query(
    "merge_three",
    f"""WITH {_CASES}, d AS (SELECT CASE WHEN week <> 5 THEN area END AS area, year, week,
  {_monday("year", "week")} AS date, source FROM cases),
a AS (SELECT area, year, week, date, count(*) AS n FROM d WHERE source = 'F' GROUP BY ALL),
b AS (SELECT area, year, week, date, count(*) AS n_right FROM d WHERE source = 'O' GROUP BY ALL),
c AS (SELECT area, year, week, date, count(*) AS n_p FROM d WHERE source = 'P' GROUP BY ALL)
SELECT area, year, week, date, n, n_right, CAST(NULL AS BIGINT) AS n_p FROM a FULL JOIN b USING (area, year, week, date)
UNION ALL SELECT area, year, week, date, NULL, NULL, n_p FROM c""",
)
def _(spark, folder):
    parts = [_wide(spark, folder, s, n, 5) for s, n in (("F", "n"), ("O", "n"), ("P", "n_p"))]
    return combine.merge(*parts, cols=COLS, unique=True)


@query(
    "merge_place_bullet",
    f"""WITH {_CASES}, d AS (SELECT area, year, week, {_monday("year", "week")} AS date, source FROM cases),
a AS (SELECT area, year, week, date, count(*) FILTER (source = 'F') AS "Flu Japan", count(*) FILTER (source = 'O') AS "Flu Other places",
  count(*) FILTER (source = 'P') AS "Flu Unknown place" FROM d WHERE week % 3 > 0 GROUP BY ALL),
b AS (SELECT area, year, week, date, count(*) AS "Flu total" FROM d WHERE week % 3 < 2 GROUP BY ALL)
SELECT area, year, week, date, "Flu Japan", "Flu Other places", "Flu Unknown place", "Flu total" FROM a FULL JOIN b USING (area, year, week, date)""",
)
def _(spark, folder):
    rows = cases(spark, folder).withColumn("date", calendar.iso_monday("year", "week"))
    keys = ["area", "year", "week", "date"]
    count = lambda s: F.count(F.when(F.col("source") == s, 1))
    place = rows.where("week % 3 > 0").groupBy(keys).agg(
        count("F").alias("Flu Japan"), count("O").alias("Flu Others"), count("P").alias("Flu Unknown")
    )
    bullet = rows.where("week % 3 < 2").groupBy(keys).agg(F.count("*").alias("Flu weekly"))
    return combine.merge(place, bullet, cols=COLS, unique=True)


@query(
    "attach_dim",
    f"""{_OBS} SELECT obs.*, r_name AS region FROM obs LEFT JOIN (SELECT n_name, r_name FROM nation JOIN region
  ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 0) ON area = n_name""",
)
def _(spark, folder):
    dim = (
        table(spark, folder, "nation")
        .where("n_nationkey % 5 <> 0")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("area"), F.col("r_name").alias("region"))
    )
    return combine.attach_dimension(observations(spark, folder), dim, "area")


@query(
    "attach_area_code",
    f"""WITH {_CASES}, o AS (SELECT CASE WHEN nationkey = 3 THEN 'Tokyo' WHEN nationkey = 7 THEN 'Okinawa' ELSE area END AS area
  FROM cases)
SELECT area, count(*) AS cases, CASE area WHEN 'Tokyo' THEN 'JP-13' WHEN 'Okinawa' THEN 'JP-47' END AS prefecture_id
FROM o GROUP BY area""",
)
def _(spark, folder):
    known = F.expr("CASE WHEN nationkey = 3 THEN 'Tokyo' WHEN nationkey = 7 THEN 'Okinawa' ELSE area END")
    per_area = cases(spark, folder).withColumn("area", known).groupBy("area").agg(F.count("*").alias("cases"))
    return combine.attach_prefecture_id(per_area, prefecture_col="area")


@query(
    "alias_join",
    f"""{_OBS}, a AS (SELECT DISTINCT o_orderpriority AS raw, 'prio ' || substr(o_orderpriority, 1, 1) AS canonical FROM orders
  WHERE o_orderpriority <> '5-LOW')
SELECT area, year, week, coalesce(canonical, cond) AS cond, source, cnt FROM obs LEFT JOIN a ON cond = raw""",
)
def _(spark, folder):
    names = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("raw")).distinct()
    aliases = names.where("raw <> '5-LOW'").withColumn("canonical", F.expr("'prio ' || substr(raw, 1, 1)"))
    return combine.alias_join(observations(spark, folder), aliases, "cond")


@query(
    "exclude_years",
    f"{_OBS} SELECT * FROM obs WHERE year NOT IN (SELECT year FROM obs WHERE week = 53)",
)
def _(spark, folder):
    obs = observations(spark, folder)
    return filters.exclude_years(obs, obs.where("week = 53"), COLS)


@query(
    "union_relaxed",
    f"""{_OBS} SELECT area, year, week, CAST(cnt AS DOUBLE) AS cnt, source, CAST(NULL AS DOUBLE) AS rate FROM obs WHERE source <> 'P'
UNION ALL SELECT area, year, week, cnt * 0.5, NULL, cnt / 4.0 FROM obs WHERE source = 'P'""",
)
def _(spark, folder):
    obs = observations(spark, folder)
    first = obs.where("source <> 'P'").select("area", "year", "week", "cnt", "source")
    second = obs.where("source = 'P'").selectExpr("area", "year", "week", "cnt * 0.5D AS cnt", "cnt / 4D AS rate")
    return combine.union_relaxed(first, second)


@query(
    "union_mixed_types",
    f"""{_OBS} SELECT area, CAST(cnt AS STRING) AS value FROM obs WHERE source <> 'P'
UNION ALL SELECT area, cond FROM obs WHERE source = 'P'""",
)
def _(spark, folder):
    obs = observations(spark, folder)
    first = obs.where("source <> 'P'").select("area", F.col("cnt").alias("value"))
    return combine.union_relaxed(first, obs.where("source = 'P'").select("area", F.col("cond").alias("value")))


@query(
    "default_category",
    f"{_OBS} SELECT area, year, week, cond, cnt, CASE WHEN source = 'F' THEN 'total' ELSE source END AS category FROM obs",
)
def _(spark, folder):
    obs = observations(spark, folder).withColumn("category", F.when(F.col("source") != "F", F.col("source")))
    return combine.default_category(obs.drop("source"), COLS)


@query("distinct_conditions", "SELECT DISTINCT o_orderpriority AS cond FROM orders")
def _(spark, folder):
    return aggregate.distinct_values(cases(spark, folder), "cond")


@query(
    "distinct_conditions_by_source",
    "SELECT DISTINCT o_orderpriority AS cond FROM orders WHERE o_orderstatus IN ('F', 'O')",
)
def _(spark, folder):
    confirmed = filters.by_source_group(cases(spark, folder), "confirmed", COLS, GROUPS)
    return aggregate.distinct_values(confirmed, "cond")


@query("distinct_areas", f"WITH {_CASES} SELECT DISTINCT area FROM cases")
def _(spark, folder):
    return aggregate.distinct_values(cases(spark, folder), "area")


# -- reshape ------------------------------------------------------------------------------------

_PRIORITY_ROWS = "(VALUES " + ", ".join(f"('{p}')" for p in report_grids.PRIORITIES) + ") p(cond)"
_PIVOTED = ", ".join(f"CAST(sum(cnt) FILTER (cond = '{p}') AS BIGINT) AS \"{p}\"" for p in report_grids.PRIORITIES)
_DATED = f"""{_WEEKLY}, dated AS (SELECT *, {_monday("year", "week")} AS date FROM weekly)"""


def _dated(spark, folder):
    return weekly(spark, folder).drop("nationkey").withColumn("date", calendar.iso_monday("year", "week"))


@query("pivot_wide", f"{_DATED} SELECT area, year, week, date, {_PIVOTED} FROM dated GROUP BY ALL")
def _(spark, folder):
    return reshape.pivot(_dated(spark, folder), "cnt", report_grids.PRIORITIES, COLS)


@query(
    "pivot_inferred",
    f"{_DATED} SELECT area, year, week, date, {_PIVOTED} FROM dated GROUP BY ALL",
)
def _(spark, folder):
    return reshape.pivot(_dated(spark, folder), "cnt", cols=COLS)


@query(
    "pivot_map",
    f"{_DATED} SELECT area, year, week, date, {_PIVOTED} FROM dated GROUP BY ALL",
)
def _(spark, folder):
    # The names come from the orders, which stand for a dimension that is kept with the table.
    names = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("cond"))
    return reshape.map_columns(reshape.pivot_map(_dated(spark, folder), "cnt", COLS), names, COLS)


@query(
    "pivot_roundtrip",
    f"""{_DATED}, k AS (SELECT DISTINCT area, year, week, date FROM dated), p AS (SELECT DISTINCT cond FROM dated)
SELECT area, year, week, date, cond, cnt FROM k CROSS JOIN p LEFT JOIN dated USING (area, year, week, date, cond)""",
)
def _(spark, folder):
    wide = reshape.pivot(_dated(spark, folder), "cnt", report_grids.PRIORITIES, COLS)
    return reshape.pivot(wide, "cnt", cols=COLS)


@query(
    "unpivot_wide",
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_partkey', CAST(l_partkey AS DOUBLE) FROM lineitem""",
)
def _(spark, folder):
    return reshape.unpivot_wide(
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey"),
        "value",
        ids=["l_orderkey", "l_linenumber"],
        variable="measure",
        cols=COLS,
    )


@query(
    "split_headers",
    f"""{_OBS}, d AS (SELECT area, year, week, cond, source, cnt FROM obs), k AS (SELECT DISTINCT area, year, week FROM d),
h AS (SELECT * FROM (VALUES ('1-URGENT', 'F'), ('1-URGENT', 'O'), ('2-HIGH', 'F')) t(cond, category))
SELECT k.area, k.year, k.week, h.cond, h.category, d.cnt FROM k CROSS JOIN h
LEFT JOIN d ON d.area = k.area AND d.year = k.year AND d.week = k.week AND d.cond = h.cond AND d.source = h.category""",
)
def _(spark, folder):
    def cell(cond, source):
        return F.sum(F.when((F.col("cond") == cond) & (F.col("source") == source), F.col("cnt")))

    wide = observations(spark, folder).groupBy("area", "year", "week").agg(
        cell("1-URGENT", "F").alias("1-URGENT||F"),
        cell("1-URGENT", "O").alias("1-URGENT||O"),
        cell("2-HIGH", "F").alias("2-HIGH||F"),
        cell("2-HIGH", "F").alias("2-HIGH||F_1"),
    )
    return reshape.split_headers(wide, cols=COLS)


@query(
    "paired_unpivot",
    """SELECT l_orderkey, l_linenumber, 'price' AS cond, l_quantity AS cnt, l_extendedprice AS rate FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_quantity, l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax, NULL FROM lineitem""",
)
def _(spark, folder):
    pairs = [
        ("price", "l_quantity", "l_extendedprice"),
        ("discount", "l_quantity", "l_discount"),
        ("tax", "l_tax", None),
    ]
    return reshape.unpivot_pairs(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], pairs, COLS)


@query(
    "pivot_category",
    f"""{_OBS} SELECT area, year, CAST(sum(cnt) FILTER (source = 'F') AS BIGINT) AS "F",
  CAST(sum(cnt) FILTER (source = 'O') AS BIGINT) AS "O", CAST(sum(cnt) FILTER (source = 'X') AS BIGINT) AS "X"
FROM obs GROUP BY area, year""",
)
def _(spark, folder):
    by_source = observations(spark, folder).withColumnRenamed("source", "category")
    return reshape.pivot_category(by_source, ["area", "year"], ("F", "O", "X"), COLS)


_COMPLEMENT = f"""{_OBS}, t AS (SELECT area, year, week, cond, 'total' AS category, CAST(sum(cnt) AS BIGINT) AS cnt
    FROM obs GROUP BY ALL
  UNION ALL SELECT area, year, week, cond, 'male', CAST(sum(cnt) AS BIGINT) FROM obs WHERE source = 'F' GROUP BY ALL)"""


def _sexes(spark, folder):
    obs = observations(spark, folder)
    keys = ["area", "year", "week", "cond"]
    total = obs.groupBy(*keys).agg(F.sum("cnt").alias("cnt")).withColumn("category", F.lit("total"))
    male = obs.where("source = 'F'").groupBy(*keys).agg(F.sum("cnt").alias("cnt")).withColumn("category", F.lit("male"))
    return total.unionByName(male)


@query(
    "derive_complement",
    f"""{_COMPLEMENT} SELECT * FROM t UNION ALL SELECT a.area, a.year, a.week, a.cond, 'female', a.cnt - b.cnt
FROM t a JOIN t b USING (area, year, week, cond) WHERE a.category = 'total' AND b.category = 'male'""",
)
def _(spark, folder):
    return reshape.derive_complement(_sexes(spark, folder), cols=COLS)


@query("derive_complement_present", f"{_COMPLEMENT} SELECT * FROM t WHERE category <> 'female'")
def _(spark, folder):
    return reshape.derive_complement(_sexes(spark, folder), part="male", derived="total", whole="male", cols=COLS)


# -- filters ------------------------------------------------------------------------------------


@query(
    "filter_all",
    f"""{_OBS} SELECT * FROM obs WHERE regexp_matches(lower(cond), 'urgent|high') AND source IN ('F', 'O')
  AND area IN ('NATION_1', 'NATION_12') AND year BETWEEN 1996 AND 1998 AND week BETWEEN 10 AND 20""",
)
def _(spark, folder):
    return filters.select_observations(
        observations(spark, folder),
        ["Urgent", "HIGH"],
        ["NATION_1", "NATION_12"],
        (1996, 1998),
        (10, 20),
        "confirmed",
        COLS,
        GROUPS,
    )


@query("filter_source_group", f"{_OBS} SELECT * FROM obs WHERE source = 'P'")
def _(spark, folder):
    return filters.by_source_group(observations(spark, folder), "sentinel", COLS, GROUPS)


@query("condition_regex", f"{_OBS} SELECT * FROM obs WHERE regexp_matches(lower(cond), '^[12]-|low$')")
def _(spark, folder):
    return filters.match_conditions(observations(spark, folder), ["^[12]-", "LOW$"], COLS)


@query("condition_literal", f"{_OBS} SELECT * FROM obs WHERE contains(lower(cond), 'not spec')")
def _(spark, folder):
    return filters.match_conditions(observations(spark, folder), "Not Spec", COLS, literal=True)


@query("condition_none", f"{_OBS} SELECT * FROM obs WHERE false")
def _(spark, folder):
    return filters.match_conditions(observations(spark, folder), [], COLS)


@query(
    "condition_by_dimension",
    "SELECT o_orderkey, o_orderpriority AS cond FROM orders WHERE regexp_matches(lower(o_orderpriority), 'urgent|medium')",
)
def _(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderpriority").alias("cond"))
    return filters.match_conditions(rows, ["urgent", "medium"], COLS, dimension=rows.select("cond").distinct())


@query(
    "area_in_list",
    f"{_OBS} SELECT * FROM obs WHERE area IN ('NATION_3', 'NATION_4')",
)
def _(spark, folder):
    return filters.in_areas(observations(spark, folder), ["NATION_3", "NATION_4", "nation_5"], COLS)


@query("year_equal", f"{_OBS} SELECT * FROM obs WHERE year = 1998 AND week = 53")
def _(spark, folder):
    return filters.in_period(observations(spark, folder), 1998, 53, COLS)


@query(
    "period_range",
    f"{_OBS} SELECT * FROM obs WHERE year BETWEEN 1995 AND 1996 AND week BETWEEN 50 AND 53",
)
def _(spark, folder):
    return filters.in_period(observations(spark, folder), (1995, 1996), (50, 53), COLS)


@query(
    "drop_totals",
    """SELECT c_custkey, label FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Grand Total ' || c_custkey
  WHEN 1 THEN '' WHEN 2 THEN NULL ELSE c_name END AS label FROM customer) WHERE c_custkey % 4 = 3""",
)
def _(spark, folder):
    label = F.expr(
        "CASE c_custkey % 4 WHEN 0 THEN 'Grand Total ' || c_custkey WHEN 1 THEN '' WHEN 2 THEN NULL ELSE c_name END"
    )
    named = table(spark, folder, "customer").select("c_custkey", label.alias("label"))
    return filters.drop_totals(named, Cols(area="label"))


@query(
    "drop_totals_styles",
    """SELECT p_partkey, p_partkey % 5 <> 0 AS keep_contains, p_partkey % 5 NOT IN (0) OR p_partkey % 2 = 1 AS keep_prefix,
  p_partkey % 5 <> 1 AS keep_japanese FROM part""",
)
def _(spark, folder):
    label = F.expr(
        "CASE p_partkey % 5 WHEN 0 THEN (CASE WHEN p_partkey % 2 = 1 THEN 'sub total' ELSE 'TOTAL No.' END) "
        "WHEN 1 THEN '総数' ELSE p_name END"
    )
    named = table(spark, folder, "part").select("p_partkey", label.alias("label"))
    return named.select(
        "p_partkey",
        (~text.is_total_row("label", "contains")).alias("keep_contains"),
        (~text.is_total_row("label", "prefix")).alias("keep_prefix"),
        (~text.is_total_row("label", "japanese")).alias("keep_japanese"),
    )


@query("drop_unnamed", f"{_OBS} SELECT * FROM obs WHERE week % 3 = 0")
def _(spark, folder):
    obs = observations(spark, folder)
    blank = obs.withColumn("cond", F.expr("CASE week % 3 WHEN 0 THEN cond WHEN 1 THEN '' END"))
    return filters.drop_unnamed(blank, COLS)


@query("category_in", f"{_OBS} SELECT area, year, week, cond, cnt, source AS category FROM obs WHERE source IN ('F', 'P')")
def _(spark, folder):
    named = observations(spark, folder).withColumnRenamed("source", "category")
    return filters.in_categories(named, ["F", "P"], COLS)


@query("with_value", f"{_OBS} SELECT * FROM obs WHERE week % 4 <> 0")
def _(spark, folder):
    gaps = observations(spark, folder).withColumn("cnt", F.when(F.col("week") % 4 != 0, F.col("cnt")))
    return filters.with_value(gaps, "cnt")


@query(
    "project_rename",
    """SELECT o_orderkey AS report, o_orderstatus AS source, 'orders' AS origin, 2024 AS year FROM orders""",
)
def _(spark, folder):
    return filters.project(
        table(spark, folder, "orders"),
        ["o_orderkey", "o_orderstatus"],
        {"o_orderkey": "report", "o_orderstatus": "source"},
        {"origin": "orders", "year": 2024},
    )


@query("named_columns", "SELECT o_orderkey, o_totalprice AS \"Influenza\" FROM orders")
def _(spark, folder):
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("Influenza"),
        F.col("o_custkey").alias("_duplicated_0"),
        F.col("o_orderstatus").alias("field_5"),
    )
    return filters.named_columns(raw)


# -- scalar functions ---------------------------------------------------------------------------

_YW = "SELECT o_orderkey, CAST(1990 + o_custkey % 60 AS INTEGER) AS year, CAST(o_orderkey % 55 AS INTEGER) AS week FROM orders"


def _year_week(spark, folder):
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey", "CAST(1990 + o_custkey % 60 AS INT) AS year", "CAST(o_orderkey % 55 AS INT) AS week"
    )


@query("iso_monday", f"SELECT *, {_monday('year', 'week')} AS monday FROM ({_YW})")
def _(spark, folder):
    return _year_week(spark, folder).withColumn("monday", calendar.iso_monday("year", "week"))


@query("iso_sunday", f"SELECT *, CAST({_monday('year', 'week')} + 6 AS DATE) AS sunday FROM ({_YW})")
def _(spark, folder):
    return _year_week(spark, folder).withColumn("sunday", calendar.iso_sunday("year", "week"))


@query(
    "weeks_in_year",
    f"""SELECT o_orderkey, year, CAST(weekofyear(make_date(year, 12, 28)) AS INTEGER) AS weeks,
  CAST(CASE WHEN year = 2026 THEN least(13, weekofyear(make_date(year, 12, 28)))
    ELSE weekofyear(make_date(year, 12, 28)) END AS INTEGER) AS open_week FROM ({_YW})""",
)
def _(spark, folder):
    return _year_week(spark, folder).select(
        "o_orderkey",
        "year",
        calendar.weeks_in_year("year").alias("weeks"),
        calendar.last_open_week("year", 2026, 13).alias("open_week"),
    )


@query(
    "period_labels",
    f"SELECT o_orderkey, CASE WHEN week <> 0 THEN printf('%d-W%02d', year, week) END AS label FROM ({_YW})",
)
def _(spark, folder):
    labels = calendar.period_label("year", F.when(F.col("week") != 0, F.col("week")))
    return _year_week(spark, folder).select("o_orderkey", labels.alias("label"))


_BLANK_SQL = "chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160) || chr(12288)"
_WIDE_SQL = "translate({x}, 'ＩｎＡＥＯ' || chr(12288), 'InAEO ')"

_CELL = """CASE p_partkey % 7 WHEN 0 THEN '全数(' || p_name || ')' WHEN 1 THEN p_name || chr(9) || p_type WHEN 2 THEN ''
  WHEN 3 THEN '  ' || p_name || chr(12288) WHEN 4 THEN '（' || p_brand || '）(' || p_type || ')'
  WHEN 5 THEN p_name || ' (Ｉ' || p_type || 'Ａ)' ELSE NULL END"""


def _clean_cell_sql(x: str) -> str:
    raw = f"translate({x}, chr(13) || chr(10) || chr(9), '   ')"
    inner = f"list_extract(regexp_extract_all({raw}, '[（(]([^)）]+)[)）]', 1), -1)"
    folded = _WIDE_SQL.format(x=f"coalesce({inner}, {raw})")
    return f"nullif(trim({folded}, {_BLANK_SQL}), '')"


@query("clean_cell", f"SELECT p_partkey, {_clean_cell_sql('x')} AS cleaned FROM (SELECT p_partkey, {_CELL} AS x FROM part)")
def _(spark, folder):
    cells = table(spark, folder, "part").select("p_partkey", F.expr(_CELL).alias("x"))
    return cells.select("p_partkey", text.clean_cell("x").alias("cleaned"))


@query("clean_text", f"SELECT doc_id, {_clean_cell_sql('text')} AS cleaned FROM documents")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.clean_cell("text").alias("cleaned"))


_HEADER = """CASE p_partkey % 6 WHEN 0 THEN p_type || chr(10) || p_name WHEN 1 THEN '...' || p_partkey
  WHEN 2 THEN '（' || p_name || '）' WHEN 3 THEN p_name || '  (' || p_type || ')' WHEN 4 THEN ' ' ELSE 'Ｉ ' || p_name END"""


@query(
    "clean_header",
    f"""SELECT p_partkey, nullif(CASE WHEN starts_with(c, '(') AND ends_with(c, ')') AND len(c) - len(replace(c, '(', '')) = 1
  THEN trim(c[2:-2]) ELSE c END, '') AS header FROM (SELECT p_partkey, trim(regexp_replace(translate(regexp_replace(
    regexp_replace(x, '^.*[\\r\\n]+', ''), '^\\.\\.\\.[0-9]+$', ''), 'Ｉ（）', 'I()'), '\\s+', ' ', 'g')) AS c
  FROM (SELECT p_partkey, {_HEADER} AS x FROM part))""",
)
def _(spark, folder):
    heads = table(spark, folder, "part").select("p_partkey", F.expr(_HEADER).alias("x"))
    return heads.select("p_partkey", text.clean_header("x").alias("header"))


_NAME = """CASE p_partkey % 7 WHEN 0 THEN 'H5N1) (' || p_name WHEN 1 THEN '  ' || p_name || '   ' || p_type WHEN 2 THEN
  p_name || ' (' || p_type WHEN 3 THEN 'HIV/AIDS' WHEN 4 THEN 'Scrub typhus(Tsutsugamushi disease' WHEN 5 THEN NULL
  ELSE p_name || '((' || p_type || ')' END"""
_ALIAS_SQL = " ".join(f"WHEN '{raw}' THEN '{name}'" for raw, name in CONDITION_ALIASES.items())
_NORMAL_SQL = f"""SELECT p_partkey, raw, CASE c {_ALIAS_SQL} ELSE c END AS normalized FROM (
  SELECT p_partkey, raw, b || repeat(')', greatest((len(b) - len(replace(b, '(', ''))) - (len(b) - len(replace(b, ')', ''))), 0)) AS c
  FROM (SELECT p_partkey, raw, trim(regexp_replace(trim(regexp_replace(raw, '\\s+', ' ', 'g')), '^[^(]*\\)\\s*\\((.+)$', '\\1')) AS b
    FROM (SELECT p_partkey, {_NAME} AS raw FROM part)))"""


@query("normalize_name", f"SELECT p_partkey, normalized FROM ({_NORMAL_SQL})")
def _(spark, folder):
    names = table(spark, folder, "part").select("p_partkey", F.expr(_NAME).alias("raw"))
    return names.select("p_partkey", text.normalize_name("raw").alias("normalized"))


@query("name_audit", f"SELECT DISTINCT raw, normalized FROM ({_NORMAL_SQL}) WHERE raw IS NOT NULL")
def _(spark, folder):
    return text.name_audit(table(spark, folder, "part").select(F.expr(_NAME).alias("raw")), "raw")


@query("normalize_names", f"SELECT p_partkey, normalized AS raw FROM ({_NORMAL_SQL})")
def _(spark, folder):
    # More names than the dictionary takes: some are looked up, the others repaired in their rows.
    names = table(spark, folder, "part").select("p_partkey", F.expr(_NAME).alias("raw"))
    return text.normalize_names(names, "raw", known=100)


@query(
    "names_read",
    f"""{_WEEKLY}, r AS (SELECT DISTINCT year, week, CASE WHEN week % 2 = 0 THEN 'teitenrui' ELSE 'zensu' END AS kind FROM weekly),
n AS (SELECT r.*, CASE WHEN cond <> '5-LOW' THEN cond WHEN week % 3 = 0 THEN 'HIV/AIDS' WHEN week % 3 = 1 THEN 'Scrub typhus (Tsutsugamushi disease' ELSE cond END AS raw
  FROM r CROSS JOIN {_PRIORITY_ROWS}),
f AS (SELECT raw, min(year * 100 + week) AS p, arg_min(kind, year * 100 + week) AS kind FROM n GROUP BY raw)
SELECT raw, CASE raw WHEN 'HIV/AIDS' THEN 'AIDS' WHEN 'Scrub typhus (Tsutsugamushi disease' THEN 'Scrub typhus' ELSE raw END AS canonical,
  CAST(p // 100 AS INTEGER) AS year, CAST(p % 100 AS INTEGER) AS week,
  'reports/' || p // 100 || '/' || kind || lpad(CAST(p % 100 AS VARCHAR), 2, '0') || '.csv' AS file FROM f""",
)
def _(spark, folder):
    obs = grid_obs(spark, folder)
    mixed = combine.union_strict(
        report_grids.bullet_reports(obs.where("week % 2 = 1")), report_grids.english_reports(obs.where("week % 2 = 0"))
    )
    kind = reports.week_from_name("file") % 3
    spelling = F.when(kind == 0, "HIV/AIDS").when(kind == 1, "Scrub typhus (Tsutsugamushi disease").otherwise("5-LOW")
    renamed = F.transform("rows", lambda row: F.transform(row, lambda c: F.when(c == "5-LOW", spelling).otherwise(c)))
    return grid.names_read(_parsed(mixed.withColumn("rows", renamed)))


_CATEGORY = """CASE l_orderkey % 9 WHEN 0 THEN 'Total No.' WHEN 1 THEN 'Female' WHEN 2 THEN 'MALE' WHEN 3 THEN 'Inside Japan'
  WHEN 4 THEN 'Others' WHEN 5 THEN 'unknown place' WHEN 6 THEN '男' WHEN 7 THEN NULL ELSE l_returnflag END"""


@query(
    "classify_category",
    f"""SELECT category, count(*) AS rows FROM (SELECT CASE WHEN c IS NULL OR c = '' OR regexp_matches(c, '[\\x{{3040}}-\\x{{30ff}}\\x{{4e00}}-\\x{{9fff}}]')
  THEN 'total' WHEN lower(c) LIKE '%total%' THEN 'total' WHEN lower(c) LIKE '%female%' THEN 'female'
  WHEN lower(c) LIKE '%male%' THEN 'male' WHEN lower(c) LIKE '%japan%' THEN 'japan' WHEN lower(c) LIKE '%others%' THEN 'others'
  WHEN lower(c) LIKE '%unknown%' THEN 'unknown' ELSE c END AS category FROM (SELECT {_CATEGORY} AS c FROM lineitem))
GROUP BY category""",
)
def _(spark, folder):
    marked = table(spark, folder, "lineitem").select(text.classify_category(F.expr(_CATEGORY)).alias("category"))
    return marked.groupBy("category").agg(F.count("*").alias("rows"))


@query(
    "has_japanese",
    """SELECT doc_id, regexp_matches(text, '[\\x{3040}-\\x{30ff}\\x{4e00}-\\x{9fff}]') AS plain,
  doc_id % 2 = 0 OR regexp_matches(text, '[\\x{3040}-\\x{30ff}\\x{4e00}-\\x{9fff}]') AS marked FROM documents""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        text.has_japanese("text").alias("plain"),
        text.has_japanese(F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("県"))).otherwise(F.col("text"))).alias("marked"),
    )


@query(
    "fold_fullwidth",
    """SELECT p_partkey, translate(p_type, 'AEIOn', 'ＡＥＩＯｎ') AS wide, p_type AS six, p_brand AS all_ascii FROM part""",
)
def _(spark, folder):
    # The texts of the table in full-width characters, and back.
    digits = "0123456789#BDRabcdr"
    wide = F.translate("p_type", "AEIOn", "ＡＥＩＯｎ")
    return table(spark, folder, "part").select(
        "p_partkey",
        wide.alias("wide"),
        text.fold_fullwidth(wide).alias("six"),
        text.fold_fullwidth(F.translate("p_brand", digits, "".join(chr(ord(c) + 0xFEE0) for c in digits)), all_ascii=True).alias("all_ascii"),
    )


_NUMBER = """CASE l_orderkey % 9 WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING)
  WHEN 1 THEN '1,' || lpad(CAST(CAST(l_quantity AS BIGINT) AS STRING), 3, '0') WHEN 2 THEN '-' WHEN 3 THEN ''
  WHEN 4 THEN ' ' || CAST(CAST(l_quantity AS BIGINT) AS STRING) || '.5 ' WHEN 5 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || 'd'
  WHEN 6 THEN 'nan' WHEN 7 THEN '-' || CAST(CAST(l_quantity AS BIGINT) AS STRING) ELSE NULL END"""
_PLAIN_NUMBER = "'^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def _numbers_sql(columns: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, {columns} FROM (SELECT *, CASE WHEN regexp_matches(t, {_PLAIN_NUMBER})
  THEN CAST(t AS DOUBLE) END AS n, CASE WHEN regexp_matches(x, {_PLAIN_NUMBER}) THEN CAST(x AS DOUBLE) END AS s
  FROM (SELECT l_orderkey, l_linenumber, x, replace(trim(x), ',', '') AS t
    FROM (SELECT l_orderkey, l_linenumber, {_NUMBER} AS x FROM lineitem)))"""


def _number_cells(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_NUMBER).alias("x"))


@query("parse_number", _numbers_sql("n AS value"))
def _(spark, folder):
    return _number_cells(spark, folder).select(
        "l_orderkey", "l_linenumber", numbers.parse_number("x").alias("value")
    )


@query(
    "parse_count",
    _numbers_sql("CAST(trunc(coalesce(n, 0)) AS BIGINT) AS lenient, CAST(trunc(coalesce(s, 0)) AS BIGINT) AS strict"),
)
def _(spark, folder):
    return _number_cells(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        numbers.parse_count("x").alias("lenient"),
        numbers.parse_count_strict("x").alias("strict"),
    )


@query(
    "drop_first_dash",
    """SELECT o_orderkey, o_orderpriority || '-' || o_orderkey AS raw, regexp_replace(o_orderpriority || '-' || o_orderkey,
  '^([^-]*)-', '\\1') AS dropped FROM orders""",
)
def _(spark, folder):
    raw = F.concat_ws("-", "o_orderpriority", "o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey", raw.alias("raw"), numbers.drop_first_dash(raw).alias("dropped")
    )


@query(
    "format_count",
    """SELECT o_orderkey, CASE WHEN v IS NULL THEN '0' WHEN v = floor(v) THEN format('{:,}', CAST(v AS BIGINT))
  ELSE format('{:,}', CAST(floor(v) AS BIGINT)) || '.' || lpad(CAST(CAST(round((v - floor(v)) * 100) AS BIGINT) AS STRING), 2, '0') END AS printed
FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN floor(o_totalprice) WHEN 1 THEN floor(o_totalprice) + 0.25 END AS v FROM orders)""",
)
def _(spark, folder):
    value = F.expr(
        "CASE o_orderkey % 3 WHEN 0 THEN CAST(floor(o_totalprice) AS DOUBLE) WHEN 1 THEN floor(o_totalprice) + 0.25D END"
    )
    return table(spark, folder, "orders").select("o_orderkey", numbers.format_count(value).alias("printed"))


@query(
    "data_version",
    "SELECT o_orderkey, isoyear(o_orderdate) || '.' || weekofyear(o_orderdate) AS version FROM orders",
)
def _(spark, folder):
    label = F.concat(
        F.when(F.col("o_orderkey") % 2 == 0, "v").otherwise(""),
        calendar.iso_year("o_orderdate"),
        F.lit("."),
        calendar.iso_week("o_orderdate"),
    )
    return table(spark, folder, "orders").select("o_orderkey", text.data_version(label).alias("version"))


# -- reports: names, headers, grids -------------------------------------------------------------

_PATHS = """SELECT o_orderkey, CAST(isoyear(o_orderdate) AS INTEGER) AS y, CAST(weekofyear(o_orderdate) AS INTEGER) AS w,
  CAST(o_orderkey % 6 AS INTEGER) AS kind FROM orders"""


def _paths(spark, folder):
    """File names of every style the reports use, one per order."""
    ww = F.lpad(F.col("w").cast("string"), 2, "0")
    y = F.col("y").cast("string")
    styles = [
        F.concat(F.lit("in/"), y, F.lit("/zensu"), ww, F.lit(".csv")),
        F.concat(F.lit("in/"), y, F.lit("-"), ww, F.lit("-zensu.csv")),
        F.concat(F.lit("in/"), y, F.lit("/Teitenrui"), ww, F.lit(".csv")),
        F.concat(F.lit("in/Syu_01_1_"), y, F.lit(".xlsx")),
        F.concat(F.lit("in/"), y, F.lit("_place.xls")),
        F.lit("in/notes.txt"),
    ]
    path = F.element_at(F.array(*styles), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", calendar.iso_year("o_orderdate").alias("y"), calendar.iso_week("o_orderdate").alias("w"))
        .select("o_orderkey", path.alias("path"))
    )


@query(
    "file_period",
    f"""SELECT o_orderkey, CASE WHEN kind < 5 THEN y END AS year, CASE WHEN kind < 3 THEN w END AS week FROM ({_PATHS})""",
)
def _(spark, folder):
    week = F.when(F.col("o_orderkey") % 6 != 3, reports.week_from_name("path"))
    return _paths(spark, folder).select("o_orderkey", reports.year_from_name("path").alias("year"), week.alias("week"))


@query(
    "file_layout",
    f"""SELECT o_orderkey, CASE kind WHEN 0 THEN 'bullet' WHEN 1 THEN 'bullet' WHEN 2 THEN 'sentinel' WHEN 3 THEN 'sex'
  WHEN 4 THEN 'place' END AS layout FROM ({_PATHS})""",
)
def _(spark, folder):
    return _paths(spark, folder).select("o_orderkey", reports.layout_of("path").alias("layout"))


@query(
    "header_period",
    """SELECT o_orderkey, CAST(weekofyear(o_orderdate) AS INTEGER) AS week, CAST(isoyear(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def _(spark, folder):
    line = F.format_string("%dth Week, %d", calendar.iso_week("o_orderdate"), calendar.iso_year("o_orderdate"))
    cells = F.array(F.lit(" "), line, F.lit(None).cast("string"), F.lit("Data collected as of today"))
    headed = table(spark, folder, "orders").select("o_orderkey", reports.header_text(cells).alias("h"))
    return headed.select(
        "o_orderkey", reports.week_from_header("h").alias("week"), reports.year_from_header("h").alias("year")
    )


@query(
    "sheet_week",
    """SELECT o_orderkey, year, sheet, CASE WHEN sheet >= 2 AND sheet + CASE WHEN year = 1999 THEN 12 ELSE -1 END
  <= weekofyear(make_date(year, 12, 28)) THEN sheet + CASE WHEN year = 1999 THEN 12 ELSE -1 END END AS week
FROM (SELECT o_orderkey, CAST(1999 + o_custkey % 20 AS INTEGER) AS year, CAST(o_orderkey % 57 AS INTEGER) AS sheet FROM orders)""",
)
def _(spark, folder):
    return (
        table(spark, folder, "orders")
        .selectExpr(
            "o_orderkey", "CAST(1999 + o_custkey % 20 AS INT) AS year", "CAST(o_orderkey % 57 AS INT) AS sheet"
        )
        .withColumn("week", reports.sheet_week("year", "sheet"))
    )


_GRID_ROWS = f"""{_WEEKLY}, k AS (SELECT DISTINCT area, year, week FROM weekly),
g AS (SELECT k.*, p.cond, weekly.cnt FROM k CROSS JOIN {_PRIORITY_ROWS}
  LEFT JOIN weekly ON weekly.area = k.area AND weekly.year = k.year AND weekly.week = k.week AND weekly.cond = p.cond)"""
_EN_ROWS = f"""SELECT area, cond, year, week, CAST({_monday("year", "week")} + 6 AS DATE) AS date, CAST(cnt * 1000 AS DOUBLE) AS cnt,
  CAST(cnt * 2 AS DOUBLE) AS rate, 'Sentinel surveillance' AS source FROM g"""
_JA_ROWS = f"""SELECT area, cond, year, week, CAST({_monday("year", "week")} + 6 AS DATE) AS date, CAST(coalesce(cnt, 0) AS DOUBLE) AS cnt,
  CAST(cnt AS DOUBLE) AS rate, 'Sentinel surveillance' AS source FROM g"""


@query(
    "bullet_grid",
    f"""{_GRID_ROWS} SELECT area, cond, coalesce(cnt, 0) AS cnt, year, week, {_monday("year", "week")} AS date,
  'Confirmed cases' AS source FROM g""",
)
def _(spark, folder):
    return grid.bullet_to_long(report_grids.bullet_reports(grid_obs(spark, folder)), COLS)


@query("sentinel_english", f"{_GRID_ROWS} {_EN_ROWS}")
def _(spark, folder):
    return grid.sentinel_to_long(report_grids.english_reports(grid_obs(spark, folder)), COLS)


@query("sentinel_japanese", f"{_GRID_ROWS} {_JA_ROWS}")
def _(spark, folder):
    return grid.sentinel_to_long(report_grids.japanese_reports(grid_obs(spark, folder)), COLS)


@query("sentinel_auto", f"{_GRID_ROWS} {_EN_ROWS} WHERE week % 2 = 0 UNION ALL {_JA_ROWS} WHERE week % 2 = 1")
def _(spark, folder):
    obs = grid_obs(spark, folder)
    mixed = report_grids.english_reports(obs.where("week % 2 = 0")).unionByName(
        report_grids.japanese_reports(obs.where("week % 2 = 1"))
    )
    return grid.sentinel_to_long(mixed, COLS)


def _parsed(reports_df: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """The reports written as CSV bytes and read again."""
    return reports.parse_contents(report_grids.as_files(reports_df, encoding))


_BULLET_ROWS = f"""SELECT area, cond, coalesce(cnt, 0) AS cnt, year, week, {_monday("year", "week")} AS date,
  'Confirmed cases' AS source FROM g"""


@query("csv_bullet", f"{_GRID_ROWS} {_BULLET_ROWS}")
def _(spark, folder):
    return grid.bullet_to_long(_parsed(report_grids.bullet_reports(grid_obs(spark, folder))), COLS)


@query("csv_sentinel_english", f"{_GRID_ROWS} {_EN_ROWS}")
def _(spark, folder):
    return grid.sentinel_to_long(_parsed(report_grids.english_reports(grid_obs(spark, folder))), COLS)


@query("csv_sentinel_cp932", f"{_GRID_ROWS} {_JA_ROWS}")
def _(spark, folder):
    return grid.sentinel_to_long(_parsed(report_grids.japanese_reports(grid_obs(spark, folder)), "cp932"), COLS)


@query(
    "csv_mixed_folder",
    f"""{_GRID_ROWS} SELECT area, cond, CAST(cnt AS DOUBLE) AS cnt, year, week, date, source, CAST(NULL AS DOUBLE) AS rate FROM ({_BULLET_ROWS})
UNION ALL SELECT area, cond, cnt, year, week, date, source, rate FROM ({_EN_ROWS} WHERE week % 2 = 0)
UNION ALL SELECT area, cond, cnt, year, week, date, source, rate FROM ({_JA_ROWS} WHERE week % 2 = 1)""",
)
def _(spark, folder):
    obs = grid_obs(spark, folder)
    files = [
        report_grids.as_files(report_grids.bullet_reports(obs)),
        report_grids.as_files(report_grids.english_reports(obs.where("week % 2 = 0"))),
        report_grids.as_files(report_grids.japanese_reports(obs.where("week % 2 = 1")), "cp932"),
    ]
    return grid.files_to_long(combine.union_strict(*files), COLS)


@query(
    "csv_header_week",
    f"{_GRID_ROWS} {_EN_ROWS} WHERE week IN (7, 53)",
)
def _(spark, folder):
    # Names without a week, or with that of another one: the header tells.
    named = report_grids.english_reports(grid_obs(spark, folder)).withColumn(
        "file", F.regexp_replace("file", r"teitenrui(\d)(\d)", "teitenrui-$2$1-")
    )
    files = reports.of_weeks(report_grids.as_files(named), [7, 53])
    return grid.sentinel_to_long(reports.parse_contents(files), COLS, weeks=[7, 53])


@query(
    "csv_quarantine",
    f"""WITH {_CASES}, f AS (SELECT DISTINCT year, week FROM cases)
SELECT 'reports/' || year || '/zensu' || lpad(CAST(week AS STRING), 2, '0') || '.csv' AS file,
  CASE week % 4 WHEN 0 THEN 'empty file' WHEN 1 THEN 'undecodable text' ELSE 'too few rows' END AS reason FROM f WHERE week % 4 < 3""",
)
def _(spark, folder):
    files = report_grids.as_files(report_grids.bullet_reports(grid_obs(spark, folder)))
    kind = reports.week_from_name("path") % 4
    broken = (
        F.when(kind == 0, F.lit(b""))
        .when(kind == 1, F.concat("content", F.unhex(F.lit("81FFFEFD"))))
        .when(kind == 2, F.substring("content", 1, 40))
        .otherwise(F.col("content"))
    )
    return grid.quarantine(reports.parse_contents(files.withColumn("content", broken)))


@query(
    "quarantine_sheets",
    f"""WITH {_CASES}, s AS (SELECT DISTINCT year + 28 AS year, week + 1 AS sheet FROM cases)
SELECT 'books/Syu_01_1_' || year || '.xlsx' AS file, CAST(CASE WHEN sheet % 5 = 0 THEN sheet + 60 ELSE sheet END AS INTEGER) AS sheet,
  CASE WHEN sheet % 5 = 0 THEN 'no week' ELSE 'too few rows' END AS reason FROM s WHERE sheet % 5 = 0 OR sheet % 7 = 0""",
)
def _(spark, folder):
    book = report_grids.workbook_grid(_book_obs(spark, folder)).where("sheet % 5 = 0 OR sheet % 7 <> 0 OR row_idx < 4")
    return grid.quarantine_sheets(book.withColumn("sheet", F.expr("CASE WHEN sheet % 5 = 0 THEN sheet + 60 ELSE sheet END")))


@query("week_subset", f"{_GRID_ROWS} {_EN_ROWS} WHERE week IN (1, 7, 52)")
def _(spark, folder):
    return grid.sentinel_to_long(report_grids.english_reports(grid_obs(spark, folder)), COLS, weeks=[1, 7, 52])


# The calendar repeats after 28 years; the first workbook year, which lacks weeks, is so left out.
_BOOK_ROWS = f"""WITH {_CASES}, o AS (SELECT * REPLACE (CAST(year + 28 AS INTEGER) AS year) FROM cases),
k AS (SELECT DISTINCT area, nationkey, year, week FROM o),
h AS (SELECT p.cond, c.category, c.source FROM {_PRIORITY_ROWS} CROSS JOIN (VALUES ('total', NULL), ('male', 'F'), ('female', 'O')) c(category, source)),
g AS (SELECT k.area, k.nationkey, k.year, k.week, h.cond, h.category, (SELECT count(*) FROM o WHERE o.area = k.area AND o.year = k.year
  AND o.week = k.week AND o.cond = h.cond AND (h.source IS NULL OR o.source = h.source)) AS cnt FROM k CROSS JOIN h)"""


@query(
    "workbook_grid",
    f"""{_BOOK_ROWS} SELECT area, year, week, CAST({_monday("year", "week")} + 6 AS DATE) AS date, cnt, cond, category,
  'Confirmed cases' AS source FROM g""",
)
def _(spark, folder):
    return grid.workbook_to_long(report_grids.workbook_grid(_book_obs(spark, folder)), COLS)


@query(
    "grid_blocks",
    f"""{_BOOK_ROWS} SELECT year, week, block, count(*) AS rows, min(row_idx) AS first_row FROM (
  SELECT DISTINCT year, week, CASE WHEN cond < '4' THEN 1 ELSE 61 END AS block,
    nationkey + CASE WHEN cond < '4' THEN 4 ELSE 64 END AS row_idx FROM g
  UNION SELECT DISTINCT year, week, 1, 3 FROM g UNION SELECT DISTINCT year, week, 61, 63 FROM g) GROUP BY ALL""",
)
def _(spark, folder):
    blocks = grid.find_blocks(report_grids.workbook_grid(_book_obs(spark, folder)))
    return (
        blocks.withColumn("year", reports.year_from_name("file"))
        .withColumn("week", reports.sheet_week("year", "sheet"))
        .where("week IS NOT NULL")
        .groupBy("year", "week", "block")
        .agg(F.count("*").alias("rows"), F.min("row_idx").alias("first_row"))
    )


@query(
    "header_fill",
    f"""{_BOOK_ROWS} SELECT DISTINCT year, week, CASE WHEN cond < '4' THEN 1 ELSE 61 END AS block,
  CASE WHEN cond < '4' THEN '1-URGENT total|1-URGENT male|1-URGENT female|2-HIGH total|2-HIGH male|2-HIGH female|3-MEDIUM total|3-MEDIUM male|3-MEDIUM female'
  ELSE '4-NOT SPECIFIED total|4-NOT SPECIFIED male|4-NOT SPECIFIED female|5-LOW total|5-LOW male|5-LOW female' END AS header FROM g""",
)
def _(spark, folder):
    blocks = grid.find_blocks(report_grids.workbook_grid(_book_obs(spark, folder)))
    labels = F.transform("header", lambda h: F.concat_ws(" ", h["name"], h["category"]))
    return (
        blocks.withColumn("year", reports.year_from_name("file"))
        .withColumn("week", reports.sheet_week("year", "sheet"))
        .where("week IS NOT NULL")
        .select("year", "week", "block", F.array_join(labels, "|").alias("header"))
        .distinct()
    )


@query(
    "quarantine",
    f"""WITH {_CASES}, f AS (SELECT DISTINCT year, week FROM cases)
SELECT 'reports/' || year || '/teitenrui' || lpad(CAST(week AS STRING), 2, '0') || '.csv' AS file, 'too few rows' AS reason
FROM f WHERE week % 10 = 0
UNION ALL SELECT 'reports/' || year || '/teitenrui' || lpad(CAST(week AS STRING), 2, '0') || '.csv', 'undecodable text'
FROM f WHERE week % 10 = 1
UNION ALL SELECT 'reports/' || year || '/teitenrui' || lpad(CAST(week AS STRING), 2, '0') || '.csv', 'no condition columns'
FROM f WHERE week % 10 = 2""",
)
def _(spark, folder):
    sent = report_grids.english_reports(grid_obs(spark, folder))
    week = reports.week_from_name("file") % 10
    unnamed = F.concat(
        F.slice("rows", 1, 2),
        F.array(F.array(F.lit(""))),
        F.slice("rows", F.lit(4), F.size("rows") - 3),
    )
    rows = (
        F.when(week == 0, F.slice("rows", 1, 5))
        .when(week == 2, unnamed)
        .when(week != 1, F.col("rows"))
    )
    return grid.quarantine(
        sent.select("file", rows.alias("rows"), F.when(week == 1, "undecodable text").alias("error"))
    )


# -- quality ------------------------------------------------------------------------------------


@query(
    "violations",
    f"""WITH {_CASES}, o AS (SELECT area, year, week, cond, source, CASE WHEN week % 9 = 0 THEN -1 ELSE 1 END AS cnt,
  CASE WHEN week % 4 = 0 THEN NULL ELSE 0.5 - nationkey END AS rate FROM cases)
SELECT 'year out of range' AS "check", count(*) FILTER (NOT year BETWEEN 1996 AND 2000) AS violations FROM o
UNION ALL SELECT 'week out of range', count(*) FILTER (NOT week BETWEEN 1 AND 52) FROM o
UNION ALL SELECT 'negative cnt', count(*) FILTER (cnt < 0) FROM o
UNION ALL SELECT 'negative rate', count(*) FILTER (rate < 0) FROM o
UNION ALL SELECT 'duplicate records', (SELECT count(*) FROM (SELECT 1 FROM o GROUP BY area, year, week, cond HAVING count(*) > 1))""",
)
def _(spark, folder):
    rows = cases(spark, folder).select(
        "area",
        "year",
        "week",
        "cond",
        "source",
        F.expr("CASE WHEN week % 9 = 0 THEN -1 ELSE 1 END").alias("cnt"),
        F.expr("CASE WHEN week % 4 = 0 THEN NULL ELSE 0.5D - nationkey END").alias("rate"),
    )
    return quality.violations(rows, years=(1996, 2000), weeks=(1, 52), cols=COLS)


@query(
    "violations_of_batch",
    """WITH b AS (SELECT o_orderkey AS l_orderkey, 1 + o_custkey % 9 AS l_linenumber, CAST(o_totalprice - 50000 AS DOUBLE) AS cnt FROM orders)
SELECT 'negative cnt' AS "check", count(*) FILTER (cnt < 0) AS violations FROM b
UNION ALL SELECT 'duplicate records', (SELECT count(*) FROM (SELECT 1 FROM b GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
UNION ALL SELECT 'existing records', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM b) JOIN
  (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) USING (l_orderkey, l_linenumber))""",
)
def _(spark, folder):
    """A batch with a key per order, against the published lines."""
    batch = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        (1 + F.col("o_custkey") % 9).alias("l_linenumber"),
        (F.col("o_totalprice") - 50000).cast("double").alias("cnt"),
    )
    return quality.violations_of_batch(batch, table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], cols=COLS)


@query(
    "unknown_areas",
    f"WITH {_CASES} SELECT DISTINCT area FROM cases WHERE nationkey % 5 = 0",
)
def _(spark, folder):
    dim = table(spark, folder, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("area"))
    return quality.unknown_areas(cases(spark, folder), dim, COLS)


# -- snapshots, views, builds -------------------------------------------------------------------


@query(
    "snapshot_diff",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'removed' WHEN o_orderkey % 10 = 1 THEN 'added'
  WHEN o_orderkey % 10 = 2 THEN 'changed' ELSE 'same' END AS status FROM orders""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    before = orders.where("o_orderkey % 10 <> 1")
    after = orders.where("o_orderkey % 10 <> 0").withColumn(
        "o_totalprice", F.expr("CASE WHEN o_orderkey % 10 = 2 THEN o_totalprice + 1 ELSE o_totalprice END")
    )
    return snapshot.snapshot_diff(before, after, ["o_orderkey"])


@query(
    "snapshot_fingerprint",
    """SELECT l_returnflag, count(*) AS rows, false AS reload_changed, true AS edit_changed FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, folder):
    base, key = table(spark, folder, "lineitem"), ["l_returnflag"]
    edited = base.withColumn("l_tax", F.when(F.col("l_linenumber") == 1, F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    again = snapshot.fingerprint(base.select(*reversed(base.columns)), key).select(*key, F.col("digest").alias("d2"))
    other = snapshot.fingerprint(edited, key).select(*key, F.col("digest").alias("d3"))
    return snapshot.fingerprint(base, key).join(again, key).join(other, key).select(
        *key,
        "rows",
        (F.col("digest") != F.col("d2")).alias("reload_changed"),
        (F.col("digest") != F.col("d3")).alias("edit_changed"),
    )


@query(
    "refresh_years",
    f"""{_OBS}, closed AS (SELECT * FROM obs WHERE year < 1999 AND year <> 1996)
SELECT area, year, week, cond, source, cnt FROM closed
UNION ALL SELECT area, year, week, cond, source, cnt * 10 FROM obs WHERE year >= 1999 OR year = 1996""",
)
def _(spark, folder):
    obs = observations(spark, folder)
    existing = obs.where("year <> 1996")
    return snapshot.merge_refresh(existing, obs.withColumn("cnt", F.col("cnt") * 10), 1999, COLS)


@query("ordered_output", f"{_OBS} SELECT area, year, week, cond, source, cnt FROM obs")
def _(spark, folder):
    return aggregate.order_for_output(observations(spark, folder), COLS)


@query("published_table", f"{_OBS} SELECT area, year, week, cond, source, cnt FROM obs")
def _(spark, folder):
    path = shared_folder(spark, "published")
    snapshot.write_table(observations(spark, folder), path, COLS)
    return snapshot.read_table(spark, path, COLS)


@query(
    "published_refresh",
    f"{_OBS} SELECT area, year, week, cond, source, CASE WHEN year >= 2000 THEN cnt + 1 ELSE cnt END AS cnt FROM obs",
)
def _(spark, folder):
    path = shared_folder(spark, "refreshed")
    obs = observations(spark, folder)
    snapshot.write_table(obs, path, COLS)
    snapshot.refresh_years(obs.where("year >= 2000").withColumn("cnt", F.col("cnt") + 1), path, COLS)
    return snapshot.read_table(spark, path, COLS)


@query(
    "table_profile",
    f"WITH {_CASES} SELECT count(*) AS rows, CAST(min(date) AS STRING) AS date_min, CAST(max(date) AS STRING) AS date_max FROM cases",
)
def _(spark, folder):
    return snapshot.profile(cases(spark, folder), COLS)


@query(
    "table_profile_by_week",
    f"""{_OBS}, b AS (SELECT count(*) AS rows, CAST(min(year * 100 + week) AS INTEGER) AS lo, CAST(max(year * 100 + week) AS INTEGER) AS hi FROM obs)
SELECT rows, CAST({_monday("lo // 100", "lo % 100")} AS STRING) AS date_min,
  CAST({_monday("hi // 100", "hi % 100")} AS STRING) AS date_max FROM b""",
)
def _(spark, folder):
    return snapshot.profile(observations(spark, folder), COLS)


@query(
    "table_profile_by_year",
    f"""{_OBS} SELECT count(*) AS rows, min(year) || '-01-01' AS date_min, max(year) || '-12-31' AS date_max FROM obs""",
)
def _(spark, folder):
    return snapshot.profile(observations(spark, folder).drop("week"), COLS)


@query(
    "content_check",
    """WITH have AS (SELECT CASE WHEN doc_id % 17 = 0 THEN 'new-' ELSE '' END || doc_id AS file, strlen(text) AS size,
  sha256(text) AS sha FROM documents),
want AS (SELECT CASE WHEN doc_id % 11 = 0 THEN 'old-' ELSE '' END || doc_id AS file, strlen(text) + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS size,
  CASE WHEN doc_id % 5 = 0 THEN reverse(sha256(text)) ELSE sha256(text) END AS sha FROM documents)
SELECT file, CASE WHEN want.size IS NULL THEN 'unlisted' WHEN have.size IS NULL THEN 'missing' WHEN have.size <> want.size
  THEN 'size mismatch' WHEN have.sha <> want.sha THEN 'checksum mismatch' ELSE 'ok' END AS status
FROM have FULL JOIN want USING (file)""",
)
def _(spark, folder):
    whole = snapshot.content_inventory(table(spark, folder, "documents"), "doc_id", "text")
    key = F.col("file").cast("long")
    named = lambda of, prefix: F.concat(F.when(key % of == 0, prefix).otherwise(""), "file")
    listed = whole.select(
        named(11, "old-").alias("file"),
        (F.col("size_bytes") + F.when(key % 7 == 0, 1).otherwise(0)).alias("size_bytes"),
        F.when(key % 5 == 0, F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"),
    )
    return snapshot.verify_files(whole.withColumn("file", named(17, "new-")), listed)


@query(
    "missing_contents",
    "SELECT CAST(doc_id AS STRING) AS file FROM documents WHERE doc_id % 17 = 0",
)
def _(spark, folder):
    documents = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("file"), "text")
    moved = F.when(F.col("file").cast("long") % 17 == 0, F.concat(F.lit("moved-"), "file")).otherwise(F.col("file"))
    have = snapshot.content_inventory(documents.withColumn("file", moved), "file", "text")
    return snapshot.missing_contents(have, documents.select("file"))


@query(
    "view_inventory",
    " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in TABLES),
)
def _(spark, folder):
    return catalog(spark, folder).row_counts()


@query(
    "sql_views",
    """SELECT CAST(isoyear(o_orderdate) AS INTEGER) AS year, CAST(weekofyear(o_orderdate) AS INTEGER) AS week, count(*) AS rows
FROM orders GROUP BY ALL ORDER BY 1 DESC, 2 DESC LIMIT 5""",
)
def _(spark, folder):
    catalog(spark, folder).register_views("given tables", "v1", None)
    return spark.sql(
        "SELECT CAST(extract(YEAROFWEEK FROM o_orderdate) AS INT) AS year, weekofyear(o_orderdate) AS week, "
        "count(*) AS rows FROM cases GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC LIMIT 5"
    )


@query("clustered_lookup", f"{_OBS} SELECT area, year, week, cond, source, cnt FROM obs WHERE area = 'NATION_7' AND cond = '2-HIGH'")
def _(spark, folder):
    table = Versions(spark, shared_folder(spark, "clustered"), COLS, cluster=("area", "cond"))
    table.overwrite(observations(spark, folder))
    return table.read().where("area = 'NATION_7' AND cond = '2-HIGH'")


@query("load_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(spark, folder):
    return catalog(spark, folder).load("supplier")


@query(
    "scan_pruned",
    "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 40",
)
def _(spark, folder):
    rows = catalog(spark, folder).scan("lineitem")
    return rows.where("l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 40").select("l_orderkey", "l_quantity")


@query("first_available", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(spark, folder):
    files = {"newest": "not_there.parquet", "older": "nation.parquet"}
    return Catalog(spark, folder, files, {}, COLS).first_available(["newest", "older"])


_UNIFIED_SQL = f"""WITH {_CASES},
h AS (SELECT area, year, week, {_monday("year", "week")} AS date, count(*) AS cnt, 'total' AS category, cond, 'old' AS source,
  CAST(NULL AS DOUBLE) AS rate FROM cases WHERE year < 1999 GROUP BY ALL),
b AS (SELECT area, year, week, {_monday("year", "week")} AS date, count(*) AS cnt, CAST(NULL AS STRING) AS category, cond, 'weekly' AS source,
  CAST(NULL AS DOUBLE) AS rate FROM cases WHERE year >= 1998 AND cond < '3' GROUP BY ALL),
s AS (SELECT area, year, week, {_monday("year", "week")} AS date, count(*) AS cnt, CAST(NULL AS STRING) AS category, cond, 'sites' AS source,
  count(*) / 4.0 AS rate FROM cases WHERE year >= 1997 GROUP BY ALL),
u AS (SELECT 0 AS o, * FROM h WHERE year NOT IN (SELECT year FROM b) UNION ALL SELECT 1, * FROM b
  UNION ALL SELECT 2, * FROM s WHERE cond NOT IN (SELECT cond FROM b))
SELECT area, year, week, date, CAST(cnt AS DOUBLE) AS cnt, coalesce(category, 'total') AS category, cond, source, CAST(rate AS DOUBLE) AS rate FROM u
QUALIFY row_number() OVER (PARTITION BY area, year, week, cond, coalesce(category, 'total') ORDER BY o) = 1"""


@query("build_unified", _UNIFIED_SQL)
def _(spark, folder):
    dated = weekly(spark, folder).drop("nationkey").withColumn("date", calendar.iso_monday("year", "week"))
    old = dated.where("year < 1999").withColumns({"source": F.lit("old"), "category": F.lit("total")})
    confirmed = dated.where("year >= 1998 AND cond < '3'").withColumn("source", F.lit("weekly"))
    sites = dated.where("year >= 1997").withColumns({"source": F.lit("sites"), "rate": F.col("cnt") / 4})
    return build.build_unified(old, confirmed, sites, COLS)


@query(
    "build_sentinel",
    f"""{_CUM}, l AS (SELECT *, lag(cnt) OVER (PARTITION BY year, area, cond ORDER BY week) AS prev FROM cum)
SELECT area, year, week, cond, {_STEP} AS cnt, 'Sentinel surveillance' AS source, {_monday("year", "week")} AS date FROM l
WHERE year >= 1999 UNION ALL SELECT area, year, week, cond, cnt * 7, 'Sentinel surveillance', {_monday("year", "week")} FROM weekly WHERE year < 1999""",
)
def _(spark, folder):
    raw = cumulative(spark, folder).drop("nationkey")
    kept = (
        weekly(spark, folder)
        .drop("nationkey")
        .withColumns(
            {
                "cnt": F.col("cnt") * 7,
                "source": F.lit("Sentinel surveillance"),
                "date": calendar.iso_monday("year", "week"),
            }
        )
    )
    return build.build_sentinel(raw, kept, 1999, COLS)


@query(
    "build_bullet",
    f"""{_WEEKLY} SELECT area, year, week, cond, CASE WHEN year >= 2000 THEN cnt ELSE cnt * 5 END AS cnt,
  CASE WHEN year >= 2000 THEN 'All-case reporting' ELSE 'kept' END AS source FROM weekly""",
)
def _(spark, folder):
    raw = weekly(spark, folder).drop("nationkey")
    kept = raw.withColumns({"cnt": F.col("cnt") * 5, "source": F.lit("kept")})
    return build.build_bullet(raw, kept, 2000, COLS)


@query(
    "build_sex",
    f"""{_COMPLEMENT} SELECT * FROM t UNION ALL SELECT a.area, a.year, a.week, a.cond, 'female', a.cnt - b.cnt
FROM t a JOIN t b USING (area, year, week, cond) WHERE a.category = 'total' AND b.category = 'male'""",
)
def _(spark, folder):
    rows = _sexes(spark, folder)
    return build.build_sex(rows.where("year < 1998"), rows.where("year >= 1998"), cols=COLS)


@query(
    "build_place",
    f"""{_OBS} SELECT area, year, week, cond, source AS category, CAST(cnt AS DOUBLE) AS cnt, CAST(NULL AS VARCHAR) AS note FROM obs WHERE year < 1995
UNION ALL SELECT area, year, week, cond, source, CAST(cnt AS DOUBLE), 'late' FROM obs WHERE year >= 1995""",
)
def _(spark, folder):
    rows = observations(spark, folder).withColumnRenamed("source", "category")
    late = rows.where("year >= 1995").withColumn("cnt", F.col("cnt").cast("double")).withColumn("note", F.lit("late"))
    return build.build_place(rows.where("year < 1995"), late, cols=COLS)


_SHIFTED = f"""WITH {_CASES}, o AS (SELECT * REPLACE (CAST(year + 28 AS INTEGER) AS year) FROM cases),
weekly AS (SELECT area, year, week, cond, count(*) AS cnt FROM o GROUP BY ALL),
cum AS (SELECT area, year, week, cond, CAST(sum(cnt) OVER (PARTITION BY year, area, cond ORDER BY week ROWS UNBOUNDED PRECEDING)
  AS BIGINT) AS cnt FROM weekly),
k AS (SELECT DISTINCT area, year, week, p.cond FROM weekly CROSS JOIN {_PRIORITY_ROWS}),
h AS (SELECT k.*, coalesce(cnt, 0) AS cnt FROM k LEFT JOIN weekly USING (area, year, week, cond)),
c AS (SELECT k.*, cnt * 1000 AS cnt FROM k LEFT JOIN cum USING (area, year, week, cond)),
l AS (SELECT *, lag(cnt) OVER (PARTITION BY year, area, cond ORDER BY week) AS prev FROM c WHERE year >= 2025),
s AS (SELECT area, year, week, 'site ' || cond AS cond, CAST({_STEP} AS DOUBLE) AS cnt FROM l),
u AS (SELECT area, year, week, CAST({_monday("year", "week")} + 6 AS DATE) AS date, CAST(cnt AS DOUBLE) AS cnt, cond,
    'Confirmed cases' AS source, CAST(NULL AS DOUBLE) AS rate FROM h WHERE year < 2026
  UNION ALL SELECT area, year, week, {_monday("year", "week")}, cnt, cond, 'All-case reporting', NULL FROM h WHERE year >= 2026
  UNION ALL SELECT area, year, week, {_monday("year", "week")}, cnt, cond, 'Sentinel surveillance', round(cnt / 500, 6) FROM s)"""


@query("build_tables", f"{_SHIFTED} SELECT *, 'total' AS category FROM u")
def _(spark, folder):
    """Weekly reports as bytes and yearly workbooks as grids -> all five published tables.

    The cases are counted once, into a table that all reports are made from; its rows do not grow with the cases.
    """
    root, counted = shared_folder(spark, "tables"), shared_folder(spark, "counted")
    obs = _book_obs(spark, folder)
    obs.write.parquet(counted)
    obs = spark.read.schema(obs.schema).parquet(counted)
    totals = _year_to_date(obs.groupBy("area", "nationkey", "year", "week", "cond").agg(F.sum("cnt").alias("cnt")))
    sites = report_grids.english_reports(totals.where("year >= 2025"))
    named = F.transform("rows", lambda row: F.transform(row, lambda c: F.regexp_replace(c, "^([0-9]-.*)$", "site $1")))
    files = combine.union_strict(
        report_grids.as_files(report_grids.bullet_reports(obs.where("year >= 2026"))),
        report_grids.as_files(sites.withColumn("rows", named)),
    )
    books = report_grids.workbook_grid(obs)
    books = books.withColumn("file", F.regexp_replace("file", r"Syu_01_1_(\d+)", "$1_Syu_01_1"))
    marks = lambda c: F.when(c == "Male", "Japan").when(c == "Fe\0male", "Others").otherwise(c)
    place = books.withColumns({"file": F.replace("file", F.lit("01_1"), F.lit("02_1")), "cells": F.transform("cells", marks)})
    books = books.unionByName(place)
    try:
        build.build_tables(spark, files, root, 2026, cols=COLS, workbooks=books)
    finally:
        remove_folder(spark, counted)
    return Catalog(spark, root, cols=COLS).load("unified").withColumn("rate", F.round("rate", 6))


_EDITED = f"""{_OBS}, now AS (SELECT area, year, week, cond, source, CASE WHEN year = 1996 THEN cnt * 2 ELSE cnt END AS cnt FROM obs
  WHERE year <> 1993)"""


@query(
    "coverage_stored",
    f"""{_EDITED} SELECT cond, min(year) AS first_year, CAST(min(year * 100 + week) % 100 AS INTEGER) AS first_week,
  max(year) AS last_year, CAST(max(year * 100 + week) % 100 AS INTEGER) AS last_week,
  string_agg(DISTINCT source, ', ' ORDER BY source) AS sources, CAST(sum(cnt) AS BIGINT) AS total_cases,
  count(*) AS rows,
  printf('%d-W%02d', min(year), CAST(min(year * 100 + week) % 100 AS INTEGER)) AS first_period,
  printf('%d-W%02d', max(year), CAST(max(year * 100 + week) % 100 AS INTEGER)) AS last_period
FROM now GROUP BY cond""",
)
def _(spark, folder):
    """Counted once, then again for a year that has changed and one that has gone."""
    root = shared_folder(spark, "covered")
    table, parts = Versions(spark, f"{root}/unified.parquet", COLS), Versions(spark, f"{root}/{build.COVERAGE_FILE}", COLS)
    rows = observations(spark, folder)
    table.overwrite(rows)
    build.refresh_coverage(table, parts, COLS)
    table.refresh(rows.where("year = 1996").withColumn("cnt", F.col("cnt") * 2), drop=[1993])
    build.refresh_coverage(table, parts, COLS)
    return build.read_coverage(spark, root, COLS)


@query("area_dimension", f"WITH {_CASES} SELECT DISTINCT area FROM cases")
def _(spark, folder):
    path = shared_folder(spark, "areas")
    names = aggregate.distinct_values(cases(spark, folder), "area")
    names.write.parquet(f"{path}/prefecture_en.parquet")
    return Catalog(spark, path, cols=COLS).areas()


@query(
    "typed_empty_union",
    f"""{_OBS} SELECT area, year, week, CAST(NULL AS DATE) AS date, cond, CAST(NULL AS VARCHAR) AS category, source,
  CAST(cnt AS DOUBLE) AS cnt, CAST(NULL AS DOUBLE) AS rate FROM obs""",
)
def _(spark, folder):
    nothing = Catalog(spark, f"{folder}/no-such-folder", cols=COLS).observations()
    return combine.union_strict(nothing, combine.to_observations(observations(spark, folder), COLS))


@query(
    "publish_gate",
    f"""{_OBS} SELECT area, year, week, cond, source AS category, cnt FROM obs
WHERE year <> 1994 AND year BETWEEN 1990 AND 2000 AND week BETWEEN 1 AND 50""",
)
def _(spark, folder):
    rows = observations(spark, folder).withColumnRenamed("source", "category")
    rows = rows.withColumn("cnt", F.when(F.col("year") == 1994, -F.col("cnt")).otherwise(F.col("cnt")))
    path = shared_folder(spark, "gated")
    good = quality.valid_rows(rows, (1990, 2000), (1, 50), COLS)
    snapshot.write_table(quality.validate(good, years=(1990, 2000), weeks=(1, 50), cols=COLS), path, COLS)
    return snapshot.read_table(spark, path, COLS)


@query(
    "version_diff",
    f"""{_OBS} SELECT area, year, week, cond, source, CASE WHEN year = 1996 AND week % 7 = 0 THEN 'removed' ELSE 'changed' END AS status
FROM obs WHERE (year = 1996 AND week % 7 = 0) OR (year = 1994 AND area < 'NATION_2')
UNION ALL SELECT area, year + 100, week, cond, source, 'added' FROM obs WHERE year = 1997""",
)
def _(spark, folder):
    versions = Versions(spark, shared_folder(spark, "versions"), COLS)
    rows = observations(spark, folder)
    before = versions.overwrite(rows)
    more = rows.where("year = 1997").withColumn("year", F.col("year") + 100)
    edited = rows.where("NOT (year = 1996 AND week % 7 = 0)").withColumn(
        "cnt", F.when((F.col("year") == 1994) & (F.col("area") < "NATION_2"), F.col("cnt") + 1).otherwise(F.col("cnt"))
    )
    after = versions.overwrite(edited.unionByName(more))
    return snapshot.version_diff(versions, before, after, ["area", "year", "week", "cond", "source"])


@query(
    "refresh_report",
    f"""{_OBS}, l AS (SELECT max(year * 100 + week) AS p FROM obs), k AS (SELECT max(year * 100 + week) AS p FROM obs WHERE year < 1998)
SELECT 'same' AS "table", false AS changed, CAST(p // 100 AS INTEGER) AS year, CAST(p % 100 AS INTEGER) AS week FROM l
UNION ALL SELECT 'edited', true, CAST(p // 100 AS INTEGER), CAST(p % 100 AS INTEGER) FROM l
UNION ALL SELECT 'cut', true, CAST(p // 100 AS INTEGER), CAST(p % 100 AS INTEGER) FROM k""",
)
def _(spark, folder):
    rows = observations(spark, folder)
    edited = rows.withColumn("cnt", F.when((F.col("year") == 1996) & (F.col("week") == 9), F.col("cnt") + 1).otherwise(F.col("cnt")))
    return snapshot.change_report(
        {"same": (rows, rows.select(*reversed(rows.columns))), "edited": (rows, edited), "cut": (rows, rows.where("year < 1998"))}, COLS
    )
