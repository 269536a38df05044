import datetime as dt

import pytest
from pyspark.sql import functions as F

import weektide as wt
from weektide.operators import grid
from weektide.sources import reports

BULLET = """Overview of the week by area,,,,,,
"27th week, 2019",,,,,,
provisional,,,,,,
Area,{a},,{b},,Plague,
,Current week,Cum,Current week,Cum,Current week,Cum
Total No.,33,70,"2,015",9,0,0
Nara,"2,000",2,15,3,-,0
Kochi,31,68,,6,0,0
,1,1,1,1,1,1
Saga
"""
PLAIN = """first line
second line
third line
Area,Rubella weekly,Mumps weekly
sub,now,now
Total,41,5
Mie,17,3
Oita,24,2
"""
ENGLISH = """Sentinel figures by area and disease
"31th week, 2022",,"printed on a Friday",,,,,,
,Mumps,,Scarlet fever (group A),,"Red, sore eyes",,Late column
,Current week,per sentinel,Current week,per sentinel,Current week,per sentinel,Current week
Total No.,912,0.51,86,0.12,7,0.02,1
Gifu,"3,405",12.25,-,0.5,...,-,9
Ehime,18,0.75,4,,0,0,8
"""
ENGLISH_LATE_HEADER = """Another title,,,,
"2nd week, 2020","made
in two lines",,,
,,,,
,,,,
Area,HIV/AIDS,,Scrub typhus(Tsutsugamushi disease),
,Current week,Per sentinel,Current week,Per sentinel
Total,5,1,6,1
Fukui,2,0.25,6,1.5
Toyama,3,0.75,,
"""
JAPANESE = """定点把握の対象となる五類感染症,,,,
2021年33週,"作成日 九月一日",,,
,"水痘",,"手足口病（Hand foot）",
,"報告","定当","報告","定当"
"総数","40","0.9","81","1.7"
"岐阜県","35","0.55","-","-"
"高知県","5","0.1","80","1.6"
"""


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_bullet_period_from_folder_and_file_name(spark, tmp_path):
    path = write(tmp_path / "2019" / "zensu27.csv", BULLET.format(a="Typhoid", b="Cholera"))
    out = wt.read(spark, path)
    got = {(r["prefecture"], r["disease"], r["count"]) for r in out.collect()}
    assert got == {
        ("Nara", "Typhoid", 2000), ("Nara", "Cholera", 15), ("Nara", "Plague", 0),
        ("Kochi", "Typhoid", 31), ("Kochi", "Cholera", 0), ("Kochi", "Plague", 0),
        ("Saga", "Typhoid", 0), ("Saga", "Cholera", 0), ("Saga", "Plague", 0),
    }
    first = out.first()
    assert (first["year"], first["week"], first["date"]) == (2019, 27, dt.date(2019, 7, 1))
    assert first["source"] == "Confirmed cases"


def test_bullet_names_are_normalised(spark, tmp_path):
    names = {"a": "HIV/AIDS", "b": "Tsutsugamushi disease"}
    path = write(tmp_path / "2019" / "zensu27.csv", BULLET.format(**names))
    out = wt.read(spark, path, type="bullet")
    assert {r["disease"] for r in out.collect()} == {"AIDS", "Scrub typhus", "Plague"}


def test_plain_bullet_header(spark, tmp_path):
    path = write(tmp_path / "2017-38-zensu.csv", PLAIN)
    got = {(r["prefecture"], r["disease"], r["count"], r["year"], r["week"]) for r in wt.read(spark, path).collect()}
    assert got == {
        ("Mie", "Rubella weekly", 17, 2017, 38), ("Mie", "Mumps weekly", 3, 2017, 38),
        ("Oita", "Rubella weekly", 24, 2017, 38), ("Oita", "Mumps weekly", 2, 2017, 38),
    }


def test_year_can_be_given(spark, tmp_path):
    path = write(tmp_path / "x" / "zensu27.csv", PLAIN)
    assert {r["year"] for r in wt.read(spark, path, year=2014).collect()} == {2014}


def test_english_sentinel(spark, tmp_path):
    out = wt.read(spark, write(tmp_path / "teitenrui31.csv", ENGLISH))
    rows = {(r["prefecture"], r["disease"]): r for r in out.collect()}
    assert {d for _, d in rows} == {"Mumps", "Scarlet fever (group A)", "Red, sore eyes", "Late column"} and len(rows) == 8
    one = rows["Gifu", "Mumps"]
    assert (one["count"], one["per_sentinel"], one["year"], one["week"]) == (3405.0, 12.25, 2022, 31)
    assert one["date"] == dt.date(2022, 8, 7)
    assert rows["Gifu", "Scarlet fever (group A)"]["count"] is None
    assert rows["Gifu", "Red, sore eyes"]["count"] is None and rows["Gifu", "Red, sore eyes"]["per_sentinel"] is None
    assert rows["Ehime", "Scarlet fever (group A)"]["per_sentinel"] is None
    assert (rows["Ehime", "Late column"]["count"], rows["Ehime", "Late column"]["per_sentinel"]) == (8.0, None)


def test_metric_row_is_found_by_content(spark, tmp_path):
    out = wt.read(spark, write(tmp_path / "teitenrui02.csv", ENGLISH_LATE_HEADER))
    got = {(r["prefecture"], r["disease"], r["count"]) for r in out.collect()}
    assert got == {("Fukui", "AIDS", 2.0), ("Fukui", "Scrub typhus", 6.0), ("Toyama", "AIDS", 3.0), ("Toyama", "Scrub typhus", None)}


def test_japanese_sentinel_in_its_own_encoding(spark, tmp_path):
    out = wt.read(spark, write(tmp_path / "2021-33-teiten.csv", JAPANESE, "cp932"))
    rows = {(r["prefecture"], r["disease"]): r for r in out.collect()}
    assert set(rows) == {(a, d) for a in ("岐阜県", "高知県") for d in ("水痘", "Hand foot")}
    assert (rows["岐阜県", "水痘"]["count"], rows["岐阜県", "水痘"]["per_sentinel"]) == (35.0, 0.55)
    assert (rows["岐阜県", "Hand foot"]["count"], rows["岐阜県", "Hand foot"]["per_sentinel"]) == (0.0, None)
    assert {r["date"] for r in rows.values()} == {dt.date(2021, 8, 22)}


def test_layout_is_chosen_per_file(spark, tmp_path):
    """A bullet report has a metric row too, but is never read as rates."""
    write(tmp_path / "in" / "teitenrui31.csv", ENGLISH)
    write(tmp_path / "in" / "2021-33-teiten.csv", JAPANESE, "cp932")
    write(tmp_path / "in" / "2019" / "zensu27.csv", BULLET.format(a="Typhoid", b="Cholera"))
    folder = str(tmp_path / "in")
    got = wt.read(spark, folder).groupBy("week", "source").agg(F.count("*").alias("n")).collect()
    assert {tuple(r) for r in got} == {(31, "Sentinel surveillance", 8), (33, "Sentinel surveillance", 4), (27, "Confirmed cases", 9)}
    assert wt.read(spark, folder).where("source = 'Confirmed cases' AND per_sentinel IS NOT NULL").count() == 0
    assert wt.read(spark, folder, type="bullet").count() == 9 and wt.read(spark, folder, type="sentinel").count() == 12
    table = reports.read_reports(spark, folder)
    assert grid.sentinel_to_long(table.where(reports.layout_of("file") == "sentinel"), layout="english").count() == 8


def test_week_subset(spark, tmp_path):
    """Names tell the week of bullet reports, headers that of sentinel ones."""
    for w in (36, 37, 38):
        write(tmp_path / "2017" / f"zensu{w}.csv", PLAIN)
    folder = str(tmp_path / "2017")
    assert {r["week"] for r in wt.read(spark, folder, weeks=[36, 38]).collect()} == {36, 38}
    assert reports.read_reports(spark, folder, weeks=[37]).count() == 1
    write(tmp_path / "2017" / "teitenrui.csv", ENGLISH)
    write(tmp_path / "2017" / "teitenrui36.csv", ENGLISH.replace("31th", "38th"))
    assert {(r["week"], r["year"]) for r in wt.read(spark, folder, weeks=[31]).select("week", "year").collect()} == {(31, 2022)}
    got = wt.read(spark, folder, weeks=[38]).select("week", "source").distinct().collect()
    assert {tuple(r) for r in got} == {(38, "Confirmed cases"), (38, "Sentinel surveillance")}


def test_bad_files_go_to_quarantine(spark, tmp_path):
    root = tmp_path / "2017"
    write(root / "zensu01.csv", PLAIN)
    write(root / "zensu02.csv", "a,b\n")
    write(root / "teitenrui03.csv", ENGLISH)
    write(root / "teitenrui04.csv", "x,current week\n")
    (root / "zensu05.csv").write_bytes(b"\x81\xff\xfe\xfd")
    write(root / "zensu06.csv", "\n")
    write(root / "zensu07.csv", "")
    write(root / "zensu.csv", PLAIN)
    table = reports.read_reports(spark, str(root))
    got = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in grid.quarantine(table).collect()}
    assert got.pop("zensu07.csv", "empty file") == "empty file"
    assert got == {
        "zensu02.csv": "too few rows",
        "teitenrui04.csv": "too few rows",
        "zensu05.csv": "undecodable text",
        "zensu06.csv": "too few rows",
        "zensu.csv": "unknown period",
    }
    empty = reports.parse_contents(spark.createDataFrame([("a/2017/zensu07.csv", b"")], "path string, content binary"))
    assert [r["reason"] for r in grid.quarantine(empty).collect()] == ["empty file"]
    assert {r["week"] for r in wt.read(spark, str(root), type="bullet").select("week").collect()} == {1}


def test_empty_folder(spark, tmp_path):
    assert reports.read_reports(spark, str(tmp_path)).count() == 0
    assert wt.read(spark, str(tmp_path)).count() == 0
    assert wt.read(spark, str(tmp_path), type="sentinel").count() == 0


def test_layout_by_name(spark):
    assert reports.detect_layout("x/2024-01-zensu.csv") == "bullet"
    assert reports.detect_layout("x/Teiten04.csv") == "sentinel"
    assert reports.detect_layout("x/Syu_01_1_2020.xlsx") == "sex"
    assert reports.detect_layout("x/2020_place.xls") == "place"
    for bad in ("x/notes.txt", "x/book.xlsx"):
        with pytest.raises(ValueError, match="do not tell"):
            reports.detect_layout(bad)
    with pytest.raises(ValueError, match="cell-grid"):
        wt.read(spark, "x/Syu_01_1_2020.xlsx")


def test_periods_of_names(spark):
    names = {
        "a/2024-01-zensu.csv": (2024, 1),
        "a/2026/zensu11.csv": (2026, 11),
        "2026x/zensu11.csv": (None, 11),
        "a/teitenrui04.csv": (None, 4),
        "a/2025-04-teiten.csv": (2025, 4),
        "a/Syu_01_1_1999.xlsx": (1999, 1),
    }
    df = spark.createDataFrame([(n,) for n in names], "path string")
    got = df.select("path", reports.year_from_name("path"), reports.week_from_name("path")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == names


def test_reports_as_grid(spark, tmp_path):
    write(tmp_path / "2017-38-zensu.csv", PLAIN)
    cells = reports.as_grid(reports.read_reports(spark, str(tmp_path)))
    assert cells.count() == 8
    assert cells.where("row_idx = 7").first()["cells"] == ["Oita", "24", "2"]


# -- workbooks ----------------------------------------------------------------------------------

TWO_BLOCKS = [
    ["Yearly book"],
    [None, "腸チフス (Ty\0phoid)", None, "Rubella", None, None],
    [None, "To\0tal", "Male", "Total", "Fe\0male", "note"],
    ["Total No.", "99", "98", "97", "96"],
    ["Mie", "11", "12", "13", "14"],
    ["Oita", "21", "22", "23"],
    ["Saga", "31", "32", "33", "34", "35"],
    [None, "Mumps", None],
    [None, "Total", "Unknown"],
    ["Mie", "41", "42"],
]


def sheet(spark, rows, file="Syu_02_1_2020.xlsx", number=2):
    data = [(file, number, i, cells) for i, cells in enumerate(rows)]
    return spark.createDataFrame(data, "file string, sheet int, row_idx int, cells array<string>")


@pytest.mark.parametrize("chunk_rows", [2, 3, 5, 4096])
def test_two_header_blocks(spark, chunk_rows):
    blocks = grid.find_blocks(sheet(spark, TWO_BLOCKS), min_rows=2, chunk_rows=chunk_rows)
    cells = grid.block_cells(blocks).where("category <> 'note'").collect()
    got = sorted((r["block"], r["prefecture"], r["disease"], r["category"], r["raw"] or "") for r in cells)
    first = (("Typhoid", "total"), ("Typhoid", "male"), ("Rubella", "total"), ("Rubella", "female"))
    want = [(1, TWO_BLOCKS[r][0], *first[k], (*TWO_BLOCKS[r], "")[k + 1]) for r in (4, 5, 6) for k in range(4)]
    want += [(7, "Mie", "Mumps", "total", "41"), (7, "Mie", "Mumps", "unknown", "42")]
    assert got == sorted(want)


def test_sheets_that_give_nothing(spark):
    rows = sheet(spark, TWO_BLOCKS)
    more = [sheet(spark, TWO_BLOCKS, number=1), sheet(spark, TWO_BLOCKS, number=55), sheet(spark, TWO_BLOCKS[:3], number=7)]
    more += [sheet(spark, [["a", "b"]] * 6, number=8), sheet(spark, TWO_BLOCKS, "Syu_02_1.xlsx", 3)]
    for m in more:
        rows = rows.unionByName(m)
    got = {(r["file"], r["sheet"]): r["reason"] for r in grid.quarantine_sheets(rows).collect()}
    book = "Syu_02_1_2020.xlsx"
    assert got == {(book, 1): "no week", (book, 55): "no week", (book, 7): "too few rows", (book, 8): "no header", ("Syu_02_1.xlsx", 3): "unknown period"}


@pytest.mark.parametrize("chunk_rows", [7, 4096])
def test_long_sheet_equals_a_plain_walk(spark, chunk_rows):
    """Many blocks of different length over chunk borders."""
    rows, want, block = [["title"]], [], None
    for b in range(12):
        block = len(rows)
        rows.append([None, f"Name {b}", None])
        rows.append([None, "Total", "Male"])
        for r in range(b):
            want.append((block, len(rows), f"Name {b}"))
            rows.append([f"Area {r}", str(r), str(b)])
    found = grid.find_blocks(sheet(spark, rows), chunk_rows=chunk_rows)
    got = [(r["block"], r["row_idx"], r["header"][0]["name"]) for r in found.collect()]
    assert sorted(got) == sorted(want)


def test_female_is_not_male_and_repeated_columns_are_dropped(spark):
    rows = [
        ["title"],
        [None, "結核 (Tuberculosis)", None, None, None],
        [None, "Total", "Male", "Female", "Male"],
        ["Tokyo", "9", "5", "4", "77"],
        ["Osaka", "1,200", "-", "x", "77"],
    ]
    out = wt.read(spark, sheet(spark, rows, "Syu_01_1_2020.xlsx", 2), type="sex")
    got = {(r["prefecture"], r["category"], r["count"]) for r in out.collect()}
    assert got == {
        ("Tokyo", "total", 9), ("Tokyo", "male", 5), ("Tokyo", "female", 4),
        ("Osaka", "total", 1200), ("Osaka", "male", 0), ("Osaka", "female", 0),
    }
    first = out.first()
    assert (first["year"], first["week"], first["date"]) == (2020, 1, dt.date(2020, 1, 5))
    assert first["source"] == "Confirmed cases" and first["disease"] == "Tuberculosis"


def test_short_sheets_and_sheets_without_a_week_are_left_out(spark):
    short = [[None, "A"], [None, "total male"], ["Tokyo", "1"]]
    assert wt.read(spark, sheet(spark, short), type="place").count() == 0
    padded = [*short, ["Osaka", "2"], ["Nara", "3"]]
    assert wt.read(spark, sheet(spark, padded), type="place").count() == 3
    assert wt.read(spark, sheet(spark, padded, number=1), type="place").count() == 0
    assert wt.read(spark, sheet(spark, padded, "Syu_02_1.xlsx"), type="place").count() == 0


def test_sheet_weeks(spark):
    cases = {(1999, 2): 14, (1999, 40): 52, (1999, 41): None, (2004, 54): 53, (2020, 54): 53, (2020, 55): None, (2003, 54): None, (2003, 1): None}
    df = spark.createDataFrame(list(cases), "y int, s int")
    got = {(r[0], r[1]): r[2] for r in df.select("y", "s", reports.sheet_week("y", "s")).collect()}
    assert got == cases


def test_workbook_kind_by_file_name(spark):
    files = ["Syu_01_1.xls", "a_01_1.xlsx", "Syu_02_1.xlsx", "other.xlsx"]
    df = spark.createDataFrame([(f,) for f in files], "file string")
    assert [r[0] for r in reports.workbook_files(df, "sex").collect()] == files[:2]
    assert [r[0] for r in reports.workbook_files(df, "place").collect()] == [files[2]]
    assert [r[0] for r in reports.workbook_files(df).collect()] == [files[0], files[2]]


def test_names_that_were_read(spark, tmp_path):
    from weektide.plans import build

    def file(name, *heads):
        cells = ["", *[c for h in heads for c in (h, "")]]
        rows = [["a"], ["b"], ["c"], cells, ["", *["Current week", "Cum"] * len(heads)], ["Total", "1"], ["Mie", *["1", "1"] * len(heads)]]
        return (f"in/{name}", rows, None)

    schema = "file string, rows array<array<string>>, error string"
    df = spark.createDataFrame(
        [file("2020-07-zensu.csv", "Mumps", "HIV/AIDS"), file("2020-03-zensu.csv", "HIV/AIDS"), file("2019-09-zensu.csv", "Measles (x"), file("2018-01-zensu.csv")],
        schema,
    )
    got = {r["raw"]: (r["canonical"], r["year"], r["week"]) for r in grid.names_read(df).collect()}
    assert got == {"Mumps": ("Mumps", 2020, 7), "HIV/AIDS": ("AIDS", 2020, 3), "Measles (x": ("Measles (x)", 2019, 9)}
    # A log of several runs, one of them repeated: the first reading of a spelling stays.
    for part in (df.where("file LIKE '%-07-%'"), df, df):
        grid.names_read(part).write.mode("append").parquet(f"{tmp_path}/{build.NAMES_FOLDER}")
    log = {r["raw"]: (r["canonical"], r["year"], r["week"]) for r in build.read_names(spark, str(tmp_path)).collect()}
    assert log == got
    # An older canonical form is not written over by a later reading.
    later = grid.names_read(df).where("raw = 'HIV/AIDS'").selectExpr("raw", "'other' AS canonical", "2021 AS year", "1 AS week", "file")
    assert grid.merge_audits(later, grid.names_read(df)).where("raw = 'HIV/AIDS'").first()["canonical"] == "AIDS"
