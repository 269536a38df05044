"""Published tables in versions: a write adds folders, and one rename makes them the table.

Layout below the root of a table::

    year=2024/commit=<id>/*.parquet    rows, sorted; a folder is written once and never changed
    _digests/commit=<id>/*.parquet     digest and rows per (year, area) of what a commit wrote
    _versions/0000000007.json          a version: its columns, and the commits of each year, oldest first

A version is a small file of a line per year. It is written aside and renamed to the next number, which
fails if another writer was first. Whatever breaks off before leaves folders that no version names; they
go with :meth:`Versions.vacuum`. Readers take the newest version, or an older one, and open the folders of
the years they want.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.model import COLS, Cols

COMMIT = "commit"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentWrite(RuntimeError):
    """Another writer published a version since the table was looked at."""


@dataclass(frozen=True)
class Version:
    """``commits``: the folders of each year, oldest first; ``notes``: what the writer wants to know later."""

    number: int
    schema: T.StructType
    commits: dict[int | None, tuple[str, ...]]
    notes: dict = field(default_factory=dict)

    def to_json(self) -> str:
        years = [[year, list(names)] for year, names in self.commits.items()]
        return json.dumps({"number": self.number, "schema": self.schema.jsonValue(), "years": years, "notes": self.notes})

    @staticmethod
    def from_json(text: str) -> Version:
        data = json.loads(text)
        commits = {year: tuple(names) for year, names in data["years"]}
        return Version(data["number"], T.StructType.fromJson(data["schema"]), commits, data["notes"])

    def changed_years(self, other: Version | None) -> set[int | None]:
        """Years that the two versions do not read from the same folders."""
        theirs = other.commits if other else {}
        return {y for y in {*self.commits, *theirs} if self.commits.get(y) != theirs.get(y)}


def row_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """Hash of the columns in the order of their names; a null is told from any value."""
    columns = [F.col(f"`{c}`") for c in sorted(columns)]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*columns, nulls).cast("decimal(38,0)")


def interleaved(columns: Sequence[str], bits: int = 10) -> Column:
    """A number that is near for rows that have some of the columns in common: the hash bits of all columns in
    turn, so that a range of it holds few values of each column."""
    hashes = [F.xxhash64(F.col(f"`{c}`")) for c in columns]
    taken = [
        F.shiftleft(F.shiftright(h, at).bitwiseAND(F.lit(1).cast("long")), at * len(hashes) + k)
        for k, h in enumerate(hashes)
        for at in range(min(bits, 62 // len(hashes)))
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


class Versions:
    """The versions of one table below ``root``, on any file system that Spark writes to."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        cols: Cols = COLS,
        cluster: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ) -> None:
        """``cluster``: columns that queries look values up in; writes then put equal values of all of them
        close together, and keep Bloom filters of them, so that scans skip row groups. ``options`` go to the
        Parquet writer."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.cols = cols
        self.cluster = list(cluster)
        self.options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in cluster} | dict(options or {})

    # -- files ----------------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    @property
    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Versions that are there, oldest first."""
        names = [s.getPath().getName() for s in self._files.globStatus(self._path("_versions", "*.json")) or []]
        return sorted(int(n.removesuffix(".json")) for n in names)

    def exists(self) -> bool:
        return bool(self.numbers())

    def at(self, number: int) -> Version:
        """A version by its number; one that is not there any more is an error."""
        stream = self._files.open(self._path("_versions", f"{number:010d}.json"))
        try:
            return Version.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> Version | None:
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else None

    def _publish(self, version: Version) -> Version:
        target = self._path("_versions", f"{version.number:010d}.json")
        aside = self._path("_versions", f".{uuid.uuid4().hex}")
        files = self._files
        stream = files.create(aside, True)
        try:
            stream.write(bytearray(version.to_json().encode()))
        finally:
            stream.close()
        # Rename does not replace a file that is there.
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(aside, target, options)
        except Exception as problem:
            files.delete(aside, False)
            if files.exists(target):
                raise ConcurrentWrite(f"Version {version.number} of {self.root} was written by another writer") from problem
            raise
        return version

    def _folder(self, year: int | None) -> str:
        return f"{self.cols.year}={_NULL_FOLDER if year is None else year}"

    def _written(self, commit: str) -> list[int | None]:
        """Years that a commit has written, by its folders."""
        found = self._files.globStatus(self._path(f"{self.cols.year}=*", f"{COMMIT}={commit}")) or []
        names = [s.getPath().getParent().getName().split("=", 1)[1] for s in found]
        return sorted((None if n == _NULL_FOLDER else int(n) for n in names), key=lambda y: (y is None, y or 0))

    # -- reads ----------------------------------------------------------------------------------

    def read(
        self, version: Version | None = None, years: Iterable[int | None] | None = None, with_commit: bool = False
    ) -> DataFrame:
        """Rows of a version, the newest by default; with ``years`` only their folders are opened.

        No footer is read, as the version tells the columns. ``with_commit`` adds the commit of each row;
        the greater one is the later one.
        """
        version = version or self.current()
        if version is None:
            raise ValueError(f"No version of a table in {self.root}")
        wanted = None if years is None else set(years)
        paths = [
            f"{self.root}/{self._folder(year)}/{COMMIT}={name}"
            for year, names in version.commits.items()
            if wanted is None or year in wanted
            for name in names
        ]
        columns = [*version.schema.names, *([COMMIT] if with_commit else [])]
        schema = T.StructType([*version.schema.fields, T.StructField(COMMIT, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], schema).select(*columns)
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths).select(*[f"`{c}`" for c in columns])

    def digests(self, version: Version | None = None) -> DataFrame:
        """(year, area, rows, digest) of a version: the digest is a sum of row hashes, so parts add up."""
        version = version or self.current()
        area = version.schema[self.cols.area].dataType if self.cols.area in version.schema.names else T.StringType()
        schema = T.StructType(
            [
                T.StructField("year", T.IntegerType()),
                T.StructField("area", area),
                T.StructField("rows", T.LongType()),
                T.StructField("digest", T.DecimalType(38, 0)),
                T.StructField(COMMIT, T.StringType()),
            ]
        )
        named = [(year, name) for year, names in version.commits.items() for name in names]
        if not named:
            return self.spark.createDataFrame([], schema).drop(COMMIT)
        paths = [f"{self.root}/_digests/{COMMIT}={name}" for name in sorted({name for _, name in named})]
        stored = self.spark.read.schema(schema).option("basePath", f"{self.root}/_digests").parquet(*paths)
        of_year: dict[str, list] = {}
        for year, name in named:
            of_year.setdefault(name, []).append(year)
        held = [
            (F.col(COMMIT) == name)
            & (F.col("year").isin([y for y in years if y is not None]) | (F.col("year").isNull() if None in years else F.lit(False)))
            for name, years in of_year.items()
        ]
        return stored.where(reduce(lambda a, b: a | b, held)).groupBy("year", "area").agg(
            F.sum("rows").alias("rows"), F.sum("digest").alias("digest")
        )

    def changed_parts(self, before: Version | None, after: Version) -> DataFrame:
        """(year, area) that two versions hold different rows of; equal folders are not looked at."""
        years = after.changed_years(before)
        some = [y for y in years if y is not None]
        mine = F.col("year").isin(some) | (F.col("year").isNull() if None in years else F.lit(False))
        sides = [(after, 1)] + ([(before, -1)] if before else [])
        parts = [
            self.digests(v).where(mine).select("year", "area", (F.col("digest") * sign).alias("d"), (F.col("rows") * sign).alias("n"))
            for v, sign in sides
        ]
        both = reduce(DataFrame.unionByName, parts).groupBy("year", "area").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
        return both.where("d <> 0 OR n <> 0").select("year", "area")

    # -- writes ---------------------------------------------------------------------------------

    def _add(self, df: DataFrame, commit: str, with_digests: bool) -> list[int | None]:
        """Write the folders of a commit. All sort keys take part in the ranges, so that a year that holds
        most rows is spread over many files."""
        keys = [F.col(c).asc_nulls_last() for c in self.cols.output_order if c in df.columns]
        near = [interleaved(self.cluster).asc()] if self.cluster else []
        by_year = [F.col(self.cols.year).asc_nulls_last(), *near, *keys]
        rows = df.repartitionByRange(*by_year).sortWithinPartitions(*by_year).withColumn(COMMIT, F.lit(commit))
        rows.write.mode("append").options(**self.options).partitionBy(self.cols.year, COMMIT).parquet(self.root)
        years = self._written(commit)
        if with_digests:
            written = self.read(Version(0, df.schema, {y: (commit,) for y in years}))
            area = F.col(f"`{self.cols.area}`") if self.cols.area in df.columns else F.lit(None).cast("string")
            sums = written.groupBy(F.col(f"`{self.cols.year}`").cast("int").alias("year"), area.alias("area")).agg(
                F.count("*").alias("rows"), F.sum(row_hash(written, written.columns)).alias("digest")
            )
            sums.coalesce(1).write.parquet(f"{self.root}/_digests/{COMMIT}={commit}")
        return years

    def _next(self, now: Version | None) -> tuple[int, str]:
        number = now.number + 1 if now else 1
        return number, f"{number:010d}-{uuid.uuid4().hex[:8]}"

    def _columns(self, now: Version | None, df: DataFrame) -> T.StructType:
        """Columns after a write that keeps other years: new ones are added, known ones keep their types."""
        if now is None:
            return df.schema
        known = {f.name: f.dataType for f in now.schema}
        for f in df.schema:
            if f.name in known and known[f.name] != f.dataType:
                raise ValueError(f"Column {f.name} is {known[f.name].simpleString()} in the table, {f.dataType.simpleString()} in the rows")
        return T.StructType([*now.schema.fields, *(f for f in df.schema.fields if f.name not in known)])

    def overwrite(self, df: DataFrame, notes: dict | None = None) -> Version:
        """The rows of ``df`` become the table. Years whose rows are the same keep their folders."""
        now = self.current()
        number, commit = self._next(now)
        years = self._add(df, commit, True)
        new = Version(number, df.schema, {y: (commit,) for y in years}, notes or {})
        if now is not None and now.schema == df.schema:
            other = {r.year for r in self.changed_parts(now, new).select("year").distinct().collect()}
            new = Version(number, df.schema, {y: new.commits[y] if y in other else now.commits[y] for y in years}, notes or {})
        return self._publish(new)

    def refresh(self, df: DataFrame, drop: Iterable[int | None] = (), notes: dict | None = None) -> Version:
        """Replace the years that ``df`` has, and those of ``drop``; the folders of other years are neither
        read nor touched. ``notes`` stay unless they are given."""
        now, gone = self.current(), set(drop)
        number, commit = self._next(now)
        columns = self._columns(now, df)
        kept = {y: names for y, names in now.commits.items() if y not in gone} if now else {}
        commits = kept | {y: (commit,) for y in self._add(df, commit, True)}
        return self._publish(Version(number, columns, commits, notes if notes is not None else now.notes if now else {}))

    def append(self, df: DataFrame, replace: Iterable[int | None] = ()) -> Version:
        """Add the rows of ``df`` to its years; the years of ``replace`` are given by ``df`` alone, as one folder."""
        now, whole = self.current(), set(replace)
        number, commit = self._next(now)
        columns = self._columns(now, df)
        commits = dict(now.commits) if now else {}
        for year in self._add(df, commit, False):
            commits[year] = (commit,) if year in whole else (*commits.get(year, ()), commit)
        return self._publish(Version(number, columns, commits, now.notes if now else {}))

    def vacuum(self, keep: int = 2) -> None:
        """Delete folders that none of the newest ``keep`` versions names, and older versions.

        What a writer at work has written belongs to a number still to come, and stays.
        """
        numbers = self.numbers()
        if not numbers:
            return
        kept = [self.at(n) for n in numbers[-max(1, keep):]]
        named = {(self._folder(year), name) for v in kept for year, names in v.commits.items() for name in names}
        commits = {name for _, name in named}
        for n in numbers[: -max(1, keep)]:
            self._files.delete(self._path("_versions", f"{n:010d}.json"), False)
        for pattern in ((f"{self.cols.year}=*", f"{COMMIT}=*"), ("_digests", f"{COMMIT}=*")):
            for status in self._files.globStatus(self._path(*pattern)) or []:
                path = status.getPath()
                name = path.getName().split("=", 1)[1]
                used = (path.getParent().getName(), name) in named if pattern[0] != "_digests" else name in commits
                if not used and int(name.split("-")[0]) <= numbers[-1]:
                    self._files.delete(path, True)
