"""Named tables of one data folder: load, views, metadata, fallback."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.model import COLS, DATASET_ALIASES, DATASET_FILES, Cols, observation_schema
from weektide.sources.versions import Versions

METADATA_SCHEMA = "key string, value string"


class Catalog:
    """Resolves table names below ``root``. Reading is lazy; nothing is cached or copied."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        files: Mapping[str, str] = DATASET_FILES,
        aliases: Mapping[str, str] = DATASET_ALIASES,
        cols: Cols = COLS,
    ) -> None:
        self.spark = spark
        self.root = root
        self.files = dict(files)
        self.aliases = dict(aliases)
        self.cols = cols

    def path(self, name: str) -> str:
        """Path of a table; an unknown name is an error before any job starts."""
        resolved = self.aliases.get(name, name)
        if resolved not in self.files:
            raise ValueError(f"Unknown dataset: {name}")
        return os.path.join(self.root, self.files[resolved])

    def load(self, name: str, schema: T.StructType | str | None = None) -> DataFrame:
        """Lazy table, the newest version of a published one. A given schema saves the footer read that infers it."""
        versions = self.versions(name)
        if versions.exists():
            table = versions.read()
            return table if schema is None else table.to(schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema))
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    scan = load

    def versions(self, name: str) -> Versions:
        """The versions of a table that this library published."""
        return Versions(self.spark, self.path(name), self.cols)

    def areas(self) -> DataFrame:
        """Area-name dimension in file order."""
        return self.load("prefecture_en").select(self.cols.area)

    def first_available(self, names: Iterable[str]) -> DataFrame:
        """First table that exists, else an empty one. Any other failure is raised, not hidden."""
        for name in names:
            try:
                return self.load(name)
            except AnalysisException as problem:
                if problem.getCondition() != "PATH_NOT_FOUND":
                    raise
        return empty_observations(self.spark, self.cols)

    def observations(self) -> DataFrame:
        """The combined table, or the newest single source when it has not been built."""
        return self.first_available(["unified", "bullet"])

    def register_views(
        self, dataset_id: str | None = None, version: str | None = None, built_at: str | None = None
    ) -> list[str]:
        """One SQL view per existing table and alias, plus ``metadata(key, value)``."""
        views = []
        for name in self.files:
            try:
                table = self.load(name)
            except AnalysisException as problem:
                if problem.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            for view in [name, *(a for a, target in self.aliases.items() if target == name)]:
                table.createOrReplaceTempView(view)
                views.append(view)
        self.metadata(dataset_id, version, built_at).createOrReplaceTempView("metadata")
        return [*views, "metadata"]

    def metadata(
        self, dataset_id: str | None = None, version: str | None = None, built_at: str | None = None
    ) -> DataFrame:
        """Key-value table that describes the snapshot; the version carries no leading ``v``."""
        plain = version[1:] if version and version.startswith("v") else version
        rows = [("dataset_id", dataset_id), ("data_version", plain), ("built_at", built_at)]
        return self.spark.createDataFrame(rows, METADATA_SCHEMA)

    def row_counts(self) -> DataFrame:
        """Rows per table, in one plan."""
        parts = [
            self.load(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
            for name in self.files
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


def empty_observations(spark: SparkSession, cols: Cols = COLS) -> DataFrame:
    """Typed table without rows."""
    return spark.createDataFrame([], observation_schema(cols))
