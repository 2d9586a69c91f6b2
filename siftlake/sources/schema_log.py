"""The schema of a growing dataset as a log of versions, so that nobody has to look into its files to know its columns."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from siftlake.workspace import children, read_text, write_new


class SchemaConflict(ValueError):
    """A column came with another type than it has in the log."""


def united(known: T.StructType, found: T.StructType) -> T.StructType:
    """The columns of both, those that only ``found`` has at the end. Columns are the same whatever the case of their names;
    all of them may be null, since files of an earlier version lack some."""
    fields = {f.name.lower(): T.StructField(f.name, f.dataType) for f in known.fields}
    for field in found.fields:
        held = fields.setdefault(field.name.lower(), T.StructField(field.name, field.dataType))
        if held.dataType != field.dataType:
            raise SchemaConflict(
                f"{field.name} is {held.dataType.simpleString()} in the log and {field.dataType.simpleString()} in new data"
            )
    return T.StructType(list(fields.values()))


class SchemaLog:
    """One numbered file per version below ``path``, never changed once written.

    Two writers that add a version at the same time both succeed: who comes second finds the number taken, and tries again
    upon what the first has written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def beside(cls, spark: SparkSession, dataset: str) -> SchemaLog:
        """The log of a dataset. It lies beside it, since overwriting a dataset removes all that is inside."""
        return cls(spark, f"{dataset.rstrip('/')}-schema")

    def versions(self) -> list[int]:
        names = (name.removesuffix(".json") for name in children(self.spark, self.path) if name.endswith(".json"))
        return sorted(int(name) for name in names if name.isdigit())

    def version(self, number: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/{number:010d}.json")))

    def latest(self) -> T.StructType | None:
        """The newest version; None when there is none."""
        versions = self.versions()
        return self.version(versions[-1]) if versions else None

    def add(self, schema: T.StructType, anew: bool = False) -> T.StructType:
        """Unite the newest version with ``schema`` and return the result, which is a new version if it has new columns.
        ``anew`` says that no file of an earlier version is left: the result is ``schema`` alone."""
        while True:
            versions = self.versions()
            known = self.version(versions[-1]) if versions else T.StructType()
            wanted = united(T.StructType() if anew else known, schema)
            if versions and wanted == known:
                return known
            number = versions[-1] + 1 if versions else 1
            if write_new(self.spark, f"{self.path}/{number:010d}.json", wanted.json()):
                return wanted

    def of_dataset(self, dataset: str, glob: str = "*.parquet") -> T.StructType:
        """The newest version. A dataset that has no log yet gets one from the footers of its files, this once; one without
        any file has no columns to log."""
        if (known := self.latest()) is not None:
            return known
        reader = self.spark.read.option("pathGlobFilter", glob).option("mergeSchema", "true")
        try:
            return self.add(reader.parquet(dataset).schema)
        except AnalysisException as problem:
            if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                raise FileNotFoundError(f"no files in {dataset} to take a schema from") from None
            raise
