"""Reading and writing parsed documents as JSON lines, and versioned snapshots of state tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_strict(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Blank lines are skipped; a bad line or one that is no object fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lenient(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The records that can be read, and the text of the lines that cannot."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.select("value", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    good = F.col("r").isNotNull() & F.col("r._bad").isNull() & F.ltrim("value").startswith("{")
    return parsed.where(good).select("r.*").drop("_bad"), parsed.where(~good).select(F.col("value").alias("line"))


def write_jsonl(nested: DataFrame, path: str, keep_existing_if_empty: bool = True) -> bool:
    """Overwrite ``path`` with one line for each document, nulls kept; whether anything was written."""
    if keep_existing_if_empty and nested.isEmpty():
        return False
    nested.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return True


#: Versions that stay: the current one, and the one that readers of the last run may hold.
KEPT = 2


class Snapshots:
    """Versions of a table below one folder; the greatest of the numbered pointers names the current one.

    A pointer is added beside the old ones when its version is whole, and nothing is deleted before: a crash leaves the old state. No
    pointer is an empty state. Any other failure to read, that of a broken version too, fails the run, as
    taking it for an empty state would embed everything anew.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType | str) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _pointers(self) -> list[tuple[int, str]]:
        """Numbers and versions of the pointers, oldest first; a run adds one."""
        try:
            rows = self.spark.read.text(f"{self.folder}/current").where("value like '% %'").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted((int(number), version) for number, version in (r[0].split(" ") for r in rows))

    def read(self) -> DataFrame:
        """The current version; an empty table before the first."""
        pointers = self._pointers()
        if pointers:
            return self.spark.read.schema(self.schema).parquet(f"{self.folder}/{pointers[-1][1]}")
        return self.spark.createDataFrame([], self.schema)

    def write(self, table: DataFrame) -> str:
        """A new version; all but the last ``KEPT`` are removed once it counts."""
        pointers, version = self._pointers(), f"v-{uuid.uuid4().hex}"
        table.write.parquet(f"{self.folder}/{version}")
        number = pointers[-1][0] + 1 if pointers else 1
        self.spark.createDataFrame([(f"{number} {version}",)], "value string").coalesce(1).write.mode("append").text(f"{self.folder}/current")
        for _, old in pointers[: 1 - KEPT]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{old}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return version
