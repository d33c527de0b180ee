"""Session helpers shared by every operator: table access and lineage cutting."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Folder that holds the package; Python workers get it on their path.
ROOT = str(Path(__file__).resolve().parent.parent)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_workers_import(spark: SparkSession) -> None:
    """Put the package on the path of the session's Python workers; to a cluster it is shipped."""
    sc = spark.sparkContext
    known = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in known:
        sc.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *known])
    if not _is_local(spark) and not getattr(sc, "_quire_shipped", False):
        folder = tempfile.mkdtemp(prefix="quire-")
        # The driver serves the file from here; executors fetch their own copy.
        sc.addPyFile(shutil.make_archive(f"{folder}/quire", "zip", ROOT, "quire"))
        sc._quire_shipped = True


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the session's shared checkpoint folder and read it from there.

    The folder is the one the session names in ``spark.checkpoint.dir``; only a local session (tests) that names none gets a temporary one,
    any other fails. The files survive the loss of executors. They go with the tables that use them where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set, as the command line does.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not _is_local(df.sparkSession):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quire-"))
    return df.checkpoint(eager=True)
