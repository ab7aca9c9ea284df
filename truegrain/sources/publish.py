"""Runs published as versions: readers see a whole run or the one before, never a part.

A run is written to a folder of its own. Only when all of it is there, a line is added to the
manifest; the highest line is the current run. Nothing that a reader may hold open is touched
until :func:`retire` deletes runs that are no longer current.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.errors import RuleError
from truegrain.session import delete_folder

_LINE = "sequence bigint, run string, has_data boolean"


def new_run(output: str) -> str:
    """A folder for a run that is not published yet."""
    return f"{output.rstrip('/')}/runs/{uuid.uuid4().hex}"


def manifest(spark: SparkSession, output: str) -> DataFrame:
    """All published runs: ``sequence``, ``run`` (folder) and whether it stored rows."""
    try:
        return spark.read.schema(_LINE).json(f"{output.rstrip('/')}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LINE)


def publish(spark: SparkSession, output: str, run: str, has_data: bool) -> None:
    """Make a run that is wholly written the current one."""
    sequence = (manifest(spark, output).agg(F.max("sequence")).first()[0] or 0) + 1
    line = spark.createDataFrame([(sequence, run.rsplit("/", 1)[1], has_data)], _LINE)
    line.coalesce(1).write.mode("append").json(f"{output.rstrip('/')}/manifest")


def current(spark: SparkSession, output: str, with_data: bool = False) -> str:
    """The folder of the current run, or of the latest that stored rows."""
    lines = manifest(spark, output)
    line = (lines.where("has_data") if with_data else lines).orderBy(F.desc("sequence"), "run").first()
    if line is None:
        raise RuleError(f"nothing is published under '{output}'")
    return f"{output.rstrip('/')}/runs/{line['run']}"


def retire(spark: SparkSession, output: str, keep: int = 2) -> int:
    """Delete published runs but the latest ``keep``, and the latest that stored rows; how many went."""
    if isinstance(keep, bool) or not isinstance(keep, int) or keep < 1:
        raise RuleError(f"keep must be a whole number from 1, not {keep!r}")
    lines = manifest(spark, output).orderBy(F.desc("sequence"), "run").collect()
    kept = {r["run"] for r in lines[:keep]} | {r["run"] for r in [r for r in lines if r["has_data"]][:1]}
    gone = [r["run"] for r in lines if r["run"] not in kept]
    for run in gone:
        delete_folder(spark, f"{output.rstrip('/')}/runs/{run}")
    return len(gone)
