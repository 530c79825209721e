"""Finished stages remembered beside their tables, so that a run that died goes on behind them.

A stage is done when its note names the same inputs and parameters as now and
its table is still the one that it wrote. Inputs and tables are told by their
files (path, length, time), which Spark lists and adds up on the executors; no
row is read. A note is written after its table, so a stage that died between
the two runs again.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.tables import current_path
from .metrics import StageError

log = logging.getLogger("enrichkit")


def files_mark(spark: SparkSession, path: str) -> str | None:
    """A text that differs when a file under ``path`` is added, removed or written again; None without a path."""
    try:
        files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    except AnalysisException:
        return None
    each = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)),
        F.coalesce(F.bit_xor(each), F.lit(0)), F.coalesce(F.sum(each.cast("decimal(20,0)")), F.lit(0)),
    ).first()
    return ":".join(str(x) for x in row)


def table_mark(spark: SparkSession, path: str) -> str | None:
    """``files_mark`` of the current version of a stored table, as the catalog or the newest folder names it."""
    return files_mark(spark, current_path(spark, path))


def _noted(spark: SparkSession, path: str) -> dict:
    try:
        rows = spark.read.text(path, wholetext=True).limit(1).collect()
    except AnalysisException:
        return {}
    return json.loads(rows[0]["value"]) if rows else {}


def run_once(spark: SparkSession, folder: str, name: str, out: str, given: Mapping, run: Callable[[], dict]) -> tuple[dict, bool]:
    """Metrics of the stage ``name``, which writes the table ``out``, and whether they come from its note.

    ``given`` holds the marks of its inputs and its parameters. With other ones,
    or when ``out`` is not as the stage left it, ``run`` is called and noted.
    """
    note, given = f"{folder}/{name}", json.loads(json.dumps(given))
    before = _noted(spark, note)
    if before and before["given"] == given and before["out"] is not None and before["out"] == table_mark(spark, out):
        log.info("stage %s: done before, not run again", name)
        return before["metrics"], True
    metrics = run()
    text = json.dumps({"given": given, "out": table_mark(spark, out), "metrics": metrics}, sort_keys=True)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(note)
    return metrics, False


def with_retries(run: Callable, retries: int, wait: float):
    """The result of ``run``; a stage that fails is run again, at most ``retries`` times, ``wait`` seconds later."""
    for left in range(retries, -1, -1):
        try:
            return run()
        except StageError as exc:
            if not left:
                raise
            log.warning("%s; %s tries left", exc, left)
            time.sleep(wait)
