"""SparkSession factory and the shared scratch location.

The factory only sets what the library relies on (ANSI, AQE, UTC, no UI);
everything cluster-specific (executor sizes, shuffle partitions at scale)
belongs to the deployment and is passed through ``extra``.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "enrichkit",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master=None`` leaves the choice to ``spark-submit``; tests pass
    ``local[*]``. ``shuffle_partitions`` should be sized so that one
    shuffle partition stays around 128-256 MB at the target scale; AQE
    coalesces the small ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partition count, used as a fixed spreading width.

    Falls back to 200 (Spark's default) when the setting is not a number.
    """
    value = spark.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(value))
    except (TypeError, ValueError):
        return 200


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment to a shared file system and is
    only read here; unset on a cluster is an error. When it is unset in local
    mode (tests) a fresh local folder is created and registered, so later
    ``checkpoint()`` calls use it too.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception as exc:  # noqa: BLE001 - e.g. Spark Connect: no context
        raise RuntimeError("spark.checkpoint.dir must be set for this session") from exc
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir adds a per-application sub-folder; use its parent
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared "
            "folder (a machine-local temporary folder would be lost with its executor)"
        )
    local = tempfile.mkdtemp(prefix="enrichkit-ckpt-")
    sc.setCheckpointDir(local)
    return local


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the checkpoint root for intermediate tables.

    Results read these tables lazily, so they stay until ``clear_scratch``,
    which also runs when the program ends with its session still open.
    """
    if not _made:
        atexit.register(_clear_at_exit)
    path = os.path.join(checkpoint_root(spark), "enrichkit", f"{name}-{uuid.uuid4().hex}")
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove every scratch folder of this program; results not yet read are lost. Returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        clear_scratch(spark)
