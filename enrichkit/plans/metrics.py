"""Inspection and run metrics (Q1-Q6).

The reference counts each input and the join result with extra actions and
pulls every group to the driver for logging. Here counts and the status
distribution are ``Observation`` metrics computed in the same pass as the
write, and reports are bounded DataFrames.
"""

from __future__ import annotations

import contextlib
import logging
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger("enrichkit")


class StageError(RuntimeError):
    """A stage failed; carries the stage name and keeps the cause chained (Q6)."""

    def __init__(self, stage: str, cause: BaseException):
        super().__init__(f"stage {stage!r} failed: {cause}")
        self.stage = stage


@contextlib.contextmanager
def stage(name: str) -> Iterator[None]:
    """Run a block as a named stage; any error is re-raised as ``StageError``."""
    try:
        yield
    except StageError:
        raise
    except Exception as exc:  # noqa: BLE001 - re-raised with context
        log.error("stage %s failed: %s", name, exc)
        raise StageError(name, exc) from exc


def unique_name(name: str) -> str:
    """Observation names must not collide between jobs running at the same time."""
    return f"{name}-{uuid.uuid4().hex[:12]}"


def observe(df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None):
    """Attach metrics that are filled by the next action on the result (Q1).

    Returns ``(df_observed, observation)``; ``observation.get`` blocks until
    the action has run. Observe above the last shuffle: below one, a map stage
    that runs again after a lost executor is counted twice. Default metric: ``rows`` = row count.
    """
    obs = Observation(unique_name(name))
    exprs = dict(metrics or {"rows": F.count(F.lit(1))})
    return df.observe(obs, *[e.alias(k) for k, e in exprs.items()]), obs


def status_metrics(column: str, labels: Mapping[str, str]) -> dict[str, Column]:
    """Row count plus one counter per label, for ``observe`` (Q2 in one pass)."""
    out = {"rows": F.count(F.lit(1))}
    for value, name in labels.items():
        out[name] = F.sum(F.when(F.col(column) == value, 1).otherwise(0))
    return out


def key_metrics(table: DataFrame, key: str, hot_threshold: int | None = None) -> dict[str, int | None]:
    """Distinct keys, most rows of a key and, given a threshold, keys with that many rows (map-side combined)."""
    counts = table.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    columns = [F.count(F.lit(1)).alias("keys"), F.max("n").alias("max_per_key")]
    if hot_threshold is not None:
        columns.append(F.count_if(F.col("n") >= hot_threshold).alias("hot_keys"))
    return counts.agg(*columns).first().asDict()


REPORT_COLUMNS = ("region", "subregion", "total_countries", "total_population")


def region_report(stats: DataFrame) -> DataFrame:
    """The whole per-group report (Q3): its narrow columns, ordered by group, NULLs first."""
    return stats.select(*REPORT_COLUMNS).orderBy("region", "subregion")


def schema_rows(df: DataFrame) -> list[tuple[str, str, bool]]:
    """``(name, type, nullable)`` per top-level field (Q4, metadata only)."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows (Q5). With ``order_by`` it is a deterministic top-n
    (planned as TakeOrderedAndProject: a per-partition top-n, no full sort);
    without it the choice of rows is arbitrary, as in the reference."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)
