"""Composed jobs E1-E6: parameters in, tables out.

Each job does its data work in one Spark action (its write); counts of written
rows and the status distribution are ``Observation`` metrics of that same pass,
above every shuffle; other counts are taken from committed tables. The
enrich job first sketches the codes for its hot keys, and the aggregate
and publish jobs log the first rows (a ``limit``). Jobs hand over
through written tables, which also cuts lineage: a lost executor never forces
a recomputation of an earlier job. Like an overwrite of a stored Delta table,
a write that would change the schema of the table already at the output path
is refused unless ``overwrite_schema=True``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import REGIONAL_STATISTICS, regional_stats
from ..operators.classify import DEVELOPED, DEVELOPING, EMERGING, development_status
from ..operators.generate import DEFAULT_SEED, ECONOMIC_MEASURES, keyed_indicators
from ..operators.join import left_enrich
from ..operators.nested import flatten_countries
from ..operators.partials import merge_batches
from ..schemas import economic_schema, raw_country_schema
from ..session import scratch_path, shuffle_width
from ..sources.documents import read_documents
from ..sources.drift import drift_report, read_with_drift
from ..sources.key_list import read_key_list
from ..sources.quarantine import bad_rows, good_rows, with_reasons
from ..sources.tables import conform, default_format, path_exists, publish, read_table, save_table
from .manifest import files_mark, run_once, table_mark, with_retries
from .metrics import (
    key_metrics,
    observe,
    preview,
    region_report,
    schema_rows,
    stage,
    status_metrics,
)

log = logging.getLogger("enrichkit")

STATUS_LABELS = {DEVELOPED: "developed", EMERGING: "emerging", DEVELOPING: "developing"}

# A code with this many indicator lines or more is joined through the salted
# hot-key path, so its fan-out is produced by many tasks (see left_enrich).
DEFAULT_SKEW_THRESHOLD = 1_000_000


@dataclass
class JobResult:
    path: str
    metrics: dict = field(default_factory=dict)
    reused: bool = False  # kept from an earlier run (run_all with resume)


def process_documents(
    spark: SparkSession,
    json_path: str,
    out: str,
    *,
    multi_line: bool | str = False,
    mode: str = "PERMISSIVE",
    corrupt_column: str = "_corrupt_record",
    fmt: str | None = None,
    overwrite_schema: bool = False,
    quarantine: str | None = None,
    required: Sequence[str] = (),
    max_bad_share: float = 1.0,
    drift: str | None = None,
) -> JobResult:
    """JSON documents -> flat table with population density.

    Metrics: ``rows`` and ``corrupt`` (records that could not be parsed; in
    PERMISSIVE mode they are rows of NULLs). When no record at all could be
    parsed, for example an indented array read without ``multi_line``, the
    job fails and the stored table stays as it was.

    With a ``quarantine`` path, records that could not be parsed and rows that
    are NULL in a ``required`` output column go to that table instead (see
    ``sources.quarantine``), with ``record`` and ``reasons``; ``bad`` counts
    them. More than ``max_bad_share`` of the records fails the job before
    either table changes. The documents are scanned once; a second time only
    when there are bad ones.

    With a ``drift`` path (JSON Lines only), the same scan looks for undeclared
    and wrong-typed fields; their counts replace the table at that path after the
    processed table is committed, and ``drifted`` counts the documents with any.
    The parsed documents are then written once to the scratch folder, from which
    both tables are made.
    """
    if drift and (multi_line or mode.upper() != "PERMISSIVE"):
        raise ValueError("a drift report needs JSON Lines and mode PERMISSIVE")
    if required and not quarantine:
        raise ValueError("required columns need a quarantine table")
    if quarantine and mode.upper() != "PERMISSIVE":
        raise ValueError("a quarantine needs mode PERMISSIVE: other modes drop or refuse broken records")
    with stage("process_documents"):
        # multi-line files parse in one task each; spread the rows afterwards
        width = shuffle_width(spark) if multi_line is True else None
        departed, drifted = None, {}
        if drift:
            docs, seen = observe(
                read_with_drift(spark, json_path, raw_country_schema(), corrupt_column=corrupt_column),
                "drift", {"drifted": F.count_if(F.size("drift") > 0)},
            )
            staged = scratch_path(spark, "documents_with_drift")
            docs.write.parquet(staged)
            drifted = seen.get
            departed = spark.read.schema(docs.schema).parquet(staged)
            raw = departed.drop("drift")
        else:
            raw = read_documents(
                spark, json_path, raw_country_schema(), multi_line=multi_line, mode=mode,
                corrupt_column=corrupt_column if mode.upper() == "PERMISSIVE" else None, partitions=width,
            )
        broken = F.col(corrupt_column).isNotNull() if corrupt_column in raw.columns else F.lit(False)
        plain = raw
        raw, obs = observe(raw, "processed", {"rows": F.count(F.lit(1)), "corrupt": F.count_if(broken)})

        def finished(metrics: dict) -> JobResult:
            if departed is not None:
                save_table(drift_report(departed), drift, fmt, overwrite_schema=overwrite_schema)
            return JobResult(out, {**metrics, **drifted})

        def any_parsed() -> None:
            if obs.get["rows"] and obs.get["corrupt"] == obs.get["rows"]:
                raise ValueError(
                    f"none of the {obs.get['rows']} records of {json_path} could be parsed"
                    + ("" if multi_line else "; documents that span lines need multi_line=True or \"array\"")
                )

        if not quarantine:
            save_table(flatten_countries(raw), out, fmt, overwrite_schema=overwrite_schema, check=any_parsed)
            return finished(obs.get)

        def marked(docs: DataFrame) -> DataFrame:
            return with_reasons(flatten_countries(docs, keep=(corrupt_column,)), corrupt_column, required)

        flat, held = observe(marked(raw), "held", {"bad": F.count_if(F.size("reasons") > 0)})
        bad_docs = bad_rows(marked(plain))

        def few_bad() -> None:
            any_parsed()
            total, bad = obs.get["rows"], held.get["bad"]
            if bad > max_bad_share * total:
                raise ValueError(f"{bad} of {total} records of {json_path} are bad, more than a share of {max_bad_share}")
            if bad:
                save_table(bad_docs, quarantine, fmt, overwrite_schema=overwrite_schema)
            elif path_exists(spark, quarantine):  # of an earlier run
                save_table(bad_docs.limit(0), quarantine, fmt, overwrite_schema=overwrite_schema)

        save_table(good_rows(flat), out, fmt, overwrite_schema=overwrite_schema, check=few_bad)
        return finished({**obs.get, **held.get})


def build_indicators(
    spark: SparkSession,
    codes_path: str,
    out: str,
    *,
    seed: int = DEFAULT_SEED,
    fmt: str | None = None,
    overwrite_schema: bool = False,
    hot_threshold: int | None = DEFAULT_SKEW_THRESHOLD,
) -> JobResult:
    """Key list -> one indicator row per line (duplicates kept).

    Metrics: ``rows`` of the same pass; ``keys`` (distinct codes),
    ``max_per_key`` and ``hot_keys`` (codes with at least ``hot_threshold``
    lines, which the enrich job will deal into cells), counted over the
    written codes, so that a map stage run twice cannot raise them.
    """
    with stage("build_indicators"):
        keys = read_key_list(spark, codes_path, "code")
        rows = keyed_indicators(keys, "code", ECONOMIC_MEASURES, seed=seed, out_key="country_code_3_econ")
        rows, obs = observe(conform(rows, economic_schema()), "indicators")
        save_table(rows, out, fmt, overwrite_schema=overwrite_schema)
        counted = key_metrics(read_table(spark, out, fmt), "country_code_3_econ", hot_threshold)
        return JobResult(out, {**obs.get, **counted, "hot_threshold": hot_threshold})


def enrich(
    spark: SparkSession,
    countries_path: str,
    indicators_path: str,
    out: str,
    *,
    skew_threshold: int | None = DEFAULT_SKEW_THRESHOLD,
    on_duplicate: str = "keep",
    hot_sides: tuple[str, ...] = ("left", "right"),
    fmt: str | None = None,
    overwrite_schema: bool = False,
) -> JobResult:
    """Processed LEFT JOIN indicators on the 3-letter code, then classify.

    Duplicate indicator codes fan out like in the reference (``"keep"``);
    ``on_duplicate="error"`` refuses them instead. ``hot_sides`` without
    ``"right"`` says that no code has ``skew_threshold`` indicator lines, as
    E2 has counted, and saves that count.
    """
    with stage("enrich"):
        countries = read_table(spark, countries_path, fmt)
        indicators = read_table(spark, indicators_path, fmt)
        joined = left_enrich(
            countries,
            indicators,
            "country_code_3",
            "country_code_3_econ",
            skew_threshold=skew_threshold,
            on_duplicate=on_duplicate,
            hot_sides=hot_sides,
        )
        enriched, obs = observe(
            development_status(joined),
            "enriched",
            status_metrics("development_status", STATUS_LABELS),
        )
        save_table(enriched, out, fmt, overwrite_schema=overwrite_schema)
        metrics = dict(obs.get)
        # of the committed files (their footers), not of a pass below the join's shuffle
        metrics["left_rows"], metrics["right_rows"] = countries.count(), indicators.count()
        return JobResult(out, metrics)


def aggregate_regions(
    spark: SparkSession,
    enriched_path: str,
    out: str,
    fmt: str | None = None,
    *,
    report_rows: int = 20,
    overwrite_schema: bool = False,
) -> JobResult:
    """Per (region, subregion) statistics.

    Logs the first ``report_rows`` groups of the written table, in order, and
    how many there are; ``region_report`` is the whole report. A NULL total is
    logged as such.
    """
    with stage("aggregate_regions"):
        stats, obs = observe(regional_stats(read_table(spark, enriched_path, fmt)), "regions")
        save_table(stats, out, fmt, overwrite_schema=overwrite_schema)
        if report_rows:
            rows = region_report(read_table(spark, out, fmt)).limit(report_rows).collect()
            log.info("%s of %s groups:", len(rows), obs.get["rows"])
            for r in rows:
                total = "NULL" if r.total_population is None else f"{r.total_population:,}"
                log.info(
                    "region %r / %r: %s rows, total population %s",
                    r.region, r.subregion, r.total_countries, total,
                )
        return JobResult(out, obs.get)


def aggregate_batches(
    spark: SparkSession,
    batches: Mapping[str, str | DataFrame],
    partials_path: str,
    out: str,
    fmt: str | None = None,
    *,
    replace: Sequence[str] = (),
    overwrite_schema: bool = False,
) -> JobResult:
    """E4 kept up by batch: only batches (tables or their paths) that are not in the partials yet are read.

    The statistics equal those of ``regional_stats(exact=True)`` over the rows
    of all ``batches`` bit for bit. ``replace`` names stored batches to read
    again; a batch taken out of ``batches`` no longer counts. Metrics: ``rows``
    and ``read``, the names of the batches read.
    """
    with stage("aggregate_batches"):
        tables = {n: read_table(spark, b, fmt) if isinstance(b, str) else b for n, b in batches.items()}
        merged, read = merge_batches(tables, partials_path, REGIONAL_STATISTICS, replace=replace)
        merged, obs = observe(merged, "regions")
        save_table(merged, out, fmt, overwrite_schema=overwrite_schema)
        return JobResult(out, {**obs.get, "read": read})


def publish_report(
    spark: SparkSession,
    enriched_path: str,
    out: str,
    fmt: str | None = None,
    *,
    preview_rows: int = 10,
    overwrite_schema: bool = False,
) -> JobResult:
    """E5: copy the enriched table unchanged to the report location.

    Logs the schema and, unless ``preview_rows`` is 0, a bounded preview of
    the copy (a ``limit``; which rows is arbitrary, as in the reference).
    """
    with stage("publish_report"):
        report = publish(spark, enriched_path, out, fmt, overwrite_schema=overwrite_schema)
        log.info("report schema: %s", schema_rows(report))
        if preview_rows:
            for row in preview(report, preview_rows).collect():
                log.info("report row: %s", row.asDict())
        return JobResult(out)


def run_all(
    spark: SparkSession,
    json_path: str,
    codes_path: str,
    workdir: str,
    *,
    multi_line: bool | str = False,
    skew_threshold: int | None = DEFAULT_SKEW_THRESHOLD,
    fmt: str | None = None,
    resume: bool = False,
    retries: int = 0,
    retry_wait: float = 0.0,
) -> dict[str, JobResult]:
    """{E1, E2} -> E3 -> {E4, E5}, in one session, handing over by table.

    With ``resume``, finished stages are noted under ``workdir/manifest`` and a
    later run with ``resume`` runs only those whose input files, parameters or
    tables are not as noted (``JobResult.reused`` tells which were kept).
    Tables written without such a note, or by Delta, are not resumed. A failed
    stage is run again up to ``retries`` times, ``retry_wait`` seconds later.
    """
    if resume and (fmt or default_format(spark)) == "delta":
        raise ValueError("resume needs tables whose versions are folders, not Delta tables")
    root = workdir.rstrip("/")
    paths = {name: f"{root}/{name}" for name in ("processed", "indicators", "enriched", "regional_stats", "report")}

    def step(name: str, job: Callable[..., JobResult], inputs: Sequence[str], marker: Callable, **options) -> JobResult:
        def run() -> dict:
            return with_retries(lambda: job(spark, *inputs, paths[name], fmt=fmt, **options).metrics, retries, retry_wait)

        if not resume:
            return JobResult(paths[name], run())
        given = {"inputs": [[i, marker(spark, i)] for i in inputs], "options": options, "fmt": fmt}
        metrics, reused = run_once(spark, f"{root}/manifest", name, paths[name], given, run)
        return JobResult(paths[name], metrics, reused)

    # independent jobs are submitted together from two driver threads, as the
    # reference runs them as parallel tasks; Spark schedules both job's tasks
    # on the same executors, so small jobs overlap instead of queueing
    with ThreadPoolExecutor(max_workers=2) as pool:
        processed = pool.submit(step, "processed", process_documents, [json_path], files_mark, multi_line=multi_line)
        indicators = pool.submit(step, "indicators", build_indicators, [codes_path], files_mark, hot_threshold=skew_threshold)
        results = {"processed": processed.result(), "indicators": indicators.result()}
        # E2 has counted the lines of every code in its own pass
        few = skew_threshold is not None and results["indicators"].metrics["hot_keys"] == 0
        results["enriched"] = step(
            "enriched", enrich, [paths["processed"], paths["indicators"]], table_mark,
            skew_threshold=skew_threshold, hot_sides=("left",) if few else ("left", "right"),
        )
        stats = pool.submit(step, "regional_stats", aggregate_regions, [paths["enriched"]], table_mark)
        report = pool.submit(step, "report", publish_report, [paths["enriched"]], table_mark)
        results["regional_stats"] = stats.result()
        results["report"] = report.result()
    return results
