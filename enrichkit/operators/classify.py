"""Rule-based classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import case_when


def classify(
    df: DataFrame, out: str, rules: Sequence[tuple[Column, str]], default: str
) -> DataFrame:
    """Add ``out`` = label of the first rule whose predicate is TRUE, else ``default``.

    Predicates follow SQL three-valued logic: ``NULL AND x`` is never TRUE,
    ``NULL OR TRUE`` is TRUE, and a row for which nothing is TRUE gets the
    default. It is a single CASE expression, evaluated in the same codegen
    stage as the surrounding projection.
    """
    return df.withColumn(out, case_when(rules, default))


# The development-status rule (inclusive bounds, first match wins).
DEVELOPED = "Developed"
EMERGING = "Emerging"
DEVELOPING = "Developing"
DEVELOPED_MIN_HDI = 0.8
DEVELOPED_MIN_GDP = 20000
EMERGING_MIN_HDI = 0.7
EMERGING_MIN_GDP = 12000


def development_rules(hdi: str = "hdi", gdp: str = "gdp_per_capita") -> list[tuple[Column, str]]:
    h, g = F.col(hdi), F.col(gdp)
    return [
        ((h >= DEVELOPED_MIN_HDI) & (g >= DEVELOPED_MIN_GDP), DEVELOPED),
        ((h >= EMERGING_MIN_HDI) | (g >= EMERGING_MIN_GDP), EMERGING),
    ]


def development_status(df: DataFrame, out: str = "development_status") -> DataFrame:
    """The country preset of ``classify``."""
    return classify(df, out, development_rules(), DEVELOPING)
