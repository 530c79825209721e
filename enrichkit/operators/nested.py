"""Flattening of nested documents (P1-P8, P12) and derived columns.

A flatten is declared as an ordered list of ``(output_name, expression)``
pairs and applied as ONE ``select``: Catalyst collapses it with any following
projection, prunes unused nested fields at the scan and keeps it in codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    first_item,
    first_map_key,
    first_map_value,
    fixed_size_item,
    safe_ratio,
)

FlattenSpec = Sequence[tuple[str, Column | str]]


def flatten(df: DataFrame, spec: FlattenSpec) -> DataFrame:
    """Project ``df`` to the flat columns of ``spec`` in order.

    A string expression is a (possibly dotted) column path such as
    ``"name.common"``; a ``Column`` is used as is.
    """
    return df.select(*[(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in spec])


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace several derived columns in one projection."""
    return df.withColumns(dict(exprs))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns ``{old: new}``."""
    return df.withColumnsRenamed(dict(mapping))


def drop(df: DataFrame, *names: str) -> DataFrame:
    """Remove columns; unknown names are ignored (P10)."""
    return df.drop(*names)


def narrow(df: DataFrame, *names: str) -> DataFrame:
    """Keep only the named columns."""
    return df.select(*names)


# --- the country-document preset ------------------------------------------

def country_flatten_spec() -> FlattenSpec:
    """Processed-table columns of the country documents (§1.3), in order.

    Fixed values: the output names and their order equal the reference's
    processed table.
    """
    return [
        ("common_name", "name.common"),
        ("official_name", "name.official"),
        ("country_code_2", "cca2"),
        ("country_code_3", "cca3"),
        ("region", "region"),
        ("subregion", "subregion"),
        ("capital_city", first_item("capital")),
        ("population", "population"),
        ("area", "area"),
        ("latitude", fixed_size_item("latlng", 0, 2)),
        ("longitude", fixed_size_item("latlng", 1, 2)),
        ("currency_code", first_map_key("currencies")),
        ("currency_name", first_map_value("currencies", "name")),
    ]


def flatten_countries(raw: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """Raw country documents -> processed table incl. ``population_density``; ``keep`` names raw columns to carry along."""
    flat = flatten(raw, [*country_flatten_spec(), *[(c, c) for c in keep]])
    return flat.withColumn("population_density", safe_ratio("population", "area"))
