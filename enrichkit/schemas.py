"""Declared schemas of the country data (actual output types, §1.3/§1.4)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


# Field names and types of the raw documents and of the
# indicator table must equal the reference's, so stored tables line up.


def raw_country_schema() -> StructType:
    """Nested country document as read from JSON."""
    return StructType(
        [
            StructField(
                "name",
                StructType(
                    [
                        StructField("common", StringType(), True),
                        StructField("official", StringType(), True),
                    ]
                ),
                True,
            ),
            StructField("cca2", StringType(), True),
            StructField("cca3", StringType(), True),
            StructField("capital", ArrayType(StringType(), True), True),
            StructField("region", StringType(), True),
            StructField("subregion", StringType(), True),
            StructField("area", DoubleType(), True),
            StructField("population", LongType(), True),
            StructField("latlng", ArrayType(DoubleType(), True), True),
            StructField(
                "currencies",
                MapType(
                    StringType(),
                    StructType(
                        [
                            StructField("name", StringType(), True),
                            StructField("symbol", StringType(), True),
                        ]
                    ),
                    True,
                ),
                True,
            ),
        ]
    )


def economic_schema() -> StructType:
    """Indicator table: the key is NOT NULL."""
    return StructType(
        [
            StructField("country_code_3_econ", StringType(), False),
            StructField("gdp_per_capita", DoubleType(), True),
            StructField("hdi", DoubleType(), True),
        ]
    )


def prune_schema(schema: StructType, fields: list[str] | tuple[str, ...]) -> StructType:
    """Keep only the named top-level fields, in schema order (S3)."""
    wanted = set(fields)
    missing = wanted - set(schema.fieldNames())
    if missing:
        raise ValueError(f"fields not in schema: {sorted(missing)}")
    return StructType([f for f in schema.fields if f.name in wanted])
