"""Files of one top-level JSON array each, read by many tasks (S1 in the reference's layout).

Spark reads such a file with ``multiLine`` in one task. Here it is read as
text lines, which Spark splits, and the records are cut out by structure:

1. Every line becomes a state map: by how much it changes the nesting depth,
   and the places where a record may end, each with the depth it needs at the
   line's start. (A JSON string holds no line end, so no line starts in one.)
2. The depth at the start of each split is a prefix sum over the splits of a
   file, at each line a prefix sum within its split.
3. Lines are cut at the commas of depth one, pieces are joined to records. A
   record that crosses splits is joined from the two or more pieces that are
   the first or last of their split; only those move again.
4. ``from_json`` parses the records.

All steps are DataFrame expressions; a task holds one record, not a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Structure of a line whose escaped characters are blanked: strings, brackets, commas, the rest.
_TOKEN = r'"[^"]*+"?|[\[\]{},]|[^"\[\]{},]++'
#: A line with more tokens is refused: cutting it costs the square of its commas.
LONGEST_LINE = 100_000

_FOLD = """
aggregate(tokens, named_struct('depth', 0, 'at', 1, 'cuts', cast(array() AS array<struct<need:int,at:int>>)),
  (s, t) -> named_struct(
    'depth', s.depth + CASE WHEN t IN ('{', '[') THEN 1 WHEN t IN ('}', ']') THEN -1 ELSE 0 END,
    'at', s.at + length(t),
    'cuts', CASE t WHEN ',' THEN array_append(s.cuts, named_struct('need', 1 - s.depth, 'at', s.at))
                   WHEN '[' THEN array_append(s.cuts, named_struct('need', 0 - s.depth, 'at', s.at))
                   WHEN ']' THEN array_append(s.cuts, named_struct('need', 1 - s.depth, 'at', s.at))
                   ELSE s.cuts END))
"""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, at (order within the block), line and its state map."""
    place = F.col("_metadata")
    lines = spark.read.text(path).select(
        place["file_path"].alias("file"), place["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    ).filter(F.length(F.trim("line")) > 0)
    tokens = F.regexp_extract_all(F.regexp_replace("line", r"\\.", "__"), F.lit(_TOKEN), F.lit(0))
    refused = F.raise_error(F.lit(f"a line of more than {LONGEST_LINE} tokens: read this file with multi_line=True"))
    lines = lines.withColumn("tokens", tokens)
    state = F.when(F.size("tokens") > LONGEST_LINE, refused).otherwise(F.expr(_FOLD))
    lines = lines.select("file", "block", "at", "line", F.inline(F.array(F.struct(state.alias("state")))))
    return lines.select("file", "block", "at", "line", "state.depth", "state.cuts")


def _depths(lines: DataFrame) -> DataFrame:
    """file, block and the depth at the block's start: one row for each split of each file."""
    blocks = lines.groupBy("file", "block").agg(F.sum("depth").alias("depth"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select("file", "block", F.coalesce(F.sum("depth").over(before), F.lit(0)).alias("start"))


def _joined(*order: str) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(*order, "piece")))
    return F.array_join(F.transform(pieces, lambda p: p["piece"]), "\n").alias("piece")


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """The elements of the arrays at ``path`` as JSON text, column ``record``."""
    lines = _lines(spark, path)
    block = Window.partitionBy("file", "block")
    before = block.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # both windows and the grouping of pieces use the same exchange, by split
    start = F.col("start") + F.coalesce(F.sum("depth").over(before), F.lit(0))
    known = lines.join(_depths(lines), ["file", "block"]).withColumn("start", start)
    known = known.withColumn("cuts", F.transform(F.filter("cuts", lambda c: c["need"] == F.col("start")), lambda c: c["at"]))
    number = F.coalesce(F.sum(F.size("cuts")).over(before), F.lit(0))
    known = known.withColumn("number", number).withColumn("cuts_of_block", F.sum(F.size("cuts")).over(block))
    ends = F.concat(F.array(F.lit(0)), F.col("cuts"), F.array(F.length("line") + 1))
    pieces = F.transform(
        F.sequence(F.lit(1), F.size(ends) - 1),
        lambda i: F.expr("line").substr(F.get(ends, i - 1) + 1, F.get(ends, i) - F.get(ends, i - 1) - 1),
    )
    each = known.select("file", "block", "at", "number", "cuts_of_block", F.posexplode(pieces).alias("i", "piece"))
    each = each.withColumn("number", F.col("number") + F.col("i"))
    found = each.groupBy("file", "block", "cuts_of_block", "number").agg(_joined("at"))
    edge = (F.col("number") == 0) | (F.col("number") == F.col("cuts_of_block"))
    # the pieces at the edges of splits, numbered over the file
    edges = found.filter(edge)
    cuts = edges.select("file", "block", "cuts_of_block").distinct()
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cuts.select("file", "block", F.coalesce(F.sum("cuts_of_block").over(earlier), F.lit(0)).alias("offset"))
    across = edges.join(offsets, ["file", "block"]).withColumn("number", F.col("number") + F.col("offset"))
    across = across.groupBy("file", "number").agg(_joined("block"))
    whole = found.filter(~edge).select("piece").union(across.select("piece"))
    return whole.select(F.trim(F.col("piece")).alias("record")).filter(F.col("record").rlike(r"\S"))


def read_array_documents(
    spark: SparkSession, path: str, schema: StructType, *, mode: str = "PERMISSIVE", corrupt_column: str | None = None
) -> DataFrame:
    """The elements of top-level arrays under a declared schema, as the ``multiLine`` reader gives them.

    An element that cannot be parsed is a row of NULLs, with its text in
    ``corrupt_column`` if named; of an array that is cut off, the elements
    before the cut are read.
    """
    if corrupt_column:
        schema = StructType([*schema.fields]).add(corrupt_column, "string")
    options = {"mode": mode, "columnNameOfCorruptRecord": corrupt_column or "_corrupt_record"}
    parsed = array_records(spark, path).select(F.from_json("record", schema, options).alias("doc"))
    return parsed.select("doc.*")
