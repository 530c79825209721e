"""Left enrichment join.

``left_enrich`` keeps every left row, attaches the matching right rows
(fan-out on duplicate right keys is kept, as in the reference), and drops
the right key. NULL keys never match (plain ``==``).

Physical strategy
-----------------
* Default: one ``left`` join; Catalyst broadcasts the right side only when
  its estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and
  AQE re-checks it on the real shuffle size, otherwise a sort-merge join on
  the key. AQE's skew handling splits hot LEFT partitions.
* ``skew_threshold``: a key with that many rows on either side is *hot*. A
  sketch finds where to look (a count-min sketch of one row of ``SKETCH``
  counters: keys are hashed into buckets and counted map-side combined, so a
  task sends at most that many rows whatever the number of keys); a bucket
  below the threshold holds no hot key, and mostly none is above. Only the
  keys of the other buckets are counted one by one. The hot list is a written
  DataFrame of any length that Catalyst broadcasts only if it is small.
  ``left_keys`` / ``right_keys`` may give a cheaper DataFrame with the same
  keys as often (for lazy plans), ``hot_sides`` may leave out a side known to
  have no hot key. A hot key becomes a
  grid of cells ``(key, a, b)``: its left rows are dealt over ``a`` and copied
  along ``b``, its right rows are dealt over ``b`` and copied along ``a``, so
  every pair meets in exactly one cell, and no cell takes more than about
  ``skew_threshold`` rows of a side or 100 times that many pairs. Equal rows
  of a hot key are first collapsed into (row, count) and cut into chunks, so
  one row repeated a billion times is split as well. The row itself is
  carried along, never rebuilt, so -0.0, NaN and map entries stay as they
  are. Left rows with a NULL key go around the join without any shuffle.

With a streaming left side only the right side is counted; left rows are
copied along the right side's cells, and NULL-key rows are spread by a hash
of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import DataType

from ..session import scratch_path, shuffle_width


class DuplicateKeyError(ValueError):
    """Raised by ``on_duplicate="error"`` when a right key occurs twice."""


#: Counters of the sketch: what it sends is bounded by this, whatever the keys.
SKETCH = 1 << 16


class _Names:
    """Names of helper columns that begin with what no column of either side begins with."""

    def __init__(self, *frames: DataFrame):
        names = [c.lower() for f in frames for c in f.columns]
        prefix = "__ek_"
        while any(c.startswith(prefix) for c in names):
            prefix += "_"
        for name in ("l", "r", "a", "b", "rep", "key", "hit", "n", "n_l", "n_r", "key_l", "key_r", "cells_l", "cells_r",
                     "chunk_l", "chunk_r", "sig", "row", "i", "times_l", "times_r", "bucket"):
            setattr(self, name, prefix + name)


def _col(name: str, of: str | None = None) -> Column:
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def left_enrich(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    drop_right_key: bool = True,
    on_duplicate: str = "keep",
    skew_threshold: int | None = None,
    hot_sides: tuple[str, ...] = ("left", "right"),
    left_keys: DataFrame | None = None,
    right_keys: DataFrame | None = None,
) -> DataFrame:
    """Left join ``right`` onto ``left`` where ``left[left_key] == right[right_key]``.

    The right key is dropped also when both keys have the same name.
    ``on_duplicate="error"`` refuses a right key that occurs twice (NULL keys
    never match, so they do not count).
    """
    if on_duplicate not in ("keep", "error"):
        raise ValueError("on_duplicate must be 'keep' or 'error'")
    if skew_threshold is not None and skew_threshold < 1:
        raise ValueError("skew_threshold must be >= 1")
    if on_duplicate == "error":
        _fail_on_duplicate_keys(right, right_key)
    kept = [c for c in right.columns if not (drop_right_key and c == right_key)]
    names, hot = _Names(left, right), None
    if skew_threshold is not None:
        of_left = None if left.isStreaming else (left if left_keys is None else left_keys)
        of_right = right if right_keys is None else right_keys
        hot = _hot_keys(of_left, of_right, left_key, right_key, skew_threshold, hot_sides, names)
    if hot is not None:
        return _grid_join(left, right, left_key, right_key, kept, hot, names)
    joined = left.alias(names.l).join(
        right.alias(names.r), _col(left_key, names.l) == _col(right_key, names.r), "left"
    )
    return joined.select(f"{names.l}.*", *[_col(c, names.r) for c in kept])


def _fail_on_duplicate_keys(right: DataFrame, key: str) -> None:
    keys = right.filter(_col(key).isNotNull()).select(_col(key).alias("key"))
    dup = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"right key {key!r} is not unique, e.g. {dup[0][0]!r}")


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SKETCH))


def _hashes_like_it_compares(left: DataType, right: DataType) -> bool:
    """Whether equal keys of the two types surely have equal hashes."""
    plain = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DateType, T.BooleanType, T.TimestampType, T.BinaryType)
    return left == right and (isinstance(left, plain) or left == T.StringType())


def _hot_keys(
    left: DataFrame | None,
    right: DataFrame,
    left_key: str,
    right_key: str,
    threshold: int,
    sides: tuple[str, ...],
    x: _Names,
) -> DataFrame | None:
    """(key, cells_l, cells_r, chunk_l, chunk_r) of the hot keys, or None without any."""
    spark, t, one = right.sparkSession, F.lit(threshold), F.lit(1)
    keys = {"right": right.filter(_col(right_key).isNotNull()).select(_col(right_key).alias(x.key))}
    if left is not None:
        keys["left"] = left.filter(_col(left_key).isNotNull()).select(_col(left_key).alias(x.key))
    looked = [keys[s] for s in sides if s in keys]
    if not looked:
        return None
    if left is None or _hashes_like_it_compares(left.schema[left_key].dataType, right.schema[right_key].dataType):
        counted = [k.groupBy(_bucket(F.col(x.key)).alias(x.bucket)).agg(F.count(one).alias(x.n)) for k in looked]
        full = counted[0] if len(counted) == 1 else counted[0].union(counted[1])
        buckets = [r[0] for r in full.filter(F.col(x.n) >= t).select(x.bucket).distinct().collect()]  # at most SKETCH
        if not buckets:
            return None
        wanted = F.broadcast(spark.createDataFrame([(b,) for b in buckets], f"{x.bucket} long"))
        keys = {s: k.join(wanted, _bucket(F.col(x.key)) == F.col(x.bucket), "left_semi") for s, k in keys.items()}
    counts = keys["right"].groupBy(F.col(x.key).alias(x.key_r)).agg(F.count(one).alias(x.n_r))
    if left is None:
        counts = counts.select(F.col(x.key_r).alias(x.key), x.n_r, one.cast("long").alias(x.n_l))
    else:
        own = keys["left"].groupBy(F.col(x.key).alias(x.key_l)).agg(F.count(one).alias(x.n_l))
        counts = counts.join(own, F.col(x.key_r) == F.col(x.key_l), "full").select(
            F.coalesce(x.key_r, x.key_l).alias(x.key),
            F.coalesce(x.n_r, F.lit(0)).alias(x.n_r),
            F.coalesce(x.n_l, F.lit(0)).alias(x.n_l),
        )
    up = lambda n, d: F.ceil(n / d).cast("long")
    n_l, n_r = F.col(x.n_l), F.col(x.n_r)
    cells_r = F.greatest(up(n_r, t), one.cast("long"))
    # enough left cells that no cell has more than 100 thresholds of pairs
    cells_l = F.greatest(up(n_l, t), up(n_l.cast("double") * n_r, F.col(x.cells_r) * t * 100))
    hot = (
        counts.filter((n_r >= t) | (n_l >= t))
        .withColumn(x.cells_r, cells_r)
        .withColumn(x.cells_l, F.greatest(one.cast("long"), F.least(n_l, cells_l)))
        .select(
            x.key, x.cells_l, x.cells_r,
            up(n_l, F.col(x.cells_l)).alias(x.chunk_l), up(n_r, F.col(x.cells_r)).alias(x.chunk_r),
        )
    )
    path = scratch_path(spark, "hot_keys")
    hot.write.parquet(path)
    stored = spark.read.schema(hot.schema).parquet(path)
    return None if stored.isEmpty() else stored


def _signature(df: DataFrame) -> Column:
    """A digest that two rows share only if they are equal bit for bit (JSON keeps -0.0 and entry order)."""
    exact = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    named = [_col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]
    return F.sha2(F.to_json(F.struct(*named), exact).cast("binary"), 256)


def _dealt(df: DataFrame, key: str, hot: DataFrame, side: str, x: _Names) -> DataFrame:
    """Rows with their cell: dealt along the own axis, copied along the other one."""
    own, other, chunk = (x.cells_l, x.cells_r, x.chunk_l) if side == "l" else (x.cells_r, x.cells_l, x.chunk_r)
    axis, across = (x.a, x.b) if side == "l" else (x.b, x.a)
    columns = [_col(c) for c in df.columns]
    one = F.lit(1).cast("long")
    keyed = df.join(hot, _col(key) == F.col(x.key), "left").drop(x.key)
    if df.isStreaming:
        spread = F.pmod(F.xxhash64(_signature(df)), F.lit(shuffle_width(df.sparkSession)))
        rows = keyed.select(
            *columns, other, one.alias(x.rep), F.when(_col(key).isNull(), spread).otherwise(F.lit(0)).alias(axis)
        )
    else:
        single = F.coalesce(F.col(own), one) == 1
        cold = keyed.filter(single).select(*columns, other, one.alias(x.rep), F.lit(0).cast("long").alias(axis))
        collapsed = (
            keyed.filter(~single)
            .groupBy(_signature(df).alias(x.sig), own, other, chunk)
            .agg(F.first(F.struct(*columns)).alias(x.row), F.count(F.lit(1)).alias(x.n))
        )
        chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"({x.n} - 1) div {chunk}"))
        split = collapsed.select("*", F.explode(chunks).alias(x.i)).select(
            f"{x.row}.*",
            other,
            F.least(F.col(chunk), F.col(x.n) - F.col(x.i) * F.col(chunk)).alias(x.rep),
            F.pmod(F.xxhash64(x.sig, x.i), F.col(own)).alias(axis),
        )
        rows = cold.unionByName(split)
    cells = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(other), one) - 1)
    return rows.select("*", F.explode(cells).alias(across))


def _grid_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, kept: list[str], hot: DataFrame, x: _Names
) -> DataFrame:
    width = shuffle_width(right.sparkSession)
    with_key = left if left.isStreaming else left.filter(_col(left_key).isNotNull())
    # both sides at one fixed width, so the hot cells come from many tasks
    # even if AQE broadcasts one side
    lh = _dealt(with_key, left_key, hot, "l", x).repartition(width, _col(left_key), x.a, x.b).alias(x.l)
    rh = (
        _dealt(right.filter(_col(right_key).isNotNull()), right_key, hot, "r", x)
        .withColumn(x.hit, F.lit(True))
        .repartition(width, _col(right_key), x.a, x.b)
        .alias(x.r)
    )
    joined = lh.join(
        rh,
        (_col(left_key, x.l) == _col(right_key, x.r))
        & (_col(x.a, x.l) == _col(x.a, x.r))
        & (_col(x.b, x.l) == _col(x.b, x.r)),
        "left",
    )
    # a key of several right cells has right rows; a cell without any is no miss
    one = F.lit(1).cast("long")
    real = _col(x.hit, x.r).isNotNull() | (F.coalesce(_col(x.cells_r, x.l), one) == 1)
    out = joined.filter(real).select(
        *[_col(c, x.l) for c in left.columns],
        *[_col(c, x.r) for c in kept],
        _col(x.rep, x.l).alias(x.times_l),
        F.coalesce(_col(x.rep, x.r), one).alias(x.times_r),
    )
    times = F.col(x.times_l) * F.col(x.times_r)
    out = out.withColumn(x.i, F.explode(F.sequence(one, times))).drop(x.i, x.times_l, x.times_r)
    if left.isStreaming:
        return out
    types = {f.name: f.dataType for f in right.schema.fields}
    without = left.filter(_col(left_key).isNull()).select(
        *[_col(c) for c in left.columns], *[F.lit(None).cast(types[c]).alias(c) for c in kept]
    )
    return out.union(without)
