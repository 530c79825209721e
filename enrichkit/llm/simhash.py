"""Operator 3, SimHash near-duplicates by a binary trie self-join.

Fingerprints: the 64-bit majority of the XXH64 hashes of all word shingles
(one map pass, nothing but ``(id, fingerprint)`` leaves it). Equal
fingerprints collapse to one row before anything else, so groups of copies
never meet in a pair.

Join: the distinct fingerprints form a binary trie. The trie is joined with
itself by walking pairs of nodes from the root; each pair carries the number
of bits in which its two prefixes differ and is dropped as soon as that
exceeds the error budget. Two fingerprints with at most ``k`` differing bits
have at most ``k // 2`` of them in the first or in the second half, so the
walk runs twice, once with the halves swapped, each time with the budget
``k // 2`` down to the middle and ``k`` below it. That keeps the set of live
node pairs near the number of fingerprints.

The walk is split at *cut nodes*: trie nodes holding at most ``leaf_rows``
fingerprints whose parent holds more. Node pairs above the cut are walked
with DataFrame joins of the (small) node table, one step per ``STEP`` bits;
every surviving pair of cut nodes is one bounded task that walks its two
subtrees with vectorised prefix splits. A hot prefix is simply cut deeper, so
no task holds more than ``2 * leaf_rows`` fingerprints and none are left out.
A task does not emit all links: it merges them into local components and
emits one edge per fingerprint and component.

Components: minimum labels flow along the edges with pointer jumping; each
round is a written table and the rounds end when no label changes.

Defined cases: null or empty text and text without words have fingerprint
zero, which links like any other. Null ids take part; a component's id is the
smallest non-null doc id in it (null when it has none). Repeated rows stay
rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import arrow_pass, utf8, written
from .components import components

#: Bits per DataFrame step of the walk above the cut nodes.
STEP = 4
#: Pairs of fingerprints compared at once inside a task (bounds its memory).
CHUNK = 1 << 20
_LANES = np.uint64(0x0101010101010101)


def text_fingerprint(data: bytes, shingle: int) -> int:
    """SimHash of one text: words split at ASCII white space, A-Z lowered."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[j:] for j in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((xxh64_intdigest(s, 42) for s in shingles), dtype=np.uint64, count=n)
    counts = np.zeros((8, 8), dtype=np.int64)
    for start in range(0, n, 255):  # byte lanes count to 255 without overflow
        part = hashes[start : start + 255]
        for b in range(8):
            lanes = ((part >> np.uint64(b)) & _LANES).sum(dtype=np.uint64)
            counts[b] += np.frombuffer(lanes.tobytes(), dtype=np.uint8)
    majority = counts.T.reshape(-1) * 2 > n  # bit 8 * byte + b
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, keep: list[str] | None = None, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``row`` and ``out.fp`` (the fingerprint as a signed long) per document."""

    def make():
        def run(texts: pa.Array) -> list:
            fps = np.array([text_fingerprint(t, shingle) for t in utf8(texts)], dtype=np.uint64)
            return [pa.array(fps.view(np.int64))]

        return run

    return arrow_pass(docs, keep or docs.columns, text_col, make, "fp long")


def _prefix(fp: Column, bits: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - bits) if bits else F.lit(0).cast("long")


def _walk(a: np.ndarray, b: np.ndarray, same: bool, budgets: list[int]):
    """Node pairs of two subtrees, walked together; yields index pairs in the budget.

    ``a`` and ``b`` are sorted uint64; a node is a range that shares a prefix.
    ``budgets[i]`` is the budget for the first ``i + 1`` bits.
    """
    stack = [(0, np.array([[0, len(a), 0, len(b), 0]], dtype=np.int64))]
    while stack:
        depth, pairs = stack.pop()
        size = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        small = (size <= 64) | (depth == 64)
        if small.any():
            yield from _compare(a, b, pairs[small], same, budgets[-1])
            pairs = pairs[~small]
        if not len(pairs):
            continue
        if len(pairs) > CHUNK // 4:
            half = len(pairs) // 2
            stack += [(depth, pairs[:half]), (depth, pairs[half:])]
            continue
        bit = np.uint64(63 - depth)
        mid_a = _split(a, pairs[:, 0], pairs[:, 1], bit)
        mid_b = _split(b, pairs[:, 2], pairs[:, 3], bit)
        parts = []
        for side_a in (0, 1):
            for side_b in (0, 1):
                lo_a, hi_a = (pairs[:, 0], mid_a) if side_a == 0 else (mid_a, pairs[:, 1])
                lo_b, hi_b = (pairs[:, 2], mid_b) if side_b == 0 else (mid_b, pairs[:, 3])
                diff = pairs[:, 4] + (side_a != side_b)
                live = (lo_a < hi_a) & (lo_b < hi_b) & (diff <= budgets[depth])
                if same:
                    live &= lo_a <= lo_b  # each unordered node pair once
                parts.append(np.stack([lo_a, hi_a, lo_b, hi_b, diff], axis=1)[live])
        nxt = np.concatenate(parts)
        if len(nxt):
            stack.append((depth + 1, nxt))


def _split(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """First index in each range [lo, hi) whose ``bit`` is set (ranges share the bits above)."""
    first = x[lo]
    target = (first >> bit | np.uint64(1)) << bit
    return np.clip(np.searchsorted(x, target), lo, hi)


def _compare(a, b, pairs, same, budget):
    """All fingerprint pairs of small or bottom node pairs, in bounded chunks."""
    n_a, n_b = pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2]
    size = n_a * n_b
    start = 0
    ends = np.cumsum(size)
    while start < len(pairs):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
        p, s, nb = pairs[start:stop], size[start:stop], n_b[start:stop]
        which = np.repeat(np.arange(len(p)), s)
        k = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
        i, j = p[which, 0] + k // nb[which], p[which, 2] + k % nb[which]
        ok = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            ok &= i < j
        yield i[ok], j[ok]
        start = stop


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give both ends of every link the smaller label until nothing changes."""
    while True:
        li, lj = label[i], label[j]
        open_ = li != lj
        if not open_.any():
            return
        i, j, li, lj = i[open_], j[open_], li[open_], lj[open_]
        np.minimum.at(label, np.maximum(li, lj), np.minimum(li, lj))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def local_edges(a: np.ndarray, b: np.ndarray | None, budgets: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what the links between (or within) two node sets connect."""
    same = b is None
    both = a if same else np.concatenate([a, b])
    offset = 0 if same else len(a)
    label = np.arange(len(both))
    for i, j in _walk(a, a if same else b, same, budgets):
        if len(i):
            _merge(label, i, j + offset)
    moved = np.flatnonzero(label != np.arange(len(both)))
    return both[moved], both[label[moved]]


def _budgets(k: int) -> list[int]:
    return [k // 2] * 32 + [k] * 32


def _cut(keys: DataFrame, leaf_rows: int) -> tuple[list[DataFrame], list[int]]:
    """Node tables (prefix, leaf) by level, each only below the large nodes of the level above."""
    levels, bits = [], []
    above = None
    for b in range(STEP, 65, STEP):
        nodes = keys.select(_prefix(F.col("key"), b).alias("prefix"))
        if above is not None:
            nodes = nodes.join(above, _up("prefix") == F.col("above"), "left_semi")
        counted = nodes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
        leaf = F.lit(True) if b == 64 else F.col("n") <= leaf_rows
        level = written(counted.select("prefix", leaf.alias("leaf")), f"trie-{b}")
        levels.append(level)
        bits.append(b)
        large = level.filter(~F.col("leaf"))
        if large.isEmpty():
            break
        above = large.select(F.col("prefix").alias("above"))
    return levels, bits


def _up(name: str) -> Column:
    return F.shiftrightunsigned(name, STEP)


def _node_pairs(levels: list[DataFrame], bits: list[int], budgets: list[int]) -> DataFrame:
    """Pairs of cut nodes whose common prefix stays in the budget.

    Both sides of a pair go down one level together; a side that has reached
    its cut node stays there while the other goes on.
    """
    spark = levels[0].sparkSession
    node = "struct<bits:int,prefix:bigint,leaf:boolean>"
    top = sorted((bits[0], r["prefix"], r["leaf"]) for r in levels[0].collect())  # at most 2 ** STEP nodes
    first = [(x, y) for i, x in enumerate(top) for y in top[i:] if (x[1] ^ y[1]).bit_count() <= budgets[0]]
    pairs = spark.createDataFrame(first, f"a {node}, b {node}")
    closed = [pairs.filter("a.leaf and b.leaf")]
    open_ = pairs.filter("not (a.leaf and b.leaf)")
    for level, b in zip(levels[1:], bits[1:], strict=True):
        children = level.select(
            _up("prefix").alias("parent"),
            F.struct(F.lit(b).alias("bits"), "prefix", "leaf").cast(node).alias("node"),
        )
        spread = -1 - F.pmod(F.xxhash64("a", "b"), F.lit(1 << 20))  # matches no parent, meets in no one task

        def down(pairs: DataFrame, side: str, children: DataFrame = children, spread: Column = spread) -> DataFrame:
            key = F.when(F.col(f"{side}.leaf"), spread).otherwise(F.col(f"{side}.prefix"))
            step = children.select(F.col("parent").alias(f"{side}_parent"), F.col("node").alias(f"{side}_node"))
            return pairs.withColumn(f"{side}_key", key).join(step, F.col(f"{side}_key") == F.col(f"{side}_parent"), "left")

        walked = down(down(open_, "a"), "b").select(
            (F.col("a") == F.col("b")).alias("same"),
            F.coalesce("a_node", "a").alias("a"),
            F.coalesce("b_node", "b").alias("b"),
        )
        common = F.least("a.bits", "b.bits")
        differ = F.bit_count(
            F.expr("shiftrightunsigned(a.prefix, a.bits - least(a.bits, b.bits))").bitwiseXOR(
                F.expr("shiftrightunsigned(b.prefix, b.bits - least(a.bits, b.bits))")
            )
        )
        walked = walked.filter(
            (~F.col("same") | (F.col("a.prefix") <= F.col("b.prefix")))
            & (differ <= F.when(common <= 32, budgets[0]).otherwise(budgets[-1]))
        ).select("a", "b")
        walked = written(walked, f"trie-pairs-{b}")
        closed.append(walked.filter("a.leaf and b.leaf"))
        open_ = walked.filter("not (a.leaf and b.leaf)")
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out


def _edges(fps: DataFrame, rotate: bool, budgets: list[int], leaf_rows: int) -> DataFrame:
    """Edges (u, v) of fingerprints that link within ``budgets``, halves swapped or not."""
    turn = _rotated if rotate else (lambda c: c)
    keys = fps.select(turn(F.col("fp")).alias("key"))
    levels, bits = _cut(keys, leaf_rows)
    pairs = _node_pairs(levels, bits, budgets)
    at = lambda side: F.struct(F.col(f"{side}.bits"), F.col(f"{side}.prefix"))
    roles = pairs.select(
        F.struct(
            F.col("a.bits").alias("a_bits"),
            F.col("a.prefix").alias("a_prefix"),
            F.col("b.bits").alias("b_bits"),
            F.col("b.prefix").alias("b_prefix"),
        ).alias("t"),
        F.explode(
            F.when(at("a") == at("b"), F.array(F.struct(at("a").alias("node"), F.lit(2).alias("side")))).otherwise(
                F.array(
                    F.struct(at("a").alias("node"), F.lit(0).alias("side")),
                    F.struct(at("b").alias("node"), F.lit(1).alias("side")),
                )
            )
        ).alias("r"),
    ).select("t", F.col("r.node.bits").alias("bits"), F.col("r.node.prefix").alias("prefix"), "r.side")
    own = None
    for level, b in zip(levels, bits, strict=True):
        part = keys.select("key", F.lit(b).alias("bits"), _prefix(F.col("key"), b).alias("prefix"))
        part = part.join(level.filter("leaf").select("prefix"), "prefix", "left_semi")
        own = part if own is None else own.unionByName(part)
    dealt = own.join(roles, ["bits", "prefix"]).select("t", "side", "key")

    def link(table: pa.Table) -> pa.Table:
        us, vs = [], []
        side = table.column("side").to_numpy()
        keys_ = table.column("key").to_numpy().astype(np.int64).view(np.uint64)
        whole, a, b = (np.sort(keys_[side == s]) for s in (2, 0, 1))
        for x, y in ((whole, None), (a, b)):
            if len(x) and (y is None or len(y)):
                u, v = local_edges(x, y, budgets)
                us.append(u)
                vs.append(v)
        cat = lambda xs: pa.array(np.concatenate(xs).view(np.int64) if xs else np.empty(0, np.int64))
        return pa.table({"u": cat(us), "v": cat(vs)})

    found = dealt.groupBy("t").applyInArrow(link, "u long, v long")
    return found.select(turn(F.col("u")).alias("u"), turn(F.col("v")).alias("v"))


def _rotated(fp: Column) -> Column:
    return F.shiftleft(fp, 32).bitwiseOR(F.shiftrightunsigned(fp, 32))


def clusters(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    keep: list[str] | None = None,
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
    leaf_rows: int = 1024,
) -> DataFrame:
    """``row``, ``id``, ``fp``, ``cluster`` and ``component_id`` per document.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits, the row's own included; ``cluster`` names
    the component by its smallest fingerprint.
    """
    keep = list(dict.fromkeys([*(keep or docs.columns), id_col]))
    rows = fingerprints(docs, keep=keep, text_col=text_col, shingle=shingle)
    rows = written(rows.select("row", F.col("row")[id_col].alias("id"), "out.fp"), "simhash-rows")
    return _with_components(rows, max_bits, leaf_rows)


def _with_components(rows: DataFrame, max_bits: int, leaf_rows: int) -> DataFrame:
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-fps")
    budgets = _budgets(max_bits)
    edges = _edges(fps, False, budgets, leaf_rows).unionByName(_edges(fps, True, budgets, leaf_rows))
    member = components(edges)  # node, component: linked fingerprints only
    tagged = written(
        fps.join(member, fps["fp"] == member["node"], "left").select(
            "fp", "first_id", F.coalesce("component", "fp").alias("component")
        ),
        "simhash-members",
    )
    least = tagged.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = tagged.join(least, "component").select(
        F.col("fp").alias("fp_of"), F.col("component").alias("cluster"), "component_id"
    )
    return rows.join(ids, F.col("fp") == F.col("fp_of"), "left").drop("fp_of")


def one_of_each(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
    leaf_rows: int = 1024,
) -> DataFrame:
    """The documents, one of each component, with all their columns.

    The row with the component's smallest id stays; of several rows with that
    id (or of a component without ids) the one with the smallest row number.
    """
    rows = fingerprints(docs, text_col=text_col, shingle=shingle)
    rows = written(rows.select(F.monotonically_increasing_id().alias("n"), "row", "out.fp"), "simhash-docs")
    found = _with_components(rows.select("n", F.col("row")[id_col].alias("id"), "fp"), max_bits, leaf_rows)
    pick = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "n"))
    stays = found.groupBy("cluster").agg(pick.alias("p")).select(F.col("p.n").alias("stays"))
    return rows.join(stays, F.col("n") == F.col("stays"), "left_semi").select("row.*")
