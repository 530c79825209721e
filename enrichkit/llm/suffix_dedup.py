"""Operator 11: repeated byte strings go, found in corpus order by prefix-free parsing.

Every ``WINDOW``-byte string (a window) that starts earlier as well, in a
smaller id or earlier in the same text, loses its bytes.

Method. A rolling hash of ``MARK`` bytes puts triggers into the texts: the
trigger of a window is the least hash among its first ``REACH`` positions, so
equal windows have equal triggers at equal places wherever they stand, and no
window is without one. The consecutive windows that share a trigger are a
phrase occurrence: at most ``REACH`` windows, about 30 on prose.

1. Dictionary. A phrase occurrence is sent, as hashes, to the block of the
   bytes that all windows of its trigger have in common (its root). One whose
   root stands nowhere else holds nothing repeated. Of occurrences with equal
   bytes the earliest stays, the others lose all their windows at once.
2. Suffix arrays. Where a root has several distinct phrases, only parts of
   them repeat. Their bytes meet in the root's block. There the dictionary is
   sorted by its suffixes (left parts, read from the trigger backwards) and
   the parse by what follows (right parts, read forwards). A window is a left
   part of o bytes and a right part of ``WINDOW`` - o bytes, so in corpus order
   equal windows are one interval of either array; the earliest of them stays.
3. A text gets its removed windows and drops the bytes they cover.

Skew. A task keeps of equal phrases its earliest one, and sends at most
``MANY`` phrases of a root; so a passage held by a third of all texts arrives
once a task, not once a text. A root with more distinct phrases than
``MANY`` in a task or ``HOT`` in all (the edges of such a passage) is not
brought together: its windows are compared one by one, again the earliest of
each task only. No path drops a case.

Defined cases. A null text is empty. A text shorter than ``WINDOW`` bytes keeps
all its bytes. Null ids come last. Rows that share an id count as one document:
their windows compare by their starts, and windows with equal id and start (as
in repeated rows) stay in each row. Long texts are parsed in pieces of some
megabytes. ``id`` is an integer column. Phrases compare by hashes of 64 bits
beside the root's, single windows by 128 bits, windows of one block by their
bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import shuffle_width
from ._common import ROWS_AT_ONCE, col, written

WINDOW = 100
MARK = 8
REACH = 64
MANY = 64
HOT = 4096
#: Bytes parsed at once; positions in a piece fit the low bits of a key.
PIECE = 1 << 22
POSITION = np.uint64((1 << 23) - 1)
#: Phrases a task gathers before it sends them.
AT_ONCE = 1 << 21
LAST = np.iinfo(np.int64).max

#: What becomes of a phrase occurrence.
ASK, GONE, PART, SINGLE, OVER = range(5)
RECORD = np.dtype([("root", "<u8"), ("body", "<u8"), ("id", "<i8"), ("crc", "<u4"), ("start", "<i4"), ("n", "u1"), ("kind", "u1")])
NOTE = "id long, crc long, start int, n int, kind int"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x


def _hash(words: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    """64-bit hashes of the ``size`` (8 or more) bytes that begin at each place."""
    found = np.full(len(at), seed, np.uint64)
    for step in [*range(0, size - 8, 8), size - 8]:
        found ^= _mix(words[at + step])
        found *= np.uint64(0xD6E8FEB86659FD93)
        found ^= found >> np.uint64(29)
    return found


def _words(buffer: bytes) -> np.ndarray:
    """The eight bytes from every place as a number; ``buffer`` ends in spare bytes."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))


def _marks(words: np.ndarray) -> np.ndarray:
    return _mix(_mix(words) * np.uint64(0xBF58476D1CE4E5B9))


def _body(words: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hashes of the bytes that ``n`` consecutive windows cover."""
    last = first + n.astype(np.int64) - 1
    found = _hash(words, first, WINDOW, 11) * np.uint64(0xBF58476D1CE4E5B9)
    return _mix(found ^ _hash(words, last, WINDOW, 12) ^ n.astype(np.uint64))


def _parse(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrase occurrences of the texts at [start, end): first window, windows, root and body hash."""
    words = _words(buffer)
    key = _marks(words)
    key &= ~POSITION
    key |= np.arange(len(key), dtype=np.uint64)
    step = 1
    while step < REACH:  # the least of a run of 2, 4, ... REACH places
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    full = ends - starts >= WINDOW
    edge = np.zeros(len(key) + 1, np.int8)
    np.add.at(edge, starts[full], 1)
    np.add.at(edge, ends[full] - WINDOW + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:-1]))
    owner = (key[at] & POSITION).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    trigger, first = owner[first], at[first]
    return first, n, _hash(words, trigger, WINDOW - REACH + 1, 10), _body(words, first, n)


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Texts, or parts of long ones, put together to some megabytes: (index, offset in the text, place)."""
    parts, held, size = [], [], 0
    for i, text in enumerate(texts):
        for base in range(0, max(1, len(text) - WINDOW + 1), PIECE):
            part = text[base : base + PIECE + WINDOW - 1]
            if size + len(part) > PIECE + WINDOW and parts:
                yield b"".join(parts) + bytes(128), held
                parts, held, size = [], [], 0
            held.append((i, base, size))
            parts.append(part)
            size += len(part)
    if parts:
        yield b"".join(parts) + bytes(128), held


def _occurrences(ids: np.ndarray, texts: list[bytes]) -> Iterator[np.ndarray]:
    for buffer, held in _pieces(texts):
        index, base, place = (np.array(x, np.int64) for x in zip(*held, strict=True))
        ends = np.append(place[1:], len(buffer) - 128)
        first, n, root, body = _parse(buffer, place, ends)
        part = np.searchsorted(place, first, side="right") - 1
        crc = np.array([zlib.crc32(texts[i]) for i in index.tolist()], np.uint32)
        found = np.empty(len(first), RECORD)
        found["root"], found["body"], found["n"], found["kind"] = root, body, n, ASK
        found["id"], found["crc"] = ids[index][part], crc[part]
        found["start"] = first - place[part] + base[part]
        yield found


def _settled(found: np.ndarray, hot: int) -> np.ndarray:
    """``found`` sorted by root, body and place, with what can be told of each from these alone.

    Of equal bodies the earliest keeps its kind; later ones are GONE. Roots
    with more than one body make their earliest ones PART, or SINGLE beyond
    ``hot`` bodies or where a task has sent only some of them.
    """
    found = found[np.lexsort((found["start"], found["id"], found["body"], found["root"]))]
    root, body = found["root"], found["body"]
    new_root = np.ones(len(found), bool)
    new_root[1:] = root[1:] != root[:-1]
    new_body = new_root.copy()
    new_body[1:] |= body[1:] != body[:-1]
    group = np.cumsum(new_root) - 1
    lead = np.flatnonzero(new_body)[np.cumsum(new_body) - 1]
    later = (found["id"] != found["id"][lead]) | (found["start"] != found["start"][lead])
    bodies = np.bincount(group, new_body)[group]
    over = np.bincount(group, found["kind"] == OVER)[group] > 0
    found["kind"] = np.where(later, GONE, np.where(over | (bodies > hot), SINGLE, np.where(bodies > 1, PART, found["kind"])))
    return found


def _first_rows(found: np.ndarray) -> np.ndarray:
    """Whether a row is the first of equal root, body, id and start (repeated rows of a table)."""
    new = np.ones(len(found), bool)
    for name in ("root", "body", "id", "crc", "start"):
        if name == "root":
            new[1:] = found[name][1:] != found[name][:-1]
        else:
            new[1:] |= found[name][1:] != found[name][:-1]
    return new


def _batches(found: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """What a task sends: later ones as GONE, the earliest of each body as a question, once a root if too many."""
    found = _settled(found, MANY)
    found = found[_first_rows(found)]
    kind = found["kind"]
    asks = kind == PART  # several bodies here; others may be elsewhere
    found["kind"][asks] = ASK
    single = kind == SINGLE
    root = found["root"]
    lead = single & np.append(True, root[1:] != root[:-1])
    told = found[lead].copy()
    told["kind"] = OVER
    found = np.concatenate([found, told])
    # what is settled needs no root's block and is spread evenly
    asks = (found["kind"] == ASK) | (found["kind"] == OVER)
    spread = found["crc"].astype(np.uint64) + found["start"].astype(np.uint64)
    block = (np.where(asks, found["root"], spread) % np.uint64(blocks)).astype(np.int32)
    order = np.argsort(block, kind="stable")
    found, block = found[order], block[order]
    edges = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.array([], int)
    blobs = [_packed(x) for x in np.split(found, edges[1:])] if len(edges) else []
    for i in range(0, len(blobs), 256):
        yield pa.RecordBatch.from_arrays(
            [pa.array(block[edges[i : i + 256]], pa.int32()), pa.array(blobs[i : i + 256], pa.binary())],
            names=["block", "records"],
        )


def _packed(found: np.ndarray) -> bytes:
    """Column by column; ids in four bytes where they fit."""
    small = len(found) and found["id"].min() >= 0 and found["id"].max() < 1 << 32
    parts = [b"S" if small else b"L", len(found).to_bytes(8, "little")]
    for name in RECORD.names:
        parts.append(found[name].astype("<u4" if small and name == "id" else RECORD[name]).tobytes())
    return b"".join(parts)


def _unpacked(blob: bytes) -> np.ndarray:
    found = np.empty(int.from_bytes(blob[1:9], "little"), RECORD)
    at = 9
    for name in RECORD.names:
        kind = np.dtype("<u4") if blob[:1] == b"S" and name == "id" else RECORD[name]
        found[name] = np.frombuffer(blob, kind, len(found), at)
        at += kind.itemsize * len(found)
    return found


def _notes(ids, crc, start, n, kind) -> pa.Table:
    return pa.table({
        "id": pa.array(ids, pa.int64()), "crc": pa.array(crc.astype(np.int64), pa.int64()),
        "start": pa.array(start.astype(np.int32), pa.int32()), "n": pa.array(n.astype(np.int32), pa.int32()),
        "kind": pa.array(kind.astype(np.int32), pa.int32()),
    })


def _resolve(key: tuple, rows: pa.Table) -> pa.Table:
    """The phrases of one block of roots from all tasks: notes about those with repeated windows."""
    found = np.concatenate([_unpacked(x.as_py()) for x in rows.column("records")])
    asks = (found["kind"] == ASK) | (found["kind"] == OVER)
    asked = _settled(found[asks], HOT)
    asked = asked[_first_rows(asked) & (asked["kind"] != ASK)]
    told = np.concatenate([found[~asks], asked])
    return _notes(told["id"], told["crc"], told["start"], told["n"], told["kind"])


def _records(df: DataFrame, make, blocks: int) -> DataFrame:
    """(block, records) of what ``make`` finds in the rows, a task's equal phrases settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                for found in make(whole.slice(at, ROWS_AT_ONCE)):
                    held.append(found)
                    size += len(found)
                    if size >= AT_ONCE:
                        yield from _batches(np.concatenate(held), blocks)
                        held, size = [], 0
        if size:
            yield from _batches(np.concatenate(held), blocks)

    return df.mapInArrow(run, "block int, records binary")


def _phrases(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    ids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
    yield from _occurrences(ids, batch.column(1).to_pylist())


def _single_windows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The windows of phrases, one by one."""
    ids, crc, start, n = (batch.column(i).to_numpy() for i in range(4))
    for at in range(0, len(ids), 4096):
        part = slice(at, at + 4096)
        texts = batch.column(4)[part].to_pylist()
        words = _words(b"".join(texts) + bytes(8))
        size = np.array([len(x) for x in texts], np.int64)
        place = np.cumsum(size) - size
        of = np.repeat(np.arange(len(texts)), n[part])
        step = np.arange(len(of)) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
        where = place[of] + step
        found = np.empty(len(of), RECORD)
        found["root"], found["body"] = _hash(words, where, WINDOW, 20), _hash(words, where, WINDOW, 21)
        found["id"], found["crc"], found["start"] = ids[part][of], crc[part][of], start[part][of] + step
        found["n"], found["kind"] = 1, ASK
        yield found


def _in_corpus_order(key: tuple, rows: pa.Table) -> pa.Table:
    """Windows of a block's phrases that stand earlier in it, by suffix arrays of dictionary and parse."""
    ids, start, n = (rows.column(x).to_numpy() for x in ("id", "start", "n"))
    crc, trigger = rows.column("crc").to_numpy(), rows.column("trigger").to_numpy().astype(np.int64)
    texts = rows.column("bytes").to_pylist()
    m = len(texts)
    left = np.frombuffer(b"".join(x[a + MARK - 1 :: -1].ljust(REACH + MARK, b"\0")[: REACH + MARK] for x, a in zip(texts, trigger.tolist(), strict=True)), np.uint8).reshape(m, -1)
    right = np.frombuffer(b"".join(x[a : a + WINDOW].ljust(WINDOW, b"\0") for x, a in zip(texts, trigger.tolist(), strict=True)), np.uint8).reshape(m, -1)

    def array(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of the rows and the bytes that each shares with the one before."""
        order = np.argsort(side.copy().view(f"S{side.shape[1]}").ravel(), kind="stable")
        shared = np.zeros(m, np.int64)
        for at in range(1, m, 1 << 16):
            a, b = side[order[at - 1 : at + (1 << 16) - 1]], side[order[at : at + (1 << 16)]]
            differs = a[: len(b)] != b
            shared[at : at + len(b)] = np.where(differs.any(1), differs.argmax(1), side.shape[1])
        return order, shared

    (dictionary, left_shared), (parse, right_shared) = array(left), array(right)
    gone = np.zeros((m, REACH), bool)
    for o in range(REACH):
        own = np.flatnonzero((trigger >= o) & (trigger - o < n))
        if not len(own):
            continue
        suffix, follow = np.empty(m, np.int64), np.empty(m, np.int64)
        suffix[dictionary] = np.cumsum(left_shared < o + MARK)
        follow[parse] = np.cumsum(right_shared < WINDOW - o)
        place = start[own] + trigger[own] - o
        order = np.lexsort((place, ids[own], follow[own], suffix[own]))
        own, place = own[order], place[order]
        new = np.ones(len(own), bool)
        new[1:] = (suffix[own][1:] != suffix[own][:-1]) | (follow[own][1:] != follow[own][:-1])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (ids[own] != ids[own][lead]) | (place != place[lead])
        gone[own[later], (trigger[own] - o)[later]] = True
    edge = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1]
    return _notes(ids[row], crc[row], start[row] + first, last - first, np.full(len(row), GONE))


def _id_key(id: str) -> Column:
    return F.coalesce(col(id).cast("long"), F.lit(LAST))


def _with_notes(df: DataFrame, notes: DataFrame, how: str) -> DataFrame:
    """``df`` (id, crc, ...) with its notes as one array."""
    told = notes.groupBy(F.col("id").alias("of_id"), F.col("crc").alias("of_crc")).agg(
        F.collect_list(F.struct("start", "n", "kind")).alias("notes")
    )
    return df.join(told, (F.col("id") == F.col("of_id")) & (F.col("crc") == F.col("of_crc")), how).drop("of_id", "of_crc")


def _numbers(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """start, n and kind of every row's notes."""
    for x in lists:
        v = x.values if x.is_valid else None
        yield tuple(v.field(i).to_numpy() if v is not None else np.zeros(0, np.int32) for i in range(3))


def repeated_windows(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, crc, start, n): runs of windows that stand earlier as well; id null is the largest long.

    ``crc`` is the CRC-32 of the text, which tells rows of one id apart.
    """
    blocks = 2 * shuffle_width(docs.sparkSession)
    slim = docs.select(_id_key(id).alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    notes = written(_records(slim, _phrases, blocks).groupBy("block").applyInArrow(_resolve, NOTE), "phrases")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                told = list(_numbers(batch.column(3)))
                each = [len(x[0]) for x in told]
                start, n, kind = (np.concatenate(x) for x in zip(*told, strict=True))
                parts, triggers, blocks_of = [], [], []
                for text, (first, size, _) in zip(batch.column(2).to_pylist(), told, strict=True):
                    words = _words(text + bytes(8))
                    first = first.astype(np.int64)
                    trigger = (_marks(words[first[:, None] + np.arange(REACH)]) & ~POSITION).argmin(1)
                    root = _hash(words, first + trigger, WINDOW - REACH + 1, 10)
                    triggers.append(trigger)
                    blocks_of.append(root % np.uint64(blocks))
                    parts += [text[s : s + k + WINDOW - 1] for s, k in zip(first.tolist(), size.tolist(), strict=True)]
                numbers = [*(batch.column(i).to_numpy().repeat(each) for i in (0, 1)), start, n, np.concatenate(triggers), kind, np.concatenate(blocks_of)]
                types = [pa.int64(), pa.int64(), *[pa.int32()] * 5]
                columns = [pa.array(x.astype(np.int64)).cast(t) for x, t in zip(numbers, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(parts, pa.binary())], names=["id", "crc", "start", "n", "trigger", "kind", "block", "bytes"]
                )

    parts = _with_notes(
        slim.select("id", F.crc32("text").alias("crc"), "text"), notes.filter(F.col("kind").isin(PART, SINGLE)), "inner"
    )
    parts = parts.dropDuplicates(["id", "crc"])  # repeated rows have the same phrases
    schema = "id long, crc long, start int, n int, trigger int, kind int, block int, bytes binary"
    cuts = written(parts.mapInArrow(cut, schema), "parts")
    wide = cuts.filter(F.col("kind") == PART).drop("kind").groupBy("block").applyInArrow(_in_corpus_order, NOTE)
    single = cuts.filter(F.col("kind") == SINGLE).select("id", "crc", "start", "n", "bytes")
    alone = _records(single, _single_windows, blocks).groupBy("block").applyInArrow(_resolve, NOTE)
    whole = notes.unionByName(wide).unionByName(alone)
    return whole.filter(F.col("kind") == GONE).drop("kind")


def without_repeated_strings(
    docs: DataFrame, id: str = "doc_id", text: str = "text", keep: Iterable[str] | None = None
) -> DataFrame:
    """One row per row: ``row`` (the columns ``keep``, all by default) and ``out``.

    ``out`` has n_bytes, n_removed, n_spans, the spans (start, size; disjoint,
    in order) and the remaining bytes ``kept`` (binary: a cut may fall inside a
    character).
    """
    notes = repeated_windows(docs, id, text).withColumn("kind", F.lit(GONE))
    row = F.struct(*[col(c) for c in (docs.columns if keep is None else keep)])
    slim = docs.select(
        _id_key(id).alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).cast("binary").alias("text"), row.alias("row")
    ).select("id", F.crc32("text").alias("crc"), "text", "row")
    joined = _with_notes(slim, notes, "left").select("row", "text", "notes")
    out = "n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,size:int>>, kept binary"
    span = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))
    types = [pa.int64(), pa.int64(), pa.int64(), span, pa.binary()]
    names = ["n_bytes", "n_removed", "n_spans", "spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                made: list[list] = [[], [], [], [], []]
                for text, (start, n, _) in zip(batch.column(1).to_pylist(), _numbers(batch.column(2)), strict=True):
                    first, end = _joined(start.astype(np.int64), start.astype(np.int64) + n + WINDOW - 1)
                    kept, place = [], 0
                    for a, b in zip(first.tolist(), end.tolist(), strict=True):
                        kept.append(text[place:a])
                        place = b
                    kept.append(text[place:])
                    values = (len(text), int((end - first).sum()), len(first),
                              [{"start": a, "size": b - a} for a, b in zip(first.tolist(), end.tolist(), strict=True)], b"".join(kept))
                    for x, v in zip(made, values, strict=True):
                        x.append(v)
                result = pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(made, types, strict=True)], names=names)
                yield pa.RecordBatch.from_arrays([batch.column(0), result], names=["row", "out"])

    schema = StructType().add("row", joined.schema["row"].dataType).add("out", _parse_datatype_string(out))
    return joined.mapInArrow(run, schema)


def _joined(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals [first, end) as disjoint ones in order; those that touch become one."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > end[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1) if len(first) else np.zeros(0, int)
    return first[new], end[last]
