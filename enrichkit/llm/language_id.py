"""Operator 8, language identification by prediction by partial matching.

For every language a variable-order context tree over bytes (orders 0 to
``ORDER``) is counted. The probability of a byte after a context is
``count / (total + distinct)``; the escape to the next shorter context has
``distinct / (total + distinct)``; order -1 gives every byte 1/256. The code
length of a whole text is the exact sum over all its bytes, under frozen
statistics. The language with the shortest code wins; the score is its
posterior under equal priors.

For scoring, the trees of all languages are compiled into sorted arrays: each
(context, next byte) that any language has seen holds the code length under
each language with all its escapes, and each context holds what each language
pays to escape from it. Scoring looks a byte up after the longest context that
any language knows; where none has seen it there, the escapes are paid and the
next shorter context is tried. All is vectorised over a batch.

Training counts whole texts of a bounded sample of the labelled rows: rows
are taken by a hash of their id so that about ``max_train_rows`` of each
language are used (all, when there are fewer). Counting is a map pass with
map-side sums. ``learn`` uses every context of the sample, also those seen
once, so the model grows with the different byte runs of the sample (8 bytes,
and 4 for each language, a run) and is bounded by ``max_train_rows`` alone.

Defined cases: a null text or one without letters is ``und`` with score 0;
without any training row every text is ``und``. Rows whose language is null
are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import ROWS_AT_ONCE, arrow_pass, col, written

ORDER = 3
#: Bytes scored at once (bounds the memory of a task).
BLOCK = 1 << 20
UND = "und"


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id's text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bounded_sample(df: DataFrame, group: Column, row_id: Column, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows of each group, chosen by a hash of the row id.

    The group sizes are counted first and broadcast, one row per group
    (languages, labels: there must be few). Which rows are in does not depend
    on the partitioning.
    """
    sizes = df.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n"))
    share = F.lit(float(1 << 31)) * max_rows / F.col("n")
    kept = sizes.select(F.col("g").alias("of"), F.least(share, F.lit(float(1 << 31))).alias("below"))
    draw = F.shiftrightunsigned(F.xxhash64(row_id.cast("string")), 33).cast("double")
    return df.withColumn("g", group).join(F.broadcast(kept), F.col("g") == F.col("of")).filter(draw < F.col("below")).drop("of", "below")


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """Codes of the ``order + 1`` bytes ending at each position that has them."""
    n = len(data) - order
    code = np.zeros(max(n, 0), np.uint64)
    for j in range(order + 1):
        code = code << np.uint64(8) | data[j : j + n].astype(np.uint64) if n > 0 else code
    return code


def gram_counts(sample: DataFrame, *, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, size, gram, n): how often each run of ``size`` bytes follows, per language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (w.slice(at, ROWS_AT_ONCE) for w in batches for at in range(0, w.num_rows, ROWS_AT_ONCE)):
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for one in sorted(set(langs)):
                mine = [t for t, g in zip(texts, langs, strict=True) if g == one and t]
                for size in range(1, ORDER + 2):
                    codes = [_grams(np.frombuffer(t, np.uint8), size - 1) for t in mine]
                    if not codes:
                        continue
                    gram, n = np.unique(np.concatenate(codes), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([one] * len(gram)),
                            pa.array(np.full(len(gram), size, np.int32)),
                            pa.array(gram.astype(np.int64)),
                            pa.array(n.astype(np.int64)),
                        ],
                        names=["lang", "size", "gram", "n"],
                    )

    counted = sample.select(col(lang).alias("lang"), col(text).cast("string").alias("text")).mapInArrow(
        count, "lang string, size int, gram long, n long"
    )
    return counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def train(sample: DataFrame) -> dict:
    """The compiled model, plain arrays, of every context of the sample."""
    rows = written(gram_counts(sample), "ppm-grams")
    counts: dict = {}
    for lang, size, gram, n in rows.orderBy("lang", "size", "gram").toLocalIterator():
        counts.setdefault(lang, {}).setdefault((size, gram >> 8), {})[gram & 255] = n
    return compiled(counts)


def compiled(counts: dict) -> dict:
    """Code lengths of the bytes seen after each context, and its escapes, by language."""
    langs = sorted(counts)
    width = max(len(langs), 1)
    contexts = sorted({c for tree in counts.values() for c in tree if c[0] > 1})
    rows = {c: i + 1 for i, c in enumerate(contexts)}  # row 0 is the empty context
    order0 = np.full((256, width), 8.0)
    for k, lang in enumerate(langs):
        order0[:, k] = _lengths(counts[lang].get((1, 0), {}), np.full(256, 8.0))
    # byte runs in ascending order of (row, byte); the empty context knows all bytes
    at = {byte: byte for byte in range(256)}
    escapes = np.zeros((len(contexts) + 1, width), np.float32)
    parents = np.zeros(len(contexts) + 1, np.int32)

    def length(row: int, byte: int) -> np.ndarray:
        """Code lengths of any byte after the context of ``row``."""
        paid = np.zeros(width)
        while (row << 8 | byte) not in at:
            paid, row = paid + escapes[row], int(parents[row])
        return paid + table[at[row << 8 | byte]]

    size_of = 256 + sum(len({b for t in counts.values() for b in t.get(c, ())}) for c in contexts)
    table = np.empty((size_of, width), np.float32)
    table[:256] = order0
    for c in contexts:  # shorter contexts first
        size, code = c
        row = rows[c]
        # a known context of one language has known shorter ones, down to the empty context
        parents[row] = rows.get((size - 1, code & ((1 << 8 * (size - 2)) - 1)), 0) if size > 2 else 0
        trees = [(k, counts[lang][c]) for k, lang in enumerate(langs) if c in counts[lang]]
        totals = {}
        for k, seen in trees:
            totals[k] = sum(seen.values()) + len(seen)
            escapes[row, k] = -np.log2(len(seen) / totals[k])
        for byte in sorted({b for _, seen in trees for b in seen}):
            own = length(int(parents[row]), byte) + escapes[row]
            for k, seen in trees:
                if byte in seen:
                    own[k] = -np.log2(seen[byte] / totals[k])
            i = len(at)
            at[row << 8 | byte] = i
            table[i] = own
    by_order = []
    for size in range(2, ORDER + 2):
        codes = [code for s, code in contexts if s == size]
        by_order.append((np.array(codes, np.int64), np.array([rows[size, c] for c in codes], np.int32)))
    keys = np.fromiter(at, np.int64, len(at))
    return {"langs": langs, "keys": keys, "table": table, "escapes": escapes, "parents": parents, "orders": by_order}


def _lengths(seen: dict[int, int], shorter: np.ndarray) -> np.ndarray:
    """Code lengths in bits after one context; unseen bytes escape to the shorter one."""
    if not seen:
        return shorter
    total = sum(seen.values()) + len(seen)
    out = shorter - np.log2(len(seen) / total)
    for byte, n in seen.items():
        out[byte] = -np.log2(n / total)
    return out


def _context_rows(model: dict) -> np.ndarray:
    """Row of the longest known context for each state of three byte classes.

    Bytes that occur in no context share class 0, so the direct-address map
    stays small; it is built once in each Python worker.
    """
    if "map" not in model:
        known = {0}
        for size, (codes, _) in enumerate(model["orders"], 2):
            for j in range(size - 1):
                known |= set(((codes >> 8 * j) & 255).tolist())
        used = sorted(known)
        classes = np.zeros(256, np.int64)
        width = len(used) + 1
        for i, b in enumerate(used):
            classes[b] = i + 1
        direct = np.zeros((width,) * ORDER, np.int32)
        for size, (codes, rows) in enumerate(model["orders"], 2):
            parts = [classes[(codes >> 8 * j) & 255] for j in range(size - 1)]  # nearest byte first
            where = tuple(parts) + (slice(None),) * (ORDER - size + 1)
            direct[where] = rows.reshape((-1,) + (1,) * (ORDER - size + 1))
        model["classes"], model["width"] = classes, width
        model["map"] = direct.ravel()
    return model["map"]


def code_lengths(data: np.ndarray, starts: np.ndarray, model: dict) -> np.ndarray:
    """Code length in bits of each text under each language; ``data`` holds all texts end to end."""
    direct = _context_rows(model)
    width, cls = model["width"], model["classes"][data]
    n = len(data)
    first = np.zeros(n, bool)
    at = np.zeros(n, np.int64)
    blocked = np.zeros(n, bool)  # the context would reach into the text before
    first[starts[starts < n]] = True
    for j in range(1, ORDER + 1):
        blocked[j - 1 :] |= first[: n - j + 1] if j > 1 else first
        near = np.zeros(n, np.int64)
        near[j:] = cls[: n - j]
        near[blocked] = 0
        at = at * width + near
    bits = _bits(direct[at].astype(np.int64), data.astype(np.int64), model)
    return np.add.reduceat(np.concatenate([bits, np.zeros((1, bits.shape[1]), bits.dtype)]), starts, axis=0, dtype=np.float64)


def _bits(row: np.ndarray, byte: np.ndarray, model: dict) -> np.ndarray:
    """Code length of each byte after the context of ``row``, by language."""
    keys, table = model["keys"], model["table"]
    want = row << 8 | byte
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    bits = table[at]
    left = np.flatnonzero(keys[at] != want)
    bits[left] = 0
    while len(left):
        bits[left] += model["escapes"][row[left]]
        row[left] = model["parents"][row[left]]
        want = row[left] << 8 | byte[left]
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = keys[at] == want
        bits[left[hit]] += table[at[hit]]
        left = left[~hit]
    return bits


def score_texts(texts: list[bytes], model: dict) -> np.ndarray:
    """Code lengths of every text, in blocks of bounded size; long texts continue over blocks."""
    out = np.zeros((len(texts), len(model["langs"])))
    group: list[tuple[int, bytes, int]] = []  # text, bytes, how many of them only give context
    size = 0

    def flush() -> None:
        nonlocal group, size
        if group:
            data = np.frombuffer(b"".join(part for _, part, _ in group), np.uint8)
            begin = np.cumsum([0] + [len(part) for _, part, _ in group])[:-1]
            total = code_lengths(data, begin, model)
            for (i, part, lead), bits in zip(group, total, strict=True):
                if lead:
                    head = np.frombuffer(part[:lead], np.uint8)
                    bits = bits - code_lengths(head, np.zeros(1, np.int64), model)[0]
                out[i] += bits
        group, size = [], 0

    for i, text in enumerate(texts):
        for at in range(0, len(text), BLOCK):
            lead = min(at, ORDER)
            part = text[at - lead : at + BLOCK]
            group.append((i, part, lead))
            size += len(part)
            if size >= BLOCK:
                flush()
    flush()
    return out


def predict(docs: DataFrame, model: dict, *, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``row`` and ``out`` (lang_pred, score) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        langs = m["langs"]

        def run(texts: pa.Array) -> list:
            values = texts.to_pylist()
            lettered = [bool(langs) and v is not None and any(map(str.isalpha, v)) for v in values]
            names, scores = [UND] * len(values), [0.0] * len(values)
            which = [i for i, ok in enumerate(lettered) if ok]
            if which:
                bits = score_texts([values[i].encode("utf-8", "surrogatepass") for i in which], m)
                best = bits.argmin(axis=1)
                share = np.exp2(-np.clip(bits - bits.min(axis=1, keepdims=True), 0, 1000)).sum(axis=1)
                for i, b, s in zip(which, best.tolist(), share.tolist(), strict=True):
                    names[i], scores[i] = langs[b], 1.0 / s
            return [names, scores]

        return run

    return arrow_pass(docs, keep or docs.columns, text_col, make, "lang_pred string, score double")


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_train_rows: int = 1500) -> dict:
    """Train on the rows that are not held out and whose language is known."""
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"), col(lang_col).alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    return train(bounded_sample(rows, F.col("lang"), F.col("id"), max_train_rows))
