"""Operator 5, token counts by a compiled finite-state byte-BPE tokenizer.

Two deterministic transducers are built from the tokenizer file:

* The *splitter* reads character symbols and emits the start of every
  pre-token. It has eight states. A text is cut into chunks of equal length;
  for each chunk the whole state map (exit state for every entry state) is
  built, all chunks in lockstep; the maps compose by a parallel prefix scan,
  which gives each chunk its entry state and with that its pre-token starts.
* The *merger* reads the bytes of a pre-token and emits, on each transition,
  the change of the token count. Byte-pair merges are local: a token sequence
  is the tokenizer's own exactly if every adjacent pair is, so after each byte
  just one last token is possible. A state holds the open trie positions with
  the token before each of them. States and transitions are compiled on first
  use, up to ``MAX_STATES``; a rare word that needs more runs on uncompiled.

Special strings of the tokenizer inside a text count as one token each, as
the tokenizer's own library has it by default.

Scale: one map pass, no shuffle. The only broadcast data are the vocabulary's
merges, of fixed size. Beside the text itself, memory is bounded by the
window, chunk, state and cache sizes: a text longer than ``WINDOW`` characters is
read window by window, between its special strings too, and both transducers
carry their state over each cut, so a cut may fall anywhere, also inside a
pre-token of any length.

Defined cases: null counts as empty, and an empty text has no bytes and no
tokens. Rows are counted one by one.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ._common import arrow_pass

MAX_STATES = 100_000
MAX_PAIRS = 1_000_000
MAX_WORDS = 600_000
CHUNK = 512
WINDOW = 1 << 21

# symbols of the splitter
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE, BLANK, RUN, CUT = range(9)
# states: what is open before the next character
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_BLANKS, LAST_OF, SECOND_OF = range(8)


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and start flag by (state, symbol).

    SHORT and LONG are apostrophes before a two or three character
    contraction; SPACE is U+0020 and BLANK other white space right before a
    visible character; RUN is white space before white space or the end.
    """
    to = np.zeros((8, 9), np.uint8)
    start = np.zeros((8, 9), bool)
    for state in range(8):
        for symbol, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
            to[state, symbol], start[state, symbol] = run, state not in (run, AFTER_SPACE)
        for symbol, rest in ((SHORT, LAST_OF), (LONG, SECOND_OF)):
            inside = state in (IN_OTHERS, AFTER_SPACE)
            to[state, symbol], start[state, symbol] = (IN_OTHERS if inside else rest), not inside
        to[state, SPACE], start[state, SPACE] = AFTER_SPACE, True
        to[state, BLANK], start[state, BLANK] = FRESH, True
        to[state, RUN], start[state, RUN] = IN_BLANKS, state != IN_BLANKS
        to[state, CUT], start[state, CUT] = FRESH, True
    for state, rest in ((LAST_OF, FRESH), (SECOND_OF, LAST_OF)):
        to[state, :CUT], start[state, :CUT] = rest, False
    return to, start


NEXT, STARTS = _splitter()


def char_classes(splits_alone) -> bytes:
    """LETTER, NUMBER, OTHER or RUN of every code point.

    ``splits_alone(pair)`` tells whether the tokenizer keeps two characters in
    one pre-token; it is asked only where Python's Unicode tables know no
    class, as the tokenizer may follow a newer Unicode version.
    """
    out = bytearray([OTHER]) * 0x110000
    for point in range(0x110000):
        char = chr(point)
        kind = unicodedata.category(char)
        if kind == "Cn" and not 0x30000 <= point and point & 0xFFFE != 0xFFFE:
            kind = "L" if splits_alone("a" + char) else "N" if splits_alone("1" + char) else kind
        if kind[0] == "L":
            out[point] = LETTER
        elif kind[0] == "N":
            out[point] = NUMBER
        elif kind[0] == "Z" or point in (9, 10, 11, 12, 13, 0x85):
            out[point] = RUN
    return bytes(out)


def load_tokenizer(path: str) -> dict:
    """Plain tables of a byte-level BPE file of the tokenizers library (driver side)."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"]
    if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
        raise ValueError(f"{path}: only plain byte-level BPE files are compiled")
    splitter = Tokenizer.from_file(path).pre_tokenizer
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ids = spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return {
        "tokens": {i: bytes(byte_of[c] for c in t) for t, i in ids.items() if all(c in byte_of for c in t)},
        "merges": [(ids[a], ids[b], ids[a + b]) for a, b in merges],
        "special": [t["content"] for t in spec["added_tokens"]],
        "classes": char_classes(lambda pair: len(splitter.pre_tokenize_str(pair)) == 1),
    }


class Merger:
    """The merge transducer; ``count(word)`` runs it over the bytes of a pre-token.

    An item of a state is (trie node, token before it, tokens up to there
    less the tokens up to the last byte).
    """

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.byte = {t[0]: i for i, t in tokens.items() if len(t) == 1}
        self.pair = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(merges)}
        self.parts = {c: (rank, a, b) for rank, (a, b, c) in enumerate(merges)}
        self.child: dict[int, int] = {}
        self.ends = [-1]
        for i, t in tokens.items():
            node = 0
            for b in t:
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.ends)
                    self.ends.append(-1)
                node = self.child[key]
            if len(t) == 1 or self.merged(t) == [i]:  # else the token never comes out
                self.ends[node] = i
        self.grows = bytearray(len(self.ends))
        for key in self.child:
            self.grows[key >> 8] = 1
        self.fits: dict[int, bool] = {}
        start = ((0, -1, 0),)
        self.items = [start]
        self.known = {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The merges carried out one by one (once per vocabulary token)."""
        parts = [self.byte[b] for b in data]
        while len(parts) > 1:
            ranks = [(self.pair[p][0], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in self.pair]
            if not ranks:
                break
            i = min(ranks)[1]
            parts[i : i + 2] = [self.pair[parts[i], parts[i + 1]][1]]
        return parts

    def adjoin(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay two tokens side by side.

        The merges at the seam are undone from the last one back; a merge
        across the seam must not have come before the one that used up
        either neighbour.
        """
        key = left << 20 | right
        never = len(self.pair)
        used_left = used_right = never  # rank of the merge that used up the piece
        good = True
        while True:
            across = self.pair.get((left, right))
            if across and across[0] < used_left and across[0] <= used_right:
                good = False
                break
            by_left, by_right = self.parts.get(left), self.parts.get(right)
            if not by_left and not by_right:
                break
            if by_left and (not by_right or by_left[0] >= by_right[0]):
                used_left, left = by_left[0], by_left[2]
            else:
                used_right, right = by_right[0], by_right[1]
        if len(self.fits) >= MAX_PAIRS:
            self.fits.clear()
        self.fits[key] = good
        return good

    def advance(self, items: tuple, byte: int) -> tuple[tuple, int]:
        """The items after one more byte and the change of the token count."""
        child, ends, grows, fits = self.child, self.ends, self.grows, self.fits
        open_ = []
        token, change = -1, 0
        for node, last, ahead in items:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if token < 0:
                end = ends[node]
                if end >= 0:
                    fit = last < 0 or fits.get(last << 20 | end)
                    if fit is None:
                        fit = self.adjoin(last, end)
                    if fit:
                        token, change = end, ahead + 1
            if grows[node]:
                open_.append((node, last, ahead))
        if change:
            open_ = [(n, t, a - change) for n, t, a in open_]
        open_.append((0, token, 0))
        return tuple(open_), change

    def count(self, word: bytes) -> int:
        return self.run(self.items[0], word)[1]

    def run(self, items: tuple, word: bytes) -> tuple[tuple, int]:
        """The items after ``word``, read from ``items`` on, and the change of the token count."""
        total = 0
        state = self.known.get(items)
        if state is None:  # never compiled
            for b in word:
                items, change = self.advance(items, b)
                total += change
            return items, total
        for i, byte in enumerate(word):
            move = self.moves.get(state << 8 | byte)
            if move is None:
                items, change = self.advance(self.items[state], byte)
                total += change
                to = self.known.get(items)
                if to is None:
                    if len(self.items) >= MAX_STATES:  # the rest without compiling it
                        for b in word[i + 1 :]:
                            items, change = self.advance(items, b)
                            total += change
                        return items, total
                    to = self.known[items] = len(self.items)
                    self.items.append(items)
                if len(self.moves) < 4 * MAX_STATES:
                    self.moves[state << 8 | byte] = (to, change)
                state = to
            else:
                state, change = move
                total += change
        return self.items[state], total


class Counts(dict):
    """Token count by pre-token; a missing one is run through the merger."""

    def __init__(self, merger: Merger):
        super().__init__()
        self.merger = merger

    def __missing__(self, word: str) -> int:
        n = self.merger.count(word.encode("utf-8"))
        if len(word) <= 64:
            self[word] = n
        return n


def starts(symbols: np.ndarray, entry: int = FRESH) -> tuple[np.ndarray, int]:
    """Start flags of the pre-tokens, read from state ``entry`` on, and the exit state.

    Chunk maps, their prefix scan, then the chunks themselves.
    """
    n = len(symbols)
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, CUT, np.uint8)
    grid[:n] = symbols
    steps = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
    to, flag = NEXT.ravel(), STARTS.ravel()
    maps = np.broadcast_to(np.arange(8, dtype=np.uint8), (rows, 8))
    for s in steps:
        maps = to[maps.astype(np.intp) * 9 + s[:, None]]
    hop = 1
    while hop < rows:  # inclusive scan: the map of a chunk after the maps of all before it
        maps = np.concatenate([maps[:hop], np.take_along_axis(maps[hop:], maps[:-hop].astype(np.intp), axis=1)])
        hop *= 2
    state = np.concatenate([[entry], maps[:-1, entry]]).astype(np.intp)
    out = np.empty((CHUNK, rows), bool)
    last, leaves = (n - 1) % CHUNK, entry
    for i, s in enumerate(steps):
        at = state * 9 + s
        out[i] = flag[at]
        state = to[at].astype(np.intp)
        if i == last:
            leaves = int(state[-1])
    return out.T.ravel()[:n], leaves


def symbols_of(text: str, classes: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = classes[points]
    blank = out == RUN
    seen = np.zeros(len(out), bool)
    seen[:-1] = ~blank[1:]
    at = blank & seen
    out[at] = np.where(points[at] == 32, SPACE, BLANK)
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, np.uint32)])
        a, b = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(a, [ord(c) for c in "stmd"])
        long_ = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        out[quotes[short]] = SHORT
        out[quotes[long_]] = LONG
    return out


def streamed(text: str, at: int, end: int, tables: dict) -> int:
    """Token count of ``text[at:end]``, a stretch without special strings, window by window."""
    words, merger = tables["counts"], tables["counts"].merger
    state, items, total = FRESH, merger.items[0], 0
    while at < end:
        size = min(WINDOW, end - at)
        part = text[at : min(at + size + 2, end)]  # symbols look two characters ahead
        flags, state = starts(symbols_of(part, tables["class_array"])[:size], state)
        bounds = np.flatnonzero(flags).tolist()
        whole = bounds[0] if bounds else size
        items, change = merger.run(items, part[:whole].encode("utf-8"))  # the rest of the open pre-token
        total += change
        if bounds:
            if len(words) > MAX_WORDS:
                words.clear()
            total += sum(words[part[a:b]] for a, b in zip(bounds, bounds[1:], strict=False))
            items, change = merger.run(merger.items[0], part[bounds[-1] : size].encode("utf-8"))
            total += change
        at += size
    return total


def long_count(text: str, tables: dict) -> int:
    at = total = 0
    if tables["special_pattern"]:
        for found in tables["special_pattern"].finditer(text):
            total += streamed(text, at, found.start(), tables) + 1
            at = found.end()
    return total + streamed(text, at, len(text), tables)


def counted(texts: list[str], tables: dict) -> list[int]:
    """Token counts of a few texts together."""
    special = tables["special_pattern"]
    parts, owner, extra = [], [], [0] * len(texts)
    for i, text in enumerate(texts):
        for piece in special.split(text) if special else (text,):
            parts.append(piece)
            owner.append(i)
            extra[i] += 1
        extra[i] -= 1  # one special token between two pieces
    joined = "\0".join(parts)
    symbols = None
    if joined:
        ends = np.cumsum([len(p) + 1 for p in parts])[:-1] - 1
        symbols = np.concatenate([np.append(symbols_of(p, tables["class_array"]), CUT) for p in parts])[:-1] if len(parts) > 1 else symbols_of(joined, tables["class_array"])
        at = np.flatnonzero(starts(symbols)[0])
        words = tables["counts"]
        if len(words) > MAX_WORDS:
            words.clear()
        bounds = at.tolist()
        bounds.append(len(joined))
        n = np.fromiter(
            (words[joined[a:b]] for a, b in zip(bounds, bounds[1:], strict=False)), dtype=np.int64, count=len(at)
        )
        n[np.isin(at, ends, assume_unique=True)] = 0
        part = np.searchsorted(ends, at, "right")
        sums = np.bincount(np.asarray(owner)[part], weights=n, minlength=len(texts)).astype(np.int64)
    else:
        sums = np.zeros(len(texts), np.int64)
    return [int(a) + b for a, b in zip(sums, extra, strict=True)]


def ready(tables: dict) -> dict:
    """The broadcast tables with both transducers, built once in each Python worker."""
    if "counts" not in tables:
        tables["counts"] = Counts(Merger(tables["tokens"], tables["merges"]))
        tables["class_array"] = np.frombuffer(tables["classes"], np.uint8)
        words = sorted(map(re.escape, tables["special"]), key=len, reverse=True)
        tables["special_pattern"] = re.compile("|".join(words)) if words else None
    return tables


def count_batch(texts: list[str], tables: dict) -> list[int]:
    out: list[int] = []
    group: list[str] = []
    size = 0
    for text in texts:
        if len(text) > WINDOW:
            out += counted(group, tables) if group else []
            group, size = [], 0
            out.append(long_count(text, tables))
            continue
        group.append(text)
        size += len(text)
        if size > WINDOW:
            out += counted(group, tables)
            group, size = [], 0
    return out + (counted(group, tables) if group else [])


def token_counts(docs: DataFrame, tokenizer_path: str, *, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``row`` and ``out`` (n_bytes, n_tokens) per document."""
    tables = docs.sparkSession.sparkContext.broadcast(load_tokenizer(tokenizer_path))

    def make():
        built = ready(tables.value)

        def run(texts: pa.Array) -> list:
            texts = texts.fill_null("")
            return [pc.binary_length(texts).to_pylist(), count_batch(texts.to_pylist(), built)]

        return run

    return arrow_pass(docs, keep or docs.columns, text_col, make, "n_bytes long, n_tokens long")
