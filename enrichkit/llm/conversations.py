"""Operator 12: conversations brought to a legal order of roles by the cheapest edits.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Rows
may be kept (0), given the role user or assistant (3) or deleted (4, a must for
blank and duplicate rows), rows with empty text may be inserted anywhere (3),
and a truncated row that stays costs 3. Of the cheapest edits the one whose
letters K, R, D, I read in order are least in ASCII is taken.

Method: rank-convergence parallel Viterbi. The rows of all conversations are
dealt by range of (conversation, turn), so one of any length is spread, and cut
into chunks of ``CHUNK`` rows. The cost to go from each of four states is a
vector that depends on the rows to the right. Every chunk computes its vectors
from its right end, the last one of a conversation from the true end, the
others from a speculative vector of zeros. Fix-up passes hand the left vector
of a chunk to its left neighbour, which reruns until it meets a vector that
differs from its former one by a constant only; the rest of the chunk is then
right but for that constant. Passes end when no chunk got a new vector. With
the stitched costs a chunk traces the least audit from each state it may be
entered in; these maps of states compose over chunks by pointer doubling until
all are constant, and a last pass traces every chunk from its one state.

Conversations inside one chunk (nearly all) need no pass. Numbers that go
through the driver: one row for each shuffle partition.

Defined cases. Null roles and texts are one space (so such a text is blank); a
null id is a conversation of its own. Rows are taken by turn, nulls first, and
within a turn by role and the hash of the text. An initial other than s, u, a
(or an empty role) cannot be kept. Extra columns are left alone. A table without
rows gives none.

``repaired_digest`` hashes a conversation's text in order, which SHA-256 allows
in no other way: its rows stream through one task, in bounded memory, and its
audit (a letter a row) is one string there. Nothing else holds a conversation
together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import shuffle_width
from ._common import col, written

CHUNK = 4096
#: Vectors kept for the comparison of a rerun: one every so many rows.
MARK = 64
ROLES = "sua"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

#: States: nothing yet, after s, after u, after a. Where an inserted or reroled row leads, and its role.
STEP = (2, 2, 3, 2)
ROLE = "uuau"
#: Kept rows: (state, class of the role) -> state.
KEEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
DELETE, CHANGE, INSERT, CUT = 4, 3, 3, 3
END = (0, 2 * INSERT, INSERT, 0)
UNKNOWN = (0, 0, 0, 0)

_BLANK = r"[\x20\x09-\x0D]"


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role and text after faults that a hash of conversation and turn deals out."""
    name = F.concat(*[F.coalesce(col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in (conv, "", turn)])
    case = F.crc32(name.cast("binary")) % 20
    space = F.lit(" ")
    known = rows.select(
        col(conv).alias("conv"), col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), space).alias("role"),
        F.coalesce(col(text).cast("string"), space).alias("text"), case.alias("case"),
    ).filter("case <> 0")
    text_now = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role_now = F.when(F.col("case") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("case") == 3, 2).otherwise(1))
    once = known.select("conv", "turn", role_now.alias("role"), text_now.alias("text"), copies.alias("copies"))
    return once.select("conv", "turn", "role", "text", F.explode("copies")).drop("col")


def judged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv, turn, role, text), written once with a number; and without texts, with the code fault * 4 + role."""
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    blank = ~F.col("text").rlike(f"[^{_BLANK[1:-1]}]")
    whole = F.col("text").rlike(rf"[.!?]{_BLANK}*\z")
    fault = F.when(blank, BLANK).when(whole, NONE).otherwise(TRUNCATED)
    numbered = written(
        rows.select(
            "conv", "turn", "role", "text", F.sha2(F.col("text").cast("binary"), 256).alias("hash"),
            fault.alias("fault"), role.alias("kind"), F.monotonically_increasing_id().alias("serial"),
        ),
        "turns",
    )
    # the first of equal rows by turn; a row of a key in each task, however many there are
    first = numbered.groupBy("conv", "role", "hash").agg(F.min(F.struct("turn", "serial"))["serial"].alias("first"))
    slim = numbered.select("conv", "turn", "role", "hash", "serial", "fault", "kind")
    known = slim.join(first.select("first"), F.col("serial") == F.col("first"), "left")
    fault = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    code = (fault * 4 + F.col("kind")).cast("int").alias("code")
    return numbered, known.select("conv", "turn", "role", "hash", "serial", code)


def _illegal(a: int, b: int) -> bool:
    return (a, b) not in ((0, 1), (1, 2), (2, 1))


def chunks(coded: DataFrame) -> DataFrame:
    """Rows in order, cut: number (consecutive over the table), conv, first, last, serials, codes, illegal pairs."""
    order = ["conv", "turn", "role", "hash", "serial"]
    spread = coded.repartitionByRange(shuffle_width(coded.sparkSession), *order).sortWithinPartitions(*order)
    slim = spread.select("conv", "serial", "code")
    schema = StructType().add("conv", coded.schema["conv"].dataType)
    for f in _parse_datatype_string("part int, index int, first boolean, last boolean, serials array<long>, codes binary, illegal int").fields:
        schema = schema.add(f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, index = TaskContext.get().partitionId(), [], 0
        held: list = []  # conv, first, serials, codes, role before

        def close(last: bool) -> None:
            nonlocal index
            conv, first, serials, codes, before = held
            roles = [c & 3 for c in codes]
            pairs = zip(roles if before is None else [before, *roles], roles[1:] if before is None else roles, strict=False)
            made.append((conv, part, index, first, last, serials, bytes(codes), sum(_illegal(a, b) for a, b in pairs)))
            index += 1

        def batch() -> pa.RecordBatch:
            columns = [pa.array(x, type=t) for x, t in zip(zip(*made, strict=True), types, strict=True)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        types = None
        for b in batches:
            types = types or [b.schema.field(0).type, pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.list_(pa.int64()), pa.binary(), pa.int32()]
            for conv, serial, code in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if not held or held[0] != conv:
                    if held:
                        close(True)
                    held = [conv, True, [serial], [code], None]
                elif len(held[2]) == CHUNK:
                    close(False)
                    held = [conv, False, [serial], [code], held[3][-1] & 3]
                else:
                    held[2].append(serial)
                    held[3].append(code)
                if len(made) >= 1000:
                    yield batch()
        if held:
            close(True)
        if made:
            yield batch()

    found = written(slim.mapInArrow(run, schema), "chunks")
    return _numbered(found)


def _numbered(found: DataFrame) -> DataFrame:
    """Chunks with consecutive numbers, and with first, last and illegal as the neighbouring partition has it."""
    edge = F.struct("conv", F.substring("codes", 1, 1).alias("a"), F.substring("codes", -1, 1).alias("z"))
    parts = found.groupBy("part").agg(
        F.count("*").alias("n"), F.min_by(edge, "index").alias("head"), F.max_by(edge, "index").alias("tail")
    ).orderBy("part").collect()  # a row for each shuffle partition
    rows, before, offset = [], None, 0
    for p in parts:
        joins = before is not None and before.tail["conv"] == p.head["conv"]
        wrong = int(joins and _illegal(before.tail["z"][0] & 3, p.head["a"][0] & 3))
        if joins:
            rows[-1][3] = True
        rows.append([p.part, offset, joins, False, wrong, p.n])
        before, offset = p, offset + p.n
    spark = found.sparkSession
    told = spark.createDataFrame(rows, "of int, offset long, head boolean, tail boolean, wrong int, n long")
    at_head, at_tail = F.col("index") == 0, F.col("index") == F.col("n") - 1
    return found.join(F.broadcast(told), F.col("part") == F.col("of")).select(
        (F.col("offset") + F.col("index")).alias("number"), "conv",
        (F.col("first") & ~(at_head & F.col("head"))).alias("first"),
        (F.col("last") & ~(at_tail & F.col("tail"))).alias("last"),
        "serials", "codes", (F.col("illegal") + F.when(at_head, F.col("wrong")).otherwise(0)).alias("illegal"),
    )


class _Costs:
    """Vectors of cost to go, least value zero; each (vector, row) is worked out once."""

    def __init__(self) -> None:
        self.steps: dict = {}
        self.traces: dict = {}

    def before(self, after: tuple, code: int) -> tuple[tuple, int]:
        """The vector before a row and the constant taken from it."""
        found = self.steps.get((after, code))
        if found is None:
            fault, kind = divmod(code, 4)
            cut = CUT * (fault == TRUNCATED)
            best = []
            for s in range(4):
                costs = [DELETE + after[s]]
                if fault not in (BLANK, DUPLICATE):
                    costs.append(CHANGE + cut + after[STEP[s]])
                    if (s, kind) in KEEP:
                        costs.append(cut + after[KEEP[s, kind]])
                best.append(min(costs))
            for _ in range(3):  # rows inserted before this one
                best = [min(best[s], INSERT + best[STEP[s]]) for s in range(4)]
            least = min(best)
            found = self.steps[after, code] = (tuple(x - least for x in best), least)
        return found

    def backward(self, codes: bytes, right: tuple, former: np.ndarray | None = None) -> tuple[tuple, int, np.ndarray]:
        """Left vector, sum of constants and the vectors at every MARK rows (with the sum so far).

        A rerun ends at the first kept vector that it meets again.
        """
        vector, total, marks = right, 0, []
        for done in range(len(codes)):
            if done % MARK == 0 and done:
                if former is not None and tuple(former[len(marks)][:4]) == vector:
                    rest = former[len(marks) :].copy()
                    rest[:, 4] += total - rest[0, 4]
                    marks = np.array([*marks, *rest.tolist()], np.int64).reshape(-1, 5)
                    return tuple(marks[-1][:4].tolist()), int(marks[-1][4]), marks
                marks.append((*vector, total))
            vector, step = self.before(vector, codes[-1 - done])
            total += step
        marks.append((*vector, total))
        return vector, total, np.array(marks, np.int64).reshape(-1, 5)

    def edit(self, after: tuple, code: int, state: int) -> tuple[str, int, int]:
        """What the least audit does up to and with a row: edit, next state, cost.

        Letters: D, K, U or A (role changed), u or a (inserted).
        """
        found = self.traces.get((after, code, state))
        if found is None:
            vector, least = self.before(after, code)
            fault, kind = divmod(code, 4)
            cut = CUT * (fault == TRUNCATED)
            text, cost, s = "", 0, state
            while True:
                here = vector[s] + least
                if DELETE + after[s] == here:
                    found = text + "D", s, cost + DELETE
                elif INSERT + vector[STEP[s]] == vector[s]:
                    text, cost, s = text + ROLE[s], cost + INSERT, STEP[s]
                    continue
                elif (s, kind) in KEEP and fault in (NONE, TRUNCATED) and cut + after[KEEP[s, kind]] == here:
                    found = text + "K", KEEP[s, kind], cost + cut
                else:
                    found = text + ROLE[s].upper(), STEP[s], cost + CHANGE + cut
                break
            self.traces[after, code, state] = found
        return found

    def trace(self, codes: bytes, right: tuple, state: int) -> tuple[list[str], list[int], int]:
        vectors = [right]
        for code in reversed(codes[1:]):
            vectors.append(self.before(vectors[-1], code)[0])
        edits, costs = [], []
        for code in codes:
            text, state, cost = self.edit(vectors.pop(), code, state)
            edits.append(text)
            costs.append(cost)
        return edits, costs, state


def _per_row(df: DataFrame, schema: str, make) -> DataFrame:
    """``make()`` gives a function from a row of Arrow values to a tuple of ``schema``; columns stay beside."""
    added = _parse_datatype_string(schema)
    out = StructType([*df.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                made = [fn(r) for r in batch.to_pylist()]
                columns = [pa.array([m[i] for m in made], _arrow(f)) for i, f in enumerate(added.fields)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=out.names)

    return df.mapInArrow(run, out)


def _arrow(field) -> pa.DataType:
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "int": pa.int32()}
    kinds |= {"array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return kinds[field.dataType.simpleString()]


def _speculated(long: DataFrame) -> DataFrame:
    """Chunks of long conversations with the true (but for a constant) vector at their right end."""

    def start():
        costs = _Costs()

        def fn(r: dict) -> tuple:
            right = END if r["last"] else UNKNOWN
            left, _, marks = costs.backward(r["codes"], right)
            return list(right), list(left), marks.tobytes(), False

        return fn

    def rerun():
        costs = _Costs()

        def fn(r: dict) -> tuple:
            given, right = r["given"], r["right"]
            if given is None or given == right:
                return right, r["left"], r["marks"], False
            former = np.frombuffer(r["marks"], np.int64).reshape(-1, 5)
            left, _, marks = costs.backward(r["codes"], tuple(given), former)
            return given, list(left), marks.tobytes(), list(left) != r["left"]

        return fn

    columns = ["number", "conv", "first", "last", "serials", "codes"]
    schema = "right array<int>, left array<int>, marks binary, changed boolean"
    now = written(_per_row(long.select(*columns), schema, start), "vectors")
    while True:
        given = now.filter(~F.col("first")).select((F.col("number") - 1).alias("of"), F.col("left").alias("given"))
        joined = now.join(given, F.col("number") == F.col("of"), "left").drop("of", "changed")
        renamed = joined.select(*columns, F.struct("right", "left", "marks", "given").alias("was"))

        def again():
            fn = rerun()
            return lambda r: fn(r | r["was"])

        now = written(_per_row(renamed, schema, again).drop("was"), "vectors")
        if now.filter("changed").isEmpty():
            return now.select(*columns, "right")


def _entered(long: DataFrame) -> DataFrame:
    """Chunks of long conversations with the state in which the one least audit enters them."""

    def ends():
        costs = _Costs()

        def fn(r: dict) -> tuple:
            states = (0,) * 4 if r["first"] else range(4)
            return ([costs.trace(r["codes"], tuple(r["right"]), s)[2] for s in states],)

        return fn

    whole = written(_per_row(long, "to array<int>", ends), "maps")
    maps, step = whole.select("number", "to"), 1
    while True:
        varied = F.size(F.array_distinct("to")) > 1
        if maps.filter(varied).isEmpty():
            break
        left = maps.select((F.col("number") + step).alias("of"), F.col("to").alias("by"))
        composed = F.when(F.col("by").isNull(), F.col("to")).otherwise(F.transform("by", lambda s: F.get("to", s)))
        maps = written(maps.join(left, F.col("number") == F.col("of"), "left").select("number", composed.alias("to")), "maps")
        step *= 2
    state = maps.select((F.col("number") + 1).alias("of"), F.get("to", F.lit(0)).alias("left_state"))
    entered = F.when(F.col("first"), 0).otherwise(F.col("left_state")).cast("int").alias("state")
    return whole.join(state, F.col("number") == F.col("of"), "left").select("number", "conv", "last", "serials", "codes", "right", entered)


def edits(cut: DataFrame) -> DataFrame:
    """serial, conv, number, at, edit and cost of every row of the chunks ``cut`` (a written table)."""
    alone = F.col("first") & F.col("last")
    long = cut.filter(~alone)
    ready = cut.filter(alone).select(
        "number", "conv", "last", "serials", "codes",
        F.array(*[F.lit(x) for x in END]).alias("right"), F.lit(0).alias("state"),
    )
    if not long.isEmpty():
        ready = ready.unionByName(_entered(_speculated(long)))

    def make():
        costs = _Costs()

        def fn(r: dict) -> tuple:
            texts, each, state = costs.trace(r["codes"], tuple(r["right"]), r["state"])
            while r["last"] and state in (1, 2):
                texts[-1] += ROLE[state]
                each[-1] += INSERT
                state = STEP[state]
            return texts, each

        return fn

    traced = _per_row(ready, "edits array<string>, costs array<int>", make)
    rows = traced.select("conv", "number", F.posexplode(F.arrays_zip("serials", "edits", "costs")).alias("at", "e"))
    return rows.select(F.col("e.serials").alias("serial"), "conv", "number", "at", F.col("e.edits").alias("edit"), F.col("e.costs").alias("cost"))


def audit_letters(edit: Column) -> Column:
    return F.translate(edit, "uaUA", "IIRR")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows (conv, turn, role, text): the rows with their edits, the chunks, and the edits alone."""
    numbered, coded = judged(rows)
    cut = written(chunks(coded), "chunks")
    found = written(edits(cut), "edits")
    text = numbered.select(F.col("serial").alias("of"), "turn", "role", "text")
    return found.join(text, F.col("serial") == F.col("of")).drop("of", "serial"), cut, found


def repaired_rows(edited: DataFrame) -> DataFrame:
    """conv, number, at, step, role and text of the repaired conversations, one row for each."""
    letters = F.filter(F.split("edit", ""), lambda x: (x != "") & (x != "D"))
    each = edited.select("conv", "number", "at", "role", "text", F.posexplode(letters).alias("step", "letter"))
    letter = F.col("letter")
    role = F.when(letter.isin("u", "U"), "user").when(letter.isin("a", "A"), "assistant").otherwise(F.col("role"))
    text = F.when(letter.isin("u", "a"), "").otherwise(F.col("text"))
    return each.select("conv", "number", "at", "step", role.alias("role"), text.alias("text"))


def repaired_digest(edited: DataFrame) -> DataFrame:
    """conv, audit and the SHA-256 of the repaired rows, streamed in order."""
    kind = edited.schema["conv"].dataType
    slim = edited.select("conv", "number", "at", "edit", "role", "text")
    dealt = slim.repartition(F.col("conv")).sortWithinPartitions("conv", "number", "at").select("conv", "edit", "role", "text")
    schema = StructType().add("conv", kind).add("audit", "string").add("digest", "string")
    names = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}
    letters = str.maketrans("uaUA", "IIRR")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list = []
        now, audit, digest, empty, begun = None, [], None, True, False
        type_of = None

        def batch() -> pa.RecordBatch:
            columns = [pa.array(x, t) for x, t in zip(zip(*made, strict=True), (type_of, pa.string(), pa.string()), strict=True)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for b in batches:
            type_of = b.schema.field(0).type
            for conv, edit, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if not begun or conv != now:
                    if begun:
                        made.append((now, "".join(audit).translate(letters), digest.hexdigest()))
                        if len(made) >= 1000:
                            yield batch()
                    now, audit, digest, empty, begun = conv, [], hashlib.sha256(), True, True
                audit.append(edit)
                for x in edit:
                    if x != "D":
                        line = f"{names.get(x, role)}:{'' if x in 'ua' else text}"
                        digest.update((line if empty else "\n" + line).encode())
                        empty = False
        if begun:
            made.append((now, "".join(audit).translate(letters), digest.hexdigest()))
        if made:
            yield batch()

    return dealt.mapInArrow(run, schema)


def report(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv of ``convs``: gaps, faults, illegal pairs, cost, audit and digest of its repair.

    ``rows`` (conv, turn, role, text) are the rows to repair; a conv without any has zeros.
    """
    edited, cut, found = repair(rows)
    zero = F.lit(0).cast("long")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def part(df: DataFrame, **values: Column) -> DataFrame:
        numbers = [values.get(n, zero).cast("long").alias(n) for n in names]
        words = [values.get(n, F.lit(None).cast("string")).alias(n) for n in ("audit", "digest")]
        return df.select("conv", *numbers, *words)

    def with_fault(fault: int) -> Column:
        return F.size(F.filter("faults", lambda x: x == fault))

    turns = rows.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), zero).alias("gaps")
    )
    counted = _per_row(cut.select("conv", "illegal", "codes"), "faults array<int>", lambda: lambda r: ([c >> 2 for c in r["codes"]],))
    parts = [
        part(convs.select("conv")),
        part(turns, gaps=F.col("gaps")),
        part(counted, illegal=F.col("illegal"), blank=with_fault(BLANK), duplicate=with_fault(DUPLICATE), truncated=with_fault(TRUNCATED)),
        part(found, cost=F.col("cost")),
        part(repaired_digest(edited), audit=F.col("audit"), digest=F.col("digest")),
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy("conv").agg(
        *[F.sum(n).alias(n) for n in names],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("digest"), F.sha2(F.lit("").cast("binary"), 256)).alias("digest"),
    )
