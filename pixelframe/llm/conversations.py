"""Repair of conversation structure by Viterbi search over chunks that run in parallel.

A repaired conversation's role initials read ``(s?(ua)+)?``.  Its cheapest edits are a shortest path through four
states (start, after s, after u, after a).  Costs run backwards: a vector of four costs to the end stands
before each row.  A conversation is cut into chunks of rows.  Each chunk starts from a speculative vector at its
right end, all at once; then fix-up passes hand every chunk its right neighbour's vector and run it again, only until
the vector differs from the earlier run's by a constant, from where on the earlier run holds.  The stitched
vectors drive the trace from the left: at each step the ASCII-least edit that is still cheapest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize_table, number_in_groups, small_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: 0 start, 1 after s, 2 after u, 3 after a.  The state after the only role that may be inserted next.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: Costs from the end: nothing left to do in states 0 and 3, else insert up to the next a.
END = (0, 2 * INSERT, INSERT, 0)
#: A row's code: 3 * (0 s, 1 u, 2 a, 3 other) + (0 sound, 1 blank or duplicate, 2 truncated).
KEPT = {(0, 0): 1, (1, 0): 2, (1, 1): 2, (1, 3): 2, (2, 2): 3}
#: Adjacent kinds that are legal: su, ua, au.
LEGAL = {(0, 1), (1, 2), (2, 1)}
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
PIECE_BYTES = 8 << 20

Vector = tuple[int, int, int, int]
_STEPS: dict[tuple[Vector, int], tuple[Vector, tuple]] = {}


def step(after: Vector, code: int) -> tuple[Vector, tuple]:
    """The vector before a row with ``code``, less its minimum, given the one after it; and for each state before
    the row: the edits' initials up to and including the row's own, the state after, and their cost.

    Vectors less their minimum are few, so every pair is worked out once.
    """
    known = _STEPS.get((after, code))
    if known:
        return known
    kind, fault = divmod(code, 3)
    extra = TRUNCATED if fault == 2 else 0

    def options(q: int) -> list[tuple[int, str, int, int]]:
        """(cost to the end, initial, state after, own cost) of the row's own edits, ASCII-least first."""
        out = [(DELETE + after[q], "D", q, DELETE)]
        if fault != 1:
            if (kind, q) in KEPT:
                out.append((KEEP + extra + after[KEPT[kind, q]], "K", KEPT[kind, q], KEEP + extra))
            out.append((REROLE + extra + after[NEXT[q]], "R", NEXT[q], REROLE + extra))
        return out

    own = [min(o[0] for o in options(q)) for q in range(4)]
    cost = [min(own[q], INSERT + own[NEXT[q]], 2 * INSERT + own[NEXT[NEXT[q]]]) for q in range(4)]
    moves = []
    for q in range(4):
        letters, spent, left = "", 0, cost[q]
        while True:
            fits = [o for o in options(q) if o[0] == left]
            if fits and fits[0][1] == "D" or INSERT + cost[NEXT[q]] != left:
                _, letter, q, own_cost = fits[0]
                moves.append((letters + letter, q, spent + own_cost))
                break
            letters, spent, left, q = letters + "I", spent + INSERT, left - INSERT, NEXT[q]
    low = min(cost)
    _STEPS[after, code] = known = (tuple(c - low for c in cost), tuple(moves))
    return known


def back(codes: list[int], right: Vector) -> tuple[Vector, list[tuple]]:
    """The vector before the first row, given the one after the last; and the moves of every row."""
    moves: list[tuple] = [()] * len(codes)
    v = right
    for i in range(len(codes) - 1, -1, -1):
        v, moves[i] = step(v, codes[i])
    return v, moves


def rerun(codes: list[int], old: Vector, old_left: Vector, new: Vector) -> Vector:
    """The vector before the first row for ``new`` on the right, given that ``old`` leads to ``old_left``: as soon as
    both runs differ by a constant only, the earlier one holds."""
    for code in reversed(codes):
        if old == new:
            return old_left
        old, new = step(old, code)[0], step(new, code)[0]
    return new


def forward(moves: list[tuple], q: int) -> tuple[list[str], int, int]:
    """From state ``q``: initials of each row, the last state, the cost."""
    letters, cost = [], 0
    for m in moves:
        text, q, c = m[q]
        letters.append(text)
        cost += c
    return letters, q, cost


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """``conversation, turn, role, text`` after damage by ``crc32(conv_id:turn) % 20``; nulls are one space, but
    ``turn`` stays null.  0 drops the row, 1 empties its text, 2 takes out ``[.!?]``, 3 repeats it, 4 makes it a user's."""
    crc = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    rows = turns.select(_text("conv_id").alias("conversation"), F.col("turn").cast("bigint").alias("turn"),
                        _text("role").alias("role"), _text("text").alias("text"), crc.alias("_n")).where("_n <> 0")
    return rows.select(
        "conversation", "turn", F.when(F.col("_n") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_n") == 1, "").when(F.col("_n") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_n") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    ).drop("_copy")


class Conversations:
    """The rows of conversations in order, cut into chunks, with each chunk's way through the states.

    ``rows (conversation, turn, role, text)``: ``conversation`` is a text, not null.  Rows of a conversation
    stand by turn (null first), then role, then the text's md5.
    """

    def __init__(self, rows: DataFrame, chunk_rows: int = 4096):
        keyed = rows.select("conversation", "turn", "role", F.md5(F.col("text").cast("binary")).alias("hash"), "text")
        keyed = number_in_groups(keyed, "conversation", ["turn", "role", "hash"], "pos")
        self.rows = keyed.withColumn("chunk", F.floor(F.col("pos") / chunk_rows))
        end = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1))
        faults = self.rows.select("conversation", "chunk", "pos", "role", "hash", (end == "").alias("blank"),
                                  (~end.isin(".", "!", "?")).alias("cut"))
        # a text said before: counts meet by a partial aggregate, and only what repeats joins back
        first = (faults.where("not blank").groupBy("conversation", "role", "hash")
                 .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
        faults = faults.join(first, ["conversation", "role", "hash"], "left")
        again = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
        fault = (F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("cut"), "truncated"))
        initial = F.substring("role", 1, 1)
        kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        code = kind * 3 + F.when(fault.isin("blank", "duplicate"), 1).when(fault == "truncated", 2).otherwise(0)
        coded = faults.select("conversation", "chunk", "pos", fault.alias("fault"), code.alias("code"))
        self.chunks = materialize_table(
            coded.groupBy("conversation", "chunk")  # at most chunk_rows rows each
            .agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("c"),
                 *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
            .withColumn("codes", F.transform("c", lambda x: x["code"])).drop("c"), "chunks")
        self.entries = self._entries()

    def _entries(self) -> DataFrame:
        """``conversation, chunk, right, entry`` of conversations of several chunks: the stitched vector after
        each chunk and the state that the trace enters it in."""
        many = self.chunks.where("chunk > 0").select("conversation").distinct()
        codes = materialize_table(self.chunks.join(many, "conversation", "left_semi")
                                  .select("conversation", "chunk", "codes"), "spans")
        end = F.array(*[F.lit(x) for x in END])
        schema = "conversation string, chunk long, codes array<int>, right array<int>, left array<int>"
        names = ["conversation", "chunk", "codes", "right", "left"]

        def batch(rows: list) -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), *[pa.list_(pa.int32())] * 3]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

        def speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small_batches(batches):
                yield batch([(r["conversation"], r["chunk"], r["codes"], END, back(r["codes"], END)[0]) for r in b.to_pylist()])

        def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before = None
            for b in small_batches(batches):
                out = []
                for r in b.to_pylist():  # chunks from the right to the left
                    new = tuple(r["new"])
                    if before and before[:2] == (r["conversation"], r["chunk"] + 1):
                        new = before[2]  # the neighbour has just run in this task
                    left = rerun(r["codes"], tuple(r["right"]), tuple(r["left"]), new)
                    out.append((r["conversation"], r["chunk"], r["codes"], new, left))
                    before = (r["conversation"], r["chunk"], left)
                yield batch(out)

        state = materialize_table(codes.mapInArrow(speculate, schema), "vectors")
        while True:  # a pass settles at least the rightmost chunk that is not yet settled
            near = state.select("conversation", (F.col("chunk") - 1).alias("chunk"), F.col("left").alias("new"))
            stitched = state.join(near, ["conversation", "chunk"], "left").withColumn("new", F.coalesce("new", end))
            if stitched.where("new <> right").isEmpty():
                break
            state = materialize_table(stitched.repartitionByRange("conversation", F.desc("chunk"))
                                      .sortWithinPartitions("conversation", F.desc("chunk"))
                                      .mapInArrow(fix, schema), "vectors")

        def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small_batches(batches):
                out = []
                for r in b.to_pylist():
                    moves = back(r["codes"], tuple(r["right"]))[1]
                    out.append((r["conversation"], r["chunk"], None, r["right"], [forward(moves, q)[1] for q in range(4)]))
                yield batch(out)

        def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, q = None, 0
            for b in batches:
                out = []
                for r in b.to_pylist():
                    q = q if r["conversation"] == last else 0
                    out.append((r["conversation"], r["chunk"], r["right"], q))
                    last, q = r["conversation"], r["left"][q]
                types = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)],
                                                 names=["conversation", "chunk", "right", "entry"])

        # one short row per chunk passes through the task of its conversation
        ends = state.mapInArrow(exits, schema).drop("codes")
        return materialize_table(ends.repartition("conversation").sortWithinPartitions("conversation", "chunk").mapInArrow(
            enter, "conversation string, chunk long, right array<int>, entry int"), "entries")

    def _streams(self) -> DataFrame:
        """Rows by chunk in order; each chunk begins with a row (``pos`` -1) of its codes, vector and state."""
        last = self.chunks.groupBy("conversation").agg(F.max("chunk").alias("last"))
        heads = (self.chunks.join(self.entries, ["conversation", "chunk"], "left").join(last, "conversation")
                 .select("conversation", "chunk", F.lit(-1).cast("bigint").alias("pos"), F.lit("").alias("role"),
                         F.lit("").alias("text"), "codes",
                         F.coalesce("right", F.array(*[F.lit(x) for x in END])).alias("right"),
                         F.coalesce("entry", F.lit(0)).alias("entry"), (F.col("chunk") == F.col("last")).alias("ends")))
        rows = self.rows.select("conversation", "chunk", "pos", "role", "text")
        return (heads.unionByName(rows, allowMissingColumns=True).repartition("conversation", "chunk")
                .sortWithinPartitions("conversation", "chunk", "pos"))

    def turns(self) -> DataFrame:
        """The repaired rows: ``conversation, pos, step, edit, role, text``.  ``pos`` and ``step`` order them;
        ``pos`` is the damaged row at which the edit stands, ``edit`` its initial (K, R or I; deleted rows are gone)."""
        fields = [("conversation", pa.string()), ("pos", pa.int64()), ("step", pa.int32()), ("edit", pa.string()),
                  ("role", pa.string()), ("text", pa.string())]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple] = []

            def batch() -> pa.RecordBatch:
                b = pa.RecordBatch.from_arrays([pa.array([e[k] for e in held], t) for k, (_, t) in enumerate(fields)],
                                               names=[n for n, _ in fields])
                held.clear()
                return b

            for head, edit in _walk(batches):
                if edit and edit[2] != "D":
                    held.append((head["conversation"], *edit))
                if len(held) >= 256:
                    yield batch()
            yield batch()

        return self._streams().mapInArrow(
            run, "conversation string, pos long, step int, edit string, role string, text string")

    def digests(self) -> DataFrame:
        """``conversation, illegal, cost, audit, repaired_sha256`` of every conversation that has rows."""
        fields = [("conversation", pa.string()), ("chunk", pa.int64()), ("piece", pa.int32()), ("cost", pa.int64()),
                  ("codes", pa.list_(pa.int32())), ("audit", pa.string()), ("lines", pa.binary())]

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            """A chunk's audit and repaired lines, each with its newline, in pieces of bounded size; the first
            piece has the cost and the codes."""
            first, audit, lines, size = None, [], [], 0

            def piece(*start) -> tuple:
                row = (*start, "".join(audit), b"".join(lines))
                audit.clear()
                lines.clear()
                return row

            for head, edit in _walk(batches):
                if edit is None:
                    if first:
                        yield piece(*first)
                    first, size = [head["conversation"], head["chunk"], 0, head["cost"], head["codes"]], 0
                    continue
                audit.append(edit[2])
                if edit[2] != "D":
                    lines.append(f"{edit[3]}:{edit[4]}\n".encode())
                    size += len(lines[-1])
                if size >= PIECE_BYTES:
                    yield piece(*first)
                    first, size = [*first[:2], first[2] + 1, 0, []], 0
            if first:
                yield piece(*first)

        ends = [("conversation", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
                ("repaired_sha256", pa.string())]

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            """One conversation after the other, piece by piece: only the hash, the audit and sums are held."""
            now: dict | None = None

            def close() -> tuple:
                return now["conversation"], now["illegal"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest()

            for r in (x for b in small_batches(batches, 8) for x in b.to_pylist()):
                if now is None or r["conversation"] != now["conversation"]:
                    if now:
                        yield close()
                    now = {"conversation": r["conversation"], "illegal": 0, "cost": 0, "audit": [], "kind": None,
                           "sha": hashlib.sha256(), "between": b""}
                for code in r["codes"]:
                    now["illegal"] += now["kind"] is not None and (now["kind"], code // 3) not in LEGAL
                    now["kind"] = code // 3
                now["cost"] += r["cost"]
                now["audit"].append(r["audit"])
                if r["lines"]:  # newlines between lines, none after the last
                    now["sha"].update(now["between"] + r["lines"][:-1])
                    now["between"] = b"\n"
            if now:
                yield close()

        parts = self._streams().mapInArrow(lambda b: _batches(pieces(b), fields), "conversation string, chunk long, piece int, cost long, "
                                           "codes array<int>, audit string, lines binary")
        return (parts.repartition("conversation").sortWithinPartitions("conversation", "chunk", "piece")
                .mapInArrow(lambda b: _batches(join(b), ends), "conversation string, illegal long, cost long, audit string, repaired_sha256 string"))


def _batches(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size; the texts and lines stand last in a row."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + len(row[-2])
        if len(held) >= 256 or size >= PIECE_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields)], names=[n for n, _ in fields])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields)], names=[n for n, _ in fields])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, tuple | None]]:
    """The edits of sorted streams: each chunk's head alone, with its ``cost``, then ``(head, (pos, step, initial,
    role, text))`` of every edit.  What is inserted after the last row stands at that row."""
    head: dict = {}
    for b in small_batches(batches):
        for r in b.to_pylist():
            if r["pos"] < 0:
                letters, q, cost = forward(back(r["codes"], tuple(r["right"]))[1], r["entry"])
                tail = END[q] // INSERT if r["ends"] else 0
                head, i, q = r | {"cost": cost + tail * INSERT}, 0, r["entry"]
                yield head, None
                continue
            edits = letters[i] + "I" * (tail if i + 1 == len(letters) else 0)
            for n, e in enumerate(edits):
                q = q if e == "D" else KEPT[head["codes"][i] // 3, q] if e == "K" else NEXT[q]
                yield head, (r["pos"], n, e, r["role"] if e in "DK" else ROLE[q], "" if e == "I" else r["text"])
            i += 1


def repair(turns: DataFrame, chunk_rows: int = 4096) -> DataFrame:
    """Damage ``turns (conv_id, turn, role, text)`` and describe each conversation's faults and cheapest repair.

    Returns for every ``conv_id`` (null is one too): ``gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``.  Nulls are one space, but a null turn stands first and leaves no gap.  Equal turns
    stand by role and the text's md5; rows alike are interchangeable.  A text without anything but white
    space is blank.  No rows after damage: zeros, empty audit, hash of the empty string.  Empty table: no rows.
    Other columns of ``turns`` are not read.
    """
    found = Conversations(damage(turns), chunk_rows)
    gaps = (found.rows.where("turn is not null").groupBy("conversation", "turn").agg(F.lit(1).alias("_1"))
            .groupBy("conversation").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps")))
    counts = found.chunks.groupBy("conversation").agg(*[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    out = (turns.select(_text("conv_id").alias("conversation")).distinct().join(gaps, "conversation", "left")
           .join(counts, "conversation", "left").join(found.digests(), "conversation", "left"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        F.when(F.col("conversation") != " ", F.col("conversation")).cast("bigint").alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
