"""Conversations brought into an order of turns that training can use, by the cheapest edits.

The roles that are left have to read ``(s?(ua)+)?`` by their initials. A turn can be kept (0),
get the role user or assistant (1), or be deleted (2; blank and duplicate turns have to be);
an empty turn of either role can be inserted anywhere (5); a truncated turn that stays costs 5
more. Of equally cheap edits the least string of their initials (D, I, K, R) is taken.

The automaton of that pattern has four states, so a turn is a 4 x 4 matrix of costs that
depends on its symbol alone (initial of its role, and fault), and turns one after another are
the min-plus product of theirs. Equal symbols in a row are one run; a run of ``n`` is advanced
by the cached powers of its matrix for the bits of ``n``. Going back from the end this gives
the cost to go at every run; the edits are then unrolled from the front, letter by letter.

Products can be taken in any grouping, so a conversation need not be in one task. Equal turns
are counted before anything is sorted; turns are range-sorted over all tasks by conversation
and turn and cut into segments of bounded size. A segment that holds its whole conversation
is finished where it is. Of the others only the matrices go by conversation (first backward
for the cost to go, then forward for the states), and each is unrolled in its own task.

Cases: NULL in role or text is one space, so such a text is blank and such a role has to be
changed; turns are taken in order of turn (NULL first), then role, then text; repeated rows
follow each other, the second is a duplicate; rows of a NULL id are one conversation; other
columns are not read; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.llm import common

WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL_PAIRS = ("su", "ua", "au")
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
NEVER = 1 << 60
#: States of the pattern: nothing yet, after s, after u, after a.
STATES = 4
FINAL = (0, NEVER, NEVER, 0)
#: From each state: the state after u, after a and after s, or None.
NEXT = {"u": (2, 2, None, 2), "a": (None, None, 3, None), "s": (1, None, None, None)}
#: A symbol is the initial of a role (or another sign) and whether the turn is truncated; this
#: one stands for turns that have to be deleted.
GONE = "x"
#: Rows and text bytes of a segment.
SEGMENT_ROWS, SEGMENT_BYTES = 20_000, 2 << 20

Vector = tuple[int, ...]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def _edges(letter: str, cost: int) -> np.ndarray:
    found = np.full((STATES, STATES), NEVER, np.int64)
    for state, then in enumerate(NEXT[letter]):
        if then is not None:
            found[state, then] = cost
    return found


def _insertions() -> np.ndarray:
    """Any number of insertions between two turns."""
    one = np.minimum(_edges("u", INSERT), _edges("a", INSERT))
    one[range(STATES), range(STATES)] = 0
    return product(product(one, one), product(one, one))


INSERTIONS = _insertions()


def symbol_of(role: str, truncated: bool) -> str:
    initial = role[:1] if role[:1] in NEXT else "-"
    return initial + "!" if truncated else initial


@lru_cache(None)
def power(symbol: str, exponent: int) -> np.ndarray:
    """The matrix of ``2 ** exponent`` turns of a symbol, insertions before each included."""
    if exponent:
        half = power(symbol, exponent - 1)
        return product(half, half)
    found = np.full((STATES, STATES), NEVER, np.int64)
    found[range(STATES), range(STATES)] = DELETE
    if symbol != GONE:
        more = TRUNCATED if symbol[-1] == "!" else 0
        choices = [_edges("u", REROLE + more), _edges("a", REROLE + more)]
        if symbol[0] in NEXT:
            choices.append(_edges(symbol[0], more))
        found = np.minimum.reduce([found, *choices])
    return product(INSERTIONS, found)


def run_matrix(symbol: str, count: int) -> np.ndarray:
    found, exponent = None, 0
    while count:
        if count & 1:
            found = power(symbol, exponent) if found is None else product(found, power(symbol, exponent))
        count, exponent = count >> 1, exponent + 1
    return found


def apply(matrix: np.ndarray, vector: Vector) -> Vector:
    return tuple(np.minimum((matrix + np.array(vector, np.int64)).min(axis=1), NEVER).tolist())


@lru_cache(1 << 16)
def _back(symbol: str, exponent: int, shape: Vector) -> Vector:
    return apply(power(symbol, exponent), shape)


def back(symbol: str, count: int, vector: Vector) -> Vector:
    """Cost to go before ``count`` turns of a symbol, from that after them."""
    exponent = 0
    while count:
        if count & 1:
            least = min(vector)
            shape = _back(symbol, exponent, tuple(min(v - least, NEVER) for v in vector))
            vector = tuple(min(v + least, NEVER) for v in shape)
        count, exponent = count >> 1, exponent + 1
    return vector


def at_end() -> Vector:
    return apply(INSERTIONS, FINAL)


def _after(letter: str, state: int, symbol: str) -> int | None:
    """State after an edit's result."""
    if letter == "K":
        return NEXT[symbol[0]][state] if symbol[0] in NEXT else None
    return 3 if state == 2 else 2  # the role that may stand here


def unroll(runs: list[tuple[str, int]], end: Vector, state: int, last: bool) -> tuple[str, int]:
    """Letters of the edits of some turns from ``state``, and the state after them.

    ``end`` is the cost to go after them; with ``last`` no turn follows, so that what has to
    be inserted at the end is among the letters.
    """
    after = [end]
    for symbol, count in reversed(runs):
        after.append(back(symbol, count, after[-1]))
    after = after[-2::-1]
    letters: list[str] = []
    for (symbol, count), vector in zip(runs, after):
        if symbol == GONE:  # an insertion is as good behind it
            letters.append("D" * count)
            continue
        steps = [vector]
        for _ in range(count):
            steps.append(back(symbol, 1, steps[-1]))
        more = TRUNCATED if symbol[-1] == "!" else 0
        for here, then in zip(steps[:0:-1], steps[-2::-1]):
            while True:
                kept, changed = _after("K", state, symbol), _after("R", state, symbol)
                if DELETE + then[state] == here[state]:
                    letters.append("D")
                    break
                if INSERT + here[changed] == here[state]:
                    letters.append("I")
                    state = changed
                elif kept is not None and more + then[kept] == here[state]:
                    letters.append("K")
                    state = kept
                    break
                else:
                    letters.append("R")
                    state = changed
                    break
    while last and FINAL[state]:
        letters.append("I")
        state = 3 if state == 2 else 2
    return "".join(letters), state


def edited(letters: str, state: int, rows: Iterable[tuple[str, str, int]]) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that the edits leave; ``rows`` have role, text and count."""
    turns = ((r, t) for r, t, n in rows for _ in range(n))
    for letter in letters:
        role = "assistant" if state == 2 else "user"
        if letter == "I":
            yield role, ""
            state = 3 if state == 2 else 2
            continue
        own, text = next(turns)
        if letter == "K":
            state = NEXT[own[0]][state]
            yield own, text
        elif letter == "R":
            state = 3 if state == 2 else 2
            yield role, text


class Segment:
    """Turns of a conversation that follow each other, as they are read."""

    def __init__(self, conversation, seq: int):
        self.conversation, self.seq = conversation, seq
        self.rows: list[tuple[str, str, int]] = []
        self.runs: list[tuple[str, int]] = []
        self.bytes = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_initial = self.last_initial = None
        self.first_turn = self.last_turn = None

    def _run(self, symbol: str, count: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1] = (symbol, self.runs[-1][1] + count)
        elif count:
            self.runs.append((symbol, count))

    def add(self, turn, role: str, text: str, count: int, seen: bool) -> None:
        if not count:
            return
        self.rows.append((role, text, count))
        self.bytes += len(text)
        stripped = text.rstrip(WHITE)
        if not stripped:
            self.blank += count
            self._run(GONE, count)
        else:
            if not seen:
                cut = stripped[-1] not in ENDS
                self.truncated += cut
                self._run(symbol_of(role, cut), 1)
            self.duplicate += count - (not seen)
            self._run(GONE, count - (not seen))
        initial = role[:1]
        if self.last_initial is None:
            self.first_initial = initial
        else:
            self.illegal += self.last_initial + initial not in LEGAL_PAIRS
        self.illegal += (count - 1) * (initial + initial not in LEGAL_PAIRS)
        self.last_initial = initial
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn

    def matrix(self) -> list[int]:
        found = np.full((STATES, STATES), NEVER, np.int64)
        found[range(STATES), range(STATES)] = 0
        for symbol, count in self.runs:
            found = product(found, run_matrix(symbol, count))
        return found.ravel().tolist()


#: Columns of a segment. ``whole`` ones have their cost, edits and lines; others their matrix,
#: runs and rows.
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_ROW = pa.struct([("role", pa.string()), ("text", pa.string()), ("n", pa.int64())])
_RUN = pa.struct([("symbol", pa.string()), ("n", pa.int64())])


def _schema(conversation: str, turn: str) -> str:
    return (
        f"conversation {conversation}, part int, seq bigint, whole boolean, "
        + "".join(f"{c} bigint, " for c in _COUNTS)
        + f"first_turn {turn}, last_turn {turn}, first_initial string, last_initial string, cost bigint, audit string, "
        "lines array<struct<role: string, text: string>>, matrix array<bigint>, "
        "runs array<struct<symbol: string, n: bigint>>, rows array<struct<role: string, text: string, n: bigint>>"
    )


def _batch(segments: list[tuple[Segment, bool]], part: int, conversation: pa.DataType, turn: pa.DataType) -> pa.RecordBatch:
    made: dict[str, list] = {c: [] for c in ("cost", "audit", "lines", "matrix", "runs", "rows")}
    for s, whole in segments:
        cost = audit = lines = matrix = runs = rows = None
        if whole:
            end = at_end()
            before = end
            for symbol, count in reversed(s.runs):
                before = back(symbol, count, before)
            audit, _ = unroll(s.runs, end, 0, True)
            cost, lines = before[0], [{"role": r, "text": t} for r, t in edited(audit, 0, s.rows)]
        else:
            matrix = s.matrix()
            runs = [{"symbol": symbol, "n": n} for symbol, n in s.runs]
            rows = [{"role": r, "text": t, "n": n} for r, t, n in s.rows]
        for name, value in zip(made, (cost, audit, lines, matrix, runs, rows)):
            made[name].append(value)
    own = [s for s, _ in segments]
    kinds = (pa.int64(), pa.string(), pa.list_(_TURN), pa.list_(pa.int64()), pa.list_(_RUN), pa.list_(_ROW))
    return pa.RecordBatch.from_pydict(
        {
            "conversation": pa.array([s.conversation for s in own], conversation),
            "part": pa.array([part] * len(own), pa.int32()),
            "seq": pa.array([s.seq for s in own], pa.int64()),
            "whole": pa.array([w for _, w in segments]),
            **{c: pa.array([int(getattr(s, c)) for s in own], pa.int64()) for c in _COUNTS},
            "first_turn": pa.array([s.first_turn for s in own], turn),
            "last_turn": pa.array([s.last_turn for s in own], turn),
            "first_initial": pa.array([s.first_initial for s in own], pa.string()),
            "last_initial": pa.array([s.last_initial for s in own], pa.string()),
            **{name: pa.array(values, kind) for (name, values), kind in zip(made.items(), kinds)},
        }
    )


def _segments(batches: Iterable[pa.RecordBatch], rows_at_most: int, bytes_at_most: int) -> Iterator[pa.RecordBatch]:
    """Segments of turns in order. The first and the last conversation may go on in other tasks."""
    part, seq = TaskContext.get().partitionId(), itertools.count()
    current: Segment | None = None
    whole, done, held = False, [], 0
    kinds = None
    for batch in batches:
        kinds = kinds or (batch.schema.field("conversation").type, batch.schema.field("turn").type)
        columns = [batch.column(c).to_pylist() for c in ("conversation", "turn", "role", "text", "n", "seen")]
        for conversation, turn, role, text, count, seen in zip(*columns):
            if current is None:
                current = Segment(conversation, next(seq))
            elif conversation != current.conversation:
                done.append((current, whole))
                held += current.bytes
                current, whole = Segment(conversation, next(seq)), True
            elif len(current.rows) >= rows_at_most or current.bytes >= bytes_at_most:
                done.append((current, False))
                held += current.bytes
                current, whole = Segment(conversation, next(seq)), False
            if held >= bytes_at_most or len(done) >= rows_at_most:
                yield _batch(done, part, *kinds)
                done, held = [], 0
            current.add(turn, role, text, count, seen)
    if current is not None:
        yield _batch([*done, (current, False)], part, *kinds)


def _in_order(df: DataFrame, run, schema: str, descending: bool = False) -> DataFrame:
    """``run`` over the rows of each conversation together and in order, as a stream."""
    order = [F.desc(c) if descending else F.col(c) for c in ("part", "seq")]
    return df.repartition("conversation").sortWithinPartitions("conversation", *order).mapInArrow(run, schema)


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, bool, dict]]:
    """Rows with their conversation, and whether it begins."""
    before: object = NotImplemented
    for batch in batches:
        for row in batch.to_pylist():
            yield row["conversation"], row["conversation"] != before, row
            before = row["conversation"]


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 1_000) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_pylist(some, schema)


def _costs_to_go(segments: DataFrame) -> DataFrame:
    """Of each segment of a cut conversation: the cost to go after and before it, whether it is the last."""
    vector = pa.list_(pa.int64())
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("after", vector), ("before", vector), ("last", pa.bool_())])

    def run(batches):
        def rows():
            before: Vector = ()
            for _, begins, row in _grouped(batches):
                after = at_end() if begins else before
                before = apply(np.array(row["matrix"], np.int64).reshape(STATES, STATES), after)
                yield {"part": row["part"], "seq": row["seq"], "after": after, "before": before, "last": begins}

        yield from _batched(rows(), schema)

    kind = "part int, seq bigint, after array<bigint>, before array<bigint>, last boolean"
    return _in_order(segments.select("conversation", "part", "seq", "matrix"), run, kind, descending=True)


def _runs(row: dict) -> list[tuple[str, int]]:
    return [(r["symbol"], r["n"]) for r in row["runs"]]


def _states(segments: DataFrame) -> DataFrame:
    """The state in which each segment of a cut conversation begins; ``segments`` have ``after`` and ``last``."""

    def exits(batches):
        for batch in batches:
            found = [
                [unroll(_runs(row), tuple(row["after"]), state, row["last"])[1] for state in range(STATES)]
                for row in batch.to_pylist()
            ]
            names = ("conversation", "part", "seq")
            yield pa.RecordBatch.from_pydict(
                {**{c: batch.column(c) for c in names}, "exits": pa.array(found, pa.list_(pa.int32()))}
            )

    def enter(batches):
        def rows():
            state = 0
            for _, begins, row in _grouped(batches):
                state = 0 if begins else state
                yield {"part": row["part"], "seq": row["seq"], "state": state, "first": begins}
                state = row["exits"][state]

        schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("state", pa.int32()), ("first", pa.bool_())])
        yield from _batched(rows(), schema)

    kind = segments.schema["conversation"].dataType.simpleString()
    wanted = segments.select("conversation", "part", "seq", "runs", "after", "last")
    found = wanted.mapInArrow(exits, f"conversation {kind}, part int, seq bigint, exits array<int>")
    return _in_order(found, enter, "part int, seq bigint, state int, first boolean")


_PIECE = (
    "conversation", "part", "seq", "whole", *_COUNTS, "first_turn", "last_turn", "first_initial", "last_initial",
    "cost", "audit", "lines",
)


def _finished(segments: DataFrame) -> DataFrame:
    """Cut conversations: edits and lines of each segment; ``segments`` have what both passes found."""

    def run(batches):
        for batch in batches:
            costs, audits, lines = [], [], []
            needed = batch.select(["runs", "rows", "after", "before", "last", "first", "state"])
            for row in needed.to_pylist():
                letters, _ = unroll(_runs(row), tuple(row["after"]), row["state"], row["last"])
                costs.append(row["before"][0] if row["first"] else 0)
                audits.append(letters)
                own = ((r["role"], r["text"], r["n"]) for r in row["rows"])
                lines.append([{"role": r, "text": t} for r, t in edited(letters, row["state"], own)])
            made = {
                "cost": pa.array(costs, pa.int64()),
                "audit": pa.array(audits, pa.string()),
                "lines": pa.array(lines, pa.list_(_TURN)),
            }
            yield pa.RecordBatch.from_pydict({c: made[c] if c in made else batch.column(c) for c in _PIECE})

    return segments.mapInArrow(run, segments.select(*_PIECE).schema)


def repair(
    df: DataFrame,
    conversation_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    count_col: str | None = None,
    rows_at_most: int = SEGMENT_ROWS,
    bytes_at_most: int = SEGMENT_BYTES,
) -> DataFrame:
    """Pieces of the repaired conversations, in order of ``part`` and ``seq`` within each.

    ``count_col`` says how often a row stands there (0: its conversation is still named).
    Use :func:`turns` for the turns that are left and :func:`summaries` for one row of each
    conversation. The pieces are written to the shared folder.
    """
    spark = df.sparkSession
    keys = ["conversation", "turn", "role", "text"]
    source = df.select(
        F.col(conversation_col).alias("conversation"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        (F.col(count_col) if count_col else F.lit(1)).cast("bigint").alias("n"),
    )
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    counted = common.stored(source.groupBy(*keys).agg(F.sum("n").alias("n")).withColumn("digest", digest), "turns")
    # Texts of a conversation that are there under several turns: all but the first are duplicates.
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = common.stored(
        counted.where((F.col("n") > 0) & F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
        .groupBy("conversation", "digest")
        .agg(F.min(at).alias("first"), F.count("*").alias("k"))
        .where("k > 1")
        .select(F.col("conversation").alias("c"), F.col("digest").alias("d"), "first"),
        "again",
    )
    same = counted["conversation"].eqNullSafe(again["c"]) & (counted["digest"] == again["d"])
    seen = F.coalesce(F.col("first") != at, F.lit(False))
    marked = counted.join(again, same, "left").select(*keys, "n", seen.alias("seen"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = marked.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    kinds = (marked.schema[c].dataType.simpleString() for c in ("conversation", "turn"))
    segments = common.stored(
        ordered.mapInArrow(lambda b: _segments(b, rows_at_most, bytes_at_most), _schema(*kinds)), "segments"
    )
    cut = segments.where("NOT whole")
    known = common.stored(cut.join(_costs_to_go(cut), ["part", "seq"]), "known")
    finished = _finished(known.join(_states(known), ["part", "seq"]))
    return segments.where("whole").select(*_PIECE).unionByName(common.stored(finished, "finished"))


def turns(pieces: DataFrame) -> DataFrame:
    """``conversation``, ``role`` and ``text`` of every turn that is left; in order of ``part``, ``seq``, ``place``."""
    return pieces.select("conversation", "part", "seq", F.posexplode("lines").alias("place", "line")).select(
        "conversation", "part", "seq", "place", "line.role", "line.text"
    )


_TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summaries(pieces: DataFrame, conversation_col: str = "conv_id") -> DataFrame:
    """One row of each conversation: its faults, ``cost``, ``audit`` and ``repaired_sha256``.

    The digest is of the turns left, as ``role:text`` with line feeds between. For a cut
    conversation it is taken piece by piece, as it has to be taken in order.
    """
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    joined = F.array_join(F.transform("lines", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = pieces.where("whole").select(
        "conversation",
        gaps.alias("gaps"),
        *_TOTALS[1:],
        "audit",
        F.sha2(joined, 256).alias("repaired_sha256"),
    )
    kind = pieces.schema["conversation"].dataType.simpleString()
    cut = pieces.where("NOT whole")

    def run(batches):
        field = None

        def rows():
            nonlocal field
            total: dict = {}

            def ended():
                turn = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["turns"]
                return {
                    "conversation": total["conversation"],
                    "gaps": turn,
                    **{c: total[c] for c in _TOTALS[1:]},
                    "audit": "".join(total["audit"]),
                    "repaired_sha256": total["hash"].hexdigest(),
                }

            for conversation, begins, row in _grouped(batches):
                if begins:
                    if total:
                        yield ended()
                    total = dict.fromkeys((*_TOTALS[1:], "turns", "lines"), 0)
                    total |= {"conversation": conversation, "audit": [], "hash": hashlib.sha256()}
                    total |= {"low": None, "high": None, "initial": None}
                for c in (*_TOTALS[1:], "turns"):
                    total[c] += row[c]
                if row["first_turn"] is not None:
                    total["turns"] -= total["high"] == row["first_turn"]
                    total["low"] = row["first_turn"] if total["low"] is None else total["low"]
                    total["high"] = row["last_turn"]
                if row["first_initial"] is not None:
                    met = total["initial"]
                    total["illegal"] += met is not None and met + row["first_initial"] not in LEGAL_PAIRS
                    total["initial"] = row["last_initial"]
                total["audit"].append(row["audit"])
                for line in row["lines"]:
                    total["hash"].update(("\n" if total["lines"] else "").encode() + f"{line['role']}:{line['text']}".encode())
                    total["lines"] += 1
            if total:
                yield ended()

        first = next(batches, None)
        if first is None:
            return
        field = first.schema.field("conversation").type
        batches = itertools.chain([first], batches)
        schema = pa.schema(
            [("conversation", field), *((c, pa.int64()) for c in _TOTALS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
        )
        yield from _batched(rows(), schema, 100)

    named = f"conversation {kind}, " + "".join(f"{c} bigint, " for c in _TOTALS) + "audit string, repaired_sha256 string"
    return whole.unionByName(_in_order(cut, run, named)).withColumnRenamed("conversation", conversation_col)


def damaged(
    df: DataFrame,
    conversation_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Faults by a hash of conversation and turn: a row in twenty each is dropped (``n`` 0), loses its
    text, its sentence ends, is repeated (``n`` 2) or is given to the user. For tests of repair."""
    space = F.lit(" ")
    conversation, turn, role, text = (
        F.coalesce(F.col(c).cast("string"), space) for c in (conversation_col, turn_col, role_col, text_col)
    )
    fate = F.crc32(F.concat(conversation, F.lit(":"), turn)) % 20
    dropped = fate == 0
    return df.select(
        F.col(conversation_col),
        F.col(turn_col),
        F.when(dropped, "").when(fate == 4, "user").otherwise(role).alias(role_col),
        F.when(dropped | (fate == 1), "").when(fate == 2, F.translate(text, ENDS, "")).otherwise(text).alias(text_col),
        F.when(dropped, 0).when(fate == 3, 2).otherwise(1).alias("n"),
    )
