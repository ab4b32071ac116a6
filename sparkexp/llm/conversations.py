"""Conversation structure repair.

A conversation is legal when its roles' initials read ``(s?(ua)+)?``. Its turns
can be kept, given another role or deleted, and empty turns can be inserted; the
cheapest edits, spelled by their initials (D, I, K, R), are its audit.

The audit comes from a persistent dynamic program over the four states of that
pattern. A state's best audit is a linked node that shares its prefix with all
others; nodes carry a rolling hash and their 2^j-th ancestors, so that of two
equally cheap audits the smaller one is found by a search for their longest
common prefix. What equal hashes claim is then compared letter by letter, down
from the last shared node.

Only facts of a fixed size (initial, fault, hashes, copies) travel for that, sorted
over all tasks, and no task needs a whole conversation: runs of at most ``CHUNK``
rows give the best audit from each state to each state, and runs of one
conversation are put together by the same comparison of linked nodes. Texts move
once, to meet their audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkexp.llm.text import hash128, strip_space

#: Rows worked on at a time.
CHUNK = 4096
# States: nothing yet, after s, after u, after a. Legal ends are nothing and a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
ENDS = (START, AFTER_A)
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
# Faults of a row.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Initials of legal neighbours.
LEGAL = ("su", "ua", "au")

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def keep_state(state: int, initial: str) -> int | None:
    """State after a kept turn; None if the pattern does not allow it."""
    if initial == "s":
        return AFTER_S if state == START else None
    if initial == "u":
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == "a" and state == AFTER_U else None


def put_state(state: int) -> int:
    """State after a turn that was given a role or inserted: user unless a user
    spoke last."""
    return AFTER_A if state == AFTER_U else AFTER_U


class Audits:
    """Strings as linked nodes: a node is its parent's string and a piece more."""

    ROOT = 0

    def __init__(self, prime: int = (1 << 61) - 1, base: int = 0x1F3D5B79A2C4E68D):
        self.prime, self.base = prime, base % prime
        self.up: list[list[int]] = [[]]
        self.piece, self.length, self.hash = [""], [0], [0]
        self.inner: dict[int, list[int]] = {}

    def _roll(self, h: int, piece: str) -> int:
        for ch in piece:
            h = (h * self.base + ord(ch)) % self.prime
        return h

    def add(self, v: int, piece: str) -> int:
        if not piece:
            return v
        up, j = [v], 0
        while j < len(self.up[up[j]]):
            up.append(self.up[up[j]][j])
            j += 1
        self.up.append(up)
        self.piece.append(piece)
        self.length.append(self.length[v] + len(piece))
        self.hash.append(self._roll(self.hash[v], piece))
        return len(self.up) - 1

    def _over(self, v: int, n: int) -> int:
        """The first of v's line whose string has n letters or more."""
        for j in range(len(self.up[v]) - 1, -1, -1):
            if j < len(self.up[v]) and self.length[self.up[v][j]] >= n:
                v = self.up[v][j]
        return v

    def _prefix_hash(self, v: int, n: int) -> int:
        w = self._over(v, n)
        if self.length[w] == n:
            return self.hash[w]
        p = self.up[w][0]
        if w not in self.inner:
            run = [self.hash[p]]
            for ch in self.piece[w]:
                run.append((run[-1] * self.base + ord(ch)) % self.prime)
            self.inner[w] = run
        return self.inner[w][n - self.length[p]]

    def letter(self, v: int, n: int) -> str:
        w = self._over(v, n + 1)
        return self.piece[w][n - self.length[self.up[w][0]]]

    def text(self, v: int, start: int = 0) -> str:
        parts = []
        while v and self.length[v] > start:
            parts.append(self.piece[v])
            v = self.up[v][0]
        return "".join(reversed(parts))[max(0, start - self.length[v]) :]

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix."""
        low, high = 0, min(self.length[a], self.length[b])
        while low < high:
            mid = (low + high + 1) // 2
            if self._prefix_hash(a, mid) == self._prefix_hash(b, mid):
                low = mid
            else:
                high = mid - 1
        return self._verified(a, b, low)

    def _verified(self, a: int, b: int, n: int) -> int:
        """n, or the place of an earlier difference that equal hashes hid."""
        x, y = self._over(a, n), self._over(b, n)
        while x != y:
            if self.length[x] >= self.length[y]:
                x = self.up[x][0]
            else:
                y = self.up[y][0]
        shared = min(self.length[x], n)
        left, right = self.text(self._over(a, n), shared), self.text(self._over(b, n), shared)
        for k in range(n - shared):
            if left[k] != right[k]:
                return shared + k
        return n

    def less(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether a's string and x come before b's string and y."""
        if a == b:
            return x < y
        n = self.common(a, b)
        if n < min(self.length[a], self.length[b]):
            return self.letter(a, n) < self.letter(b, n)
        return self.text(a, n) + x < self.text(b, n) + y


class Best:
    """Cheapest audit in each state, as (cost, node); smaller audits first."""

    def __init__(self, audits: Audits, at: dict[int, tuple[int, int]]):
        self.audits, self.at = audits, at

    def step(self, moves: list[tuple[int, int, int, str]], keep: bool = False) -> None:
        """Take moves (from state, to state, cost, letters); ``keep`` lets states
        stay as they are."""
        found: dict[int, tuple[int, int, str]] = {q: (c, v, "") for q, (c, v) in self.at.items()} if keep else {}
        for q, r, cost, letters in moves:
            if q not in self.at:
                continue
            c, v = self.at[q]
            c += cost
            old = found.get(r)
            if old is None or c < old[0] or (c == old[0] and self.audits.less(v, letters, old[1], old[2])):
                found[r] = (c, v, letters)
        self.at = {r: (c, self.audits.add(v, letters)) for r, (c, v, letters) in found.items()}

    def insert(self) -> None:
        self.step([(q, AFTER_U, INSERT, "I") for q in (START, AFTER_S, AFTER_A)], keep=True)
        self.step([(AFTER_U, AFTER_A, INSERT, "I")], keep=True)

    def row(self, initial: str, fault: int, copies: int) -> None:
        moves = [(q, q, DELETE, "D") for q in STATES]
        if fault not in (BLANK, DUPLICATE):
            more = CUT_OFF if fault == TRUNCATED else 0
            for q in STATES:
                r = keep_state(q, initial)
                if r is not None:
                    moves.append((q, r, more, "K"))
                moves.append((q, put_state(q), more + REROLE, "R"))
        self.step(moves)
        if copies > 1:
            # Further copies must go, and before any insertion: D comes first.
            self.step([(q, q, DELETE * (copies - 1), "D" * (copies - 1)) for q in STATES])
        self.insert()

    def pick(self) -> tuple[int, int]:
        """Cost and node of the best legal end."""
        self.step([(q, START, 0, "") for q in ENDS])
        return self.at[START]


class Chunk:
    """A run of rows of one conversation: (turn, initial, fault, copies) in order."""

    def __init__(self, rows: list[tuple], from_start: bool):
        self.cost, self.audit = [None] * 16, [None] * 16
        self.first = self.last = ""
        self.n = self.illegal = self.distinct = 0
        self.faults = [0] * 4
        self.lo = self.hi = self.last_turn = None
        for turn, initial, fault, copies in rows:
            if not copies:
                continue
            self.illegal += (self.n > 0 and self.last + initial not in LEGAL) + copies - 1
            self.first = self.first if self.n else initial
            self.last = initial
            self.n += copies
            self.faults[fault] += 1
            self.faults[BLANK if fault == BLANK else DUPLICATE] += copies - 1
            if turn is not None:
                self.distinct += self.hi is None or turn != self.hi
                self.lo = turn if self.lo is None else self.lo
                self.hi = turn
        audits = Audits()
        for q in STATES if not from_start else (START,):
            best = Best(audits, {q: (0, Audits.ROOT)})
            best.insert()
            for _, initial, fault, copies in rows:
                if copies:
                    best.row(initial, fault, copies)
            for r, (c, v) in best.at.items():
                self.cost[4 * q + r], self.audit[4 * q + r] = c, audits.text(v)


_CHUNK = (
    "turn0 long, g1 long, g2 long, n long, first string, last string, illegal long, distinct long, lo long, hi long, "
    "blank long, duplicate long, truncated long, costs array<long>, audits array<string>"
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _arrow(conv: pa.DataType, names: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([("conv", conv), *[(n, kinds[t]) for n, t in (x.strip().split(" ") for x in names.split(","))]])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _stream(batches, made, names: str) -> Iterator[pa.RecordBatch]:
    """Rows made from rows, batch by batch; the first column keeps its type."""
    batches = iter(batches)
    first = next(batches, None)
    if first is not None:
        yield from _batches(made(_rows(chain([first], batches))), _arrow(first.schema.field(0).type, names))


def _chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Runs of rows from sorted facts (conv, turn, g1, g2, initial, fault, copies)."""
    held: list[tuple] = []
    # A task's first conversation may have begun in another task.
    started = False

    def out():
        c = Chunk([(t, i, f, n) for _, t, _, _, i, f, n in held], started)
        return (*held[0][:4], c.n, c.first, c.last, c.illegal, c.distinct, c.lo, c.hi,
                c.faults[BLANK], c.faults[DUPLICATE], c.faults[TRUNCATED], c.cost, c.audit)

    for row in rows:
        if held and (row[0] != held[0][0] or len(held) >= CHUNK):
            yield out()
            started = row[0] != held[0][0]
            held = []
        held.append(row)
    if held:
        yield out()


_SUMMARY = ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


def _join_chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row per conversation from its runs in order."""
    state = None

    def out():
        conv, best, s = state
        cost, v = best.pick()
        gaps = s["hi"] - s["lo"] + 1 - s["distinct"] if s["lo"] is not None else 0
        return (conv, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], cost, best.audits.text(v))

    for conv, _, _, _, n, first, last, illegal, distinct, lo, hi, blank, duplicate, truncated, costs, audit in rows:
        if state is None or state[0] != conv:
            if state is not None:
                yield out()
            zero = dict.fromkeys(("n", "blank", "duplicate", "truncated", "illegal", "distinct"), 0) | {"lo": None, "hi": None, "last": ""}
            state = (conv, Best(Audits(), {START: (0, Audits.ROOT)}), zero)
        _, best, s = state
        best.step([(q, r, costs[4 * q + r], audit[4 * q + r]) for q in STATES for r in STATES if costs[4 * q + r] is not None])
        if n:
            s["illegal"] += illegal + (s["n"] > 0 and s["last"] + first not in LEGAL)
            s["last"] = last
            s["distinct"] += distinct - (lo is not None and s["hi"] == lo)
            s["lo"], s["hi"] = lo if s["lo"] is None else s["lo"], s["hi"] if hi is None else hi
            for k, x in (("n", n), ("blank", blank), ("duplicate", duplicate), ("truncated", truncated)):
                s[k] += x
    if state is not None:
        yield out()


def _prepared(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, copies_col: str | None) -> DataFrame:
    c = lambda x: F.col(f"`{x}`")
    role, text = (F.coalesce(c(x), F.lit(" ")) for x in (role_col, text_col))
    copies = F.coalesce(c(copies_col), F.lit(1)) if copies_col else F.lit(1)
    d = turns.select(c(id_col).alias("conv"), c(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))
    g1, g2 = hash128(F.col("role"), F.col("text"))
    return d.withColumns({"g1": g1, "g2": g2})


def audit_conversations(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None
) -> DataFrame:
    """One row per conversation: the id, ``gaps`` in its turn numbers, its
    ``blank``, ``duplicate`` and ``truncated`` rows (first fault only), ``illegal``
    neighbours, and ``cost`` and ``audit`` of the cheapest edits.

    Rows are taken by turn, NULL first; rows of one turn in an order that their
    content fixes, equal ones next to each other. NULL roles and texts count as one
    space. All rows with a NULL id are one conversation. ``copies_col`` says how
    often a row stands there; a conversation of which no row stands has zeros and an
    empty audit. An empty table gives an empty table; other columns are ignored.
    """
    conv = dict(turns.dtypes)[id_col]
    d = _prepared(turns, id_col, turn_col, role_col, text_col, copies_col)
    core = strip_space(F.col("text"))
    facts = d.select(
        "conv", "turn", "g1", "g2", F.substring("role", 1, 1).alias("initial"),
        F.when(core == "", BLANK).when(F.right(core, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED).alias("fault"), "copies",
    )
    one = facts.groupBy("conv", "turn", "g1", "g2").agg(F.max("initial").alias("initial"), F.max("fault").alias("fault"), F.sum("copies").alias("copies"))
    seen = one.where("copies > 0").groupBy("conv", "g1", "g2").agg(F.min(F.struct("turn")).alias("f"), F.count("*").alias("k")).where("k > 1")
    seen = seen.select(F.col("conv").alias("s_conv"), F.col("g1").alias("s1"), F.col("g2").alias("s2"), F.col("f.turn").alias("first_turn"), F.lit(True).alias("again"))
    j = one.join(seen, F.col("conv").eqNullSafe(F.col("s_conv")) & (F.col("g1") == F.col("s1")) & (F.col("g2") == F.col("s2")), "left")
    later = F.coalesce("again", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    fault = F.when(later & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault"))
    keys = ["conv", "turn", "g1", "g2"]
    rows = j.select(*keys, "initial", fault.cast("int").alias("fault"), "copies")
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    chunks = rows.mapInArrow(lambda b: _stream(b, _chunks, _CHUNK), f"conv {conv}, {_CHUNK}")
    chunks = chunks.repartition("conv").sortWithinPartitions("conv", "turn0", "g1", "g2")
    return chunks.mapInArrow(lambda b: _stream(b, _join_chunks, _SUMMARY), f"conv {conv}, {_SUMMARY}").withColumnRenamed("conv", id_col)


def _replayed(rows: Iterator[tuple]) -> Iterator[tuple[tuple, Iterator[tuple[str, str]]]]:
    """Each conversation's summary with its repaired (role, text) rows, from rows
    sorted by conversation, the summary first."""
    head = next(rows, None)

    def turns(audit: str) -> Iterator[tuple[str, str]]:
        nonlocal head
        state, k = START, 0
        head = next(rows, None)

        def put(text: str) -> tuple[str, str]:
            nonlocal state
            state = put_state(state)
            return ("user" if state == AFTER_U else "assistant", text)

        while head is not None and head[1] == 1:
            role, text = head[5], head[6]
            for _ in range(head[7]):
                while audit[k] == "I":
                    k += 1
                    yield put("")
                edit, k = audit[k], k + 1
                if edit == "K":
                    state = keep_state(state, role[:1])
                    yield (role, text)
                elif edit == "R":
                    yield put(text)
            head = next(rows, None)
        for _ in audit[k:]:
            yield put("")

    while head is not None:
        own = head
        out = turns(own[-1])
        yield own, out
        for _ in out:
            pass


def _with_audits(turns: DataFrame, audits: DataFrame, names: dict) -> DataFrame:
    """Rows and audits of a conversation together, the audit first."""
    d = _prepared(turns, **names).where("copies > 0")
    no = lambda t: F.lit(None).cast(t)
    a = audits.select(
        F.col(f"`{names['id_col']}`").alias("conv"), F.lit(0).alias("kind"), no("long").alias("turn"), no("long").alias("g1"), no("long").alias("g2"),
        no("string").alias("role"), no("string").alias("text"), no("long").alias("copies"), *COUNTS, "audit",
    )
    d = d.select("conv", F.lit(1).alias("kind"), "turn", "g1", "g2", "role", "text", "copies", *[no("long").alias(c) for c in COUNTS], no("string").alias("audit"))
    return a.unionByName(d).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "g1", "g2")


def _names(id_col, turn_col, role_col, text_col, copies_col) -> dict:
    return {"id_col": id_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col, "copies_col": copies_col}


def repaired_turns(
    turns: DataFrame, audits: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    copies_col: str | None = None,
) -> DataFrame:
    """The conversations after their audits' edits: id, position (from 0), role and
    text, from the rows given to ``audit_conversations`` and its result."""
    conv = dict(turns.dtypes)[id_col]

    names = "position long, role string, text string"

    def made(rows):
        for own, out in _replayed(rows):
            for k, (role, text) in enumerate(out):
                yield (own[0], k, role, text)

    d = _with_audits(turns, audits, _names(id_col, turn_col, role_col, text_col, copies_col))
    return d.mapInArrow(lambda b: _stream(b, made, names), f"conv {conv}, {names}").withColumnRenamed("conv", id_col)


def with_digest(
    turns: DataFrame, audits: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    copies_col: str | None = None,
) -> DataFrame:
    """``audits`` plus ``repaired_sha256``, the hash of the repaired conversation's
    ``role:text`` rows joined by newlines. Such a hash is sequential: the rows of a
    conversation pass through one task, which holds one batch of them."""
    conv = dict(turns.dtypes)[id_col]

    names = _SUMMARY + ", repaired_sha256 string"

    def made(rows):
        for own, out in _replayed(rows):
            h = hashlib.sha256()
            for k, (role, text) in enumerate(out):
                h.update(("\n" * (k > 0) + role + ":" + text).encode())
            yield (own[0], *own[8:], h.hexdigest())

    d = _with_audits(turns, audits, _names(id_col, turn_col, role_col, text_col, copies_col))
    return d.mapInArrow(lambda b: _stream(b, made, names), f"conv {conv}, {names}").withColumnRenamed("conv", id_col)
