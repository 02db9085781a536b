"""Repair of the role structure of conversations at least cost.

A conversation's rows, by turn, are edited until the initials of its roles read
``(s?(ua)+)?``.  Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert
(an empty text of user or assistant, anywhere) 3; a row that is blank or repeats
an earlier role and text has to be deleted, a truncated one that stays costs 3.
Of the cheapest edits those win whose initials, in order, are least in ASCII.

Weights.  One integer carries both: its high digits are the cost; its low ones,
base 8 and of a fixed width, are the letters (D 1, I 2, K 3, R 4) from the left,
with zeros behind the last.  The weight of an edit is its cost and its letter at
its place, so the least sum over the paths of a DAG (rows times the four states
of the grammar: start, after s, u, a) is the answer, ties included: of two paths
to a node, of equal cost, neither's letters begin with all of the other's, as
the longer one would hold more inserts.

Plan.
1. Faults, by row: native.  A repeat is found with the first row of each text
   (a combined aggregate) joined back on a digest, in salted parts.
2. Narrow rows (no text) are sorted by range of conversation, turn, role and
   digest, so a conversation of any size lies over as many tasks as it needs.
   Each task solves the runs of rows it has: a run gives the least weights
   between every two states, which are combined like a matrix product.  Runs
   that a border cuts (two a task at most) are combined in a group of their own.
3. The texts are shuffled once, by conversation, sorted behind the row that
   holds its edits, and repaired as a stream: nothing but a batch is held.

The letters of a conversation are one value, so its rows are bounded by what a
value can hold; its texts are not.  A digest of the repaired texts (``report``)
reads them in order in one task, as any SHA-256 does.

Defined results: nulls in role and text are one space; turns in order with nulls
first, equal turns by role and then by the SHA-256 of role and text; rows that
repeat are duplicates of the first; a null conversation is one of its own; a
conversation that ends without a row has no edits; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .words import WHITE_SPACE

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LETTERS = "DIKR"  # in ASCII order, digits 1 to 4
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
CHUNK = 64
SALTS = 16
_AFTER = {("s", START): SYSTEM, **{("u", s): USER for s in (START, SYSTEM, ASSISTANT)}, ("a", USER): ASSISTANT}
_ORDER = ("conv_id", "turn", "role", "digest")


# ---- the weights of a run of rows --------------------------------------------------------------------------------------
# A row is one character: its role's initial (s, u, a or o for any other), a capital if truncated; x if it has to go.

def _next_role(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _inserted(best: dict, width: int) -> dict:
    """Any inserts from each node's state; two reach every state that inserts can."""
    out, new = dict(best), best
    for _ in range(2):
        step = {}
        for state, node in new.items():
            to, edge = _next_role(state), _edge(node, INSERT, "I", width)
            if to not in out or edge < out[to]:
                out[to] = step[to] = edge
        new = step
    return out


def _edge(node: tuple[int, int], cost: int, letter: str, width: int) -> tuple[int, int]:
    """(weight, letters so far) behind one more edit."""
    weight, n = node
    return weight + (cost << 3 * width) + (LETTERS.index(letter) + 1 << 3 * (width - 1 - n)), n + 1


def _row(best: dict, code: str, width: int) -> dict:
    out = {}
    for state, node in _inserted(best, width).items():
        edits = [(DELETE, "D", state)]
        if code != "x":
            late = TRUNCATED if code.isupper() else 0
            edits.append((REROLE + late, "R", _next_role(state)))
            kept = _AFTER.get((code.lower(), state))
            if kept is not None:
                edits.append((late, "K", kept))
        for cost, letter, to in edits:
            edge = _edge(node, cost, letter, width)
            if to not in out or edge < out[to]:
                out[to] = edge
    return out


@lru_cache(20_000)
def _chunk(codes: str) -> tuple[int, list]:
    """(width, for each state before the rows, {state after: (weight, letters)})."""
    width, out = 3 * len(codes), []
    for state in range(4):
        best = {state: (0, 0)}
        for code in codes:
            best = _row(best, code, width)
        out.append(best)
    return width, out


def _then(x: tuple[int, list], y: tuple[int, list]) -> tuple[int, list]:
    """The weights of two runs, one behind the other."""
    (wx, before), (wy, after) = x, y
    mask, out = (1 << 3 * wy) - 1, []
    for best in before:
        joined = {}
        for middle, (weight, n) in best.items():
            for to, (more, m) in after[middle].items():
                total = (weight << 3 * wy) + (more >> 3 * wy << 3 * (wx + wy)) + ((more & mask) << 3 * (wx - n))
                if to not in joined or (total, n + m) < joined[to]:
                    joined[to] = (total, n + m)
        out.append(joined)
    return wx + wy, out


def weights(codes: str) -> tuple[int, list]:
    """The least weights of a run of rows between every two states."""
    if len(codes) <= CHUNK:
        return _chunk(codes)
    middle = (len(codes) // 2 + CHUNK - 1) // CHUNK * CHUNK
    return _then(weights(codes[:middle]), weights(codes[middle:]))


def decided(solved: tuple[int, list]) -> tuple[int, str]:
    """(cost, letters) of a whole conversation."""
    width, out = solved
    best = {to: (w << 6, n) for to, (w, n) in out[START].items()}  # two more places for inserts at the end
    width += 2
    weight, n = min(node for to, node in _inserted(best, width).items() if to in ACCEPTED)
    digits = weight & (1 << 3 * width) - 1
    letters = oct(digits >> 3 * (width - n))[2:].translate(str.maketrans("1234", LETTERS)) if n else ""
    return weight >> 3 * width, letters


@lru_cache(20_000)
def _short(codes: str) -> tuple[int, str]:
    return decided(weights(codes))


def solve(codes: str) -> tuple[int, str]:
    """(cost, letters) of the rows of one conversation."""
    return _short(codes) if len(codes) <= CHUNK else decided(weights(codes))


# ---- rows, runs and conversations -------------------------------------------------------------------------------------

_COUNTS = ("n", "blank", "duplicate", "truncated", "illegal", "turns")


class Run:
    """What is known of successive rows of one conversation."""

    def __init__(self, conv):
        self.conv, self.codes = conv, []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = self.low = self.high = None

    def add(self, turn, initial: str, fault: str):
        c = self.counts
        if c["n"]:
            c["illegal"] += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last = initial
        c["n"] += 1
        if turn is not None:
            c["turns"] += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            c[fault] += 1
        code = initial if initial in ("s", "u", "a") else "o"
        self.codes.append("x" if fault in ("blank", "duplicate") else code.upper() if fault else code)

    def record(self, solved=None) -> dict:
        out = {"conv_id": self.conv, **self.counts, "first": self.first, "last": self.last, "low": self.low, "high": self.high}
        if solved is not None:
            return out | {"cost": solved[0], "audit": solved[1]}
        width, best = weights("".join(self.codes))
        size = max(w.bit_length() for b in best for w, _ in b.values()) // 8 + 1
        return out | {"width": width, "edges": [{"before": s, "after": t, "weight": w.to_bytes(size, "big"), "letters": n}
                                                for s, b in enumerate(best) for t, (w, n) in b.items()]}


def _schema(conv_type: pa.DataType) -> pa.Schema:
    edge = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("weight", pa.binary()), ("letters", pa.int64())])
    return pa.schema([("conv_id", conv_type), *((c, pa.int64()) for c in _COUNTS), ("first", pa.string()),
                      ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("cost", pa.int64()),
                      ("audit", pa.string()), ("width", pa.int64()), ("edges", pa.list_(edge)),
                      ("part", pa.int32()), ("place", pa.int64())])


def _ddl(conv_type: str) -> str:
    return (f"conv_id {conv_type}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", first string, last string, low long, "
            "high long, cost long, audit string, width long, "
            "edges array<struct<before:int,after:int,weight:binary,letters:long>>, part int, place long")


def _runs(batches):
    """Sorted rows -> one record for each conversation's run in this task.  The
    first and the last run may go on in another task: their weights are kept."""
    part, place, run, types = TaskContext.get().partitionId(), 0, None, None
    out = []

    def flush():
        batch = pa.RecordBatch.from_pylist(out, schema=types)
        out.clear()
        return batch
    for batch in batches:
        types = _schema(batch.schema.field("conv_id").type)
        for conv, turn, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault"))):
            if run is None or conv != run.conv:
                if run is not None:
                    out.append(run.record(solve("".join(run.codes)) if place else None) | {"part": part, "place": place})
                    place += 1
                run = Run(conv)
            if fault != "gone":
                run.add(turn, initial, fault)
        if len(out) >= 4096:
            yield flush()
    if run is not None:
        out.append(run.record() | {"part": part, "place": place})
        yield flush()


def _combined(group: pa.Table) -> pa.Table:
    """The runs of one conversation that borders of tasks have cut."""
    total, solved, last_high = None, None, None
    for r in sorted(group.to_pylist(), key=lambda r: (r["part"], r["place"])):
        best = [{} for _ in range(4)]
        for e in r["edges"]:
            best[e["before"]][e["after"]] = (int.from_bytes(e["weight"], "big"), e["letters"])
        solved = (r["width"], best) if solved is None else _then(solved, (r["width"], best))
        if total is None or not total["n"]:
            total, last_high = r, r["high"]
            continue
        if r["n"]:
            total["illegal"] += total["last"] + r["first"] not in ("su", "ua", "au")
            total["turns"] -= r["low"] is not None and r["low"] == last_high
            total["low"] = r["low"] if total["low"] is None else total["low"]
            total["last"], last_high = r["last"], r["high"] if r["high"] is not None else last_high
            for c in _COUNTS:
                total[c] += r[c]
    total["high"] = last_high
    total["cost"], total["audit"] = decided(solved)
    total["edges"] = None
    return pa.Table.from_pylist([total], schema=group.schema)


def _faulty(rows: DataFrame) -> DataFrame:
    """Narrow rows: conv_id, turn, role, digest, initial, fault (null, blank,
    duplicate, truncated, or gone for a row that only names its conversation)."""
    text, role = F.col("text"), F.col("role")
    bare = F.btrim(text, F.lit(WHITE_SPACE))
    end = F.substring(bare, -1, 1)
    narrow = rows.select(
        "conv_id", "turn", "role", "digest", F.substring(role, 1, 1).alias("initial"),
        F.when(F.col("gone"), "gone").when(bare == "", "blank").when(~end.isin(".", "!", "?"), "truncated").alias("fault"),
        F.monotonically_increasing_id().alias("id"))
    narrow = materialize(narrow, "conversation-rows")
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    live = F.coalesce(~F.col("fault").isin("gone", "blank"), F.lit(True))
    firsts = (narrow.where(live).groupBy(conv.alias("c"), F.col("digest").alias("d")).agg(F.min(F.struct("turn", "id")).alias("head"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1").select("c", "d", "head", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    mine = narrow.withColumn("salt", F.pmod("id", F.lit(SALTS)).cast("int"))
    joined = mine.join(firsts, (conv == F.col("c")) & (F.col("digest") == F.col("d")) & (mine["salt"] == firsts["salt"]) & live, "left")
    again = live & F.col("head").isNotNull() & (F.col("head.id") != F.col("id"))
    return joined.select("conv_id", "turn", "role", "digest", "id", "initial", F.when(again, "duplicate").otherwise(F.col("fault")).alias("fault"))


def _prepared(conversations: DataFrame, gone: str | None) -> DataFrame:
    """conv_id, turn, role, text, gone, digest."""
    gone = F.col(gone) if gone else F.lit(False)
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("gone"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def plans(conversations: DataFrame, gone: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost and audit (the initials of its edits, in order).

    The boolean column ``gone``, if any, marks rows that only name their
    conversation."""
    ship_package(conversations.sparkSession)
    return _planned(_prepared(conversations, gone))


def _planned(rows: DataFrame) -> DataFrame:
    ddl = _ddl(rows.schema["conv_id"].dataType.simpleString())
    faulty = _faulty(rows)
    order = [F.col(c).asc_nulls_first() for c in (*_ORDER, "id")]
    dealt = faulty.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = materialize(dealt.select("conv_id", "turn", "initial", "fault").mapInArrow(_runs, ddl), "conversation-runs")
    cut = runs.where("edges is not null").groupBy("conv_id").applyInArrow(_combined, ddl)
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    return runs.where("edges is null").unionByName(cut).select(
        "conv_id", gaps.cast("bigint").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")


# ---- the edits applied ------------------------------------------------------------------------------------------------

class _Editor:
    """Applies the letters of one conversation to its rows."""

    def __init__(self, letters: str):
        self.letters, self.at, self.state = letters, 0, START

    def _stays(self, role: str):
        self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]

    def inserts(self):
        """Roles of the empty texts that stand here."""
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            role = ("user", "assistant")[_next_role(self.state) == ASSISTANT]
            self._stays(role)
            yield role

    def row(self, role: str) -> tuple[str, str | None]:
        """(letter, role that the next row gets, or None)."""
        letter = self.letters[self.at]
        self.at += 1
        if letter == "D":
            return letter, None
        if letter == "R":
            role = ("user", "assistant")[_next_role(self.state) == ASSISTANT]
        self._stays(role)
        return letter, role


def _events(batches):
    """Rows sorted behind their plan -> (conv_id, None) at each conversation's
    begin, then (conv_id, (letter, role, text)) for every row that stays."""
    conv = editor = None
    for batch in batches:
        for kind, c, letters, role, text in zip(*(batch.column(x).to_pylist() for x in ("kind", "conv_id", "audit", "role", "text"))):
            if kind == 0:
                if editor is not None:
                    yield from ((conv, ("I", r, "")) for r in editor.inserts())
                conv, editor = c, _Editor(letters)
                yield conv, None
                continue
            yield from ((conv, ("I", r, "")) for r in editor.inserts())
            letter, role = editor.row(role)
            if role is not None:
                yield conv, (letter, role, text)
    if editor is not None:
        yield from ((conv, ("I", r, "")) for r in editor.inserts())


def _in_batches(records, types: pa.Schema, size: int = 4096, n_bytes: int = 1 << 22):
    out, held = [], 0
    for r in records:
        out.append(r)
        held += len(r.get("text") or "")
        if len(out) >= size or held >= n_bytes:
            yield pa.RecordBatch.from_pylist(out, schema=types)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=types)


def _with_type(make):
    """A mapInArrow function whose output has the type of the input's conv_id."""
    def run(batches):
        for first in batches:
            def again(first=first):
                yield first
                yield from batches
            yield from make(again(), first.schema.field("conv_id").type)
    return run


@_with_type
def _repaired(batches, conv_type):
    def records():
        place = 0
        for conv, event in _events(batches):
            if event is None:
                place = 0
            else:
                yield {"conv_id": conv, "place": place, "role": event[1], "text": event[2], "edit": event[0]}
                place += 1
    yield from _in_batches(records(), pa.schema([("conv_id", conv_type), ("place", pa.int64()), ("role", pa.string()),
                                                 ("text", pa.string()), ("edit", pa.string())]))


@_with_type
def _hashed(batches, conv_type):
    def records():
        conv = state = None
        for c, event in _events(batches):
            if event is None:
                if state is not None:
                    yield {"conv_id": conv, "repaired_sha256": state.hexdigest()}
                conv, state, between = c, hashlib.sha256(), b""
            else:
                state.update(between + f"{event[1]}:{event[2]}".encode())
                between = b"\n"
        if state is not None:
            yield {"conv_id": conv, "repaired_sha256": state.hexdigest()}
    yield from _in_batches(records(), pa.schema([("conv_id", conv_type), ("repaired_sha256", pa.string())]))


def _behind_plans(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Plans and rows in one stream: each conversation's plan, then its rows."""
    both = (planned.select("conv_id", F.lit(0).alias("kind"), "audit", *(F.lit(None).cast(t).alias(c) for c, t in (
                ("turn", "bigint"), ("role", "string"), ("digest", "binary"), ("text", "string"))))
            .unionByName(rows.where(~F.col("gone")).select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"),
                                                           "turn", "role", "digest", "text")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "role", "digest")]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("kind", "conv_id", "audit", "role", "text")


def repaired(conversations: DataFrame, gone: str | None = None) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), role, text and edit (K, R, I)."""
    ship_package(conversations.sparkSession)
    rows = _prepared(conversations, gone)
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    return _behind_plans(rows, _planned(rows)).mapInArrow(
        _repaired, f"conv_id {conv_type}, place long, role string, text string, edit string")


def report(conversations: DataFrame, gone: str | None = None) -> DataFrame:
    """``plans`` with repaired_sha256, the SHA-256 of the repaired ``role:text``
    joined by newlines."""
    ship_package(conversations.sparkSession)
    rows = _prepared(conversations, gone)
    planned = materialize(_planned(rows), "conversation-plans")
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    digests = _behind_plans(rows, planned).mapInArrow(_hashed, f"conv_id {conv_type}, repaired_sha256 string")
    named = digests.select(F.col("conv_id").alias("c"), "repaired_sha256")
    return planned.join(named, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with known faults, for measuring repairs.  By the CRC-32 of
    ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row (``gone``), 1
    empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets the role user."""
    def spaced(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    role, text = spaced("role"), spaced("text")
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
