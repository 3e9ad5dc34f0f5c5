"""Repair of conversation structure by iterative-deepening A*.

A conversation should read ``(s?(ua)+)?`` in its roles' initials: an optional
system turn, then user and assistant in turn. Its rows may be kept (cost 0),
given the role user or assistant (2) or deleted (3, which blank rows and repeats
of an earlier role and text require), and empty user or assistant rows may be
inserted anywhere (2); a row whose text breaks off adds 1 unless it is deleted.
Of the cheapest edit sequences the one whose initials (D, I, K, R) come first in
ASCII order is taken.

The search is a depth-first one over (row, last role kept) that tries edits in
ASCII order within a cost bound, so that the first accepting path is the answer.
If there is none, the bound rises to the least estimate that went beyond it. The
estimate counts what the remaining rows must cost whatever is done about the
others: forced deletions, broken-off texts, roles that can't stay, and half the
length of each run of equal roles. A transposition table keeps, for each state,
the largest rest of the bound with which it failed; a failed state is entered
again only with more left. It is kept between bounds, since its entries hold for
any of them.

A conversation of any length is searched in blocks of ``BLOCK`` rows: rows are
range-sorted by (conversation, turn, role, text hash), so a long conversation is
spread over partitions, and a block that isn't a whole conversation is searched
from each role it may be entered with to each it may be left with. The blocks'
costs and edits are then chained in order. Chaining keeps the tie order: of two
edit sequences of a block with equal cost and ends none is a prefix of the other.

Rows are searched without their texts (a hash tells repeats). Equal rows are
counted before the sort. The repaired rows come from a second pass, in which a
conversation's rows stream past its edits; only its edits, a byte a row, are held.

Defined results: null roles and texts are one space; null ids form a conversation
of their own; null turns come first; rows of one turn are ordered by role, then
by a hash of the text; an empty role has no initial and can't stay; an empty
table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import attach

BLOCK = 256
#: Last role kept: none, system, user, assistant.
START, S, U, A = range(4)
NEXT = (U, U, A, U)
KEEP = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
ROLE = {U: "user", A: "assistant"}
DELETE, INSERT, REROLE, BROKEN = 3, 2, 2, 1
FINE, FORCED, CUT = 0, 1, 2

SPACES = r"[\x20\x09-\x0D]"


# --------------------------------------------------------------------------
# the search
# --------------------------------------------------------------------------

class Search:
    """Cheapest edits of ``rows`` (initial, FINE / FORCED / CUT) that enter with
    one role and leave with one of ``ends``."""

    def __init__(self, rows: list[tuple[str, int]], ends: tuple[int, ...]):
        self.rows, self.ends, self.failed = rows, ends, {}
        n = len(rows)
        odd = {U: "a", A: "u", S: "", START: ""}[ends[-1]]  # a last row of this role can't stay last
        self.must = [0] * (n + 1)    # forced deletions, broken texts, roles that can't stay
        self.system = [0] * (n + 1)  # system rows that might stay
        self.first = [""] * (n + 1)  # first initial that might stay
        self.run = [0] * (n + 1)     # length of the run of equal roles it starts
        self.later = [0] * (n + 1)   # cost of the runs after that one
        for i in range(n - 1, -1, -1):
            c, kind = rows[i]
            self.must[i], self.system[i], self.first[i], self.run[i], self.later[i] = \
                self.must[i + 1], self.system[i + 1], self.first[i + 1], self.run[i + 1], self.later[i + 1]
            if kind == FORCED:
                self.must[i] += DELETE
                continue
            self.must[i] += BROKEN * (kind == CUT) + REROLE * (c not in ("s", "u", "a"))
            self.system[i] += c == "s"
            if c in ("u", "a") and c == self.first[i + 1]:
                self.run[i] += 1
            else:
                self.later[i] += 2 * (self.run[i + 1] // 2)
                last = self.first[i + 1] == ""
                self.run[i] = (1 + (last and c == odd)) if c in ("u", "a") else 0
            self.first[i] = c or "?"

    def least(self, i: int, q: int) -> int:
        """No completion from here costs less."""
        first = self.first[i]
        clash = first in ("u", "a") and (q, first) not in KEEP
        stay = min(self.system[i], 1) if q == START else 0
        return self.must[i] + REROLE * (self.system[i] - stay) + 2 * ((self.run[i] + clash) // 2) + self.later[i]

    def from_role(self, q: int) -> tuple[int, str] | None:
        """(cost, edits), or None where the ends can't be reached."""
        rows, n = self.rows, len(self.rows)
        if self.ends == (START,):
            return (DELETE * n, "D" * n) if q == START else None
        failed, ends = self.failed, self.ends
        only_s = ends == (S,)
        if only_s and (q in (U, A) or (q == START and not any(c == "s" and k != FORCED for c, k in rows))):
            return None

        def least(i, q):
            if only_s:
                # nothing but one system row may stay
                if q in (U, A):
                    return 1 << 60
                return DELETE * (n - i - (q == START))
            return max(self.least(i, q), failed.get(4 * i + q, -1) + 1)

        bound = least(0, q)
        while True:
            beyond = 1 << 60
            stack, path = [[0, q, bound, 0]], []
            while stack:
                top = stack[-1]
                i, at, left, move = top
                if move == 0 and i == n and at in ends:
                    return bound - left, "".join(path)
                top[3] += 1
                step = None
                if move == 0:
                    if i < n:
                        step = ("D", i + 1, at, DELETE)
                elif move == 1:
                    step = ("I", i, NEXT[at], INSERT)
                elif move == 2:
                    if i < n and rows[i][1] != FORCED and (to := KEEP.get((at, rows[i][0]))) is not None:
                        step = ("K", i + 1, to, BROKEN * (rows[i][1] == CUT))
                elif move == 3:
                    if i < n and rows[i][1] != FORCED:
                        step = ("R", i + 1, NEXT[at], REROLE + BROKEN * (rows[i][1] == CUT))
                else:
                    if not only_s:
                        key = 4 * i + at
                        failed[key] = max(failed.get(key, -1), left)
                    stack.pop()
                    if path:
                        path.pop()
                    continue
                if step is None:
                    continue
                rest = left - step[3]
                short = least(step[1], step[2]) - rest
                if short > 0:
                    beyond = min(beyond, bound + short)
                else:
                    path.append(step[0])
                    stack.append([step[1], step[2], rest, 0])
            bound = beyond


def cheapest(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, edits) of a whole conversation."""
    return Search(rows, (START, A)).from_role(START)


def table(rows: list[tuple[str, int]]) -> tuple[list, list]:
    """(costs, edits) of a block from each role (rows) to each role (columns),
    16 of each; None where there is no way."""
    costs, edits = [None] * 16, [None] * 16
    for end in range(4):
        search = Search(rows, (end,))
        for q in range(4):
            if (found := search.from_role(q)) is not None:
                costs[4 * q + end], edits[4 * q + end] = found
    return costs, edits


# --------------------------------------------------------------------------
# rows and faults
# --------------------------------------------------------------------------

def rows_of(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, h, text): nulls of role and text are one space."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    return df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), r.alias("role"),
                     F.md5(t.cast("binary")).alias("h"), t.alias("text"))


def counted(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, h, kind, again, n): equal rows of a turn once, n of
    them; ``kind`` is B(lank), C(ut) or F(ine); ``again``: an earlier turn of
    the conversation has the role and text."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    kind = F.when(blank, "B").when(~last.isin(".", "!", "?"), "C").otherwise("F")
    runs = rows.select("conv", "turn", "role", "h", kind.alias("kind")) \
        .groupBy("conv", "turn", "role", "h", "kind").agg(F.count(F.lit(1)).alias("n"))
    # one key that is never null, so that rows without an id find theirs
    runs = runs.withColumn("same", F.struct(F.col("conv").isNull().alias("z"), F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("c"), "role", "h"))
    when = F.struct(F.col("turn").isNotNull().alias("z"), F.col("turn").alias("t"))
    first = runs.groupBy("same").agg(F.min(when).alias("first"))
    both = attach(runs, first, "same")
    return both.select("conv", "turn", "role", "h", "kind", (~F.col("first").eqNullSafe(when)).alias("again"), "n")


_STATS = ("rows", "lo", "hi", "turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal")


class _Block:
    """Rows of one conversation in a row, up to BLOCK of them."""

    def __init__(self, conv, turn, role, h, copy):
        self.conv, self.at = conv, (turn, role, h, copy)
        self.rows, self.lo, self.hi, self.turns = [], None, None, 0
        self.first_turn = self.last_turn = None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None

    def add(self, turn, role, kind, again) -> None:
        c = role[:1]
        if turn is not None:
            self.turns += turn != self.last_turn
            if self.lo is None:
                self.lo = self.first_turn = turn
            self.hi = self.last_turn = turn
        if self.rows:
            self.illegal += self.last + c not in ("su", "ua", "au")
        else:
            self.first = c
        self.last = c
        if kind == "B":
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif kind == "C":
            self.truncated += 1
        self.rows.append((c, FORCED if kind == "B" or again else CUT if kind == "C" else FINE))

    def row(self, whole: bool) -> tuple:
        if whole:
            cost, path = cheapest(self.rows)
            costs, edits = [cost], [path]
        else:
            costs, edits = table(self.rows)
        return (self.conv, *self.at, whole, len(self.rows), self.lo, self.hi, self.turns, self.first_turn, self.last_turn, self.blank,
                self.duplicate, self.truncated, self.illegal, self.first, self.last, costs, edits)


def _block_schema(conv) -> str:
    return (f"conv {conv}, turn long, role string, h string, copy long, whole boolean, " + ", ".join(f"{s} long" for s in _STATS)
            + ", first string, last string, costs array<long>, edits array<string>")


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _arrow(conv_type: pa.DataType) -> pa.Schema:
    longs = [(s, pa.int64()) for s in _STATS]
    return pa.schema([("conv", conv_type), ("turn", pa.int64()), ("role", pa.string()), ("h", pa.string()), ("copy", pa.int64()), ("whole", pa.bool_()),
                      *longs, ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string()))])


def _blocks(batches):
    """Blocks of the sorted runs of a partition. A conversation is whole if
    others lie before and after it in the partition and one block holds it."""
    schema, out, block, opened, parts = None, [], None, False, 0

    def close(b, whole):
        out.append(b.row(whole))

    for b in batches:
        schema = schema or _arrow(b.schema.field(0).type)
        for conv, turn, role, h, kind, again, n in zip(*(c.to_pylist() for c in b.columns)):
            if block is None or conv != block.conv or (conv is None) != (block.conv is None):
                if block is not None:
                    close(block, opened and parts == 1)
                    opened = True
                block, parts = _Block(conv, turn, role, h, 0), 1
            for k in range(n):
                if len(block.rows) == BLOCK:
                    close(block, False)
                    block, parts = _Block(conv, turn, role, h, k), parts + 1
                block.add(turn, role, kind, again or k > 0)
                if len(out) >= 256:
                    yield _out(out, schema)
                    out.clear()
        if out:
            yield _out(out, schema)
            out.clear()
    if block is not None:
        close(block, False)
        yield _out(out, schema)


class _Chain:
    """The blocks of one conversation, joined in order."""

    def __init__(self, conv):
        self.conv, self.head, self.best = conv, [], {START: (0, "")}
        self.lo = self.hi = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.rows = 0
        self.last = None

    def add(self, r: dict) -> None:
        self.rows += r["rows"]
        if r["lo"] is not None:
            self.lo = r["lo"] if self.lo is None else self.lo
            self.hi = r["hi"]
            self.turns += r["turns"] - (self.last_turn is not None and self.last_turn == r["first_turn"])
            self.last_turn = r["last_turn"]
        for k in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, k, getattr(self, k) + r[k])
        if self.last is not None:
            self.illegal += self.last + r["first"] not in ("su", "ua", "au")
        self.last = r["last"]
        new: dict = {}
        for q, (cost, path) in self.best.items():
            for end in range(4):
                more = r["costs"][4 * q + end]
                if more is not None and (end not in new or (cost + more, path + r["edits"][4 * q + end]) < new[end]):
                    new[end] = (cost + more, path + r["edits"][4 * q + end])
        self.best = new
        # what all ways share is settled
        paths = [p for _, p in new.values()]
        low, high, k = min(paths), max(paths), 0
        while k < min(len(low), len(high)) and low[k] == high[k]:
            k += 1
        if k:
            self.head.append(low[:k])
            self.best = {q: (c, p[k:]) for q, (c, p) in new.items()}

    def done(self) -> tuple:
        cost, path = min(self.best[q] for q in (START, A) if q in self.best)
        gaps = 0 if self.lo is None else self.hi - self.lo + 1 - self.turns
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join([*self.head, path])


_AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _chained(batches):
    """Audits of the conversations whose blocks come in order."""
    schema, out, chain = None, [], None
    for b in batches:
        schema = schema or pa.schema([("conv", b.schema.field("conv").type), *((c.split()[0], pa.int64()) for c in _AUDIT.split(", ")[:-1]), ("audit", pa.string())])
        for r in b.to_pylist():
            if chain is None or chain.conv != r["conv"]:
                if chain is not None:
                    out.append(chain.done())
                chain = _Chain(r["conv"])
            chain.add(r)
        if out:
            yield _out(out, schema)
            out = []
    if chain is not None:
        yield _out([*out, chain.done()], schema)


def audits(df: DataFrame, **names) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit. ``names``: the columns conv, turn, role and text."""
    runs = counted(rows_of(df, **names))
    kind = runs.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", "role", "h"]
    blocks = written(runs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks, _block_schema(kind)))
    gaps = F.when(F.col("lo").isNull(), 0).otherwise(F.col("hi") - F.col("lo") + 1 - F.col("turns")).cast("long")
    whole = blocks.where("whole").select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                                         F.col("costs")[0].alias("cost"), F.col("edits")[0].alias("audit"))
    parts = blocks.where(~F.col("whole")).repartition("conv").sortWithinPartitions(*order, "copy") \
        .mapInArrow(_chained, f"conv {kind}, {_AUDIT}")
    return whole.unionByName(parts).withColumnRenamed("conv", "conv_id")


# --------------------------------------------------------------------------
# repaired rows
# --------------------------------------------------------------------------

_REPAIRED = [("position", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]


def _repaired(batches):
    """Rows in order behind their conversation's edits (``audit``)."""
    schema, out, edits, k, at, position, size = None, [], "", 0, START, 0, 0
    conv = None

    def inserted():
        nonlocal k, at, position
        while k < len(edits) and edits[k] == "I":
            at = NEXT[at]
            out.append((conv, position, "I", None, ROLE[at], ""))
            position, k = position + 1, k + 1

    for b in batches:
        schema = schema or pa.schema([("conv_id", b.schema.field("conv").type), *_REPAIRED])
        for r in b.to_pylist():
            if r["audit"] is not None:
                inserted()
                conv, edits, k, at, position = r["conv"], r["audit"], 0, START, 0
                continue
            inserted()
            e, k = edits[k], k + 1
            if e != "D":
                at = KEEP[at, r["role"][:1]] if e == "K" else NEXT[at]
                out.append((conv, position, e, r["turn"], r["role"] if e == "K" else ROLE[at], r["text"]))
                position += 1
                size += len(r["text"])
            if len(out) >= 256 or size > 1 << 22:
                yield _out(out, schema)
                out, size = [], 0
    if schema is not None:
        inserted()
        yield _out(out, schema)


def apply(df: DataFrame, audited: DataFrame, **names) -> DataFrame:
    """conv_id, position (from 0), edit (K, R or I), turn, role, text of the
    repaired conversations, each in one partition and in order."""
    rows = rows_of(df, **names)
    kind = rows.schema["conv"].dataType.simpleString()
    heads = audited.select(F.col("conv_id").alias("conv"), F.lit(0).alias("k"), "audit")
    both = rows.withColumn("k", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    return both.repartition("conv").sortWithinPartitions("conv", "k", "turn", "role", "h") \
        .mapInArrow(_repaired, f"conv_id {kind}, position long, edit string, turn long, role string, text string")


def _hashed(batches):
    schema, out, conv, sha = None, [], None, None
    for b in batches:
        schema = schema or pa.schema([("conv_id", b.schema.field("conv_id").type), ("repaired_sha256", pa.string())])
        for c, position, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "position", "role", "text"))):
            if position == 0:
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256()
            sha.update(f"{'' if position == 0 else chr(10)}{role}:{text}".encode())
        if out:
            yield _out(out, schema)
            out = []
    if sha is not None:
        yield _out([*out, (conv, sha.hexdigest())], schema)


def digest(repaired: DataFrame, audited: DataFrame, conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per id of ``conversations``: the audit's columns and
    ``repaired_sha256`` of its ``role:text`` lines. ``repaired`` as :func:`apply`
    gives it, in order."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    sha = repaired.mapInArrow(_hashed, f"conv_id {kind}, repaired_sha256 string")
    ids = conversations.select(F.col(conv).alias("conv_id")).distinct()
    cols = [c.split()[0] for c in _AUDIT.split(", ")]

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("" if name == "audit" else 0)).alias(name)

    a, s = audited.withColumnRenamed("conv_id", "a_id"), sha.withColumnRenamed("conv_id", "s_id")
    return ids.join(a, F.col("conv_id").eqNullSafe(F.col("a_id")), "left").join(s, F.col("conv_id").eqNullSafe(F.col("s_id")), "left") \
        .select("conv_id", *[filled(c) for c in cols], F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The query's test damage: one row in 20 each is dropped, emptied, robbed
    of its full stops, repeated, or given the role user. Nulls count as one space."""
    def plain(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    c = F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn)).cast("binary")) % 20
    t = F.when(c == 1, F.lit("")).when(c == 2, F.regexp_replace(plain(text), "[.!?]", "")).otherwise(plain(text))
    r = F.when(c == 4, F.lit("user")).otherwise(plain(role))
    copies = F.when(c == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.where(c != 0).select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), r.alias("role"), t.alias("text"), F.explode(copies).alias("copy")).drop("copy")
