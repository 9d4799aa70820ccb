"""Conversation repair as a search for the lightest derivation (Knuth's agenda).

A repaired conversation's role initials must read ``(s?(ua)+)?``.  The
automaton of that pattern has four states.  An item ``(i, q)`` stands for
"rows i and later, repaired so that they lead from state q to an accepted
end"; a deduction joins one edit of a row, or one insertion, to an item that
is already final.  It adds the edit's cost and puts its initial before the
item's audit.  Costs never fall and, at equal cost, items with more rows come
later, so every deduction is superior in the order (cost, rows, audit);
putting the same initial before two audits keeps their order.  Items are
popped lightest first and are final when popped; the search ends with the
goal ``(0, start)``.

Rows are sorted by range of (conversation, turn, role, text): a conversation
lies in one task or in a stretch of neighbouring ones, however large it is.
A task repairs the conversations that lie inside it.  The first and the last
of every task, and any that outgrows ``HELD_ROWS``, may go on elsewhere:
they are cut in pieces of ``PIECE`` rows, each piece gives the lightest
derivation between any two states, and the pieces of a conversation are
joined from its end to its beginning.  No task holds the texts of such a
conversation; its audit is one value of the result, so the task that writes
it holds that (four of them, one for each state), one character a row.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import ASCII_SPACE, fresh, materialize, prepare, text_key
from lakebars.session import discard

PIECE = 8192             # rows of a piece of a conversation that spans tasks
HELD_ROWS = 20_000       # rows of one conversation that a task holds
HELD_CHARS = 1 << 25     # characters of them
MEMO = 1 << 16           # repairs of short conversations that a task remembers
MEMO_ROWS = 64           # rows of a short conversation
PREFIX = 64              # characters of a text that take part in the ranges (whole texts decide the order)

# Costs of the edits
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
ENDS = (START, AFTER_ASSISTANT)
#: state: (state before, initial that leads here)
BEFORE = {START: (), AFTER_SYSTEM: ((START, "s"),), AFTER_ASSISTANT: ((AFTER_USER, "a"),),
          AFTER_USER: ((START, "u"), (AFTER_SYSTEM, "u"), (AFTER_ASSISTANT, "u"))}
AFTER = {(q, initial): after for after, before in BEFORE.items() for q, initial in before}
#: the role that an inserted or reroled row takes in a state
TURN_OF = {START: "user", AFTER_SYSTEM: "user", AFTER_USER: "assistant", AFTER_ASSISTANT: "user"}
LEGAL = ("su", "ua", "au")
FINE, BLANK, CUT, LOST = range(4)       # what Spark finds out about a row
MUST_DELETE = "d"


def sign(initial: str, cut: bool) -> str:
    """A row as the search sees it: its initial (``x``: any other), upper case if it is truncated."""
    kind = initial if initial and initial in "sua" else "x"
    return kind.upper() if cut else kind


def _less(x, y, known: dict) -> bool:
    """Whether audit ``x`` precedes ``y``; both are linked ``(initial, rest)`` and their rests are final."""
    if x[0] != y[0]:
        return x[0] < y[0]
    x, y, seen, result = x[1], y[1], [], False
    while x is not y:
        if x is None or y is None:
            result = x is None
            break
        pair = (id(x), id(y))
        if pair in known:
            result = known[pair]
            break
        seen.append(pair)
        if x[0] != y[0]:
            result = x[0] < y[0]
            break
        x, y = x[1], y[1]
    for pair in seen:
        known[pair] = result
    return result


def lightest(signs: str, ends=ENDS, goals=(START,)) -> dict:
    """``{state: (cost, audit)}`` of the lightest derivation from each goal state over all rows to one of ``ends``.

    States from which no end can be reached are missing.
    """
    n, final, best, agenda, known, reached = len(signs), {}, {}, [], {}, {}
    left = set(goals)

    def offer(i: int, q: int, cost: int, audit) -> None:
        item = (i, q)
        if item in final:
            return
        held = best.get(item)
        if held is None or cost < held[0]:
            best[item] = (cost, audit)
            heappush(agenda, (cost, n - i, q))
        elif cost == held[0] and audit is not None and held[1] is not None and _less(audit, held[1], known):
            best[item] = (cost, audit)

    for q in ends:
        offer(n, q, 0, None)
    while agenda and left:
        cost, done, q = heappop(agenda)
        i = n - done
        if (i, q) in final:
            continue
        audit = final[i, q] = best.pop((i, q))[1]
        if i == 0 and q in left:
            left.discard(q)
            reached[q] = (cost, _spell(audit))
        for before, initial in BEFORE[q]:
            if initial != "s":
                offer(i, before, cost + INSERT, ("I", audit))
        if i:
            row = signs[i - 1]
            offer(i - 1, q, cost + DELETE, ("D", audit))
            if row != MUST_DELETE:
                more = TRUNCATED if row.isupper() else 0
                for before, initial in BEFORE[q]:
                    if initial == row.lower():
                        offer(i - 1, before, cost + more, ("K", audit))
                    if initial != "s":
                        offer(i - 1, before, cost + REROLE + more, ("R", audit))
    return reached


def _spell(audit) -> str:
    letters = []
    while audit is not None:
        letters.append(audit[0])
        audit = audit[1]
    return "".join(letters)


class Tally:
    """Counts over the rows of a conversation, or of a piece of it, in order; tallies of neighbours add up."""
    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self, first="", last="", low=None, high=None, counts=(0, 0, 0, 0, 0)):
        self.first, self.last, self.low, self.high = first, last, low, high
        self.blank, self.duplicate, self.truncated, self.illegal, self.turns = counts
        self.any = False

    def row(self, turn, initial: str, code: int, duplicate: bool) -> str:
        """Adds a row; gives its sign."""
        if self.any:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first, self.any = initial, True
        self.last = initial
        if turn is not None and (self.high is None or turn != self.high):
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if code == BLANK:
            self.blank += 1
            return MUST_DELETE
        if duplicate:
            self.duplicate += 1
            return MUST_DELETE
        self.truncated += code == CUT
        return sign(initial, code == CUT)

    def after(self, earlier: "Tally") -> "Tally":
        """The tally of an earlier piece and this one."""
        if not earlier.any or not self.any:
            return self if self.any else earlier
        out = Tally(earlier.first, self.last)
        out.any = True
        for name in self.FIELDS:
            setattr(out, name, getattr(earlier, name) + getattr(self, name))
        out.illegal += earlier.last + self.first not in LEGAL
        out.low = earlier.low if earlier.low is not None else self.low
        out.high = self.high if self.high is not None else earlier.high
        out.turns -= earlier.high is not None and earlier.high == self.low
        return out

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


class Replay:
    """Follows an audit over the rows: what stays, in which role."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.n = audit, 0, START, hashlib.sha256(), 0

    def _put(self, edit: str, role: str, text: str):
        if self.n:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.state, self.n = AFTER[self.state, role[0]], self.n + 1
        return self.n - 1, edit, role, text

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put("I", TURN_OF[self.state], "")

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._put(edit, role if edit == "K" else TURN_OF[self.state], text)


class Sink:
    """Rows of the result, handed out in Arrow batches of bounded size."""

    def __init__(self, fields: list[tuple]):
        self.names, self.kinds, self.rows, self.size = [n for n, _ in fields], [k for _, k in fields], [], 0

    def add(self, **values):
        self.rows.append([values.get(n) for n in self.names])
        self.size += 100 + len(values.get("text") or "") + len(values.get("audit") or "")

    def batches(self, least: int = 1 << 21):
        if self.rows and self.size >= least:
            columns = [pa.array(c, k) for c, k in zip(zip(*self.rows), self.kinds)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(columns, self.names)


LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT, EDGE, TURN = range(3)


def _fields(kind: str) -> tuple[str, list]:
    """DDL and Arrow types of what the passes hand on; ``conv`` has the type of the ids."""
    spec = [("kind", "int", pa.int32()), ("conv", kind, None), ("pid", "int", pa.int32()), ("seq", "long", pa.int64()),
            ("turn", "long", pa.int64()), ("role", "string", pa.string()), ("text", "string", pa.string()),
            ("code", "int", pa.int32()), ("seen", "boolean", pa.bool_()), ("edit", "string", pa.string()),
            *[(c, "long", pa.int64()) for c in LONGS], ("audit", "string", pa.string()), ("hash", "string", pa.string())]
    return ", ".join(f"{n} {k}" for n, k, _ in spec), [(n, a) for n, _, a in spec]


def _rows(batches, conv_type: list):
    """The rows of the batches as lists; the first batch tells the Arrow type of the ids."""
    for batch in batches:
        conv_type[:] = [batch.column(0).type]
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _typed(fields, conv_type):
    return [(n, conv_type[0] if n == "conv" else k) for n, k in fields]


def _finish(sink: Sink, conv, rows: list, memo: dict, turns: bool) -> None:
    """Result (or turns) of a conversation whose rows ``(turn, role, text, code)`` are all here."""
    tally, seen, signs = Tally(), set(), []
    rows = [r for r in rows if r[3] != LOST]
    for turn, role, text, code in rows:
        again = code != BLANK and (role, text) in seen
        if code != BLANK:
            seen.add((role, text))
        signs.append(tally.row(turn, role[:1], code, again))
    signs = "".join(signs)
    found = memo.get(signs)
    if found is None:
        found = lightest(signs)[START]
        if len(signs) <= MEMO_ROWS and len(memo) < MEMO:
            memo[signs] = found
    replay, out = Replay(found[1]), []
    for _, role, text, _ in rows:
        out.extend(replay.row(role, text))
    out.extend(replay.inserted())
    if turns:
        for n, edit, role, text in out:
            sink.add(kind=TURN, conv=conv, seq=n, edit=edit, role=role, text=text)
    else:
        _result(sink, conv, tally, *found, replay.hash.hexdigest())


def _result(sink, conv, tally: Tally, cost: int, audit: str, digest) -> None:
    sink.add(kind=RESULT, conv=conv, gaps=tally.gaps(), blank=tally.blank, duplicate=tally.duplicate,
             truncated=tally.truncated, illegal=tally.illegal, cost=cost, audit=audit, hash=digest)


def _inside(fields, turns: bool):
    """First pass, over rows in order: results of whole conversations, rows of those that may go on elsewhere."""
    def run(batches):
        pid, kind = TaskContext.get().partitionId(), []
        sink, memo, seen, piece = None, {}, set(), None
        conv, held, chars, edge, seq = None, [], 0, True, 0     # the first conversation is an edge from its start

        def stream(row):
            """Hands on a row of an edge, marking what its piece has seen before."""
            nonlocal seq, piece
            if piece != seq // PIECE:
                piece = seq // PIECE
                seen.clear()
            turn, role, text, code = row
            again = False
            if code in (FINE, CUT):
                mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
                again = mark in seen
                seen.add(mark)
            sink.add(kind=EDGE, conv=conv, pid=pid, seq=seq, turn=turn, role=role, text=text, code=code, seen=again)
            seq += 1

        for at, *row in _rows(batches, kind):
            if sink is None:
                sink, conv = Sink(_typed(fields, kind)), at
            elif at != conv:
                if not edge:
                    _finish(sink, conv, held, memo, turns)
                conv, held, chars, edge = at, [], 0, False
                seen.clear()
                seq = (seq // PIECE + 1) * PIECE if seq % PIECE else seq     # a piece has rows of one conversation
            if not edge:
                held.append(row)
                chars += len(row[2] or "")
                if len(held) > HELD_ROWS or chars > HELD_CHARS:
                    edge = True
                    for r in held:
                        stream(r)
                        yield from sink.batches()
                    held = []
            else:
                stream(row)
            yield from sink.batches()
        if sink is not None:
            for r in held:
                stream(r)
                yield from sink.batches()
            yield from sink.batches(0)

    return run


PIECE_SPEC = [("conv", None), ("pid", pa.int32()), ("piece", pa.int64()), ("first", pa.string()), ("last", pa.string()),
              ("low", pa.int64()), ("high", pa.int64()), ("any", pa.bool_()), ("counts", pa.list_(pa.int64())),
              ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]


def _pieces(batches):
    """Second pass, over the rows of edges: each piece's tally and its lightest derivation between any two states."""
    kind, sink, key, tally, signs = [], None, None, None, []

    def close():
        spans = [lightest("".join(signs), (end,), range(4)) for end in range(4)]
        pairs = [spans[end].get(q) for q in range(4) for end in range(4)]
        sink.add(conv=key[0], pid=key[1], piece=key[2], first=tally.first, last=tally.last, low=tally.low, high=tally.high,
                 any=tally.any, counts=[getattr(tally, f) for f in Tally.FIELDS],
                 costs=[None if p is None else p[0] for p in pairs], audits=[None if p is None else p[1] for p in pairs])
        sink.size += sum(len(p[1]) for p in pairs if p)

    for conv, pid, piece, _, turn, initial, code, again in _rows(batches, kind):
        if sink is None:
            sink = Sink(_typed(PIECE_SPEC, kind))
        if key != (conv, pid, piece):
            if key is not None:
                close()
                yield from sink.batches()
            key, tally, signs = (conv, pid, piece), Tally(), []
        if code != LOST:
            signs.append(tally.row(turn, initial, code, again))
    if key is not None:
        close()
        yield from sink.batches(0)


def _joined(fields):
    """Third pass, over pieces from the last to the first of each conversation: its result but for the text."""
    def run(batches):
        kind, sink, conv, tally, suffix = [], None, None, None, None

        def close():
            _result(sink, conv, tally, *suffix[START], None)

        for row in _rows(batches, kind):
            at, _, _, first, last, low, high, some, counts, costs, audits = row
            if sink is None:
                sink = Sink(_typed(fields, kind))
            if suffix is None or at != conv:
                if suffix is not None:
                    close()
                    yield from sink.batches()
                conv, tally, suffix = at, Tally(), {q: (0, "") for q in ENDS}
            mine = Tally(first, last, low, high, counts)
            mine.any = some
            tally = tally.after(mine)
            ahead = {}
            for q in range(4):
                joined = [(costs[4 * q + end] + suffix[end][0], end) for end in suffix if costs[4 * q + end] is not None]
                if joined:
                    least = min(joined)[0]
                    ahead[q] = (least, min(audits[4 * q + end] + suffix[end][1] for cost, end in joined if cost == least))
            suffix = ahead
        if suffix is not None:
            close()
            yield from sink.batches(0)

    return run


def _replayed(fields, turns: bool):
    """Last pass, over each edge's result and then its rows: the repaired text, hashed row by row."""
    def run(batches):
        kind, sink, result, replay = [], None, None, None

        def close():
            for n, edit, role, text in replay.inserted():
                if turns:
                    sink.add(kind=TURN, conv=result["conv"], seq=n, edit=edit, role=role, text=text)
            if not turns:
                sink.add(**{**result, "hash": replay.hash.hexdigest()})

        for row in _rows(batches, kind):
            if sink is None:
                sink = Sink(_typed(fields, kind))
            values = dict(zip(("conv", "kind", "role", "text", *LONGS, "audit"), row))
            if values["kind"] == RESULT:
                if replay is not None:
                    close()
                result, replay = {k: v for k, v in values.items() if k not in ("role", "text")}, Replay(values["audit"])
            else:
                for n, edit, role, text in replay.row(values["role"], values["text"]):
                    if turns:
                        sink.add(kind=TURN, conv=values["conv"], seq=n, edit=edit, role=role, text=text)
            yield from sink.batches()
        if replay is not None:
            close()
            yield from sink.batches(0)

    return run


def _told_apart(*parts):
    """Strings as one, each after its length, so that no two lists of strings give the same."""
    return F.concat(*[x for part in parts for x in (
        F.coalesce(F.char_length(part).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(part, F.lit("")))])


def _repaired(conversations: DataFrame, conv_col, turn_col, role_col, text_col, lost_col, turns: bool) -> DataFrame:
    prepare(conversations.sparkSession)
    space = F.lit(" ")
    lost = F.coalesce(F.col(lost_col), F.lit(False)) if lost_col else F.lit(False)
    rows = conversations.select(
        F.col(conv_col).alias("conv"), F.when(~lost, F.col(turn_col).cast("long")).alias("turn"),
        F.when(~lost, F.coalesce(F.col(role_col).cast("string"), space)).alias("role"),
        F.when(~lost, F.coalesce(F.col(text_col).cast("string"), space)).alias("text"))
    tail = F.right(F.btrim("text", F.lit(ASCII_SPACE)), F.lit(1))
    rows = rows.withColumn("code", F.when(F.col("text").isNull(), LOST).when(tail == "", BLANK)
                           .when(~tail.isin(".", "!", "?"), CUT).otherwise(FINE))
    ordered = (rows.repartitionByRange("conv", "turn", "role", F.substring("text", 1, PREFIX))
               .sortWithinPartitions("conv", "turn", "role", "text"))
    ddl, fields = _fields(rows.schema["conv"].dataType.simpleString())
    first = materialize(ordered.mapInArrow(_inside(fields, turns), ddl), "conversations")
    edges = first.where(F.col("kind") == EDGE).select(
        "conv", "pid", (F.col("seq") / PIECE).cast("long").alias("piece"), "seq", "turn", "role", "text", "code", "seen",
        text_key(_told_apart(F.col("conv").cast("string"), F.col("role"), F.col("text"))).alias("key"))

    # A row repeats an earlier one if its piece has seen it, or if an earlier
    # piece has: only each piece's first rows meet on the key, so a text
    # repeated without end is at most one row for each piece.
    new = (F.col("code").isin(FINE, CUT)) & ~F.col("seen")
    heads = edges.where(new)
    firsts = heads.groupBy("key").agg(F.min(F.struct("pid", "seq")).alias("least"))
    judged = (heads.join(firsts, "key").withColumn("seen", F.struct("pid", "seq") > F.col("least")).drop("least")
              .unionByName(edges.where(~new)).drop("key"))
    judged = materialize(judged, "edges")

    spanned = (judged.select("conv", "pid", "piece", "seq", "turn", F.substring("role", 1, 1).alias("initial"), "code", "seen")
               .repartition("conv", "pid", "piece").sortWithinPartitions("conv", "pid", "piece", "seq")
               .mapInArrow(_pieces, f"conv {rows.schema['conv'].dataType.simpleString()}, pid int, piece long, first string, "
                                    "last string, low long, high long, any boolean, counts array<long>, "
                                    "costs array<long>, audits array<string>"))
    results = (spanned.repartition("conv").sortWithinPartitions("conv", F.desc("pid"), F.desc("piece"))
               .mapInArrow(_joined(fields), ddl))
    none = F.lit(None)
    both = results.select("conv", "kind", F.lit(-1).alias("pid"), F.lit(0).cast("long").alias("seq"),
                          none.cast("string").alias("role"), none.cast("string").alias("text"), *LONGS, "audit").unionByName(
        judged.where(F.col("code") != LOST).select("conv", F.lit(EDGE).alias("kind"), "pid", "seq", "role", "text",
                                                   *[none.cast("long").alias(c) for c in LONGS],
                                                   none.cast("string").alias("audit")))
    whole = (both.repartition("conv").sortWithinPartitions("conv", "pid", "seq")
             .select("conv", "kind", "role", "text", *LONGS, "audit").mapInArrow(_replayed(fields, turns), ddl))
    wanted = TURN if turns else RESULT
    out = materialize(first.where(F.col("kind") == wanted).unionByName(whole), "repaired")
    for side in (first, judged):
        discard(side)
    return out


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", lost_col: str | None = None) -> DataFrame:
    """One row per conversation: its faults, and the cheapest edits that repair it.

    Rows are taken by turn (NULL first), then role, then text; a NULL role or
    text is one space.  A row's first fault counts: ``blank`` (nothing but
    white space), ``duplicate`` (an earlier row has its role and text),
    ``truncated`` (does not end with ``.``, ``!`` or ``?``).  ``gaps`` are
    missing turns between the least and the greatest, ``illegal`` the
    neighbours whose role initials are not su, ua or au.  ``cost`` and
    ``audit`` (initials of the edits, Keep, Rerole, Delete, Insert) are those
    of the cheapest repair, the ASCII-least of equal cost; ``hash`` is the
    SHA-256 of the repaired ``role:text`` lines (see :func:`repaired_turns`).
    Rows with a true ``lost_col`` are not there, but their conversation is
    reported: without rows it has zeros, an empty audit and the hash of the
    empty string.  A NULL conversation id is one conversation.  Repeated rows
    are rows like others (the second is a duplicate).  An empty table gives
    no rows; other columns are ignored.
    """
    out = _repaired(conversations, conv_col, turn_col, role_col, text_col, lost_col, False)
    return out.select(F.col("conv").alias(conv_col), *LONGS[:5], "cost", "audit", F.col("hash").alias("repaired_sha256"))


def repaired_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", lost_col: str | None = None) -> DataFrame:
    """The repaired conversations themselves: conversation, ``position`` from 0, ``edit``, ``role`` and ``text``.

    Kept rows have edit K, reroled ones R, inserted ones I and an empty text;
    deleted ones are gone.  Order, NULLs and empty tables as in :func:`repair`.
    """
    out = _repaired(conversations, conv_col, turn_col, role_col, text_col, lost_col, True)
    return out.select(F.col("conv").alias(conv_col), F.col("seq").alias("position"), "edit", "role", "text")


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Conversations with planted faults, the same for the same rows: four columns and ``lost``.

    The CRC-32 of ``conversation:turn`` modulo 20 decides: 0 loses the row,
    1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it,
    4 makes its role user.  NULLs are one space there, in role and in text;
    ids and turns stay NULL in the result.  An empty table gives no rows.
    """
    space = F.lit(" ")
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), space)
    hit = F.crc32(F.concat(text_of(conv_col), F.lit(":"), text_of(turn_col)).cast("binary")) % 20
    d, role, text, copy = (fresh(n, conversations.columns) for n in ("_hit", "_role", "_text", "_copy"))
    rows = conversations.select(
        conv_col, turn_col, hit.alias(d), text_of(role_col).alias(role), text_of(text_col).alias(text))
    rows = rows.select(
        conv_col, turn_col, F.when(F.col(d) == 4, F.lit("user")).otherwise(F.col(role)).alias(role_col),
        F.when(F.col(d) == 1, F.lit("")).when(F.col(d) == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)).alias(text_col),
        (F.col(d) == 0).alias("lost"),
        F.explode(F.when(F.col(d) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias(copy))
    return rows.drop(copy)
