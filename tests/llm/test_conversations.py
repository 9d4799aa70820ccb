"""Operator 12 against a plain version: strings compared as they are, every fault found row by row."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import zlib

import pytest

from lakebars.llm import conversations
from tests.llm.test_operators import SF, data, same

TURNS = "conv_id long, turn long, role string, text string, lost long, _copy string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """``conv -> [(turn, role, text)]`` after the planted faults; conversations that lose all rows stay."""
    out: dict = {}
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        text, role = " " if text is None else text, " " if role is None else role
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        here += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def before(initial, q):
    """States from which an initial leads to ``q``; 0 start, 1 after system, 2 after user, 3 after assistant."""
    return {("s", 1): [0], ("u", 2): [0, 1, 3], ("a", 3): [2]}.get((initial, q), [])


def cheapest(rows):
    """Least (cost, audit) for rows ``(initial, must_delete, truncated)``: relaxed until nothing changes, on whole strings."""
    level = {0: (0, ""), 3: (0, "")}
    for row in [None, *reversed(rows)]:
        found: dict = {}

        def offer(q, cost, audit):
            if q not in found or (cost, audit) < found[q]:
                found[q] = (cost, audit)
                return True

        if row is None:
            found = dict(level)
        else:
            initial, must, cut = row
            for q, (cost, audit) in level.items():
                offer(q, cost + 3, "D" + audit)
                if not must:
                    for p in before(initial, q):
                        offer(p, cost + cut, "K" + audit)
                    for x in "ua":
                        for p in before(x, q):
                            offer(p, cost + cut + 2, "R" + audit)
        more = True
        while more:
            more = False
            for q, (cost, audit) in list(found.items()):
                for x in "ua":
                    for p in before(x, q):
                        more |= bool(offer(p, cost + 2, "I" + audit))
        level = found
    return level[0]


def apply(audit, rows):
    out, at, initials = [], 0, ""
    for edit in audit:
        follows = "a" if initials[-1:] == "u" else "u"
        if edit == "I":
            out.append(("user" if follows == "u" else "assistant") + ":")
            initials += follows
            continue
        _, role, text = rows[at]
        at += 1
        if edit != "D":
            if edit == "R":
                role = "user" if follows == "u" else "assistant"
            out.append(f"{role}:{text}")
            initials += role[0]
    assert at == len(rows) and re.fullmatch("(s?(ua)+)?", initials)
    return "\n".join(out)


def plain(rows, hurt=damaged):
    found = []
    for conv, own in hurt(rows).items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in own if r[0] is not None]
        seen, marks, counts = set(), [], {"b": 0, "d": 0, "t": 0}
        for _, role, text in own:
            bare = text.strip(SPACE)
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marks.append((role[:1], fault in ("b", "d") and fault != "", int(fault == "t")))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, audit = cheapest(marks)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found.append((conv, gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit,
                      hashlib.sha256(apply(audit, own).encode()).hexdigest()))
    return found


def hostile(n=60, seed=9, longest=12):
    rng = random.Random(seed)
    texts = ["Hello.", "What?", "So so", "Fine!", "", " \t", None, "é.", "x\x00y", "a. \n", "…", "No. Yes"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher", "User"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            rows.append((conv, None if rng.random() < 0.08 else turn * rng.choice([1, 1, 1, 2]), role,
                         rng.choice(texts) if rng.random() < 0.7 else f"Text {rng.random()}."))
    rows += [(None, k, "user", "Of no conversation.") for k in range(4)] + [(None, None, None, None)]
    rows += rows[:7] + [(900, None, "user", "a."), (900, None, "assistant", "b."), (901, -5, "assistant", "c."), (901, 7, "user", "d.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)


def got(spark, rows):
    hurt = conversations.damage(frame(spark, rows).drop("lost"))
    return [tuple(r) for r in conversations.repair(hurt, lost_col="lost").collect()]


def test_repair(spark):
    rows = hostile()
    same(got(spark, rows), plain(rows))


@pytest.mark.parametrize("piece, held", [(1, 2), (3, 4), (7, 10_000)])
def test_conversations_that_span_tasks(spark, monkeypatch, piece, held):
    """Pieces of few rows, one hot conversation with a third of all rows, texts that it repeats without end."""
    monkeypatch.setattr(conversations, "PIECE", piece)
    monkeypatch.setattr(conversations, "HELD_ROWS", held)
    rng = random.Random(2)
    rows = hostile(40, 5)
    rows += [(10_000, t // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", "Same", f"T {t}.", f"T {t}", ""]))
             for t in range(len(rows) // 2)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same(got(spark, rows), plain(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_everything_lost_and_nothing_there(spark):
    assert got(spark, []) == []
    gone = [(c, t, "user", "x.") for c in range(400) for t in range(2) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    empty = hashlib.sha256(b"").hexdigest()
    assert gone
    same(got(spark, gone), [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in {r[0] for r in gone}])


def test_repaired_turns(spark):
    """The rows that come out are those whose hash the report gives; nothing is damaged here."""
    rows = hostile(25, 3)
    table = frame(spark, rows)
    report = {r[0]: tuple(r)[1:] for r in conversations.repair(table).collect()}
    turns: dict = {}
    for conv, position, edit, role, text in conversations.repaired_turns(table).collect():
        turns.setdefault(conv, []).append((position, edit, role, text))
    for conv, told in report.items():
        own = sorted(turns.get(conv, []))
        assert [x[0] for x in own] == list(range(len(own)))
        assert told[-1] == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in own).encode()).hexdigest()
        assert "".join(e for _, e, _, _ in own) == told[-2].replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, _, r, _ in own))
    whole = lambda rs: {c: [(t, " " if r is None else r, " " if x is None else x) for k, t, r, x in rs if k == c]
                        for c in {k for k, *_ in rs}}
    same([(c, *told) for c, told in report.items()], plain(rows, whole))


def test_search_against_all_edits():
    """Every sequence of edits of up to three rows, with up to two insertions at each place."""
    def exhaustive(signs):
        best = None
        gaps = [("", "I", "II")] * (len(signs) + 1)
        for edits in itertools.product("KRD", repeat=len(signs)):
            for inserts in itertools.product(*gaps):
                cost, state, ok = 0, 0, True
                audit = inserts[0] + "".join(e + i for e, i in zip(edits, inserts[1:]))
                at = 0
                for edit in audit:
                    if edit == "I":
                        state, cost = conversations.AFTER[state, conversations.TURN_OF[state][0]], cost + 2
                        continue
                    row, at = signs[at], at + 1
                    if edit == "D":
                        cost += 3
                        continue
                    cost += row.isupper() + 2 * (edit == "R")
                    initial = row.lower() if edit == "K" else conversations.TURN_OF[state][0]
                    if row == "d" or (state, initial) not in conversations.AFTER:
                        ok = False
                        break
                    state = conversations.AFTER[state, initial]
                if ok and state in conversations.ENDS and (best is None or (cost, audit) < best):
                    best = cost, audit
        return best

    for n in range(4):
        for signs in itertools.product("sSuUaAxXd", repeat=n):
            if n < 3 or random.Random("".join(signs)).random() < 0.3:
                assert conversations.lightest("".join(signs))[0] == exhaustive("".join(signs)), signs


def test_search_of_long_conversations():
    """Ties of long audits are settled from the rows that differ: the work stays in proportion to the rows."""
    rng = random.Random(1)
    for n in (200, 600):
        signs = "".join(rng.choice("suaUAxd") for _ in range(n))
        rows = [(s.lower(), s == "d", int(s.isupper())) for s in signs]
        assert conversations.lightest(signs)[0] == cheapest(rows)
    for signs in ("xd" * 20_000, "uu" * 20_000, "sd" * 20_000):
        cost, audit = conversations.lightest(signs)[0]
        assert cost > 0 and len(audit) >= len(signs)


@data
def test_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(os.path.join(SF, "conversations.parquet"))
            .select("conv_id", "turn", "role", "text").collect()]
    same(got(spark, rows), plain(rows))
