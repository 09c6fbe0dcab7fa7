"""Conversation repair against exhaustive search and a plain whole-query form."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from talentflow.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string"


def search(rows):
    """Least (cost, audit, lines) over all edit scripts of (role, text, fault):
    every script with at most two insertions before each row and at the end,
    by the grammar's regular expression alone."""
    grammar = re.compile(r"(s?(ua)+)?")
    prefix = re.compile(r"|s|s?(ua)*u?")

    @functools.lru_cache(None)
    def go(i, initials, inserted):
        if not prefix.fullmatch(initials):
            return []
        out = []
        if i == len(rows):
            if grammar.fullmatch(initials):
                out.append((0, "", ()))
        else:
            role, text, fault = rows[i]
            out += [(2 + x, "D" + a, t) for x, a, t in go(i + 1, initials, 0)]
            if fault not in ("blank", "duplicate"):
                late = 5 if fault == "truncated" else 0
                if role[:1]:
                    out += [(late + x, "K" + a, (f"{role}:{text}", *t)) for x, a, t in go(i + 1, short(initials + role[0]), 0)]
                for to in ("user", "assistant"):
                    out += [(late + 1 + x, "R" + a, (f"{to}:{text}", *t)) for x, a, t in go(i + 1, short(initials + to[0]), 0)]
        if inserted < 2:
            for to in ("user", "assistant"):
                out += [(5 + x, "I" + a, (f"{to}:", *t)) for x, a, t in go(i, short(initials + to[0]), inserted + 1)]
        return [min(out)] if out else []

    def short(initials):  # what follows 'ua' is what follows 'uaua'
        while "uaua" in initials:
            initials = initials.replace("uaua", "ua")
        return initials

    return go(0, "", 0)[0]


def plain(table):
    """The contract, conversation by conversation."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if code == 0:
                continue
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            rows += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, marked = set(), []
        for turn, role, text in rows:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit, lines = search(tuple(marked))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def random_table(rnd, convs, longest):
    texts = ["Yes.", "no", "So it is!", "", " \t\n", "Why?  ", "half a", None, "é.\n", "Yes."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    table = []
    for conv in [None, *range(convs)]:
        for _ in range(rnd.randint(1, longest)):
            table.append((conv, rnd.choice([None, *range(8), 3]), rnd.choice(roles), rnd.choice(texts)))
    return table


def report(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_plain_form(spark, seed):
    table = random_table(random.Random(seed), 60, 7)
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    assert report(c.repair_report(df.selectExpr("*", "1 as start", "2 as kind", "'x' as `a.b`", "0 as place"))) == plain(table)


def test_blocks_and_units_do_not_change_the_repair(spark):
    rnd = random.Random(4)
    table = [(rnd.choice([1, 1, 1, 2, 3]), rnd.randint(0, 30), rnd.choice(["system", "user", "assistant"]), rnd.choice(["a.", "b!", "c", ""])) for _ in range(120)]
    df = spark.createDataFrame(table, SCHEMA)
    whole, parts = c.repair(df), c.repair(df, block_bits=1, unit=3)
    key = lambda r: str(r.conv_id)
    assert sorted(whole.summary.collect(), key=key) == sorted(parts.summary.collect(), key=key)
    assert sorted(c.digests(whole.rows).collect()) == sorted(c.digests(parts.rows).collect())
    kept = parts.rows.orderBy("conv_id", "start", "step").collect()
    for conv in (1, 2, 3):
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept if r.conv_id == conv))
        assert all((r.edit == "I") == (r.text == "") for r in kept if r.conv_id == conv)


def test_solver_equals_search():
    rnd = random.Random(7)
    names = {0: "x", c.SYSTEM: "s", c.USER: "u", c.ASSISTANT: "a"}
    flags = {0: "", c.BLANK: "blank", c.DUPLICATE: "duplicate", c.TRUNCATED: "truncated"}
    for _ in range(60):
        run = [(rnd.choice(list(names)), rnd.choice([0, 0, *flags])) for _ in range(rnd.randint(1, 9))]
        want = search(tuple((names[r], "t", flags[f]) for r, f in run))[:2]
        kinds = np.array([r | f for r, f in run], np.int8)
        for unit in (1, 2, 4, 100):
            [(_, letters, _, cost)] = c.edits_of(kinds, np.array([0, len(run)]), unit)
            assert (cost, "".join(letters)) == want


def test_very_long_conversation(spark):
    n = 150_000
    df = spark.range(n).selectExpr("id % 20 div 19 as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role", "concat('turn ', id, '.') as text")
    found = {r.conv_id: r for r in c.repair(df).summary.collect()}
    assert len(found[0].audit.replace("I", "")) == n * 19 // 20 and len(found[1].audit.replace("I", "")) == n // 20
    rows = df.filter("conv_id = 1").orderBy("turn").limit(40)
    short = {r.conv_id: r for r in c.repair(rows).summary.collect()}[1]
    assert (short.cost, short.audit) == search(tuple((r.role, r.text, "") for r in rows.collect()))[:2]


def test_empty_table_and_dropped_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert c.repair_report(empty).count() == 0
    assert c.repair(empty).rows.count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hello.")], SCHEMA)
    assert report(c.repair_report(df)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
