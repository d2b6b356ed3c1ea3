"""Conversation repair against a plain dynamic program and a literal version of the rules."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cladeweave.llm import repair
from cladeweave.llm.common import table
from cladeweave.llm.queries import all_queries

LETTERS = "xsuaoSUAO"
GIVEN = {"^": "u", "s": "u", "u": "a", "a": "u"}
AFTER = {"^": "su", "s": "u", "u": "a", "a": "u"}


def needs(signature):
    """Least cost from every place and role, backwards."""
    n, cost = len(signature), {}
    for i in range(n, -1, -1):
        for role in "^sua":
            ways = [0] if i == n and role in "^a" else []
            if i < n:
                row, more = signature[i].lower(), 3 * signature[i].isupper()
                ways.append(4 + cost[i + 1, role])
                if row != "x":
                    ways += [more + cost[i + 1, row]] if row in AFTER[role] else []
                    ways.append(3 + more + cost[i + 1, GIVEN[role]])
            cost[i, role] = min(ways, default=10**9)
        for _ in range(4):
            for role in "^sua":
                cost[i, role] = min(cost[i, role], 3 + cost[i, GIVEN[role]])
    return cost


def least(signature, cost):
    """The cheapest audit that is least in ASCII order."""
    i, role, audit = 0, "^", ""
    while not (i == len(signature) and role in "^a"):
        left, row = cost[i, role], signature[i : i + 1]
        more = 3 * row.isupper()
        if row and left == 4 + cost[i + 1, role]:
            audit, i = audit + "D", i + 1
        elif left == 3 + cost[i, GIVEN[role]]:
            audit, role = audit + "I", GIVEN[role]
        elif row not in ("", "x") and row.lower() in AFTER[role] and left == more + cost[i + 1, row.lower()]:
            audit, i, role = audit + "K", i + 1, row.lower()
        else:
            audit, i, role = audit + "R", i + 1, GIVEN[role]
    return audit


def check(signature):
    cost, bound = needs(signature), repair._Bound(signature)
    assert all(bound(i, role) <= c for (i, role), c in cost.items()), signature
    assert repair.search(signature) == (least(signature, cost), cost[0, "^"]), signature


def test_search_on_all_short_conversations():
    for n in range(4):
        for letters in itertools.product(LETTERS, repeat=n):
            check("".join(letters))


def test_search_on_random_conversations():
    rnd = random.Random(5)
    for _ in range(400):
        weights = [rnd.random() ** 2 for _ in LETTERS]
        check("".join(rnd.choices(LETTERS, weights, k=rnd.randint(4, 14))))
    check("".join(rnd.choices("xuaUA", [1, 8, 8, 1, 1], k=600)))


def literal(rows):
    """Repair by the rules as they are written, from (conv_id, turn, role, text)."""
    found = {}
    for conv_id in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv_id):
            role, text = " " if role is None else role, " " if text is None else text
            name = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
            draw = zlib.crc32(name.encode()) % 20
            if draw == 1:
                text = ""
            if draw == 2:
                text = "".join(c for c in text if c not in ".!?")
            if draw == 4:
                role = "user"
            kept += [(turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        counts, signature, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, "", set()
        for _, role, text in kept:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            signature += {"truncated": letter.upper(), "": letter}.get(fault, "x")
            if fault:
                counts[fault] += 1
        turns = [r[0] for r in kept if r[0] is not None]
        cost = needs(signature)
        audit = least(signature, cost)
        out, left, before = [], iter(kept), "^"
        for edit in audit:
            row = next(left) if edit != "I" else (None, "", "")
            if edit == "K":
                out.append(f"{row[1]}:{row[2]}")
                before = row[1][0]
            elif edit != "D":
                before = GIVEN[before]
                out.append(f"{ {'u': 'user', 'a': 'assistant'}[before] }:{row[2]}")
        found[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *counts.values(),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:])),
            cost[0, "^"],
            audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest(),
        )
    return found


def repaired(spark, messages):
    damaged = repair.damage(messages)
    audits = spark.createDataFrame(repair.audits(damaged).collect(), repair.AUDIT_SCHEMA)
    rows = repair.digests(damaged, audits).collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in rows}, damaged, audits


def test_rules_on_odd_rows(spark):
    rnd = random.Random(3)
    texts = [None, "", " \n", "Yes.", "Yes.\t ", "no", "What? ", "x" * 9000 + "!", "ß É 中文。", ".", "a\x85", "yes."]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "ua", "System"]
    rows = [
        (rnd.choice([None, *range(60)]), rnd.choice([None, *range(8)]), rnd.choice(roles), rnd.choice(texts))
        for _ in range(700)
    ]
    rows += rows[:30]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages = messages.withColumns({"letter": F.lit("mine"), "_text": F.lit("mine"), "audit": F.lit("mine"), "_row": F.lit(1)})
    got, _, _ = repaired(spark, messages)
    assert got == literal(rows)


def test_tables_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repaired(spark, empty)[0] == {}
    gone = next(i for i in range(10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got, _, _ = repaired(spark, spark.createDataFrame([(gone, 0, "user", "a.")], empty.schema))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query_equals_rules_and_repaired_rows_alternate(spark, smallest):
    rows = [tuple(r) for r in table(spark, smallest, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got, damaged, audits = repaired(spark, table(spark, smallest, "conversations"))
    query = {r.conv_id: tuple(r)[1:] for r in all_queries()["op11_repair"](spark, smallest).collect()}
    assert got == query == literal(rows)
    out = repair.apply(damaged, audits).orderBy("conv_id", "place").collect()
    for conv_id, turns in itertools.groupby(out, key=lambda r: r.conv_id):
        turns = list(turns)
        initials = "".join(r.role[0] for r in turns).removeprefix("s")
        assert initials == "ua" * (len(initials) // 2)
        text = "\n".join(f"{r.role}:{r.text}" for r in turns)
        assert hashlib.sha256(text.encode()).hexdigest() == query[conv_id][-1]


@pytest.mark.parametrize("letters", ["u" * 300, "ua" * 300, "UA" * 100 + "ss" + "oO" * 50, "x" * 200, "a" + "ua" * 200 + "s"])
def test_long_conversations(letters):
    check(letters)
