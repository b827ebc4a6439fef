"""Conversation repair against exhaustive search and a plain recount."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from scanledger.llm import conversations as conv
from scanledger.llm.queries import op13_conversation_repair
from tests.llm.cases import CLASHES, words

SCHEMA = "conv_id long, turn long, role string, text string"
VALID = re.compile("(s?(ua)+)?")


def cheapest(symbols: str, most_inserted: int = 2) -> tuple[int, str]:
    """Every choice of an edit for each row and of up to so many rows between them."""
    best = None
    gaps = ["".join(g) for n in range(most_inserted + 1) for g in itertools.product("ua", repeat=n)]

    def edits(symbol):
        yield 3, "D", ""
        if symbol != conv.DELETED:
            more = int(symbol.isupper())
            yield more, "K", symbol.lower()
            for role in "ua":
                yield 2 + more, "R", role

    ways = [list(edits(s)) for s in symbols]
    for chosen in itertools.product(*ways):
        for between in itertools.product(gaps, repeat=len(symbols) + 1):
            roles = between[0] + "".join(c[2] + g for c, g in zip(chosen, between[1:], strict=True))
            if not VALID.fullmatch(roles):
                continue
            cost = sum(c[0] for c in chosen) + 2 * sum(map(len, between))
            audit = "I" * len(between[0]) + "".join(c[1] + "I" * len(g) for c, g in zip(chosen, between[1:], strict=True))
            best = min(best or (cost, audit), (cost, audit))
    return best


def plain_audit(symbols: str) -> tuple[int, str]:
    """Least (cost, string) from the left, over roles kept as text instead of states."""
    held = {"": (0, "")}

    def inserted(held):
        for _ in range(3):
            new = dict(held)
            for last, (cost, audit) in held.items():
                for role in "ua":
                    if last + role in ("u", "su", "au", "ua"):
                        new[role] = min(new.get(role, (1 << 60, "")), (cost + 2, audit + "I"))
            held = new
        return held

    for symbol in symbols:
        new: dict = {}
        for last, (cost, audit) in inserted(held).items():
            ways = [(3, "D", last)]
            if symbol != conv.DELETED:
                kept = symbol.lower()
                for extra, edit, role in ((0, "K", kept), (2, "R", "u"), (2, "R", "a")):
                    if last + role in ("s", "u", "su", "au", "ua"):
                        ways.append((extra + symbol.isupper(), edit, role))
            for extra, edit, role in ways:
                new[role] = min(new.get(role, (1 << 60, "")), (cost + extra, audit + edit))
        held = new
    held = inserted(held)
    return min(held[k] for k in ("", "a") if k in held)


def slow_repair(rows: list[tuple]) -> list[tuple]:
    """The contract, conversation by conversation."""
    held = defaultdict(list)
    for conv_id, turn, role, text in rows:
        own = held[conv_id]
        name = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        way = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        role = "user" if way == 4 else role
        own += [(turn, role, text)] * (2 if way == 3 else 1)
    expected = []
    for conv_id, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        symbols, seen, faults = "", set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = (
                "blank" if not bare else "duplicate" if (role, text) in seen
                else "truncated" if bare[-1] not in ".!?" else None
            )
            seen.add((role, text))
            faults.append(fault)
            kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "-" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        firsts = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
        cost, audit = plain_audit(symbols)
        lines, roles, coming = [], "", iter(own)
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(coming)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if roles.endswith("u") else "user"
            roles += role[:1]
            lines.append(f"{role}:{text}")
        assert VALID.fullmatch(roles)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        expected.append(
            (conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
        )
    return expected


RESULT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_audit_against_all_edits():
    grammar = conv.Grammar()
    sequences = [s for n in (0, 1, 2) for s in map("".join, itertools.product(conv.TERMINALS, repeat=n))]
    sequences += random.Random(1).sample(list(map("".join, itertools.product(conv.TERMINALS, repeat=3))), 12)
    for symbols in sequences:
        assert grammar.audit(symbols) == cheapest(symbols) == plain_audit(symbols), symbols


def test_grammar_does_not_change_audits():
    rng = random.Random(5)
    rules = ["ua", chr(256) * 2, "s" + chr(257), "U-", "-" + "A", "oo", chr(260) + chr(261)]
    grammar, plain = conv.Grammar(rules), conv.Grammar()
    for _ in range(300):
        symbols = "".join(rng.choices(conv.TERMINALS + "uaua" * 3, k=rng.randint(0, 60)))
        assert grammar.audit(symbols) == plain.audit(symbols) == plain_audit(symbols), symbols
    long = "".join(rng.choices("uauaUA-so", k=6000))
    assert grammar.audit(long) == plain_audit(long)


def awkward_conversations() -> list[tuple]:
    rng = random.Random(3)
    rows = []
    for k in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice([words(k, 5) + ".", words(k, 5), "same text here.", " \t\x0b", "", None, "Éé ¿? ", "x!\x0c"])
            rows.append((k, rng.choice([turn, turn, turn * 3, None]), role, text))
    rows += [(None, t, "user", "null id.") for t in range(4)] + [(None, None, None, None)] * 2
    rows += [(-7, t, ("user", "assistant")[t % 2], words(t, 8) + ".") for t in range(700)]  # a long one
    rows += [(90, 1, "user", "a" * 300_000 + "."), (90, 2, "assistant", " " * 100_000 + "b" + " " * 100_000)]
    rows += [(91, t, "user", "all the same.") for t in range(300)]
    dropped = [t for t in range(2000) if zlib.crc32(f"95:{t}".encode()) % 20 == 0][:3]
    rows += [(95, t, "user", "dropped.") for t in dropped]
    return rows + rows[10:14]


def test_repair_against_plain_recount(spark):
    rows = awkward_conversations()
    table = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", *(f"'own' AS {c}" for c in (*CLASHES, "fault", "audit", "symbols")))
    damaged = conv.damage(table)
    result = conv.repaired_digests(damaged, conv.repair_conversations(damaged))
    # conversations that lose all their rows still have one
    expected = slow_repair(rows)
    assert (95, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in expected
    assert found(result, *RESULT) == sorted(expected, key=repr)


def test_query_against_plain_recount(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = op13_conversation_repair(spark, "/root/testdata/sf0.01")
    assert result.columns == list(RESULT)
    assert found(result, *RESULT) == sorted(slow_repair(rows), key=repr)


def test_grammar_is_learned_and_shared(spark):
    rows = [(k, t, ("user", "assistant")[t % 2], f"{k} {t}.") for k in range(50) for t in range(16)]
    sequences = conv.conversation_sequences(conv.undamaged(spark.createDataFrame(rows, SCHEMA)))
    grammar = conv.fit_grammar(sequences)
    # pairs of pairs: a conversation of sixteen rows is one symbol
    assert len(grammar.compress("ua" * 8)) == 1
    audited = conv.audits(sequences, grammar)
    assert {tuple(r) for r in audited.select("cost", "audit").collect()} == {(0, "K" * 16)}


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "A question?"), (1, 2, "user", ""), (2, 5, "system", "Be kind.")]
    plain = conv.undamaged(spark.createDataFrame(rows, SCHEMA))
    repaired = conv.repaired_rows(plain, conv.repair_conversations(plain, conv.Grammar()))
    assert found(repaired, "conv_id", "place", "edit", "role", "text") == [
        (1, 0, "I", "user", ""), (1, 1, "K", "assistant", "Hello."),
        (1, 2, "K", "user", "A question?"), (1, 3, "I", "assistant", ""),
    ]


def test_empty_table(spark):
    damaged = conv.damage(spark.createDataFrame([], SCHEMA))
    assert conv.repaired_digests(damaged, conv.repair_conversations(damaged)).count() == 0
