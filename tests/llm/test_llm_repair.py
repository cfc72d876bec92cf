"""Conversation repair against a plain dynamic programme, and its edges."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from tillstream.llm import conversation_repair as C
from tillstream.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Least (cost, audit) over rows of (initial, fault), string by string."""
    n = len(rows)
    ends = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {}
    for i in range(n, -1, -1):
        now = {}
        for p in ends:
            options = [(0, "")] if i == n and p in ("", "a") else []
            if i < n:
                initial, fault = rows[i]
                c, t = best[i + 1][p]
                options.append((c + 4, "D" + t))
                if fault not in ("blank", "duplicate"):
                    extra = 3 if fault == "truncated" else 0
                    if initial == ends[p] or (initial == "s" and p == ""):
                        c, t = best[i + 1][initial]
                        options.append((c + extra, "K" + t))
                    c, t = best[i + 1][ends[p]]
                    options.append((c + 3 + extra, "R" + t))
            now[p] = min(options, default=(10 ** 9, ""))
        for _ in range(4):
            now = {p: min(now[p], (now[q][0] + 3, "I" + now[q][1])) for p, q in ends.items()}
        best[i] = now
    return best[0][""]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda v: " " if v is None else v
        role, text = space(role), space(text)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def expected(rows, all_ids):
    """The result's rows by conversation."""
    of = defaultdict(list)
    for r in rows:
        of[r[0]].append(r)
    out = {}
    for conv in all_ids:
        mine = sorted(of[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))
        seen, symbols, faults = set(), [], Counter()
        for _, _, role, text in mine:
            end = text.rstrip(SPACE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "?", fault))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(symbols)
        lines, last, i = [], "", 0
        for e in audit:
            spoken = {"": "u", "s": "u", "u": "a", "a": "u"}[last]
            name = {"u": "user", "a": "assistant"}[spoken]
            if e == "I":
                lines, last = [*lines, f"{name}:"], spoken
                continue
            _, _, role, text = mine[i]
            i += 1
            if e == "K":
                lines, last = [*lines, f"{role}:{text}"], role[0]
            elif e == "R":
                lines, last = [*lines, f"{name}:{text}"], spoken
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def through(rows):
    audits, repaired = C.repair(rows)
    return C.of_every(rows, audits, C.digests(repaired))


NAMES = {"s": 0, "u": 1, "a": 2, "?": 3}
FAULTS = {"": C.FINE, "blank": C.BLANK, "duplicate": C.DUPLICATE, "truncated": C.TRUNCATED}
SYMBOL = st.tuples(st.sampled_from("sua?"), st.sampled_from(list(FAULTS)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(SYMBOL, st.integers(1, 5)), max_size=8))
def test_runs_give_the_least_audit(runs):
    rows = [s for s, n in runs for _ in range(n)]
    assert C.cheapest([(NAMES[r] * 4 + FAULTS[f], n) for (r, f), n in runs]) == cheapest(rows)


@pytest.mark.parametrize("symbol", ["u", "a", "s", "?"])
def test_long_runs(symbol, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 7)
    rows = [("u", "")] + [(symbol, "")] * 100 + [("u", "truncated")] * 33
    assert C.cheapest([(NAMES["u"] * 4, 1), (NAMES[symbol] * 4, 100), (NAMES["u"] * 4 + C.TRUNCATED, 33)]) == cheapest(rows)
    cost, audit = C.cheapest([(NAMES["u"] * 4, 100_001)])
    assert len([e for e in audit if e != "I"]) == 100_001 and cost == 3 * 50_001


def nasty():
    rnd = random.Random(12)
    roles = ["user", "assistant", "system", "", "User", "agent", None]
    texts = ["Hello.", "Hello", "", " \t", None, "Yes!\n ", "No? ", "a\nb.", "..", "."]
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice([None, 0, 1, 2, 5, 9, -3]), rnd.choice(roles), rnd.choice(texts)) for _ in range(300)]
    rows += [(4, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(700)]
    rows += [(5, t, "user", "same.") for t in range(300)] + [(6, 1, "user", "same.")] * 200
    rows += [(100 + i, t, ("user", "assistant")[t % 2], f"{i} {t}.") for i in range(60) for t in range(4)]
    return rows + [(7, 0, "user", "long " * 200_000 + "."), (8, None, None, None)]


def test_edges_against_brute_force(spark):
    rows = nasty()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns(
        {c: F.lit(1) for c in ("n", "symbol", "seen", "audit", "th", "conv", "part")})
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert found(through(df)) == expected(plain, {r[0] for r in rows})
    hurt = C.damage(df)
    audits, repaired = C.repair(hurt)
    assert found(C.of_every(df, audits, C.digests(repaired))) == expected(damaged(rows), {r[0] for r in rows})
    for c, t, e in repaired.where("edit = 'I'").select("role", "text", "edit").collect():
        assert c in ("user", "assistant") and t == "" and e == "I"


def test_dropped_conversations_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    audits, repaired = C.repair(C.damage(rows))
    empty = hashlib.sha256(b"").hexdigest()
    assert found(C.of_every(rows, audits, C.digests(repaired))) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert found(through(rows.limit(0))) == {}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op12_conversation_repair"](spark, SF001)
    assert dict(out.dtypes)["cost"] == "bigint"
    assert found(out) == expected(damaged(rows), {r[0] for r in rows})
