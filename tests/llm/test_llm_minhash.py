"""MinHash near-duplicates against all pairs, signatures against their definition."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tillstream.llm import minhash as M
from tillstream.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def shingle_set(text, k=4):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    ws = [w for w in text.translate(LOWER).split(" ") if w]
    return {" ".join(ws)} if 0 < len(ws) < k else {" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)}


def brute(rows):
    """Expected (doc_id, n_shingles, component_id, kept) from all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return Counter((k, len(s), least.get(find(i)), k == least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def found(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def family(rnd, first, n, words, changes):
    """Copies of one text, each with some words changed."""
    base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        ws = list(base)
        for _ in range(rnd.randrange(changes + 1)):
            ws[rnd.randrange(words)] = f"x{rnd.randrange(10 ** 6)}"
        out.append((first + i, " ".join(ws)))
    return out


def test_signature_is_the_walk(monkeypatch):
    """Each slot holds the least of all elements' values for it; blocks and stopping change nothing."""
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 2 ** 63, n).astype(np.uint64)) for n in (1, 2, 7, 60, 500, 3000)]
    whole = M.signatures(sets, 64)
    best = np.full((len(sets), 64), M._EMPTY)
    for d, s in enumerate(sets):
        for e in s[:60] if len(s) > 500 else s:
            order = list(range(64))
            for j in range(64):
                z = int(M._mix(np.array([int(e) + (j + 1) * M._STEP & (1 << 64) - 1], dtype=np.uint64))[0])
                k = j + ((z >> 32) * (64 - j) >> 32)
                order[j], order[k] = order[k], order[j]
                best[d, order[j]] = min(int(best[d, order[j]]), j << 32 | z & 0xFFFFFFFF)
    assert ((M._mix(best) >> np.uint64(48)).astype("<u2")[:5] == whole[:5]).all()
    monkeypatch.setattr(M, "_BLOCK", 50)
    assert (M.signatures(sets, 64) == whole).all()


def test_agreement_estimates_the_similarity():
    rnd = np.random.default_rng(2)
    for j in (0.5, 0.8, 0.9):
        errors = []
        for _ in range(60):
            pool = rnd.integers(0, 2 ** 63, 400).astype(np.uint64)
            both = int(400 * j)
            a, b = np.unique(pool[:both + (400 - both) // 2]), np.unique(np.concatenate([pool[:both], pool[both + (400 - both) // 2:]]))
            u, v = M.signatures([a, b])
            errors.append((u == v).mean() - j)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 1.1 * (j * (1 - j) / M.SLOTS) ** 0.5 + 0.005


@pytest.mark.parametrize("crowded", [2, 64])
def test_groups_against_all_pairs(spark, crowded):
    rnd = random.Random(5)
    rows = family(rnd, 0, 60, 120, 8) + family(rnd, 100, 40, 30, 2) + family(rnd, 200, 30, 400, 30)
    rows += [(300 + i, t) for i, (_, t) in enumerate(rows[:20])]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(400 + i, passage + " " + " ".join(f"q{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(5, 40)))) for i in range(60)]
    rows += [(500, "One two three"), (501, "one TWO three"), (502, "one two"), (503, None), (504, ""), (505, " \t\n"),
             (506, "a b c d"), (507, "a b c d a b c d"), (508, " x y z w"), (None, rows[0][1]), (None, "only here without id now"),
             (None, "only here without id now"), (None, None), (0, rows[0][1]), (600, "ÀB cd Ef gh ij"), (601, "Àb CD ef GH ij")]
    rows += [(700, " ".join(f"l{i}" for i in range(60_000))), (701, " ".join(f"l{i}" for i in range(100, 60_000)))]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns(
        {c: F.lit(1) for c in ("n", "key", "sig", "id", "th", "label", "nid", "bucket")})
    want = Counter({k: n for k, n in brute([(k, t) for k, t in rows]).items()})
    fix = Counter()
    for (k, n, c, kept), m in want.items():  # a component without any id keeps its rows; empty sets stand for themselves
        fix[(k, n, k if n == 0 else c, k == (k if n == 0 else c))] += m
    assert found(M.near_duplicates(df, crowded=crowded)) == fix


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_rarest_shingles_meet(spark, percent):
    """Every pair of different labels that reaches the similarity shares one of its rarest shingles."""
    rnd = random.Random(percent)
    rows = [(k, t, k % 7) for k, t in family(rnd, 0, 60, 60, 14) + family(rnd, 100, 40, 25, 6)]
    rows += [(200 + i, " ".join(t.split()[:rnd.randrange(5, 60)]), i % 5) for i, (_, t, _) in enumerate(rows[:40])]
    unique = {frozenset(shingle_set(t)): (k, t, label) for k, t, label in rows}
    sets = {k: (s, t, label) for s, (k, t, label) in unique.items()}
    df = spark.createDataFrame([(k, len(s), label, t.encode()) for k, (s, t, label) in sets.items()],
                               "nid long, n long, label int, text binary")
    got = {(r.a, r.b) for r in M.prefix_pairs(df, 4, percent).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and sets[a][2] != sets[b][2]
            and 100 * len(sets[a][0] & sets[b][0]) >= percent * len(sets[a][0] | sets[b][0])}
    assert want and want <= got and all(sets[a][2] != sets[b][2] for a, b in got)


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = Counter()
    for (k, n, c, _), m in brute(rows).items():
        want[(k, n, k if n == 0 else c, k == (k if n == 0 else c))] += m
    assert found(QUERIES["op11_minhash_near_dedup"](spark, SF001)) == want


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert M.near_duplicates(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (2, " ")], SCHEMA)
    assert found(M.near_duplicates(blank)) == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 2})
