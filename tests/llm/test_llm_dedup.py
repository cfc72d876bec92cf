"""Line dedup and SimHash near-duplicates against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF001
from oracle_util import duck
from tillstream.llm import line_dedup as L
from tillstream.llm import simhash as S
from tillstream.llm.queries import line_dedup_sql


def lines_by_sql(rows):
    con = duck(SF001)
    con.execute("CREATE TABLE t (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    return sorted(con.execute(line_dedup_sql("t")).fetchall(), key=str)


def line_rows():
    rnd = random.Random(5)
    line = lambda: " ".join(rnd.choice("alpha beta gamma delta eps zeta eta".split()) + str(rnd.randrange(999)) for _ in range(6))
    passage = [line() for _ in range(14)]
    rows = []
    for i in range(40):
        own = [line() for _ in range(rnd.randrange(1, 9))]
        at = rnd.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + (passage if i % 3 == 0 else []) + own[at:])))
    rows += [(50, None), (51, ""), (52, "\n\n\n"), (53, "\n".join(passage * 3)), (54, rows[0][1]), (0, rows[0][1]),
             (None, rows[3][1]), (None, "only\nhere\nonly\nhere\nonly\nhere"), (55, "x" * 400), (56, "x" * 400),
             (57, "x" * 399), (59, "w " * 50), (60, "own line\n" + "w " * 50 + "\nend"), (61, "v " * 49), (62, "a\n" + "v " * 49 + "\nb"), (58, "\n".join(passage + ["tail"] * 3000)), (0, "another\ntext\nof the\nsame id")]
    return rows


def test_lines_against_sql(spark):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"id": F.lit(1), "hash": F.lit("h"), "n_lines": F.lit("gone"), "chunk": F.lit(2)})
    out = L.dedup_lines(df)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in out.collect()), key=str)
    assert got == lines_by_sql(rows)
    assert {r.id for r in out.select("id").collect()} == {1}
    assert L.dedup_lines(df.limit(0)).count() == 0


def test_shifted_passages_go(spark):
    """Wherever a passage of 20 lines stands, most of it goes: the edges up to the next boundary stay."""
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randrange(10 ** 6)}"
    text = lambda n: [" ".join(word() for _ in range(5)) for _ in range(n)]
    rows, passages = [], [text(20) for _ in range(12)]
    for i, passage in enumerate(passages):
        rows.append((i, "\n".join(text(3) + passage + text(2))))
        rows.append((100 + i, "\n".join(text(i) + passage + text(4))))
    out = {r.doc_id: r.n_removed_lines for r in
           L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i] == 0 for i in range(12)) and all(out[100 + i] <= 20 for i in range(12))
    assert sum(out[100 + i] for i in range(12)) > 0.7 * 20 * 12


@pytest.mark.parametrize("words", [12, 30, 60])
@pytest.mark.parametrize("n_lines", [1, 2, 3, 4, 5])
def test_short_passages_go_whole(spark, n_lines, words):
    """Passages of 1 to 5 lines and over 50 words between differing lines are found wherever they stand."""
    rnd = random.Random(n_lines * 100 + words)
    word = lambda: f"w{rnd.randrange(10 ** 6)}"
    line = lambda n: " ".join(word() for _ in range(n))
    around = lambda: [line(rnd.choice([2, 5, 9, 40])) for _ in range(rnd.randrange(4))]
    passages = [[line(words) for _ in range(n_lines)] for _ in range(20)]
    if n_lines * words <= 50:
        pytest.skip("a passage of over 50 words is meant")
    rows = [(k * 100 + i, [around(), p, around()]) for i, p in enumerate(passages) for k in (0, 1)]
    df = spark.createDataFrame([(i, "\n".join(sum(parts, []))) for i, parts in rows], "doc_id long, text string")
    left = {r.doc_id: (r.text or "").split("\n") for r in L.dedup_lines(df).collect()}
    whole = sum(not set(parts[1]) & set(left[i]) for i, parts in rows if i >= 100)
    assert whole >= 0.9 * len(passages)
    assert all(set(parts[0] + parts[2]) <= set(left[i]) for i, parts in rows)  # what is their own stays
    assert all("\n".join(left[i]) == "\n".join(sum(parts, [])) for i, parts in rows if i < 100)


def test_rows_of_one_id_keep_their_own_lists(spark):
    """Rows without an id, or that share one, hold only the repeated chunks of their own text."""
    rnd = random.Random(3)
    line = lambda: " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(9))
    texts = ["\n".join(line() for _ in range(8)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(k, t + "\nend") for t in texts for k in (None, 700)]
    rows += [(None, texts[0]), (None, texts[0]), (700, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("r"))
    found = L.repeated_chunks(df, "doc_id", "text", L.chunks_of(F.col("text")))
    assert max(len(r[L._FOUND]) for r in found.collect()) <= 9
    out = L.dedup_lines(df).select("doc_id", "text", "n_lines", "n_removed_lines", "row").collect()
    assert sorted((tuple(r)[:4] for r in out), key=str) == lines_by_sql(rows) and {r.row for r in out} == {"r"}


def test_bytes_decide_not_hashes(spark, monkeypatch):
    monkeypatch.setattr(L, "_chunk_hash", lambda c: F.lit(1).cast("long"))
    rows = [(1, "aa bb\ncc dd\nee\nff"), (2, "gg hh\nii jj\nkk\nll"), (3, "mm nn\noo pp\nqq\nrr")]
    out = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in out) == rows


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids = [p[0] for p in prints]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return ([(key, f"{p:016x}", least.get(find(i))) for i, (key, p) in enumerate(prints)],
            len({find(i) for i in range(len(ids))}))


def simhash_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(120).collect()]
    long = " ".join(f"w{i}" for i in range(70_000))
    return rows + [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "oNe"), (905, "É one"), (906, "é one"),
                   (907, long), (908, long + " end"), (None, rows[0][1]), (None, "nobody else has this text"), (3, rows[5][1]),
                   (rows[0][0], rows[0][1]), (909, "a b c\x0bd\x0ce")]


def test_simhash_against_brute_force(spark):
    rows = simhash_rows(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, parts = brute_components([(k, brute_print(t)) for k, t in rows])
    got = [tuple(r) for r in S.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    extra = df.withColumns({"fp": F.lit("a"), "component_id": F.lit("b"), "component": F.lit(1), "id": F.lit(0)})
    kept = S.keep_one(extra)
    assert kept.columns == extra.columns
    assert kept.count() == parts  # one row of each component, although two of them have a document 3
    assert S.near_duplicates(df.limit(0)).count() == 0 and S.keep_one(df.limit(0)).count() == 0


@pytest.mark.parametrize("crowded", [2_000, 8])
def test_links_miss_nothing(spark, crowded):
    rnd = random.Random(9)
    base, prints = rnd.getrandbits(64), {0, 1, 3, 7, (1 << 64) - 1, 1 << 63}
    for _ in range(200):
        near = base
        for b in rnd.sample(range(64), rnd.choice((1, 1, 2, 3))):
            near ^= 1 << b
        prints |= {near, rnd.getrandbits(64), base >> 32 << 32 | rnd.getrandbits(32)}
        if rnd.random() < 0.3:
            base = near
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for bits in (0, 1, 2, 3):
        want = {(min(a, b), max(a, b)) for a in map(signed, prints) for b in map(signed, prints)
                if 0 < ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits}
        got = [tuple(r) for r in S.links(nodes, bits, crowded).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    with pytest.raises(ValueError):
        S.links(nodes, 4)


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000 + i, 2000) for i in range(50)], "a long, b long")
    got = {r.node: r.component for r in S.components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(50)}, 2000: 1000}
    assert S.components(edges.limit(0)).count() == 0
