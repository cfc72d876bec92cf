"""Packing and mixing: round trips, the subset choice, targets; and the whole pipeline."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF001
from oracle_util import duck
from test_llm_dedup import brute_components, brute_print
from tillstream.llm import mixing as M
from tillstream.llm import packing as P
from tillstream.llm.queries import line_dedup_sql, quality_sql, token_file

ODD = ["", " ", "a  b", " lead", "trail ", "x\n\ny", "x \ny", "x\n y", "a<|endoftext|>b <|endoftext|> c", "it's 'a' we'll.",
       "tab\tx \t y", "日本語 テキスト。 ", "a.\nB, c.\r\nd", "a,. b..", "\n", "x\x1c y", "\x85 a", "é́ ñ.", "1.5, 2,", " \n a",
       "a​b ​c", "𝔘𝔫 ²³. ½,", "ªº. x y  z", "ab " * 5000, "z" * 20_000]


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(token_file())


def check_pieces(rows, texts, exact, capacity=2048):
    """``texts``: list of (doc_id, text). Every id in one piece, sequences gapless and unpadded."""
    want = defaultdict(list)
    for key, text in texts:
        want[key].append([*exact.encode(text or "", add_special_tokens=False).ids, 1])
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity and end & (end - 1) == 0
    assert set(pieces) == set(want)
    for key, parts in pieces.items():
        got = Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in parts)
        if len(want[key]) > 1:  # repeated rows: their tokens in all
            assert sum(r.length for r in parts) == sum(map(len, want[key]))
            continue
        [ids] = want[key]
        end = 0
        for start, length, crc, total in sorted(got):
            assert start == end and total == len(ids)
            assert crc == zlib.crc32(np.array(ids[start:start + length], dtype="<u4").tobytes())
            end += length
        assert end == len(ids)
    return len(sequences)


def test_packing_round_trip(spark, exact):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    texts = docs + [(5000 + i, t) for i, t in enumerate([None, *ODD])] + [(None, "no id"), docs[0], docs[0]]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"start": F.lit("s"), "length": F.lit(1)})
    n = check_pieces(P.pack(df.repartition(3), token_file(), pool=16).collect(), texts, exact)
    tokens = sum(len(exact.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
    assert n <= tokens / 2048 + 3 * 12
    assert P.pack(df.limit(0), token_file()).count() == 0


def test_pieces_give_the_tokenizers_ids(exact):
    rnd = random.Random(8)
    units = P.PieceTokenizer(token_file(), cache=50)
    pieces = ["word", "Ünï", " ", "  ", "\n", "\t", ".", ",", "'s", "12", "<|endoftext|>", "日", " ", " ", "é"]
    texts = ODD + ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 12))) for _ in range(1500)]
    texts += ["".join(chr(c) for c in range(a, a + 7)) + " " + chr(a) * 2 for a in range(0, 0x2C0)]
    texts += ["".join(chr(rnd.choice([rnd.randrange(0x250), rnd.randrange(0xD000), 32, 10])) for _ in range(9)) for _ in range(3000)]
    for t in texts:
        assert units.encode(t).tolist() == exact.encode(t, add_special_tokens=False).ids, t[:80]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=5), st.integers(0, 30))
def test_subset_choice_is_closest(counts, room):
    taken = P.slack_choice(counts, room)
    assert all(0 < n <= counts[k] for k, n in taken.items())
    best = max(s for s in (sum(k * n for k, n in zip(counts, ns)) for ns in
                           itertools.product(*[range(c + 1) for c in counts.values()])) if s <= room)
    assert sum(k * n for k, n in taken.items()) == best


def water_level(sizes, weights):
    """Targets by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, excess, free = dict.fromkeys(sizes, 0.0), float(sum(sizes.values())), set(sizes)
    while excess > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += excess * weight[s] / total
        excess = sum(max(0, target[s] - 3 * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= 3 * sizes[s]:
                target[s] = 3.0 * sizes[s]
                free.discard(s)
    return target


def mix_rows():
    rnd = random.Random(6)
    rows = [(i, rnd.choice(["a", "b", "B", "é", None, "zz"]), rnd.randrange(0, 400)) for i in range(400)]
    rows += [(1000 + i, "hot", rnd.randrange(50)) for i in range(900)]
    return rows + [(2000, "none", 0), (2001, "tiny", 2), (None, "a", 7), (None, None, 9), (3, "a", 11), (3, "a", 11), (2002, "long", 60_000)]


@pytest.mark.parametrize("bucket_rows", [20, 100_000])
def test_mix_meets_targets(spark, bucket_rows):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumns(
        {"target": F.lit("x"), "placements": F.lit(1), "before": F.lit(2), "weight": F.lit(3)})
    out = M.plan(df, bucket_rows=bucket_rows).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in out) == Counter(rows)
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.before == 2
        assert all(0 <= p.position <= 1 for p in r.placements) and sum(p.words for p in r.placements) == r.taken
    want = water_level(dict(sizes), M.WEIGHTS)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    again = M.plan(df.repartition(5), bucket_rows=33).collect()
    assert Counter((r.doc_id, r.source, r.size, r.taken) for r in out) == Counter((r.doc_id, r.source, r.size, r.taken) for r in again)
    assert M.plan(df.limit(0)).count() == 0


def test_rows_without_an_id_are_spread(spark):
    """A third of all rows in one source and without an id: no bucket holds much more than it should."""
    rows = [(None, "hot", 5, f"t{i}") for i in range(3000)] + [(i, f"s{i % 40}", 5, f"u{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, text_md5 string")
    bits = 6  # 3000 rows in buckets of 50
    sizes = Counter(r[0] for r in df.where("source = 'hot'").select(
        M._bucket(M.order_key("doc_id", "text_md5"), F.lit(bits))).collect())
    assert len(sizes) == 2 ** bits and max(sizes.values()) < 2 * 3000 / 2 ** bits + 20
    out = M.by_position(M.plan(df, apart="text_md5", bucket_rows=50))
    rows = out.collect()
    told = [r.position for r in rows if r.position is not None]
    assert len(rows) == 9000 and told == sorted(told) and all(r.position is None for r in rows[len(told):])


def test_positions_follow_the_schedules(spark):
    """At every time the share of a source's demand that is placed is the integral of its schedule."""
    df = spark.createDataFrame([(i, s, 1) for s in "abc" for i in range(1000)], "doc_id long, source string, size long")
    placed = defaultdict(list)
    for r in M.plan(df).collect():
        placed[r.source] += [p.position for p in r.placements]
    for source, weight in zip("abc", M.WEIGHTS):
        knots = M.SCHEDULES[weight]
        for t in (0.1, 0.25, 0.5, 0.8):
            x = np.linspace(0, t, 2001)
            f = np.interp(x, *zip(*knots))
            area = ((f[1:] + f[:-1]) / 2).sum() * (t / 2000)
            assert np.mean(np.array(placed[source]) < t) == pytest.approx(area, abs=0.01)


def test_mixed_corpus(spark):
    text = "one two three"
    docs = spark.createDataFrame([(i, text, s) for i, s in enumerate("abc" * 50)] + [(900, None, "a"), (901, "", None)],
                                 "doc_id long, text string, source string").withColumn("words", F.lit(1))
    out = M.mix(docs)
    rows = out.collect()
    n = Counter(r.source for r in rows)
    assert out.columns == docs.columns and n == Counter({"a": 25, "b": 50, "c": 75})
    assert [r.source for r in rows[:20]].count("a") > [r.source for r in rows[-20:]].count("a")
    assert M.mix(docs.limit(0)).count() == 0


def nasty(spark):
    good = "The house of the man is in the town and it was old, as she said to him.\nOne day the river rose by the " \
           "bridge, and all of it was under water for a week.\nThen the rain was gone."
    docs = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    return docs + docs[:3] + [(None, good, "en", "src0", 1), (9001, None, None, None, None), (9002, "", "en", None, 0),
                              (9003, good, None, None, 5), (9004, good + " " + " ".join(f"the{i} of" for i in range(40_000)), "en", "src1", 9)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_against_brute_force(spark, exact):
    rows = nasty(spark)
    con = duck(SF001)

    def load(name, data):
        con.execute(f"CREATE TABLE {name} (doc_id BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)

    load("t1", [r[:2] for r in rows])
    kept = Counter(con.execute(f"SELECT doc_id, n_words FROM ({quality_sql('t1')}) WHERE kept").fetchall())
    docs = spark.createDataFrame(rows, SCHEMA)
    steps = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "source_mixing", "packing"]

    out1 = steps["quality_rules"](spark, docs, SF001).collect()
    assert Counter((r.doc_id, len((r.text or "").split())) for r in out1) == kept
    assert all(tuple(r) in set(rows) for r in out1)

    load("t2", [(r.doc_id, r.text) for r in out1])
    want = Counter((k, t) for k, t, _, _ in con.execute(line_dedup_sql("t2")).fetchall())
    out2 = steps["line_dedup"](spark, spark.createDataFrame(out1, SCHEMA), SF001).collect()
    assert Counter((r.doc_id, r.text) for r in out2) == want and all(r.n_chars == len(r.text) for r in out2)

    out3 = steps["simhash_near_dedup"](spark, spark.createDataFrame(out2, SCHEMA), SF001).collect()
    parts = brute_components([(r.doc_id, brute_print(r.text)) for r in out2])
    assert len(out3) == parts[1] and {r.doc_id for r in out3} == {c for _, _, c in parts[0]}
    assert all(r in out2 for r in out3)

    mixed = steps["source_mixing"](spark, spark.createDataFrame(out3, SCHEMA), SF001)
    out4 = mixed.collect()
    size = lambda r: len(r.text.split())  # noqa: E731  (these texts have ASCII white space only)
    sizes, taken = Counter(), Counter()
    for r in out3:
        sizes[r.source] += size(r)
    for r in out4:
        taken[r.source] += size(r)
    target = water_level(dict(sizes), M.WEIGHTS)
    assert mixed.columns == docs.columns and max(Counter(out4).values()) <= 3 and set(out4) <= set(out3)
    assert all(abs(taken[s] - target[s]) <= max(size(r) for r in out3 if r.source == s) for s in sizes)

    out5 = steps["packing"](spark, mixed, SF001).collect()
    check_pieces(out5, [(r.doc_id, r.text) for r in out4], exact)


def test_pipeline_runs_end_to_end_and_on_nothing(spark):
    pieces = corpus_pipeline.run(spark, SF001)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert pieces.count() > 0
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0


def test_stages_keep_extra_columns(spark):
    docs = spark.createDataFrame(nasty(spark)[:40], SCHEMA).withColumns(
        {c: F.lit(1) for c in ("kept", "n_words", "fp", "id", "component", "size", "target", "words", "n_lines", "rule")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns and out.count() > 0
