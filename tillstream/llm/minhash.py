"""MinHash near-duplicates: SuperMinHash signatures, banding, verification, union-find.

Every shingle of a document walks through a random permutation of the signature
slots; its j-th slot gets j plus a uniform fraction, the slot's minimum stays.
The ranks of one element are correlated (a permutation), which lowers the
variance against independent hashes. Once every slot holds less than j, no
later step of any element can matter and the document stops.

Documents with the same set are one node. Slots are cut into bands of four;
nodes that agree in a band share a bucket. At a similarity of 0.8, a pair shares
no bucket with a probability of (1 - 0.8 ^ 4) ^ 32 = 5e-8. Buckets are never
expanded into all their pairs: in a few rounds every node is held against one
node that stands for its bucket (first the one that shares most buckets, then
another one each round), and what is confirmed is united, so that a group of
near copies, however large, melts into one component at a linear cost. Then only
buckets are left that hold different components. Small ones are compared across
components. Nodes of crowded ones meet exactly: of two similar sets, the rarest
shingles (as many as may differ) have one in common, so they meet there, by size
classes, and components only with others. A pair is dismissed unread where the
signatures agree in less than 0.6 of the slots (six standard deviations below
0.8), else both texts' full shingle sets decide, as strings.

Defined results: shingles are case-folded for A-Z only; a document of fewer
words than a shingle is one shingle; null, empty and white-space texts have an
empty set, are linked with nothing and stand for themselves; repeated rows share
set and component; a null doc_id takes part but is a component's id only where
there is no other (then ``kept`` is true); an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import temporary_conf
from .common import discard, written
from .simhash import components

SHINGLE, PERCENT = 4, 80
#: Signature slots, slots a band.
SLOTS, BAND = 128, 4
#: Rounds in which one node stands for its bucket.
ROUNDS = 3
#: Pairs whose signatures agree in a smaller share of the slots are dismissed.
LEAST_AGREEMENT = 0.6
#: Nodes in a bucket up to which its pairs are compared as they are; rows of one representative a task.
CROWDED, SALT_ROWS = 32, 1_000
#: Pairs of texts that a worker is handed at once.
TEXT_ROWS = 200
#: Ratio between size classes.
CLASS = 1.05

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLOCK = 1 << 15  # shingles walked at once
_U = np.uint64
_ODD, _STEP, _MIX1, _MIX2 = _U(0x9E3779B97F4A7C15), 0x9E3779B97F4A7C15, _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> _U(30))) * _MIX1
    z = (z ^ (z >> _U(27))) * _MIX2
    return z ^ (z >> _U(31))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWER).split()


def shingles(ws: list[bytes], k: int) -> set:
    """Distinct shingles of ``k`` words; fewer words are one shingle."""
    if len(ws) < k:
        return {tuple(ws)} if ws else set()
    return set(zip(*(ws[i:] for i in range(k))))


def shingle_hashes(ws: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, ws), dtype=np.uint64, count=len(ws))
    n = max(len(ws) - k + 1, 1) if ws else 0
    out = np.zeros(n, dtype=np.uint64)
    for i in range(min(k, len(ws))):
        out = out * _ODD + h[i:i + n]
    return np.unique(_mix(out + _U(len(ws[:k]))))


def super_minhash(elements: np.ndarray, owner: np.ndarray, best: np.ndarray) -> None:
    """Lower ``best`` (documents x slots) by the walks of ``elements`` of the documents ``owner``.

    Slot values are the step in the upper and a uniform fraction in the lower 32 bits.
    """
    slots = best.shape[1]
    flat, low = best.reshape(-1), _U(0xFFFFFFFF)
    order = np.tile(np.arange(slots, dtype=np.int32), (len(elements), 1))
    active = np.arange(len(elements))
    for j in range(slots):
        z = _mix(elements[active] + _U((j + 1) * _STEP & 0xFFFFFFFFFFFFFFFF))
        pick = j + ((z >> _U(32)) * _U(slots - j) >> _U(32)).astype(np.int64)
        slot = order[active, pick]
        order[active, pick] = order[active, j]
        np.minimum.at(flat, owner[active] * slots + slot, (z & low) | _U(j << 32))
        # A slot that holds at most the next step's least value cannot be lowered any more.
        active = active[(best.max(axis=1) > _U((j + 1) << 32))[owner[active]]]
        if not len(active):
            break


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Signatures (documents x slots, 16 bits each) of sets of hashes, none empty."""
    best = np.full((len(sets), slots), _EMPTY)
    start = 0
    while start < len(sets):
        stop, size = start, 0
        while stop < len(sets) and (stop == start or size + len(sets[stop]) <= _BLOCK):
            size += len(sets[stop])
            stop += 1
        if stop == start + 1:  # perhaps a long one: block by block
            for a in range(0, size, _BLOCK):
                part = sets[start][a:a + _BLOCK]
                super_minhash(part, np.zeros(len(part), dtype=np.int64), best[start:stop])
        else:
            super_minhash(np.concatenate(sets[start:stop]),
                          np.repeat(np.arange(stop - start), [len(s) for s in sets[start:stop]]), best[start:stop])
        start = stop
    return (_mix(best) >> _U(48)).astype("<u2")


def signed(text: Column, shingle: int = SHINGLE, slots: int = SLOTS) -> Column:
    """Struct of a text: ``n`` (set size), ``key`` (128-bit digest of the set), ``sig`` (2 bytes a slot)."""
    @F.pandas_udf("n long, key binary, sig binary")
    def of(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_hashes(words(t), shingle) for t in texts]
        full = [i for i, s in enumerate(sets) if len(s)]
        sigs = [None] * len(sets)
        for i, row in zip(full, signatures([sets[i] for i in full], slots)):
            sigs[i] = row.tobytes()
        return pd.DataFrame({"n": [len(s) for s in sets],
                             "key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "sig": sigs})

    return of(text.cast("binary"))


def _agreement(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        u, v = (np.frombuffer(b"".join(s), dtype="<u2").reshape(len(s), -1) for s in (x, y))
        return pd.Series((u == v).mean(axis=1))

    return share(a, b)


def _linked(a: Column, b: Column, k: int, percent: int) -> Column:
    """Whether the full shingle sets of two texts reach the similarity; rows of one ``b`` stand together."""
    @F.pandas_udf("boolean")
    def judge(x: pd.Series, y: pd.Series) -> pd.Series:
        out, last, held = [], None, set()
        for s, t in zip(x, y):
            if t != last:
                last, held = t, shingles(words(t), k)
            own = shingles(words(s), k)
            both = len(own & held)
            out.append(100 * both >= percent * (len(own) + len(held) - both))
        return pd.Series(out, dtype=bool)

    return judge(a, b)


class _Verifier:
    """Confirms candidate pairs (a, b) of nodes."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int):
        self.nodes, self.texts, self.shingle, self.percent = nodes, texts, shingle, percent

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        side = lambda p: self.nodes.select(
            F.col("nid").alias(p), F.col("n").alias(f"n_{p}"), F.col("sig").alias(f"sig_{p}"))
        size = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        likely = written(pairs.join(side("a"), "a").join(side("b"), "b").where(size)
                         .where(_agreement(F.col("sig_a"), F.col("sig_b")) >= LEAST_AGREEMENT)
                         .select("a", "b"), "likely_pairs")
        # A node that many are held against is copied to as many tasks as its pairs need.
        copies = written(likely.groupBy("b").agg((F.floor(F.count(F.lit(1)) / SALT_ROWS) + 1).cast("int").alias("copies")),
                         "held_against")
        text = lambda p: self.texts.select(F.col("nid").alias(p), F.col("text").alias(f"text_{p}"))
        held = copies.join(text("b"), "b").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        met = (likely.join(copies, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int"))
               .select("a", "b", "salt").join(text("a"), "a").join(held.select("b", "salt", "text_b"), ["b", "salt"]))
        with temporary_conf(pairs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(TEXT_ROWS)}):
            out = written(met.sortWithinPartitions("b")
                          .where(_linked(F.col("text_a"), F.col("text_b"), self.shingle, self.percent)).select("a", "b"), "linked")
        discard(likely, copies)
        return out


def _open_buckets(live: DataFrame, turn: int) -> DataFrame:
    """Buckets of ``live`` (bucket, nid, degree, label) with different labels; ``rep`` changes with the turn."""
    first = F.struct(-F.col("degree"), "nid") if turn == 0 else F.xxhash64(F.col("nid"), F.lit(turn))
    return (live.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"),
        F.min_by(F.struct("nid", "label"), first).alias("rep"))
        .where("low != high").select("bucket", "size", "rep"))


def _across(live: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs (a, b), a < b, of different labels that share ``keys``."""
    side = lambda p: live.select(*keys, F.col("nid").alias(p), F.col("label").alias(f"l_{p}"))
    return side("a").join(side("b"), keys).where("a < b and l_a != l_b").select("a", "b")


def prefix_pairs(sets: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of different labels among ``sets`` (nid, n, label, text): all that
    reach the similarity, and others that share one of their rarest shingles.

    Shingles are ordered by how many of the sets have them. Sets of sizes x >= y that reach the
    similarity share t = percent * (x + y) / (100 + percent) shingles, hence one among the first
    x - t + 1 and y - t + 1. The smaller one is filed under its size class, the larger one asks
    every class within reach. Under a shingle, the most frequent label meets only the others.
    """
    @F.pandas_udf("array<long>")
    def hashes(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_hashes(words(t), shingle).view(np.int64) for t in texts], dtype=object)

    need = lambda both: F.ceil(F.lit(percent) * both / F.lit(100 + percent))
    n, at, size_class = F.col("n"), F.col("at"), lambda v: F.floor(F.log(v.cast("double")) / float(np.log(CLASS)))
    tokens = written(sets.select("nid", "n", "label", F.explode(hashes("text")).alias("token")), "shingles")
    common = tokens.groupBy("token").count().where("count > 1")
    of_node = Window.partitionBy("nid")
    least = F.ceil(F.lit(percent) * n / 100)
    ranked = written(
        tokens.join(common, "token")
        .withColumn("at", n - F.count(F.lit(1)).over(of_node) + F.row_number().over(of_node.orderBy("count", "token")) - 1)
        .where(at <= n - least).drop("count"), "rare_shingles")
    filed = ranked.where(at <= n - need(2 * n)).withColumn("class", size_class(n))
    asked = (ranked.withColumn("class", F.explode(F.sequence(size_class(F.greatest(least, F.lit(1))), size_class(n))))
             .withColumn("from", F.greatest(F.floor(F.pow(F.lit(CLASS), F.col("class"))), least))
             .where(at <= n - need(n + F.col("from"))).drop("from"))
    posted = filed.select("token", "class", "label").unionByName(asked.select("token", "class", "label"))
    labels = posted.groupBy("token", "class", "label").count()
    major = written(labels.groupBy("token", "class").agg(F.count(F.lit(1)).alias("labels"), F.max_by("label", "count").alias("major"))
                    .where("labels > 1").select("token", "class", "major"), "shared_shingles")
    side = lambda df, p: df.join(major, ["token", "class"]).select(
        "token", "class", (F.col("label") == F.col("major")).alias(f"major_{p}"),
        *[F.col(c).alias(f"{c}_{p}") for c in ("nid", "n", "label", "at")])
    y, x = written(side(filed, "y"), "filed_shingles"), written(side(asked, "x"), "asked_shingles")
    enough = 1 + F.least(F.col("n_x") - F.col("at_x") - 1, F.col("n_y") - F.col("at_y") - 1) >= need(F.col("n_x") + F.col("n_y"))
    fits = (F.col("n_y") <= F.col("n_x")) & (F.col("label_x") != F.col("label_y")) & enough
    meet = lambda u, v: u.join(v, ["token", "class"]).where(fits).select(
        F.least("nid_x", "nid_y").alias("a"), F.greatest("nid_x", "nid_y").alias("b"))
    out = written(meet(x.where("not major_x"), y).unionByName(meet(x.where("major_x"), y.where("not major_y"))).distinct(),
                  "rare_pairs")
    discard(tokens, ranked, major, x, y)
    return out


def link_components(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, shingle: int, percent: int,
                    band: int = BAND, rounds: int = ROUNDS, crowded: int = CROWDED) -> DataFrame:
    """(nid, label): the smallest node reachable, for the nodes that have a link.

    ``nodes``: (nid, n, sig, id, th), one row a distinct set; ``id`` and ``th`` name a row of ``docs`` that has it.
    """
    width = 2 * band
    bands = nodes.select("nid", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS // band - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * width + 1, F.lit(width))))).alias("bucket"))
    bands = written(bands, "bands")
    shared = bands.groupBy("bucket").count().where("count > 1")
    members = written(bands.join(shared, "bucket"), "shared_buckets")
    discard(bands)
    degrees = members.groupBy("nid").agg(F.sum("count").alias("degree"))
    bare, members = members, written(members.select("bucket", "nid").join(degrees, "nid"), "bucket_members")
    discard(bare)
    asked = members.select("nid").distinct().join(nodes.select("nid", "id", "th"), "nid")
    found = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("hash"), F.col(text).cast("binary").alias("text"))
    texts = written(found.join(asked, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("th")))
                    .groupBy("nid").agg(F.first("text").alias("text")), "candidate_texts")
    verifier = _Verifier(nodes, texts, shingle, percent)
    labels, edges = None, []

    def live() -> DataFrame:
        if labels is None:
            return members.withColumn("label", F.col("nid"))
        return members.join(labels, "nid", "left").withColumn("label", F.coalesce("label", "nid"))

    def unite(new: DataFrame):
        nonlocal labels
        if new.isEmpty():
            discard(new)
            return False
        edges.append(new)
        known = edges[0]
        for e in edges[1:]:
            known = known.unionByName(e)
        if labels is not None:
            discard(labels)
        labels = written(components(known).select(F.col("node").alias("nid"), F.col("component").alias("label")), "node_labels")
        return True

    for turn in range(rounds):
        now = live()
        buckets = _open_buckets(now, turn)
        held = (now.join(buckets, "bucket").where(F.col("label") != F.col("rep.label"))
                .groupBy(F.col("nid").alias("a"), F.col("rep.nid").alias("b")).count()
                .groupBy("a").agg(F.max(F.struct("count", "b")).alias("best")).select("a", "best.b"))
        if not unite(verifier.confirmed(held)):
            break
    now = written(live(), "bucket_labels")
    buckets = written(_open_buckets(now, rounds), "open_buckets")
    left = now.join(buckets.select("bucket", "size"), "bucket")
    dense = (left.where(F.col("size") > crowded).select("nid", "label").distinct()
             .join(nodes.select("nid", "n"), "nid").join(texts, "nid"))
    small = _across(left.where(F.col("size") <= crowded), ["bucket"])
    if dense.isEmpty():
        pairs = written(small.distinct(), "pairs_across")
    else:
        rare = prefix_pairs(dense, shingle, percent)
        pairs = written(small.unionByName(rare).distinct(), "pairs_across")
        discard(rare)
    unite(verifier.confirmed(pairs))
    discard(members, texts, now, buckets, pairs, *edges)
    return labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT, **options) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` (the smallest
    doc_id reachable by links) and ``kept`` (whether that is its own)."""
    rows = written(docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("th"),
                               signed(F.col(text), shingle).alias("s")).select("id", "th", "s.*"), "signatures")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    nodes = written(rows.where("n > 0").groupBy("key")
                    .agg(F.min(first).alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig"))
                    .select(F.monotonically_increasing_id().alias("nid"), "key", "n", "sig", "first.id", "first.th"), "nodes")
    labels = link_components(docs, nodes, doc_id, text, shingle, percent, **options)
    label = F.col("nid") if labels is None else F.coalesce("label", "nid")
    named = nodes.select("nid", "key", F.col("id").alias("first"))
    if labels is not None:
        named = named.join(labels, "nid", "left")
    named = named.withColumn("label", label)
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of = written(named.join(smallest, "label").select(F.col("key").alias("k"), "component_id"), "components_of_sets")
    out = rows.where("n > 0").join(of, F.col("key") == F.col("k")).select("id", "n", "component_id").unionByName(
        rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
