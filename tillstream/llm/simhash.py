"""SimHash near-duplicates: segment-popcount embedding and a grid range join.

A fingerprint's 64 bits are cut into 32 segments of two bits; the popcounts of
the segments (0, 1 or 2 each) are its embedding. The Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints, so it is a
lower bound to filter with. Of a pair within ``max_bits`` (at most 3), one half
of the embedding (16 segments) lies within distance 1. Every fingerprint is
therefore filed in its two half-grid cells and probes each cell and its upper
neighbours; what meets is verified exactly by ``bit_count(a ^ b)``.

Only distinct fingerprints take part: copies, however many, are one node. A
node has at most 2,080 others within two bits, so its degree is bounded by
geometry. Cells that many nodes share are split by the same argument over the
quarters of the other half, so no cell is compared whole.

Defined results: a null or empty text has fingerprint zero, linked like any
other; repeated rows share a fingerprint and a component; a null doc_id takes
part but is never a component's id (a component of null ids only has a null
id); very long texts are hashed block by block; an empty table gives an empty
result; near_duplicates reads no other columns, keep_one passes them through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RESERVED, discard, written

SEED = 42
#: Cells with more nodes than this are split by the quarters of the other half.
CROWDED = 2_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Row b: the bits of byte value b, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BLOCK = 1 << 16


def text_fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one UTF-8 text (ASCII-lowered, ASCII white space splits words)."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros((8, 256), dtype=np.int64)
    lanes = (np.arange(8, dtype=np.int64) * 256)[None, :]
    for lo in range(0, n, _BLOCK):  # long texts block by block
        hi = min(lo + _BLOCK, n)
        part = words[lo:hi + shingle - 1]
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED)
                  for s in (zip(*(part[k:] for k in range(shingle))) if len(words) >= shingle else [part])]
        lane = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8) + lanes
        ones += np.bincount(lane.ravel(), minlength=2048).reshape(8, 256)
    set_ = 2 * (ones @ _BITS).ravel() > n
    return int(np.packbits(set_, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Column of signed 64-bit fingerprints (Arrow batches, one text at a time in memory)."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def _half(fp: Column, half: int) -> Column:
    """Popcounts of a half's 16 two-bit segments, packed two bits each."""
    bits = F.shiftrightunsigned(fp, 32) if half else fp.bitwiseAND(F.lit(0xFFFFFFFF))
    return bits - F.shiftright(bits, 1).bitwiseAND(F.lit(0x55555555))


def _with_upper(cell: Column, segments: int) -> Column:
    """The cell and its neighbours one step up in one segment."""
    steps = [F.lit(0).cast("long")] + [
        F.when(F.shiftright(cell, 2 * s).bitwiseAND(F.lit(3)) < 2, F.lit(1 << (2 * s)).cast("long"))
        for s in range(segments)]
    return F.transform(F.array_compact(F.array(*steps)), lambda x: cell + x)


def _near(max_bits: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits


def _cells(nodes: DataFrame) -> DataFrame:
    return nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(h).alias("half"), _half(F.col("fp"), h).alias("cell"),
                 _half(F.col("fp"), 1 - h).alias("other")) for h in (0, 1)])).alias("c")).select("fp", "c.*")


def _quarters(df: DataFrame) -> DataFrame:
    return df.select("*", F.explode(F.array(*[
        F.struct(F.lit(q).alias("quarter"),
                 F.shiftright("other", 16 * q).bitwiseAND(F.lit(0xFFFF)).alias("sub")) for q in (0, 1)])).alias("q")) \
        .select("fp", "half", "cell", "q.*")


def _meet(filed: DataFrame, probes: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    return (probes.withColumnRenamed("fp", "a").join(filed.withColumnRenamed("fp", "b"), keys)
            .where((F.col("a") != F.col("b")) & _near(max_bits))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def links(nodes: DataFrame, max_bits: int = 2, crowded: int = CROWDED) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints within ``max_bits`` bits, each once.

    ``nodes``: one row per distinct fingerprint, column ``fp``.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves within distance 1 cover at most 3 bits")
    filed = _cells(nodes)
    probes = filed.select("fp", "half", "other", F.explode(_with_upper(F.col("cell"), 16)).alias("cell"))
    full = written(filed.groupBy("half", "cell").count().where(F.col("count") > crowded)
                   .select("half", "cell"), "crowded_cells")
    keys = ["half", "cell"]
    thin = _meet(filed.join(full, keys, "left_anti").drop("other"), probes.drop("other"), keys, max_bits)
    # Crowded cells: the other half is within max_bits, so one of its quarters is within 1,
    # in either direction (the probe's own cell may lie below or in the crowded one).
    dense_filed = _quarters(filed.join(full, keys, "left_semi"))
    dense_probes = _quarters(probes.join(full, keys, "left_semi"))
    around = F.array_distinct(F.concat(_with_upper(F.col("sub"), 8), _with_lower(F.col("sub"), 8)))
    dense = _meet(dense_filed, dense_probes.withColumn("sub", F.explode(around)),
                  ["half", "cell", "quarter", "sub"], max_bits)
    return thin.unionByName(dense).distinct()


def _with_lower(cell: Column, segments: int) -> Column:
    steps = [F.when(F.shiftright(cell, 2 * s).bitwiseAND(F.lit(3)) > 0, F.lit(1 << (2 * s)).cast("long"))
             for s in range(segments)]
    return F.transform(F.array_compact(F.array(*steps)), lambda x: cell - x)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (a, b); component = smallest node reachable.

    Rounds of: take the smallest label among the neighbours, hook the own label
    to it, shortcut labels of labels. Edges keep their end points, so no join
    key gathers a component; each round is a written table (no growing plan).
    """
    both = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                   .unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))), "edges")
    total = lambda df: df.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
    labels = written(both.groupBy(F.col("u").alias("node"))
                     .agg(F.least(F.min("v"), F.col("u")).alias("component")), "labels")
    before, now = None, total(labels)
    while before != now:
        lowest = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("component").alias("low"))
        seen = labels.join(lowest, labels.node == lowest.u).select(
            "node", "component", F.least("component", "low").alias("low"))
        hooked = (seen.select("node", "low").unionAll(seen.select("component", "low"))
                  .groupBy("node").agg(F.min("low").alias("component")))
        hooked = written(hooked, "hooked")
        up = hooked.select(F.col("node").alias("p"), F.col("component").alias("pc"))
        old, labels = labels, written(hooked.join(up, hooked.component == up.p)
                                      .select("node", F.least("component", "pc").alias("component")), "labels")
        discard(old, hooked)
        before, now = now, total(labels)
    discard(both)
    return labels


def fingerprint_components(prints: DataFrame, doc_id: str, fp: str, max_bits: int = 2) -> DataFrame:
    """``(fp, component, component_id)`` for every distinct fingerprint of ``prints``: its
    component, and the smallest doc_id that links reach (null ids aside)."""
    nodes = written(prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first_id")), "nodes")
    edges = written(links(nodes.select("fp"), max_bits), "links")
    label = components(edges).select(F.col("node").alias("fp"), "component")
    labelled = nodes.join(label, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    out = written(labelled.join(smallest, "component").select("fp", "component", "component_id"),
                  "fingerprint_components")
    discard(nodes, edges)
    return out


def hexadecimal(fp: Column) -> Column:
    """16 lower-case hex digits of a 64-bit value."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (hex) and ``component_id``."""
    prints = written(docs.select(F.col(doc_id).alias("doc_id"),
                                 fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    of = fingerprint_components(prints, "doc_id", "fp", max_bits)
    return prints.join(of, "fp").select(
        F.col("doc_id").alias(doc_id), hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each component: the one of the smallest id (of repeated rows, one).

    Only ids and fingerprints are stored and compared; of the documents, those that go are
    named (fewer than those that stay), so that the texts move at most once. Ids that several
    rows have are told apart by the fingerprint of those rows, which is then taken again.
    """
    fp = f"{RESERVED}fp"
    prints = written(docs.select(F.col(doc_id).alias("id"), fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    of = fingerprint_components(prints, "id", "fp", max_bits)
    pairs = prints.groupBy("id", "fp").agg(F.count(F.lit(1)).alias("n"))
    placed = written(pairs.join(of, "fp").select("id", "fp", "n", "component"), "placed")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("fp").alias("fp")))
    kept = placed.groupBy("component").agg(first.alias("first")).select(
        F.col("first.id").alias("kept_id"), F.col("first.fp").alias("kept_fp"))
    rows = placed.groupBy(F.col("id").alias("of_id")).agg(F.sum("n").alias("rows")).where("rows > 1")
    # Met by row, not by component: a large component is not one task's.
    judged = written(placed.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("fp") == F.col("kept_fp")), "left")
                     .join(rows, F.col("id").eqNullSafe(F.col("of_id")), "left")
                     .select("id", "fp", F.col("kept_fp").isNotNull().alias("stays"), F.col("rows").isNotNull().alias("shared"))
                     .where("shared or not stays"), "judged")
    discard(prints, of, placed)
    gone = judged.select("id").distinct()
    out = docs.join(gone, docs[doc_id].eqNullSafe(gone["id"]), "left_anti")
    shared = judged.where("shared and stays").select("id", "fp")
    if shared.isEmpty():
        return out
    again = docs.join(shared, docs[doc_id].eqNullSafe(shared["id"]), "left_semi").withColumn(
        fp, fingerprint(F.col(text), shingle))
    again = again.join(shared, again[doc_id].eqNullSafe(shared["id"]) & (again[fp] == shared["fp"]), "left_semi")
    return out.unionByName(again.dropDuplicates([doc_id, fp]).drop(fp))
