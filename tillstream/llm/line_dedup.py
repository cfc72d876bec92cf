"""Line dedup: content-defined chunks of lines, repeated ones removed.

Lines are hashed, a rolling hash over the last lines' hashes chooses the chunk
boundaries, so an insertion moves only the boundaries next to it. A line of
several words has boundaries on both sides, so that what surrounds a passage
never hides its lines. A chunk that occurs again anywhere stands only at its
first place in order of (doc_id, position) and is repeated elsewhere - after a
byte comparison, never on its hash alone. What is removed are runs of repeated
chunks with several lines (a chunk of several lines with words, or repeated
chunks side by side) or with one line of many words; a short line alone stays.

Only hashes are shuffled to find what repeats (partial counts combine the
copies of a hot chunk map-side). Lists of repeated chunks belong to rows (doc_id
and a hash of the text; equal rows share theirs), so that of a null or repeated
id is no longer than the row's own chunks. Texts meet these lists twice, for the
comparison and at the end; only repeated chunks' texts move to be compared, and
copies are combined map-side there, too.

Defined results: a null text stays null and an empty one empty; rows sharing a
doc_id count as one document, so what one of them keeps the others keep too; a
document with a null id never holds the first place, and a chunk that only
such documents have is removed only where it repeats inside a row; a text whose
chunks all go becomes empty; clashing input columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, RESERVED, discard, let, written

#: Lines in the rolling window, mean lines between boundaries.
WINDOW = 2
DIVISOR = 2
#: Rolling hash: line hashes of 28 bits, a base and a prime modulus (products stay below 2^63).
BASE, PRIME = 1_000_003, 2_147_483_647
#: Words from which a line has boundaries of its own.
OWN_WORDS = 8
#: A lone repeated chunk needs this many lines with a word, or this many words.
MIN_LINES, MIN_WORDS = 2, 50

_CHUNKS, _FOUND, _TOLD = f"{RESERVED}chunks", f"{RESERVED}found", f"{RESERVED}told"


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def _chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{NOT_SPACE}+"))


def _ends(lines: Column, window: int, divisor: int, own_words: int) -> Column:
    """Line counts at which chunks end: after a boundary, and at the end.

    ``lines``: structs of a line's hash ``h`` and whether it stands alone (``own``).
    """
    own = lambda i: F.coalesce(F.get(lines, i)["own"], F.lit(False))

    def boundary(end: Column) -> Column:
        rolled = sum((F.get(lines, end - 1 - k)["h"] * pow(BASE, k, PRIME) for k in range(1, window)),
                     F.get(lines, end - 1)["h"])
        return ((end >= window) & (rolled % PRIME % divisor == 0)) | own(end - 1) | own(end)

    every = F.sequence(F.lit(1), F.size(lines))
    return F.filter(every, lambda e: (e == F.size(lines)) | F.coalesce(boundary(e), F.lit(False)))


def chunks_of(text: Column, window: int = WINDOW, divisor: int = DIVISOR, own_words: int = OWN_WORDS) -> Column:
    """Array of chunk texts; joined by line breaks they give the text back."""
    seen_as = lambda x: F.struct(_line_hash(x).alias("h"), (_n_words(x) >= own_words).alias("own"))

    def cut(lines: Column) -> Column:
        ends_of = lambda told: _ends(told, window, divisor, own_words)
        return let(let(F.transform(lines, seen_as), ends_of), lambda ends: F.transform(
            ends, lambda e, k: let(F.coalesce(F.get(ends, k - 1), F.lit(0)), lambda start: F.array_join(
                F.slice(lines, start + 1, e - start), "\n"))))

    return let(F.split(F.coalesce(text, F.lit("")), "\n"), cut)


def _alone(chunk: Column, min_lines: int, min_words: int) -> Column:
    """Whether a repeated chunk goes without a repeated neighbour."""
    worded = F.size(F.filter(F.split(chunk, "\n"), lambda x: x.rlike(NOT_SPACE)))
    return (worded >= min_lines) | (_n_words(chunk) >= min_words)


def _row_hash(text: Column) -> Column:
    """What tells rows of one doc_id apart."""
    return F.xxhash64(text)


def _of_row(docs: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with what was ``found`` for each row, by (id, row)."""
    same = F.col(doc_id).eqNullSafe(F.col("id")) & (_row_hash(F.col(text)) == F.col("row"))
    return docs.join(found, same, "left").drop("id", "row")


def repeated_chunks(docs: DataFrame, doc_id: str, text: str, chunks: Column) -> DataFrame:
    """Per row, by (id, row): its repeated chunks as ``found``, an array of (hash, first doc_id)."""
    chunk = F.col("chunk")
    seen = written(
        docs.select(F.col(doc_id).alias("id"), _row_hash(F.col(text)).alias("row"), F.explode(chunks).alias("chunk"))
        .where(chunk.rlike(NOT_SPACE))
        .select("id", "row", _chunk_hash(chunk).alias("hash")), "chunk_hashes")
    again = written(seen.groupBy("hash").agg(F.count("*").alias("n"), F.min("id").alias("first"))
                    .where("n > 1").select("hash", "first"), "repeated_hashes")
    found = written(seen.join(again, "hash").groupBy("id", "row")
                    .agg(F.collect_set(F.struct("hash", "first")).alias(_FOUND)), "repeated_of_rows")
    discard(seen, again)
    return found


def _unequal(docs: DataFrame, found: DataFrame, doc_id: str, text: str, chunks: Column) -> DataFrame | None:
    """Byte comparison: per row, hashes of repeated chunks that differ from the first occurrence.

    A hash whose least and greatest text are the same has one text. Only where that fails (None if
    nowhere) are its chunks held against the first occurrence one by one.
    """
    hashes, firsts_of = F.col(_FOUND)["hash"], F.col(_FOUND)["first"]
    same = F.col(doc_id).eqNullSafe(F.col("id")) & (_row_hash(F.col(text)) == F.col("row"))
    chunk = (docs.join(found.select("id", "row", _FOUND), same)
             .select(F.col(doc_id).alias("id"), _row_hash(F.col(text)).alias("row"), _FOUND, F.explode(chunks).alias("chunk"))
             .select("id", "row", "chunk", _FOUND, F.array_position(hashes, _chunk_hash(F.col("chunk"))).alias("at"))
             .where("at > 0")
             .select("id", "row", "chunk", F.get(hashes, F.col("at").cast("int") - 1).alias("hash"),
                     F.get(firsts_of, F.col("at").cast("int") - 1).alias("first")))
    shared = written(chunk.groupBy("hash").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
                     .where("low != high").select("hash"), "shared_hashes")
    if shared.isEmpty():
        discard(shared)
        return None
    chunk = written(chunk.join(shared, "hash"), "chunks_of_shared_hashes")
    firsts = chunk.where(F.col("id") == F.col("first")).groupBy("hash").agg(F.min("chunk").alias("original"))
    others = chunk.where(~F.col("id").eqNullSafe(F.col("first")))
    unequal = written(others.join(firsts, "hash").where(F.col("chunk") != F.col("original"))
                      .groupBy("id", "row").agg(F.collect_set("hash").alias(_TOLD)), "unequal")
    discard(shared, chunk)
    return unequal


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                divisor: int = DIVISOR, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
                own_words: int = OWN_WORDS) -> DataFrame:
    """``docs`` with ``text`` less its repeated chunks, and ``n_lines``,
    ``n_removed_lines`` (lines of the text given, and those removed)."""
    names = {c: f"{RESERVED}in_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in names.items()])
    key, body = names[doc_id], names[text]
    chunks = chunks_of(F.col(body), window, divisor, own_words)
    found = repeated_chunks(plain, key, body, chunks)
    unequal = _unequal(plain, found, key, body, chunks)
    if unequal is None:
        told = _of_row(plain, found, key, body).withColumn(_TOLD, F.array().cast("array<bigint>"))
    else:
        told = _of_row(_of_row(plain, found, key, body), unequal, key, body)

    def repeated(chunk: Column, place: Column, chunks: Column) -> Column:
        def judged(at: Column) -> Column:
            first = F.get(F.col(_FOUND)["first"], at - 1)
            untrue = F.coalesce(F.array_contains(_TOLD, F.get(F.col(_FOUND)["hash"], at - 1)), F.lit(False))
            elsewhere = first.isNotNull() & ~F.col(key).eqNullSafe(first) & ~untrue
            return (at > 0) & (F.coalesce(elsewhere, F.lit(False)) | (F.array_position(chunks, chunk) <= place))

        return let(F.array_position(F.col(_FOUND)["hash"], _chunk_hash(chunk)).cast("int"), judged)

    lines = F.size(F.split(F.coalesce(F.col(body), F.lit("")), "\n"))

    def kept_of(chunks: Column) -> Column:
        def kept(flags: Column) -> Column:
            beside = lambda k: F.coalesce(F.get(flags, k), F.lit(False))
            return F.filter(chunks, lambda x, k: ~(F.get(flags, k) & (
                beside(k - 1) | beside(k + 1) | _alone(x, min_lines, min_words))))

        return let(F.transform(chunks, lambda x, k: repeated(x, k, chunks)), kept)

    kept = let(chunks, kept_of)
    has = F.size(F.coalesce(F.col(_FOUND), F.array())) > 0
    out = told.withColumn(_CHUNKS, F.when(has, kept))
    left = F.when(has, F.array_join(_CHUNKS, "\n")).otherwise(F.col(body))
    n_left = F.when(has, F.when(F.size(_CHUNKS) == 0, 0).otherwise(
        F.size(F.split(F.array_join(_CHUNKS, "\n"), "\n")))).otherwise(lines)
    counts = {"n_lines": lines.cast("long"), "n_removed_lines": (lines - n_left).cast("long")}
    return out.select(*[(left if c == text else F.col(a)).alias(c) for c, a in names.items() if c not in counts],
                      *[v.alias(c) for c, v in counts.items()])
