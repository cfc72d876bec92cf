"""Packing by minimum bin slack: documents into sequences of a fixed capacity.

Every task tokenizes its documents, emits full windows of long documents as
they are, and keeps the tails (shorter than a window) in a bounded pool. Once
the pool is full, windows are filled from it: the longest tail anchors a
window, and a bitset dynamic programme over the multiset of remaining lengths
finds the reachable fill closest to capacity; backtracking yields how many
tails of each length to take. Where no multiset closes the window exactly, one
tail is cut to close it. What a task has left at its end is cut into sequences
whose lengths are powers of two. No sequence holds padding, nothing is
shuffled, and a task holds at most ``pool`` tails, however large or skewed the
input; a lost task is packed anew from its own input partition.

Defined results: a null text is an empty one (its document is the end id
alone); null ids pass through; repeated rows are packed each on its own; very
long texts are cut into windows as a whole; an empty table gives an empty
result; other columns, also of the result's names, are not read.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_process

CAPACITY = 2048
END_ID = 1
POOL = 4096
#: Pieces of text in each of a worker's two cache generations.
CACHE = 400_000
#: Sequences that one task can number.
TASK_SHIFT = 36

#: Characters below are letters, digits or white space in every version of Unicode alike.
_LATIN_END = "\u0250"
_OTHER = re.compile(f"[{_LATIN_END}-\U0010ffff]")
#: Units up to this length are cached whole where they hold other characters.
_SHORT = 32


def _latin_pieces() -> re.Pattern:
    """The byte-level pre-tokenizer's pattern, its classes spelled out for characters below ``_LATIN_END``.

    Fixed value: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    chars = [chr(c) for c in range(ord(_LATIN_END))]
    of = lambda kind: "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind)
    letter, digit, space = of("L"), of("N"), r"\t-\r \x85\xa0"
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
                      rf"|[{space}]+(?![^{space}])|[{space}]+")


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


def _two_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 16-bit ids."""
    return struct.pack(f"<{len(ids)}H", *ids)


class _Pieces(dict):
    """Ids by piece, made where they are missing; two generations bound its size."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        self[piece] = ids
        return ids

    def turn(self) -> None:
        self.old = dict(self)
        self.clear()


class PieceTokenizer:
    """Token ids of whole texts, through a cache of their pieces.

    A text's ids are the concatenated ids of the pieces that the byte-level
    pattern cuts, and a piece's ids are its merges alone. Pieces repeat like
    words do, so most come from the cache. Texts with characters whose class
    depends on the version of Unicode, or that spell a special token, are cut at
    single spaces between other characters (there the pattern always cuts), and
    their units of that kind go to the tokenizer itself. What is used again moves
    to the cache's young generation; the old one is dropped once the young one
    holds ``cache`` pieces (and those of one text).
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.space = self.letters[ord(" ")]
        self.pieces = _latin_pieces().findall
        self.limit = cache
        self.known, self.units = _Pieces(self._merges), _Pieces(self._exact)

    def _exact(self, text: str) -> bytes:
        return _two_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _merges(self, piece: str) -> bytes:
        """Ids of one piece of the pattern."""
        word = piece[1:] if piece[0] == " " else piece
        if word.isascii() and word.isalnum():  # these bytes are written as themselves
            mapped = piece if word is piece else self.space + word
        else:
            mapped = piece.encode().decode("latin-1").translate(self.letters)
        return _two_bytes([t.id for t in self.model.tokenize(mapped)])

    def _plain(self, text: str) -> bool:
        return (text.isascii() or not _OTHER.search(text)) and not any(s in text for s in self.special)

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.pieces(text)))

    def _unit(self, unit: str) -> bytes:
        if self._plain(unit):
            return self._latin(unit)
        return self.units[unit] if len(unit) <= _SHORT else self._exact(unit)

    def encode(self, text: str) -> np.ndarray:
        """Ids as an array of unsigned 32-bit integers."""
        if not text:
            return np.empty(0, dtype="<u4")
        for cache in (self.known, self.units):
            if len(cache) >= self.limit:
                cache.turn()
        ids = self._latin(text) if self._plain(text) else b"".join(
            [self._unit(space + unit) for space, unit in _merged(text.split(" ")) if space or unit])
        return np.frombuffer(ids, dtype="<u2").astype("<u4")


def _merged(units: list[str]) -> Iterator[tuple[str, str]]:
    """(space, unit): units joined again wherever white space touches their boundary."""
    space, parts = "", [units[0]]
    for u in units[1:]:
        # Only the last part's end and the next one's start decide.
        if parts[-1] and u and not parts[-1][-1].isspace() and not u[0].isspace():
            yield space, " ".join(parts)
            space, parts = " ", [u]
        else:
            parts.append(u)
    yield space, " ".join(parts)


def slack_choice(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is the largest one up to ``room``.

    Bit s of the set is 1 if some sub-multiset sums to s; lengths are added with
    doubled multiples of their count, and adding stops once ``room`` is reached.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        before, left, lot = reach, min(counts[length], room // length), 1
        while left:
            take = min(lot, left)
            reach |= (reach << (take * length)) & mask
            left, lot = left - take, lot * 2
        steps.append((length, before))
        if reach >> room & 1:
            break
    best, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> best & 1:
            best, n = best - length, n + 1
        if n:
            taken[length] = n
    return taken


class Packer:
    """Packs one task's documents; ``rows`` collects finished pieces."""

    def __init__(self, capacity: int = CAPACITY, pool: int = POOL, first_sequence: int = 0):
        self.capacity, self.pool, self.sequence = capacity, pool, first_sequence
        self.tails: dict[int, list] = defaultdict(list)  # by length: (doc_id, start, ids, doc_tokens)
        self.count = self.tokens = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def _hold(self, tail) -> None:
        self.tails[len(tail[2])].append(tail)
        self.count += 1
        self.tokens += len(tail[2])

    def _take(self, length: int):
        tail = self.tails[length].pop()
        if not self.tails[length]:
            del self.tails[length]
        self.count -= 1
        self.tokens -= length
        return tail

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, cut = len(ids), len(ids) - len(ids) % self.capacity
        for start in range(0, cut, self.capacity):
            self._emit([(doc_id, start, ids[start:start + self.capacity], total)])
        if cut < total:
            self._hold((doc_id, cut, ids[cut:], total))
        if self.count >= self.pool:
            while self.count > self.pool // 2 and self.tokens >= self.capacity:
                self._window()

    def _window(self) -> None:
        """Fill one sequence to capacity (the pool holds enough tokens)."""
        pieces = [self._take(max(self.tails))]
        room = self.capacity - len(pieces[0][2])
        for length, n in slack_choice({k: len(v) for k, v in self.tails.items()}, room).items():
            pieces += [self._take(length) for _ in range(n)]
            room -= n * length
        if room:  # every tail left is longer than the slack: cut the shortest
            doc_id, start, ids, total = self._take(min(self.tails))
            pieces.append((doc_id, start, ids[:room], total))
            self._hold((doc_id, start + room, ids[room:], total))
        self._emit(pieces)

    def finish(self) -> None:
        while self.tokens >= self.capacity:
            self._window()
        left = [t for length in sorted(self.tails, reverse=True) for t in self.tails[length]]
        while self.tokens:
            room = 1 << (self.tokens.bit_length() - 1)  # the largest power of two that is filled
            self.tokens -= room
            pieces = []
            while room:
                doc_id, start, ids, total = left[0]
                piece, rest = ids[:room], ids[room:]
                pieces.append((doc_id, start, piece, total))
                room -= len(piece)
                if len(rest):
                    left[0] = (doc_id, start + len(piece), rest, total)
                else:
                    left.pop(0)
            self._emit(pieces)
        self.tails.clear()
        self.count = 0


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, pool: int = POOL) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    ``tokenizer``: path of a byte-level BPE file for the ``tokenizers`` library
    with at most 65,536 ids. A document is its text's ids and then ``end_id``.
    """
    ids_type = docs.schema[doc_id].dataType
    fields = [(doc_id, ids_type), *[(n, T.LongType()) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_process(("pieces", tokenizer), lambda: PieceTokenizer(tokenizer)).encode
        packer = Packer(capacity, pool, TaskContext.get().partitionId() << TASK_SHIFT)
        id_type = None

        def out():
            columns = list(zip(*packer.rows))
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], type=id_type), *[pa.array(c, type=pa.int64()) for c in columns[1:]]],
                names=schema.names)

        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(key, np.concatenate([encode(body.as_py() or ""), end]))
                if len(packer.rows) >= 10_000:
                    yield out()
        packer.finish()
        if packer.rows:
            yield out()

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, schema)
