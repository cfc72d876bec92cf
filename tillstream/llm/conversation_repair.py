"""Conversation structure repair by a run-length dynamic programme.

A conversation is a sequence of symbols (role initial, fault). Edits keep,
delete or re-role its rows, or insert empty ones, so that the roles read
``(s?(ua)+)?`` at least cost. Four states say who spoke last; a symbol is a
min-plus matrix over them. Equal consecutive symbols are one run, and a run of
n rows moves the cost-to-go through the cached binary powers of its matrix.
From the front, the choices are then unrolled in ASCII order: the audit is the
least string among the cheapest.

Rows that are equal in conversation, turn, role and text are counted before
anything moves. Skinny symbol rows (no texts) are range-sorted, so a hot
conversation is spread over tasks; each task leaves only its runs. Texts move
once, to their conversation's task, in order behind a header row that carries
the audit, and are edited as they stream by: no task holds a conversation's
texts. What a task holds of one conversation are its runs and its audit, which
the result returns whole.

Defined results: a null role or text is one space, a null conv_id is a
conversation of its own, null turns come first; rows of one turn are ordered by
role and the MD5 of their text; a role counts by its first character; repeated
rows are duplicates; very long texts stream like others; an empty table gives
empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import RESERVED, written

KEEP, DELETE, INSERT, REROLE = "K", "D", "I", "R"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: Added to an undeleted truncated row.
TRUNCATED_COST = 3

#: Faults, and role initials; any other initial is the last one. A symbol is 4 * initial + fault.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
#: Who spoke last: nobody, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: The state that an inserted or re-roled row leads to.
SPOKEN = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Cheapest end from each state: inserts until nobody or the assistant spoke last.
END = (0, 2 * COST[INSERT], COST[INSERT], 0)
NEVER = 1 << 60
#: Rows of a run unrolled at a time.
BLOCK = 4096
#: ASCII white space, as a trim list.
_BLANKS = " \t\n\x0b\x0c\r"


def kept_state(state: int, initial: int) -> int | None:
    """The state after keeping a row of that initial, if it may be kept."""
    if initial == 0:
        return SYSTEM if state == START else None
    return SPOKEN[state] if SPOKEN[state] == initial + 1 else None


@lru_cache(maxsize=None)
def edits_of(symbol: int) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """By state: (edit, cost, next state) of a row of ``symbol``, in ASCII order of the edits."""
    initial, fault = divmod(symbol, 4)
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    out = []
    for p in STATES:
        edits = [(DELETE, COST[DELETE], p)]
        if fault not in (BLANK, DUPLICATE):
            if (q := kept_state(p, initial)) is not None:
                edits.append((KEEP, COST[KEEP] + extra, q))
            edits.append((REROLE, COST[REROLE] + extra, SPOKEN[p]))
        out.append(tuple(edits))
    return tuple(out)


def _times(a, b):
    """Min-plus product of two matrices."""
    return tuple(tuple(min(a[p][k] + b[k][q] for k in STATES) for q in STATES) for p in STATES)


@lru_cache(maxsize=None)
def power(symbol: int, bit: int):
    """Cost matrix of 2 ** bit rows of ``symbol``, inserts before each row included."""
    if bit:
        half = power(symbol, bit - 1)
        return _times(half, half)
    insert = [[NEVER] * 4 for _ in STATES]
    for p in STATES:
        q, cost = p, 0
        while cost < insert[p][q]:
            insert[p][q] = cost
            q, cost = SPOKEN[q], cost + COST[INSERT]
    row = [[NEVER] * 4 for _ in STATES]
    for p, edits in enumerate(edits_of(symbol)):
        for _, cost, q in edits:
            row[p][q] = min(row[p][q], cost)
    return _times(insert, row)


def before(symbol: int, rows: int, togo: tuple) -> tuple:
    """Cost-to-go by state in front of ``rows`` rows of ``symbol``, given that behind them."""
    bit = 0
    while rows:
        if rows & 1:
            m = power(symbol, bit)
            togo = tuple(min(m[p][q] + togo[q] for q in STATES) for p in STATES)
        rows, bit = rows >> 1, bit + 1
    return togo


def cheapest(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """(cost, audit) of the runs (symbol, rows): the ASCII-least of the cheapest edit strings."""
    behind = [END]
    for symbol, rows in reversed(runs):
        behind.append(before(symbol, rows, behind[-1]))
    behind.reverse()
    state, audit = START, []
    for k, (symbol, rows) in enumerate(runs):
        if symbol % 4 in (BLANK, DUPLICATE):  # an insert can wait until after a forced delete
            audit.append(DELETE * rows)
            continue
        edits = edits_of(symbol)
        while rows:
            block = min(rows, BLOCK)
            rows -= block
            togo = [before(symbol, rows, behind[k + 1])]
            for _ in range(block):
                togo.append(before(symbol, 1, togo[-1]))
            for i in range(block, 0, -1):
                while True:
                    now, after = togo[i], togo[i - 1]
                    found = next(((e, q) for e, cost, q in edits[state] if cost + after[q] == now[state]), None)
                    if found and found[0] == DELETE:
                        break
                    if COST[INSERT] + now[SPOKEN[state]] == now[state]:  # I comes before K and R
                        audit.append(INSERT)
                        state = SPOKEN[state]
                        continue
                    break
                edit, state = found
                audit.append(edit)
    while END[state]:
        audit.append(INSERT)
        state = SPOKEN[state]
    return behind[0][START], "".join(audit)


def counts_of(runs: list[tuple[int, int]]) -> dict[str, int]:
    """Rows by fault, and adjacent rows whose initials are not su, ua or au."""
    fault, illegal, last = [0] * 4, 0, None
    for symbol, rows in runs:
        initial = symbol // 4
        fault[symbol % 4] += rows
        illegal += rows - 1 + (last is not None and (last, initial) not in ((0, 1), (1, 2), (2, 1)))
        last = initial
    return {"blank": fault[BLANK], "duplicate": fault[DUPLICATE], "truncated": fault[TRUNCATED], "illegal": illegal}


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with the test damage: by crc32 of ``conv:turn`` modulo 20, 0 drops
    the row, 1 empties its text, 2 removes its stops, 3 repeats it, 4 sets role user."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = f"{RESERVED}kind"
    return (
        rows.select(conv, turn, or_space(role).alias(role), or_space(text).alias(text),
                    (F.crc32(F.concat_ws(":", or_space(conv), or_space(turn)).cast("binary")) % 20).alias(kind))
        .where(F.col(kind) != 0)
        .select(conv, turn, F.when(F.col(kind) == 4, "user").otherwise(F.col(role)).alias(role),
                F.when(F.col(kind) == 1, "").when(F.col(kind) == 2, F.translate(text, ".!?", ""))
                .otherwise(F.col(text)).alias(text),
                F.explode(F.array_repeat(F.lit(0), F.when(F.col(kind) == 3, 2).otherwise(1))).alias(kind))
        .drop(kind))


def _symbols(rows: DataFrame) -> DataFrame:
    """One row per (conv, turn, role, th): its symbol, its ``n`` rows, whether it was ``seen`` at an earlier turn."""
    end = F.rtrim("text", F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    code = F.lit(len(INITIALS))
    for i, letter in enumerate(INITIALS):
        code = F.when(initial == letter, i).otherwise(code)
    fault = (F.when(F.length(end) == 0, BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), FINE)
             .otherwise(TRUNCATED))
    counted = written(
        rows.groupBy("conv", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("th"),
                     (code * 4 + fault).alias("symbol"))
        .agg(F.count(F.lit(1)).alias("n")), "turn_counts")
    at = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn"))
    first = counted.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("th").alias("h")) \
        .agg(F.min(at).alias("first"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("th") == F.col("h"))
    return written(counted.join(first, same).select(
        "conv", "turn", "role", "th", "symbol", "n", (F.col("first") < at).alias("seen")), "symbols")


_ORDER = ("conv", F"{RESERVED}null_turn", "turn", "role", "th")


def _same(a, b) -> bool:
    return a == b and type(a) is type(b)


def _collapse(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs, and turns, of every conversation's rows in this task."""
    part, out = TaskContext.get().partitionId(), []
    conv = runs = turns = None

    def close():
        if runs is not None:
            out.append((conv, part, bytes(s for s, _ in runs), [n for _, n in runs], *turns))

    def flush():
        columns = list(zip(*out)) or [()] * len(schema)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(5)]
        for c, turn, symbol, n, seen in zip(*cols):
            if runs is None or not _same(c, conv):
                close()
                conv, runs, turns = c, [], [None, None, 0]
                if len(out) >= 10_000:
                    yield flush()
            if turn is not None and turn != turns[1]:
                turns = [turn if turns[0] is None else turns[0], turn, turns[2] + 1]
            again = symbol - symbol % 4 + DUPLICATE
            blank = symbol % 4 == BLANK
            for s, k in ((again if seen and not blank else symbol, n if blank or seen else 1),
                         (again, 0 if blank or seen else n - 1)):
                if k and runs and runs[-1][0] == s:
                    runs[-1] = (s, runs[-1][1] + k)
                elif k:
                    runs.append((s, k))
    close()
    yield flush()


def _solve(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row a conversation, from its tasks' runs in order."""
    out, conv, runs, turns = [], None, None, None

    def close():
        if runs is not None:
            cost, audit = cheapest(runs)
            n = counts_of(runs)
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
            out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit))

    def flush():
        columns = list(zip(*out)) or [()] * len(schema)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for c, symbols, lengths, low, high, distinct in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if runs is None or not _same(c, conv):
                close()
                conv, runs, turns = c, [], [None, None, 0]
                if len(out) >= 10_000:
                    yield flush()
            for s, n in zip(symbols, lengths):
                if runs and runs[-1][0] == s:
                    runs[-1] = (s, runs[-1][1] + n)
                else:
                    runs.append((s, n))
            if distinct:
                turns = [low if turns[0] is None else turns[0], high, turns[2] + distinct - (low == turns[1])]
    close()
    yield flush()


def _edit(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Repaired rows: a conversation's header (its audit) comes first, then its rows in order."""
    out, held = [], 0
    audit, at, state, place, conv = "", 0, START, 0, None

    def speak(turn, edit, role, text):
        nonlocal place, held
        out.append((conv, place, turn, edit, role, text))
        place, held = place + 1, held + len(text)

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            at, state = at + 1, SPOKEN[state]
            speak(None, INSERT, ROLE[state], b"")

    def flush():
        nonlocal held
        columns = list(zip(*out)) or [()] * len(schema)
        out.clear()
        held = 0
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for c, header, turn, role, text in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if header is not None:
                audit, at, state, place, conv = header, 0, START, 0, c
                inserts()
                continue
            edit = audit[at]
            at += 1
            if edit != DELETE:
                state = SYSTEM if edit == KEEP and role[:1] == INITIALS[0] else SPOKEN[state]
                speak(turn, edit, role if edit == KEEP else ROLE[state], text)
            inserts()
            if len(out) >= 10_000 or held > 1 << 24:
                yield flush()
    yield flush()


def _mapped(df: DataFrame, body, fields: list[tuple[str, T.DataType]]) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return body(batches, arrow)

    return df.mapInArrow(run, schema)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(audits, repaired)`` of conversation rows.

    ``audits``: one row a conversation: ``gaps`` (turns missing between its
    first and last), ``blank``, ``duplicate``, ``truncated`` (rows by first
    fault), ``illegal``, ``cost``, ``audit``. ``repaired``: its rows after the
    edits (conv, position, turn, edit, role, text); a conversation's rows stand
    together and in order within one partition.
    """
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                        or_space(role).alias("role"), or_space(text).alias("text"))
    kind, long, null = rows.schema[conv].dataType, T.LongType(), f"{RESERVED}null_turn"
    symbols = _symbols(plain).withColumn(null, F.col("turn").isNotNull())
    runs = written(_mapped(
        symbols.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).select("conv", "turn", "symbol", "n", "seen"),
        _collapse, [("conv", kind), ("part", long), ("symbols", T.BinaryType()), ("lengths", T.ArrayType(long)),
                    ("low", long), ("high", long), ("turns", long)]), "runs")
    audits = written(_mapped(
        runs.repartition("conv").sortWithinPartitions("conv", "part").drop("part"), _solve,
        [(conv, kind), *[(n, long) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
         ("audit", T.StringType())]), "audits")
    none = lambda t: F.lit(None).cast(t)
    headers = audits.select(F.col(conv).alias("conv"), "audit", none("long").alias("turn"), none("string").alias("role"),
                            none("binary").alias("text"), none("binary").alias("th"), none("boolean").alias(null))
    bodies = plain.select("conv", none("string").alias("audit"), "turn", "role", F.col("text").cast("binary").alias("text"),
                          F.unhex(F.md5(F.col("text").cast("binary"))).alias("th"), F.col("turn").isNotNull().alias(null))
    ordered = headers.unionByName(bodies).repartition("conv").sortWithinPartitions(*_ORDER)
    repaired = _mapped(
        ordered.select("conv", "audit", "turn", "role", "text"), _edit,
        [(conv, kind), ("position", long), ("turn", long), ("edit", T.StringType()), ("role", T.StringType()),
         ("text", T.BinaryType())])
    return audits, repaired.withColumn("text", F.col("text").cast("string"))


def digests(repaired: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, repaired_sha256): SHA-256 of each conversation's ``role:text`` lines, hashed as they stream."""
    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        out, last, hasher = [], None, None

        def flush():
            columns = list(zip(*out)) or [()] * 2
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for c, position, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if position == 0:
                    if hasher is not None:
                        out.append((last, hasher.hexdigest()))
                    last, hasher = c, hashlib.sha256()
                else:
                    hasher.update(b"\n")
                hasher.update(role + b":")
                hasher.update(text)
            if len(out) >= 10_000:
                yield flush()
        if hasher is not None:
            out.append((last, hasher.hexdigest()))
        yield flush()

    rows = repaired.select(conv, "position", F.col("role").cast("binary"), F.col("text").cast("binary"))
    return _mapped(rows, run, [(conv, repaired.schema[conv].dataType), ("repaired_sha256", T.StringType())])


def of_every(ids: DataFrame, audits: DataFrame, shas: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Audits and digests of all conversations in ``ids``, also of those without rows."""
    counts = [c for c in audits.columns if c not in (conv, "audit")]
    found = (ids.select(conv).distinct()
             .join(audits.withColumnRenamed(conv, "a"), F.col(conv).eqNullSafe(F.col("a")), "left")
             .join(shas.withColumnRenamed(conv, "s"), F.col(conv).eqNullSafe(F.col("s")), "left"))
    return found.select(conv, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
