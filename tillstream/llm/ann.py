"""Approximate nearest neighbours by learned partitions (inner product).

A neighbour graph of a bounded sample is cut into balanced partitions (moves
along the graph under a capacity), and a small classifier learns, for a
vector, how its neighbours spread over the partitions. Every vector of the
table is filed under its most probable partition; a query is routed to its
several most probable ones and reranked there by exact inner products. How
many partitions are probed is calibrated to a recall target: on held-out
sample vectors, and by rows that the router has not seen against all rows of
the table; the larger number counts.

Partitions keep their size as the table grows: beyond ``MOST_PARTITIONS`` of
them, each is cut again, by the same method on a bounded sample of its own rows
(fitted in parallel, one task each), and a vector is routed to leaves by the
product of both levels' probabilities.

Partitions are scored in blocks: a partition of more rows than a block is
split by id, so copies of one vector (all in one partition) are spread over
tasks, and its queries are split likewise. A task holds one block of each. Only
each block's best ``k`` per query leave it.

Every row takes part on its own: rows that repeat an id, and rows without one,
are candidates like any other, and only a query's own row is left out of its
answer. Vectors of different lengths have no inner product; each length is an
index of its own.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part; a row without an id is never a query; of rows that
repeat a query's id each has its own answer; ties go to the smaller id (null
last); a query with fewer candidates than ``k`` gets all of them; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

#: Rows the index is fitted on (about; all rows of smaller tables), rows a partition is meant to have,
#: partitions of a level, and rows that a partition's second level is fitted on (about).
SAMPLE_ROWS, PARTITION_ROWS, MOST_PARTITIONS, SECOND_ROWS = 16_384, 640, 256, 8_192
#: Graph neighbours, share of the sample held out, recall aimed at on it.
NEIGHBOURS, HELD_OUT, RECALL = 20, 0.1, 0.95
#: Rows outside the sample (about) whose neighbours among all rows calibrate the search.
CALIBRATION_ROWS = 1_024
#: Rows and queries of a block, queries scored at once.
BLOCK_ROWS, BLOCK_QUERIES, STEP = 8_192, 4_096, 256
#: Most probable partitions whose k-th best score bounds what the others still return.
FIRST = 2
#: Tasks that pairs of blocks are spread over at most.
MOST_TASKS = 20_000


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's ``k`` nearest other rows by inner product."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), dtype=np.int64)
    for a in range(0, len(x), STEP):
        s = x[a:a + STEP] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + STEP] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(x: np.ndarray, near: np.ndarray, parts: int, rng, rounds: int = 15) -> np.ndarray:
    """Partition of the graph ``near``: few cut edges, at most 5 % above equal size."""
    n = len(x)
    room = int(np.ceil(n / parts * 1.05))
    centres = x[rng.choice(n, parts, replace=False)].copy()
    for _ in range(8):
        nearest = (x @ centres.T).argmax(1)
        for p in np.unique(nearest):
            mean = x[nearest == p].mean(0)
            centres[p] = mean / (np.linalg.norm(mean) + 1e-12)
    fit = x @ centres.T
    label, size = np.full(n, -1), np.zeros(parts, dtype=np.int64)
    for i in np.argsort(-fit.max(1), kind="stable"):
        for p in np.argsort(-fit[i], kind="stable"):
            if size[p] < room:
                label[i] = p
                size[p] += 1
                break
    src = np.repeat(np.arange(n), near.shape[1])
    a, b = np.concatenate([src, near.ravel()]), np.concatenate([near.ravel(), src])
    for _ in range(rounds):
        linked = np.zeros((n, parts), dtype=np.float32)
        np.add.at(linked, (a, label[b]), 1)
        gain = linked - linked[np.arange(n), label][:, None]
        best = gain.argmax(1)
        gain = gain[np.arange(n), best]
        movers = np.flatnonzero((gain > 0) & (rng.random(n) < 0.5))
        moved = 0
        for i in movers[np.argsort(-gain[movers], kind="stable")]:
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """One hidden layer, softmax over partitions, trained by Adam on neighbour shares."""
    layers: list

    @staticmethod
    def fit(x: np.ndarray, shares: np.ndarray, rng, hidden: int = 128, epochs: int = 25,
            batch: int = 256, rate: float = 2e-3) -> Router:
        d, parts = x.shape[1], shares.shape[1]
        w = [rng.normal(0, 2 * d ** -0.5, (d, hidden)).astype(np.float32), np.zeros(hidden, np.float32),
             rng.normal(0, hidden ** -0.5, (hidden, parts)).astype(np.float32), np.zeros(parts, np.float32)]
        first, second, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), batch):
                rows = order[a:a + batch]
                h = np.maximum(x[rows] @ w[0] + w[1], 0)
                z = h @ w[2] + w[3]
                p = np.exp(z - z.max(1, keepdims=True))
                dz = (p / p.sum(1, keepdims=True) - shares[rows]) / len(rows)
                dh = dz @ w[2].T * (h > 0)
                t += 1
                for q, g, m, v in zip(w, (x[rows].T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    q -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        return Router(w)

    @staticmethod
    def single(width: int) -> Router:
        """Files everything under one partition."""
        return Router([np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)])

    @property
    def parts(self) -> int:
        return len(self.layers[-1])

    def scores(self, x: np.ndarray) -> np.ndarray:
        w = self.layers
        return np.maximum(x.astype(np.float32) @ w[0] + w[1], 0) @ w[2] + w[3]

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Partitions by falling probability."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


@dataclass
class Tree:
    """A router, and one within each of its partitions; leaves are numbered through."""
    coarse: Router
    within: list[Router]

    @staticmethod
    def flat(router: Router) -> Tree:
        return Tree(router, [Router.single(len(router.layers[0]))] * router.parts)

    @property
    def firsts(self) -> np.ndarray:
        """Number of each partition's first leaf, and the number of leaves."""
        return np.concatenate([[0], np.cumsum([r.parts for r in self.within])])

    @property
    def parts(self) -> int:
        return int(self.firsts[-1])

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the most probable one of its most probable partition."""
        part, firsts = self.coarse.scores(x).argmax(1), self.firsts
        out = firsts[part]
        for p in np.unique(part):
            if self.within[p].parts > 1:
                out[part == p] += self.within[p].scores(x[part == p]).argmax(1)
        return out

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Leaves by falling probability."""
        coarse = _log_softmax(self.coarse.scores(x))
        leaves = [coarse[:, p:p + 1] + (_log_softmax(r.scores(x)) if r.parts > 1 else 0) for p, r in enumerate(self.within)]
        return np.argsort(-np.concatenate(leaves, axis=1), axis=1, kind="stable")


def second_level(filed: DataFrame, sizes: dict[int, int], parts: int, width: int, partition_rows: int,
                 second_rows: int, recall: float) -> list[Router]:
    """A router within each of ``parts`` partitions of ``filed`` (part, vec, row), from a bounded sample of its rows."""
    spark, grain = filed.sparkSession, 1 << 30
    wanted = {p: min(MOST_PARTITIONS, 1 << max(0, (n - 1) // partition_rows).bit_length()) for p, n in sizes.items()}
    share = spark.createDataFrame([(p, int(grain * min(1.0, second_rows / n))) for p, n in sizes.items()], "part int, share long")

    def fit(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        router, _ = fit_router(_matrix(rows, width).astype(np.float32), wanted[part], recall)
        return pa.table({"part": [part], "layers": [pickle.dumps(router.layers)]},
                        schema=pa.schema([("part", pa.int32()), ("layers", pa.binary())]))

    drawn = filed.join(F.broadcast(share), "part").where(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(grain)) < F.col("share"))
    found = drawn.select("part", "vec").groupBy("part").applyInArrow(fit, "part int, layers binary").collect()  # one a partition
    made = {r["part"]: Router(pickle.loads(r["layers"])) for r in found}
    return [made.get(p, Router.single(width)) for p in range(parts)]


def fit_router(sample: np.ndarray, parts: int, recall: float = RECALL, seed: int = 7) -> tuple[Router, int]:
    """(router, partitions to probe) from a sample of vectors, one per row.

    Of ``parts`` partitions as many are made as the distinct vectors not held
    out fill with ``NEIGHBOURS`` each; too few of them make one.
    """
    x = np.unique(sample.astype(np.float32), axis=0)
    rng = np.random.default_rng(seed)
    x = x[rng.permutation(len(x))]
    held = max(1, int(len(x) * HELD_OUT))
    test, x = x[:held], x[held:]
    parts = min(parts, len(x) // NEIGHBOURS)
    if parts < 2:
        return Router.single(sample.shape[1]), 1
    near = neighbour_graph(x, NEIGHBOURS)
    label = balanced_partition(x, near, parts, rng)
    shares = np.zeros((len(x), parts), dtype=np.float32)
    np.add.at(shares, (np.repeat(np.arange(len(x)), near.shape[1]), label[near].ravel()), 1 / near.shape[1])
    router = Router.fit(x, shares, rng)
    filed = router.scores(x).argmax(1)
    place = np.argsort(router.ranked(test), axis=1)  # place[i, p]: when partition p is probed
    hits = np.zeros(parts)
    for a in range(0, len(test), STEP):
        best = np.argpartition(-(test[a:a + STEP] @ x.T), near.shape[1] - 1, axis=1)[:, :near.shape[1]]
        when = place[a:a + STEP][np.arange(len(best))[:, None], filed[best]]
        hits += np.bincount(when.ravel(), minlength=parts)
    reached = np.cumsum(hits) / hits.sum()
    return router, int(np.argmax(reached >= recall)) + 1


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(row, id, vec): the vectors that take part, with a number for each row (fixed once written)."""
    fine = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (rows.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).alias("id"), F.col(vector).alias("vec"))
            .where(fine & F.exists("vec", lambda x: x != 0)))


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy())


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """The vectors of a block in double precision."""
    lists = table.column("vec").combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def best_in_block(queries: np.ndarray, own_rows: np.ndarray, bounds: np.ndarray, vectors: np.ndarray,
                  row_numbers: np.ndarray, id_ranks: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, scores) of each query's best ``k`` of ``vectors`` that reach its bound, ties to the smaller id.

    A matrix product preselects; whatever lies within rounding of the k-th best
    is scored again in one fixed order of summation, so equal vectors tie.
    """
    for a in range(0, len(queries), STEP):
        rough = queries[a:a + STEP] @ vectors.T
        for q, own, bound, score in zip(queries[a:a + STEP], own_rows[a:a + STEP], bounds[a:a + STEP], rough):
            score[row_numbers == own] = -np.inf
            limit = max(bound, np.partition(score, -k)[-k] if len(score) > k else -np.inf)
            pick = np.flatnonzero((score >= limit - 1e-9 * max(1.0, abs(limit))) & (score > -np.inf)) \
                if limit > -np.inf else np.flatnonzero(score > -np.inf)
            exact = (vectors[pick] * q).sum(axis=1)
            order = np.lexsort((row_numbers[pick], id_ranks[pick], -exact))[:k]
            yield pick[order], exact[order]


def probes_over_all(router: Tree, filed: DataFrame, unseen: DataFrame, k: int, recall: float) -> int:
    """Partitions to probe so that ``unseen`` rows (row, vec) find that share of their ``k`` nearest of all rows."""
    asked = unseen.toPandas()
    if asked.empty:
        return 1
    x, place = _stack(asked["vec"]).astype(np.float32), {key: i for i, key in enumerate(asked["row"])}
    keys = asked["row"].to_numpy()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.full((len(x), k), -np.inf, dtype=np.float32)
        part = np.full((len(x), k), -1, dtype=np.int32)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rows, ids = _matrix(table, x.shape[1]).astype(np.float32), table.column("row").to_numpy()
            own = table.column("part").to_numpy()
            for a in range(0, len(rows), BLOCK_QUERIES):
                s = x @ rows[a:a + BLOCK_QUERIES].T
                for j in np.flatnonzero(np.isin(ids[a:a + BLOCK_QUERIES], keys)):
                    s[place[ids[a + j]], j] = -np.inf
                both = np.concatenate([score, s], axis=1)
                best = np.argpartition(-both, k - 1, axis=1)[:, :k]
                score = np.take_along_axis(both, best, axis=1)
                part = np.where(best < k, np.take_along_axis(part, np.minimum(best, k - 1), axis=1),
                                own[a + np.maximum(best - k, 0)])
        asker, at = np.nonzero(score > -np.inf)
        yield pa.record_batch({"asker": asker.astype(np.int32), "score": score[asker, at], "part": part[asker, at]})

    best = Window.partitionBy("asker").orderBy(F.desc("score"), "part")
    found = (filed.select("row", "vec", "part").mapInArrow(nearest, "asker int, score float, part int")
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
             .select("asker", "part").toPandas())  # at most k rows of each
    when = np.argsort(router.ranked(x), axis=1)[found["asker"], found["part"]]
    reached = np.cumsum(np.bincount(when, minlength=router.parts)) / max(1, len(when))
    return int(np.argmax(reached >= recall)) + 1


def search(rows: DataFrame, is_query: Callable[[Column], Column], vec_id: str = "vec_id",
           vector: str = "embedding", k: int = 20, recall: float = RECALL,
           partition_rows: int = PARTITION_ROWS, sample_rows: int = SAMPLE_ROWS,
           block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
           most_partitions: int = MOST_PARTITIONS, second_rows: int = SECOND_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: nearest found of every query row's vector.

    ``is_query``: condition on the id column that makes a row a query.
    """
    kind = rows.schema[vec_id].dataType.simpleString()
    base = written(usable(rows, vec_id, vector), "vectors")
    out = None
    for r in base.groupBy(F.size("vec").alias("width")).count().orderBy("width").collect():  # one row a vector length
        found = _search(base.where(F.size("vec") == r["width"]), int(r["count"]), r["width"], kind, is_query, k, recall,
                        partition_rows, sample_rows, block_rows, block_queries, most_partitions, second_rows)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.sparkSession.createDataFrame([], f"query_id {kind}, rank int, `{vec_id}` {kind}, score double")
    return out.select("query_id", "rank", F.col("id").alias(vec_id), "score")


def _search(base: DataFrame, n: int, width: int, kind: str, is_query, k: int, recall: float,
            partition_rows: int, sample_rows: int, block_rows: int, block_queries: int,
            most_partitions: int, second_rows: int) -> DataFrame:
    """(query_id, rank, id, score) among the ``n`` vectors (row, id, vec) of one length."""
    leaves = 1 << max(0, (max(n, 1) - 1) // partition_rows).bit_length()
    if leaves > 1:
        grain = 1 << 30
        drawn = F.pmod(F.xxhash64("row"), F.lit(grain))
        chosen = base.where(drawn < int(grain * min(1 - HELD_OUT, sample_rows / n)))
        unseen = base.where(drawn >= int(grain * (1 - min(HELD_OUT, CALIBRATION_ROWS / n))))
        coarse, probes = fit_router(_stack(chosen.select("vec").toPandas()["vec"]), min(leaves, most_partitions), recall)
        router = Tree.flat(coarse)
    else:
        router, probes = Tree.flat(Router.single(width)), 1

    def filed_by(tree: Tree) -> DataFrame:
        @F.pandas_udf("int")
        def file_under(vectors: pd.Series) -> pd.Series:
            return pd.Series(tree.file(_stack(vectors)).astype(np.int32)) if len(vectors) else pd.Series([], dtype="int32")

        return written(base.withColumn("part", file_under("vec")), "filed")

    def counted(df: DataFrame, parts: int) -> np.ndarray:
        counts = np.zeros(parts, dtype=np.int64)
        for r in df.groupBy("part").count().collect():  # one row a leaf
            counts[r["part"]] = r["count"]
        return counts

    filed = filed_by(router)
    if leaves > most_partitions and router.parts > 1:
        by_part = counted(filed, router.parts)
        held = {p: int(c) for p, c in enumerate(by_part) if c > partition_rows}
        if held:
            within = second_level(filed, held, router.parts, width, partition_rows, second_rows, recall)
            router = Tree(coarse, within)
            discard(filed)
            filed = filed_by(router)
    parts = router.parts
    if parts > 1:
        probes = max(probes, probes_over_all(router, filed, unseen.select("row", "vec"), k, recall))
    sizes = counted(filed, parts)

    @F.pandas_udf("array<int>")
    def route(vectors: pd.Series) -> pd.Series:
        out = []
        for a in range(0, len(vectors), STEP):
            for order in router.ranked(_stack(vectors[a:a + STEP])):
                enough = int(np.searchsorted(np.cumsum(sizes[order]), k + 1)) + 1
                out.append(order[:max(probes, enough)].astype(np.int32))
        return pd.Series(out, dtype=object)

    routed = written(base.where(is_query(F.col("id"))).select("*", F.posexplode(route("vec")).alias("pos", "part")),
                     "routed")
    row_blocks = np.maximum(1, -(-sizes // block_rows))
    keys = ["part", "row_block", "query_block"]

    def rerank(q: pa.Table, v: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        ids, numbers = v.column("id").combine_chunks(), v.column("row").to_numpy()
        ranks = pc.rank(ids, null_placement="at_end", tiebreaker="dense").to_numpy() if v.num_rows else numbers
        found = list(best_in_block(
            _matrix(q, width), q.column("row").to_numpy(), q.column("bound").to_numpy(),
            _matrix(v, width), numbers, ranks, k)) if q.num_rows and v.num_rows else []
        asker = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]), type=pa.int64())
        place = np.concatenate([f[0] for f in found]) if found else np.zeros(0, dtype=np.int64)
        return pa.table({
            "query": q.column("row").combine_chunks().take(asker),
            "query_id": q.column("id").combine_chunks().take(asker),
            "row": pa.array(numbers[place], type=pa.int64()), "id": ids.take(pa.array(place)),
            "score": pa.array(np.concatenate([f[1] for f in found]) if found else [], type=pa.float64()),
        })

    def best_of(queries: DataFrame) -> DataFrame:
        """Candidates of (row, id, vec, part, bound) rows, from blocks of their partitions."""
        query_blocks = np.maximum(1, -(-counted(queries, parts) // block_queries))
        blocks = base.sparkSession.createDataFrame(  # one row a leaf
            pd.DataFrame({"part": np.arange(parts, dtype=np.int32), "row_blocks": row_blocks, "query_blocks": query_blocks}))
        own = lambda of: F.pmod(F.xxhash64("row"), F.col(of)).cast("int")
        every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of).cast("int") - 1))
        row_side, query_side = (df.join(blocks, "part").withColumn(mine, own(f"{mine}s")).withColumn(other, every(f"{other}s"))
                                .drop("row_blocks", "query_blocks")
                                for df, mine, other in ((filed, "row_block", "query_block"), (queries, "query_block", "row_block")))
        # A stated number of partitions: few bytes make much work here, so blocks are not merged into few tasks.
        tasks = min(MOST_TASKS, int((row_blocks * query_blocks).sum()))
        spread = lambda df: df.repartition(tasks, *keys).groupBy(*keys)
        return (spread(query_side).cogroup(spread(row_side))
                .applyInArrow(rerank, f"query long, query_id {kind}, row long, id {kind}, score double"))

    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    top = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    nothing = F.lit(float("-inf"))
    first = written(top(best_of(routed.where(F.col("pos") < FIRST).select("row", "id", "vec", "part", nothing.alias("bound")))),
                    "first_found")
    # The other partitions return only what can still be among a query's k best.
    bounds = first.where(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("bound"))
    rest = best_of(written(routed.where(F.col("pos") >= FIRST).drop("pos").join(bounds, "row", "left")
                           .select("row", "id", "vec", "part", F.coalesce("bound", nothing).alias("bound")), "bounded"))
    return top(first.drop("rank").unionByName(rest)).select("query_id", "rank", "id", "score")
