"""Whitening against NumPy on all rows, and its edges."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tillstream.llm import whitening as W
from tillstream.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def usable(rows):
    return [(k, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for k, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]


def check(out, rows, components=32):
    """Rows of the result against a plain fit on every row, per vector length."""
    by_length = defaultdict(list)
    for k, x in usable(rows):
        by_length[len(x)].append((k, x))
    got = defaultdict(list)
    for r in out:
        got[r.vec_id].append(r)
    total = 0
    for d, mine in by_length.items():
        n, x = len(mine), np.array([x for _, x in mine], dtype=object)
        sums = x.sum(0)
        centred = ((x * n - sums) / n).astype(float)
        v = centred.T @ centred / n
        e, u = np.linalg.eigh(v)
        e, u = e[::-1], u[:, ::-1]
        k = min(components, int((e > 1e-12 * max(e[0], 0)).sum()))
        total += n * k
        z = centred @ u[:, :k] / np.sqrt(e[:k])
        signs = {}
        for (key, _), own, white in zip(mine, x, z):
            same = [r for r in got[key] if r.deviation == int(((own * n - sums) ** 2).sum()) and r.n == n]
            assert len(same) >= k
            for r in same:
                assert r.explained == pytest.approx(e[r.component - 1] / np.trace(v), rel=1e-9)
                assert 0 <= r.identity_error <= 1e-4
                if len(got[key]) == k and abs(white[r.component - 1]) > 1e-3 and \
                        all(abs(e[r.component - 1] - o) > 1e-6 * e[0] for i, o in enumerate(e) if i != r.component - 1):
                    assert abs(r.whitened) == pytest.approx(abs(white[r.component - 1]), rel=1e-6)
                    sign = np.sign(r.whitened * white[r.component - 1])
                    assert signs.setdefault(r.component, sign) == sign
    assert len(out) == total


def test_query_against_numpy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    out = QUERIES["op13_embedding_whitening"](spark, SF001)
    assert [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    check(out.collect(), rows)


@pytest.mark.parametrize("hot", [2, 256])
def test_copies_nulls_and_lengths(spark, hot):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(5)]) for i in range(200)]
    rows += [(500 + i, [0.5, 0.25, -1.0, 2.0, 0.0]) for i in range(150)] + rows[:10]
    rows += [(None, [1.0] * 5), (900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]),
             (903, [float("nan")] * 5), (904, [float("inf")] * 5), (None, None)]
    rows += [(1000 + i, [float(i % 3), float(i % 2)]) for i in range(30)] + [(2000, [7.0])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit(1) for c in ("x", "w", "key", "d", "component", "n")})
    out = W.whiten(df, components=3, hot=hot).collect()
    check(out, rows, components=3)
    assert Counter(r.vec_id for r in out)[3] == 6  # both of its rows
    assert {r.vec_id for r in out}.isdisjoint({900, 901, 902, 903, 904, 2000})
    per_length = defaultdict(list)
    for r in out:
        per_length[r.n].append(r)
    for n, part in per_length.items():  # the stated error is that of the rows returned
        k = max(r.component for r in part)
        z = np.array([[r.whitened for r in part if r.component == c + 1] for c in range(k)])
        assert z.shape[1] == n and np.abs((z * z).sum(1) / n - 1).max() <= part[0].identity_error + 1e-9


def test_flat_empty_and_extreme(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)
    assert W.whiten(same).count() == 0 and W.whiten(same.limit(0)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], SCHEMA)
    assert {r.component for r in W.whiten(line).collect()} == {1}
    far = spark.createDataFrame([(1, [3.0e38, 0.0]), (2, [-3.0e38, 1.0]), (3, [0.0, 5.0])], SCHEMA)
    out = W.whiten(far).collect()
    assert {r.vec_id for r in out} == {1, 2, 3} and any(r.deviation is None for r in out)
