"""Projected neighbour search against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargotide.llm import stable_search

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, qid string"
def is_query():
    return F.col("vec_id") % 20 == 0



def brute(rows, k):
    """One list per query row; `rows` holds usable (id, vector)."""
    out = []
    for at, (i, q) in enumerate(rows):
        if i % 20 == 0:
            score = [(-float(np.dot(np.asarray(v), np.asarray(q))), j) for b, (j, v) in enumerate(rows) if b != at and len(v) == len(q)]
            out.append((i, sorted(score)[:k]))
    return out


def asked(spark, rows, **options):
    frame = spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v], 1, "r", "q") for i, v in rows], SCHEMA).repartition(3)
    got = defaultdict(list)
    for r in stable_search.nearest(frame, is_query(), **options).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    return {q: sorted(rows) for q, rows in got.items()}


def test_recall_on_random_vectors_of_different_norms(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(4000, 24)) * rng.uniform(0.5, 2, size=(4000, 1))
    got = asked(spark, list(enumerate(x)), shard_rows=600, fit_rows=1000)
    want = brute(list(enumerate(x)), 20)
    hits = 0
    for i, near in want:
        assert [r for r, _, _ in got[i]] == list(range(1, 21))
        assert all(abs(float(x[i] @ x[j]) - s) < 1e-9 and j != i for _, j, s in got[i])
        assert [s for _, _, s in got[i]] == sorted((s for _, _, s in got[i]), reverse=True)
        hits += len({j for _, j in near} & {j for _, j, _ in got[i]})
    assert hits >= 0.95 * 20 * len(want)


def test_copies_ties_odd_vectors_and_few_candidates(spark):
    rng = np.random.default_rng(3)
    small = [(k, [int(e) for e in rng.integers(-2, 3, 4)]) for k in range(300)]          # very many ties
    hot = [(1000 + k, [3, 3, 3, 3]) for k in range(400)]                                 # a common vector
    rows = small + hot + [(20, [1, 2, 3, 4]), (40, small[40][1]), (60, [1.0, 2.0]), (61, [2.0, 1.0]), (1980, [5.0] * 3)]
    odd = [(2000, None), (2020, []), (2040, [0, 0, 0, 0]), (2060, [1, None, 1, 1]), (2080, [1, float("nan"), 1, 1]), (2100, [float("inf")] * 4), (None, [1, 1, 1, 1])]
    usable = [(i, v) for i, v in rows if any(v)]
    got = asked(spark, rows + odd, k=5, confidence=1 - 1e-9, shard_rows=100, fit_rows=200)
    want = Counter()
    for i, near in brute(usable, 5):
        want.update((i, r + 1, j, -s) for r, (s, j) in enumerate(near))
    have = Counter((q, r, j, s) for q, near in got.items() for r, j, s in near)
    assert have == want and 1980 not in got and all(q < 2000 for q in got)


def test_extreme_components_and_empty_tables(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 6))
    for factor in (1e-150, 1e150):
        got = asked(spark, [(k, v * factor) for k, v in enumerate(x)], k=3, confidence=1 - 1e-9)
        assert {q: [j for _, j, _ in near] for q, near in got.items()} == {i: [j for _, j in near] for i, near in brute(list(enumerate(x)), 3)}
    assert asked(spark, []) == {} and asked(spark, [(1, [1.0])]) == {} and asked(spark, [(20, [1.0])]) == {}


@pytest.mark.parametrize("dims", [1, 2, 5, 8])
def test_chi_square(dims):
    draws = (np.random.default_rng(dims).normal(size=(200_000, dims)) ** 2).sum(1)
    for p in (0.1, 0.5, 0.95):
        q = stable_search.chi_square_quantile(p, dims)
        assert abs((draws <= q).mean() - p) < 0.005 and abs(stable_search.chi_square_cdf(q, dims) - p) < 1e-9
