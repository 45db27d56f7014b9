"""Ranked search against a plain version, and the bounds that prune it."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cargotide.llm import ball_tree
from cargotide.llm.queries import ORACLES, op11_ball_tree

SCHEMA = "doc_id long, text string, rank int, score string, item string"
RNG = np.random.default_rng(11)
VOCABULARY = ["Alpha", "É", "é", "中文", "x9", "of", "the"] + [f"w{k}" for k in range(300)]


def terms(text):
    return [t.translate({k: k + 32 for k in range(65, 91)}) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(1 for _, b in bags if b), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in items:
        rows = []
        for i, b in bags:
            if i is None or not b:
                continue
            m = 100 - 50 + 50 * b.total() * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m)) for t in set(terms(text)) if b[t])
            if s > 0:
                rows.append((-s, i))
        out.update((item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(rows)[:k]))
    return out


def text(n):
    return " -".join(VOCABULARY[int(k)] for k in np.minimum(RNG.zipf(1.3, n) - 1, len(VOCABULARY) - 1))


@pytest.mark.parametrize("block_chars", [ball_tree.BLOCK_CHARS, 400])
def test_ranks_equal_the_plain_version(spark, monkeypatch, block_chars):
    docs = [(k, text(int(RNG.integers(0, 80)))) for k in range(400)]
    docs += [(1000 + k, docs[3][1]) for k in range(90)] + [docs[5], docs[5], (None, text(30)), (None, None), (600, None), (601, ""), (602, " .\x00"), (603, text(50_000))]
    items = [(k, text(12)) for k in range(12)] + [(20, None), (21, ""), (22, "nowhere"), (5, text(9)), (None, text(5)), (23, docs[3][1])]
    monkeypatch.setattr(ball_tree, "LEAF", 4)
    frame = spark.createDataFrame([(*d, 1, "s", "i") for d in docs], SCHEMA).repartition(3)
    wanted = spark.createDataFrame([(*i, 0, 0) for i in items], "item_id long, text string, rank int, doc_id int")
    got = ball_tree.ranked_search(frame, wanted, k=10, block_chars=block_chars)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, got.collect())) == plain(docs, items, 10)
    assert ball_tree.ranked_search(frame.limit(0), wanted).count() == ball_tree.ranked_search(frame, wanted.limit(0)).count() == 0


def test_bounds_hold_and_prune():
    items = ball_tree.Items([text(8) for _ in range(20)])
    size = len(items.vocabulary)
    weight = RNG.integers(0, 25_000, size)
    centre = RNG.integers(0, 10**6, (40, size)) * (RNG.random((40, size)) < 0.3)
    dense = np.repeat(centre, 50, 0) + RNG.integers(0, 10**4, (2000, size)) * (RNG.random((2000, size)) < 0.1)
    at = [np.flatnonzero(row) for row in dense]
    vectors = ball_tree.Vectors(np.cumsum([0, *map(len, at)]), np.concatenate(at), np.concatenate([row[a] for row, a in zip(dense, at)]))
    tree = ball_tree.BallTree(vectors, items, weight)
    scored = 0
    for i in range(len(items)):
        wanted = items.vector(i, weight)
        truth = dense @ wanted
        for node, (rows, _) in tree.leaves.items():
            assert (truth[rows] <= tree.bounds[node, i]).all()
        assert tree.bounds[0, i] >= truth.max()
        scores, who, n = tree.search(i, wanted, 10, (np.zeros(0, np.int64), np.zeros(0, np.int64)), np.arange(2000))
        best = np.lexsort((np.arange(2000), -truth))[:10]
        assert (who == best).all() and (scores == truth[best]).all()
        scored += n
    assert scored < 0.25 * 2000 * len(items)


def test_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{name}.parquet')")
    got = op11_ball_tree(spark, "/root/testdata/sf0.001")
    rel = con.sql(ORACLES["op11_ball_tree"])
    assert rel.columns == got.columns and Counter(map(tuple, got.collect())) == Counter(rel.fetchall())


def test_terms_are_maximal_runs():
    texts = ["A-b É.ß 中文\x00z9", "", " ; ", "x" * 100_000]
    encoded, owner = ball_tree.terms(pa.array(texts, pa.large_string()))
    assert list(zip(owner.tolist(), encoded.to_pylist())) == [(k, t) for k, x in enumerate(texts) for t in terms(x)]
