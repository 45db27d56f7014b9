"""Slices of any quality, audits of the graphs, proportions of packed sequences."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargotide.llm import hnsw_dedup, mixing, packing
from cargotide.llm.tokenizer_files import byte_bpe


@pytest.mark.parametrize("quality", [0.05, 1.0, 0.0, 1000.0])
def test_slices_stay_small_and_ordered_at_any_quality(spark, quality):
    key = mixing.exponential_key(F.col("id"), F.lit(quality), 5)
    rows = mixing._bucketed(spark.range(50_000).select(key.alias("key")), 64).collect()
    most = max(Counter(r.bucket for r in rows).values())
    assert most <= 1.25 * 50_000 / (np.e * 64)
    ordered = sorted(rows, key=lambda r: r.key)
    assert all(a.bucket <= b.bucket for a, b in zip(ordered, ordered[1:]))


def test_a_zero_key_has_a_slice(spark):
    rows = mixing._bucketed(spark.createDataFrame([(0.0,), (-0.0,), (1e300,)], "key double"), 1024).collect()
    assert None not in {r.bucket for r in rows} and rows[0].bucket == rows[1].bucket < rows[2].bucket


def test_the_audit_widens_a_beam_that_loses_links():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))  # no links of its own
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw_dedup.build(x.astype(np.float32))
    asked = hnsw_dedup.probes(x, 256, 0.93)
    truth = asked @ x.T >= 0.93
    assert truth.any(1).all() and (x @ x.T >= 0.93).sum() == 3000
    graph.levels = [np.where(rng.random(level.shape) < 0.6, -1, level) for level in graph.levels]  # a graph with lost edges
    graph.ef = 1
    wide = hnsw_dedup.audited(graph, x, 0.93, 0.99, 256)
    assert wide.ef > 1 and len(hnsw_dedup.linked(wide, x, asked, 0.93)[0]) >= 0.99 * truth.sum()


def order_of(sources, sizes, share, window, deficit=None):
    return packing.round_robin(np.array(sources), np.array(sizes), share, deficit or {}, window)


def test_every_window_is_near_its_shares():
    rng = np.random.default_rng(3)
    sources = [["sa", "sb", "sc"][int(k)] for k in rng.choice(3, 6000, p=[0.6, 0.3, 0.1])]
    sizes = rng.integers(5, 60, 6000)
    total = sizes.sum()
    share = {s: float(sizes[[k for k, x in enumerate(sources) if x == s]].sum() / total) for s in ("sa", "sb", "sc")}
    order = order_of(sources, sizes, share, 1024)
    assert sorted(order) == list(range(6000))
    own = {s: np.cumsum([sizes[k] if sources[k] == s else 0 for k in order]) for s in share}
    at = np.cumsum(sizes[order])
    for s in share:  # over any prefix a source is off by no more than a window and a document
        assert np.abs(own[s] - share[s] * at).max() <= 1024 + 60
    plain = {s: [k for k, x in enumerate(sources) if x == s] for s in share}
    assert all([k for k in order if sources[k] == s] == plain[s] for s in share)


def test_large_debts_take_no_time():
    order = order_of(["sa", "sa", "sb"], [10, 10, 10], {"sa": 1e-9, "sb": 1e-9}, 1024, {"sa": -1e9, "sb": -3e12})
    assert list(order) == [0, 1, 2]


def test_chosen_targets_and_spans_of_shards(spark, monkeypatch):
    rows = [(k, "some words in a row " * 4, "a" if k % 4 else "b") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(packing, "SPAN", 2)
    pieces = packing.pack(docs, tokenizer_files=byte_bpe(), targets={"a": 1, "b": 1}, shard_tokens=4000).collect()
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, Counter())["b" if r.doc_id % 4 == 0 else "a"] += r.length
    size = sum(r.length for r in pieces)
    assert {(r.doc_id, r.start) for r in pieces if r.start == 0} == {(k, 0) for k in range(800)}
    assert sorted(by_sequence) == list(range(len(by_sequence))) and size <= 1024 * len(by_sequence)
    early = [c for c in by_sequence.values() if c["a"] and c["b"] and sum(c.values()) >= 1000]
    assert early and max(c["b"] / sum(c.values()) for c in early) > 0.4  # while both queues last
    sums = spark.createDataFrame([(k, 10 * k) for k in range(9)], "shard long, n long")
    assert {r.shard: r.n for r in packing.earlier_sums(sums, ["n"]).collect()} == {k: sum(10 * j for j in range(k)) for k in range(9)}


def test_wide_ids(tmp_path):
    assert packing.id_type(byte_bpe()[0]) == "<u2"
    from tokenizers import Tokenizer
    from tokenizers.models import WordLevel
    Tokenizer(WordLevel({"a": 0, "b": 70_000}, unk_token="a")).save(str(tmp_path / "t.json"))
    assert packing.id_type(str(tmp_path / "t.json")) == "<u4"
