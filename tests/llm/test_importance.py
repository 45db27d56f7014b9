"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from cargotide.llm import importance

SCHEMA = "doc_id long, text string, rank int, slots string, score string"
RNG = np.random.default_rng(12)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text, n):
    w = words(text)
    return [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, n, buckets, least, percent):
    slot = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(slot, grams(x, n)))
    for x in target:
        t.update(map(slot, grams(x, n)))
    a, b = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (a + buckets) / ((s[k] + 1) * (b + buckets)))) for k in range(buckets)]
    rows = []
    for i, x in docs:
        f = grams(x, n)
        h = int(hashlib.sha256(f"{importance.SEED}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[slot(g)] for g in f)
        rows.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x))))
    may = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    most = len(may) * percent // 100
    return Counter([(*r[:4], k + 1 if k < most else None) for k, r in enumerate(may)] + [(*r[:4], None) for r in rows if r[4] < least])


def corpus():
    vocabulary = ["Alpha", "beta", "Γάμμα", "中文", "x9", "É", "of", "the"] + [f"w{k}" for k in range(60)]
    text = lambda n: " -\t".join(vocabulary[k] for k in RNG.integers(0, len(vocabulary), n))
    docs = [(k, text(int(RNG.integers(0, 60)))) for k in range(120)]
    docs += [(None, text(40)), (None, None), (200, None), (201, ""), (202, " ,.; \x00\x7f"), (203, text(30_000)), (204, "y" * 300_000), (5, text(25)), docs[7], docs[7]]
    return docs, [text(30) for _ in range(9)] + [None, ""]


def test_report_equals_the_plain_version(spark):
    docs, target = corpus()
    frame = spark.createDataFrame([(*d, 1, "s", "x") for d in docs], SCHEMA).repartition(3)
    wanted = spark.createDataFrame([(None, t) for t in target], "item_id long, text string")
    for n, buckets, least, percent in ((1, 10_000, 20, 10), (1, 7, 0, 100), (3, 500, 5, 33)):
        got = importance.importance_report(frame, wanted, n=n, buckets=buckets, least_words=least, percent=percent)
        assert Counter(map(tuple, got.collect())) == plain(docs, target, n, buckets, least, percent)
    drawn = importance.resample(frame, wanted)
    assert drawn.columns == frame.columns and drawn.count() >= sum(1 for _, x in docs if len(words(x)) >= 20) // 10


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two", 0, "", "")], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.importance_report(docs.limit(0), none).count() == 0
    assert importance.importance_report(docs, none, least_words=1, percent=100).collect()[0]["rank"] == 1


def test_spans_are_the_runs_of_words():
    text = importance.collapsed("  A-b  ç,c \n".encode() + bytes([0, 127]))
    assert text == "a b ç c".encode()
    for n in (1, 2, 3, 4, 5):
        spans = list(importance.ngram_spans(text, importance.ngram_pattern(n)))
        assert [text[a:b].decode() for a, b in spans] == [" ".join("a b ç c".split()[i:i + n]) for i in range(5 - n)]
