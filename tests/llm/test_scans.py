"""Base spans against the plain patterns, license labels against a plain search, also on long runs and broken templates."""

import re
import time

import numpy as np
import pytest

from cargotide.llm import license_scan as L, pii_semicrf as S

BSD = next(text for text, label in L.TEMPLATES if label == "bsd")
COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def plain_spans(text):
    return [(k, *m.span()) for k, kind in enumerate(S.KINDS) for m in S.BASE[kind].finditer(text) if S.passes(kind, m[0])]


@pytest.mark.parametrize("letters", ["a1.@", "1. -", "+1 (.-", "a@.-_é", "012.5@+ -a%"])
def test_base_spans_equal_the_plain_patterns(letters):
    rng = np.random.default_rng(len(letters))
    for n in (0, 1, 7, 40, 200):
        for _ in range(400):
            text = "".join(rng.choice(list(letters), n))
            assert S.base_spans(text) == plain_spans(text), text


def test_base_spans_of_planted_data():
    text = "x a.b@c.de_f@g.hi 10.0.0.1.2 x 4111 1111-1111 1111 x +49 (30) 1234567. x 999.1.1.1 @a.b a@b c@d..e"
    assert S.base_spans(text) == plain_spans(text) and {k for k, _, _ in S.base_spans(text)} == {0, 1, 2, 3}


@pytest.mark.parametrize("text", ["7" * 10**6, "a" * 10**6 + "@", "a@" * 500_000, "+1" + " " * 10**6, "1." * 500_000, "1 " * 500_000 + "@"])
def test_long_runs_take_linear_time(text):
    began = time.process_time()
    S.base_spans(text)
    assert time.process_time() - began < 5  # the plain patterns need hours


def plain_licenses(text):
    words = re.findall(L.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = sorted((i, label) for phrase, label in L.PHRASES for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


@pytest.mark.parametrize("k", [1, 2, 3])
def test_licenses_equal_a_plain_search(spark, k):
    rng = np.random.default_rng(k)
    vocabulary = ["MIT", "license", "apache", "general", "public", "of", "the", "following", "é", "-"]
    texts = [" ".join(rng.choice(vocabulary, int(n))) for n in rng.integers(0, 60, 60)] + [None, "", "license", "mit license " * 3000]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(0, texts[0], 1, "x"), (None, "mit license", 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, gram string")
    got = L.license_report(docs, k=k).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, *[str(r[c]) for c in COLUMNS]) for r in got) == sorted(
        (i is None, i or 0, *map(str, plain_licenses(t))) for i, t, _, _ in rows)
    assert L.license_report(docs.limit(0), k=k).count() == 0


def test_broken_templates_keep_their_label(spark):
    w = BSD.split()
    mixed = {
        "whole": BSD, "words": " ".join(w[:8] + ["x", "y"] + w[8:]), "stray": " ".join(w[:8] + ["the", "following"] + w[8:]),
        "two": " ".join(w[:6] + ["the", "following", "x"] + w[6:13] + ["are", "met"] + w[13:]), "missing": " ".join(w[:9] + w[10:]),
        "strays around": "the following " * 50 + BSD + " the following" * 50,
        "half": " ".join(w[:10]), "turned": " ".join(" ".join(w[i:i + 2]) for i in range(len(w) - 2, -1, -2)),
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(mixed.values())], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in L.license_report(docs).collect()}
    found = {name for i, name in enumerate(mixed) if got[i][0] == "bsd"}
    assert found == {"whole", "words", "stray", "two", "missing", "strays around"}
    assert got[0][1] == 1.0 and 0.85 <= got[2][1] < 1.0
    blocks = " ".join([" ".join(w[12:]), " ".join(w[:12])])  # all but one pair, but in the wrong order
    turned = L.license_report(spark.createDataFrame([(0, blocks)], "doc_id long, text string"), reach=100).first()
    assert turned.labels == ""
