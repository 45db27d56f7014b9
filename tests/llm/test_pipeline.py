"""Every stage of the pipeline on odd rows, the middle ones against plain versions, and the whole run."""

import functools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cargotide.llm.tokenizer_files import byte_bpe

RNG = np.random.default_rng(11)
VOCABULARY = ["".join(chr(97 + int(c)) for c in RNG.integers(0, 20, int(RNG.integers(3, 8)))) for _ in range(150)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n):
    return [VOCABULARY[int(k)] for k in RNG.integers(0, len(VOCABULARY), n)]


@functools.cache
def odd_rows():
    rows = [(k, " ".join(prose(60)), "en" if k % 2 else "de", f"s{k % 3}", 1) for k in range(60)]
    base = prose(100)
    near = base[:50] + ["another"] + base[51:]
    rows += [(100, " ".join(base), "en", "s0", 1), (101, "  ".join(base), "en", "s1", 1), (102, " ".join(near), "en", None, 1),
             (103, " ".join(base), None, "s2", 1), (104, " ".join(near[:-1]), "de", "s2", 1), (105, " ".join(prose(5000)), "en", "s0", 1),
             (3, rows[3][1], "en", "s0", 1), (200, None, "en", "s0", 1), (201, "", None, None, 1), (None, " ".join(prose(40)), "en", "s0", None),
             (202, " \n", "en", "s1", 1), (203, "one two", "en", "s1", 1)]
    return rows


def plain_near(rows):
    """Smallest id of each component of documents at similarity 0.8 (of rows with different ids)."""
    sets = {}
    for i, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if all(root[root[i]] == root[i] for i in root):
            break
    return {i for i in sets if root[i] == i}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(odd_rows(), SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(60)] + [(None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_take_empty_tables_and_clashing_names(spark, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wide = docs.selectExpr("*", "'m' as model", "1 as n", "2 as size", "'r' as row", "3 as keep_id", "4 as bucket", "5 as component_id")
    assert stage(spark, docs.limit(0), folder).count() == 0
    out = stage(spark, wide, folder)
    assert out.columns == wide.columns
    assert Counter(tuple(r)[:5] for r in out.collect()) == Counter(map(tuple, stage(spark, docs, folder).collect()))


def test_exact_and_near_equal_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = odd_rows()
    exact = corpus_pipeline.exact(spark, docs, folder).collect()
    squeezed = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in rows]
    assert Counter(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in exact) == Counter(set(squeezed))
    assert {100, 200} <= {r.doc_id for r in exact} and not {101, 103, 201} & {r.doc_id for r in exact}
    given = [r for r in rows if r[0] is not None and r not in rows[:3]]
    distinct = list({r[0]: r for r in given}.values())
    kept = corpus_pipeline.near(spark, spark.createDataFrame(distinct, SCHEMA), folder).collect()
    assert {r.doc_id for r in kept} == plain_near(distinct)


def test_mix_takes_whole_documents_by_epochs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    taken = Counter(tuple(r) for r in corpus_pipeline.mix(spark, docs, folder).collect())
    given = Counter(odd_rows())
    assert all(row in given and n <= 3 * given[row] and row[1] and row[1].strip() for row, n in taken.items())
    by_source = {}
    for row, n in given.items():
        if row[1] and row[1].strip():
            by_source.setdefault(row[3], set()).add(taken[row] // n)
    assert all(max(counts) - min(counts) <= 1 for counts in by_source.values())  # complete epochs first


def test_run_packs_what_the_stages_kept(spark, folder):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(byte_bpe()[0])
    pieces = corpus_pipeline.run(spark, folder).collect()
    text = {i: t for i, t, *_ in odd_rows()}
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in text.items()}
    for r in pieces:
        assert zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    used = {r.doc_id for r in pieces}
    assert not used & {101, 102, 103, 104, 200, 201, 202} and 100 in used
    tokens = Counter()
    for r in pieces:
        tokens[r.doc_id] += r.length
    assert all(n % len(ids[i]) == 0 for i, n in tokens.items())  # every copy is whole
