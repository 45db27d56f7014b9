"""Each operator against a plain version, with nulls, empty texts, ties and clashing columns."""

import hashlib
import itertools
import math
import os
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cargotide.llm import (exact_dedup, hnsw_dedup, jaccard_join, license_scan, mixing, packing, perplexity, pii_semicrf,
                           substring_dedup, warc_index)
from cargotide.llm.components import connected_components
from cargotide.llm.tokenizer_files import byte_bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, n int"
RNG = np.random.default_rng(7)
VOCABULARY = [f"w{k}" for k in range(400)]


def prose(n: int) -> list[str]:
    return [VOCABULARY[k] for k in RNG.integers(0, len(VOCABULARY), n)]


BASE = prose(120)
NEAR = BASE[:60] + ["changed"] + BASE[61:]
TEXTS = [
    (1, " ".join(BASE)), (2, "  ".join(BASE)), (3, " ".join(NEAR)), (4, None), (5, ""), (6, " \n "), (7, "one two"), (8, "One Two"),
    (9, " ".join(prose(3000))), (10, "mail a.b@c.example.com or 4785380592391139, +1 (743) 555-3824, 10.0.0.300 and 10.0.0.3"),
    (11, "Under the MIT License and the GNU General Public License; mit  license"), (12, " ".join(prose(30) + BASE[20:100] + prose(30))),
    (13, "中文 文本 <|endoftext|> é  x"), (None, "no id"), (None, None), (7, "one two"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 5 == 4 else "en", None if k % 4 == 3 else f"s{k % 3}", 0, "r", "k", k) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_exact_dedup(docs, empty):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    for bits in (256, 8):  # eight bits make different texts share a digest
        got = exact_dedup.duplicate_report(docs, digest_bits=bits).collect()
        want = Counter((i, min((x for x in g if x is not None), default=None), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.duplicate_report(empty).count() == exact_dedup.drop_duplicates(empty).count() == 0


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_jaccard_join(docs, empty):
    sets = [(i, shingle_set(t)) for i, t in TEXTS]
    parent = {i: i for i, _ in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])
    for (a, x), (b, y) in itertools.combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(x & y) >= 80 * len(x | y):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    for size in (2048, 2):
        got = jaccard_join.near_duplicate_report(docs, region_docs=size).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((i, len(s), None if i is None else root(i)) for i, s in sets)
    assert {r.doc_id for r in jaccard_join.keep_one(docs).collect()} == {i for i, _ in sets if i is None or root(i) == i}
    assert jaccard_join.near_duplicate_report(empty).count() == 0


def test_regions_and_sketches_lose_no_link():
    for _ in range(20):
        base = RNG.integers(0, 2**60, int(RNG.integers(1, 1500)))
        sets = [np.unique(np.concatenate([base[RNG.random(len(base)) > 0.3 * RNG.random()], RNG.integers(0, 2**60, 1 + len(base) // 8)])) for _ in range(8)]
        links = {(i, j) for i, j in itertools.combinations(range(8), 2)
                 if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
        may = jaccard_join.with_partner([np.frombuffer(jaccard_join.sketch(s), np.uint8) for s in sets], np.array([len(s) for s in sets]))
        assert all(may[i] and may[j] for i, j in links)

        def parts(pairs):
            label = list(range(8))
            for a, b in pairs:
                label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
            return [[j for j in range(8) if label[j] == x] for x in label]
        assert parts(jaccard_join.region_links(np.arange(8), sets)) == parts(links)


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 180)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 180)}}


def test_hnsw(spark):
    centre = RNG.normal(size=(40, 16))
    x = np.repeat(centre, 12, 0) + 0.1 * RNG.normal(size=(480, 16))
    x[5] = x[6]
    rows = [(k, [float(v) for v in x[k]], k % 2, "e") for k in range(480)]
    odd = [(1000, None, 1, "e"), (1001, [0.0] * 16, 1, "e"), (1002, [float("nan")] * 16, 1, "e"), (1003, [1.0] * 16, None, "e"), (None, [1.0] * 16, 1, "e"), (1004, [], 1, "e")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int, rep string")
    got = {r.vec_id: r for r in hnsw_dedup.near_duplicate_report(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    same = (unit @ unit.T >= 0.93) & (np.arange(480)[:, None] % 2 == np.arange(480) % 2)
    np.fill_diagonal(same, False)
    assert sum(got[k].n_links for k in range(480)) >= 0.98 * same.sum() and all(got[k].n_links <= same[k].sum() for k in range(480))
    assert all(got[k].n_links == 0 and got[k].component_id == k for k in (1000, 1001, 1002, 1003, 1004)) and None in got
    assert hnsw_dedup.near_duplicate_report(frame.limit(0)).count() == 0


def test_mixing(docs, empty, spark):
    got = mixing.mix_report(docs).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len((t or "").split())) for i, t in TEXTS)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    by = defaultdict(list)
    for r in got:
        by[(r.source_size, r.target)].append(r)
    assert all(abs(sum(r.taken for r in rows) - target) < 1 for (_, target), rows in by.items())
    assert Counter(got) == Counter(mixing.mix_report(docs.repartition(5)).collect())
    sizes = spark.createDataFrame([("sa", 100), ("sb", 100), ("sc", 100), ("sd", 1000), ("n", 50)], "source string, source_size long")
    weights, cap = {"sa": 1, "sb": 2, "sc": 3, "sd": 1, "n": 2}, {"sa": 300, "sb": 300, "sc": 300, "sd": 3000, "n": 150}
    share, left, open_ = dict.fromkeys(cap, 0.0), 1350.0, set(cap)
    while open_ and left > 1e-9:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > cap[s]} or open_
        for s in over:
            share[s] = min(cap[s], level * weights[s])
            left -= share[s]
        open_ -= over
    assert {r.source: round(r.target, 6) for r in mixing.source_targets(sizes).collect()} == {s: round(v, 6) for s, v in share.items()}
    whole = mixing.mix_documents(docs)
    assert whole.columns == docs.columns and mixing.mix_report(empty).count() == mixing.mix_documents(empty).count() == 0


def test_kneser_ney_is_a_distribution_and_rejects_noise(spark):
    text = [" ".join(prose(40)) for _ in range(60)]
    noise = ["".join(chr(0x400 + int(k)) for k in RNG.integers(0, 200, 120)), None, ""]
    frame = spark.createDataFrame([(k, t, "en" if k % 7 else None, "x") for k, t in enumerate(text + noise)], "doc_id long, text string, lang string, nll string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(60)] + [(60, 0, 0), (60, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = perplexity.train(frame, labels)
    table = np.exp(model.tables_of("en")[1].astype(float)).reshape(-1, model.n_classes)
    table[:, 1] *= perplexity.RARE_CHARACTERS
    assert np.allclose(table.sum(1), 1, atol=1e-4)
    rows = {r.doc_id: r for r in perplexity.quality_report(frame, labels).collect()}
    assert not any(rows[k].kept for k in (60, 61, 62)) and sum(rows[k].kept for k in range(60)) >= 58
    assert rows[61].perplexity is None and perplexity.keep_good(frame, labels).columns == frame.columns
    nll, n = model.score("en", ["w1 w2"])
    logs, classes = model.tables_of("en")[1], model.tables_of("en")[0]
    c = [0, 0, 0, *[int(classes[ord(x)]) for x in "w1 w2"]]
    assert math.isclose(nll[0], -sum(float(logs[((c[i] * 48 + c[i + 1]) * 48 + c[i + 2]) * 48 + c[i + 3]]) for i in range(5)), rel_tol=1e-5) and n[0] == 5
    assert perplexity.quality_report(frame, labels.limit(0)).where("kept").count() == 61


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(byte_bpe()[0])
    for shard in (1_000_000, 2000):
        rows = packing.pack(docs, tokenizer_files=byte_bpe(), shard_tokens=shard).collect()
        assert sum(r.length for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS)
        want = {(i, n): ids for i, t in TEXTS for ids in [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]] for n in [len(ids)]}
        for r in rows:
            part = np.array(want[(r.doc_id, r.doc_tokens)][r.start:r.start + r.length], "<u4")
            assert zlib.crc32(part.tobytes()) == r.ids_crc32
        for _, own in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
            end = 0
            for r in own:
                assert r.offset == end
                end += r.length
            assert end <= 1024
    assert packing.pack(empty, tokenizer_files=byte_bpe()).count() == 0


def test_license_scan(docs, empty):
    got = license_scan.license_report(docs).collect()
    assert len(got) == len(TEXTS)
    row = next(r for r in got if r.doc_id == 11)
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels, row.score) == (12, 3, 2, 10, "gpl,mit", 1.0)
    assert all(r.n_words == 0 and r.labels == "" and r.score == 0 and r.first_word is None for r in got if r.doc_id in (4, 5, 6))
    assert license_scan.license_report(empty).count() == 0


def test_warc(spark, tmp_path):
    long = "<p>é" + "x" * 2000
    pages = [(1, "http://a.example.com/x", long), (2, "http://b.example.com/", long), (3, None, None), (4, "http://a.example.com/x", "s"), (5, "u\tv", "s"),
             (6, "http://c.org/\r\nz", "\r\n\r\nWARC/1.1\r\n"), (None, "http://n.org", long)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc_index.round_trip(frame).collect())
    want = Counter((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if h == long and i != 2 else "response", 2 if h == long and i != 2 else None)
                   for i, _, h in pages for b in [(h or "").encode()])
    assert got == want
    folder = str(tmp_path / "warc")
    directory = warc_index.build(frame, folder, block_lines=2)
    urls = spark.createDataFrame([("http://a.example.com/x",), ("http://none.org/",)], "url string")
    assert {r.page_id for r in warc_index.lookup(urls, directory, f"{folder}/index", f"{folder}/archives").collect()} == {"1", "4"}
    assert warc_index.round_trip(frame.limit(0)).count() == 0


def test_pii(docs, empty):
    rows = {r.doc_id: r for r in pii_semicrf.pii_report(docs).collect()}
    row = rows[10]
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1) and rows[4].spans == rows[5].spans == ""
    text = dict(TEXTS)[10]
    spans = [(k, m.start(), m.end()) for k, p in pii_semicrf.BASE.items() for m in p.finditer(text) if pii_semicrf.passes(k, m[0])]
    assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    assert pii_semicrf.pii_report(empty).count() == 0


def test_segment_choice_and_marginals_against_all_segmentations():
    for _ in range(30):
        spans = sorted({(int(a), int(a + n)) for a, n in zip(RNG.integers(0, 20, 7), RNG.integers(1, 8, 7))}, key=lambda s: s[1])
        scores = RNG.normal(size=len(spans))
        ways = [w for k in range(len(spans) + 1) for w in itertools.combinations(range(len(spans)), k)
                if all(spans[a][1] <= spans[b][0] or spans[b][1] <= spans[a][0] for a, b in itertools.combinations(w, 2))]
        totals = [scores[list(w)].sum() for w in ways]
        assert math.isclose(scores[pii_semicrf.best_segments(spans, scores)].sum(), max(totals), abs_tol=1e-9)
        p, z = pii_semicrf.marginals(spans, scores)
        weight = np.exp(totals)
        assert math.isclose(z, math.log(weight.sum()), abs_tol=1e-9)
        assert np.allclose(p, [sum(x for x, w in zip(weight, ways) if k in w) / weight.sum() for k in range(len(spans))])


def test_compact_windows_and_passages(docs, empty):
    h = RNG.integers(0, 2**63, 90).astype(np.uint64)
    left, c, right = substring_dedup.compact_windows(h, np.array([0, 90]), 10)
    for i in range(90):
        for j in range(i + 9, 90):
            own = (left <= i) & (i <= c) & (c <= j) & (j <= right)
            assert own.sum() == 1 and c[own][0] == i + int(np.argmin(h[i:j + 1]))
    rows = substring_dedup.passages(docs).collect()
    assert (12, 30, 80) in {(r.doc_id, r.start_word, r.n_words) for r in rows} and {r.doc_id for r in rows} == {2, 3, 12}
    assert all(r.similarity >= 0.8 and r.keep_id < r.doc_id for r in rows) and substring_dedup.passages(empty).count() == 0


def test_passages_with_parts_in_earlier_documents(spark):
    def own(n):
        return [f"u{k}" for k in RNG.integers(0, 10**9, n)]
    rows, want = [], set()
    for k in range(40):  # half of an equal passage stands in earlier documents, also between its two holders
        line, rest = own(32), own(28)
        whole = rest[:14] + line + rest[14:] if k % 2 else line + rest
        for j, part in enumerate([line, line, whole, line, line, whole]):
            rows.append((k * 10 + j, " ".join(own(40) + part + own(40))))
        want.add((k * 10 + 5, k * 10 + 2))
    repeated, passage = own(30), own(25)  # the head document has the line at an earlier place too
    rows += [(900, " ".join(repeated + own(60) + repeated + passage)), (901, " ".join(own(50) + repeated + passage))]
    want.add((901, 900))
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == want and all(r.similarity == 1 for r in got)
    assert all(abs(r.n_words - (55 if r.doc_id == 901 else 60)) == 0 for r in got)


def test_near_passages_at_the_threshold_are_found(spark):
    rng, rows, want = np.random.default_rng(5), [], set()

    def own(n):
        return [f"u{k}" for k in rng.integers(0, 10**9, n)]
    for k in range(200):  # one word of 50 changed: 41 of 51 shingles are shared
        a = own(50)
        b = [*a[:20], "changed" + a[20], *a[21:]]
        assert 100 * len(shingle_set(" ".join(a)) & shingle_set(" ".join(b))) >= 80 * len(shingle_set(" ".join(a)) | shingle_set(" ".join(b)))
        rows += [(2 * k, " ".join(own(40) + a + own(40))), (2 * k + 1, " ".join(own(40) + b + own(40)))]
        want.add((2 * k + 1, 2 * k))
    got = {(r.doc_id, r.keep_id) for r in substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got <= want and len(got) >= 198


def test_small_languages_keep_their_models(spark):
    rng = np.random.default_rng(3)
    def text(first):
        return " ".join("".join(chr(first + int(k)) for k in rng.integers(0, 20, 6)) for _ in range(12))
    rows = [(k, "w%d of many plain words" % (k % 50), "en") for k in range(9000)]
    rows += [(9000 + 10 * j + i, text(0x400 + 40 * j), f"l{j}") for j in range(12) for i in range(2)]  # two texts each in other scripts
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")
    assert set(perplexity.train(frame, labels).alphabets) == {"*", "en", *(f"l{j}" for j in range(12))}
    own = [r for r in perplexity.quality_report(frame, labels).where("lang <> 'en'").collect()]
    assert len(own) == 24 and all(r.kept for r in own) and len({r.threshold for r in own}) == 12


def test_rows_of_cells_and_links_travel_packed():
    rng = np.random.default_rng(9)
    ids = np.sort(rng.integers(10**6, 10**6 + 5000, 3000))
    columns = [ids, rng.integers(-2**63, 2**63 - 1, 3000), rng.integers(0, 900, 3000), rng.integers(-50, 50, 3000), np.zeros(3000, np.int64)]
    for n in (3000, 1):
        data = substring_dedup.packed([x[:n] for x in columns])
        assert (substring_dedup.unpacked(data, n, 5) == np.stack([x[:n] for x in columns])).all()
    assert len(substring_dedup.packed(columns)) < 3000 * 13  # a key of eight bytes among them
    blob = substring_dedup.blobs(substring_dedup.LINK, ids >> 4, [ids, *columns[1:], ids])
    got = {int(i): 0 for i in ids}
    for most in (10**6, 70):  # one bucket in parts: rows with equal first values stay together
        old, substring_dedup.MOST = substring_dedup.MOST, most
        parts = [x[substring_dedup.LINK] for x in substring_dedup.gathered(iter([blob]))]
        substring_dedup.MOST = old
        assert sum(x.shape[1] for x in parts) == 3000 and (len(parts) > 1) == (most == 70)
        assert Counter(i for x in parts for i in set(x[0].tolist())) == dict.fromkeys(got, 1)


def test_passages_write_less_than_their_text_several_times(spark, tmp_path):
    """In a session of its own, whose shuffle files stay: before, they were six times the text."""
    rng = np.random.default_rng(4)
    texts = [" ".join(VOCABULARY[k] for k in rng.integers(0, 400, 600)) for _ in range(1500)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(10000 + k, texts[k] if k % 2 else " ".join(t.split()[:300])) for k, t in enumerate(texts[:700])]
    source = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(source)
    code = f"""
from cargotide.llm import substring_dedup
from cargotide.session import build_session
spark = build_session("disk", "local[2]", **{{"spark.ui.enabled": "false", "spark.local.dir": {str(tmp_path / "local")!r}, "spark.sql.shuffle.partitions": "4",
    "spark.checkpoint.dir": {str(tmp_path / "ckpt")!r}, "spark.cleaner.referenceTracking": "false"}})
rows = substring_dedup.passages(spark.read.parquet({source!r})).collect()
import os
print(len(rows), sum(os.path.getsize(os.path.join(d, f)) for top in {[str(tmp_path / "local"), str(tmp_path / "ckpt")]!r} for d, _, names in os.walk(top) for f in names))
"""
    env = {k: v for k, v in os.environ.items() if k != "SPARK_LOCAL_DIRS"} | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}
    n, size = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env=env).stdout.split()[-2:])
    text = sum(len(t) for _, t in rows)
    assert n >= 700 and size < 3.5 * text, (n, size / text)
