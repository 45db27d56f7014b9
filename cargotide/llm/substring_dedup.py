"""Near-duplicate passages across documents by compact windows (operator 1).

A text is its sequence of 5-word shingles; each of `bands * 2` hash functions orders them. A node of the
Cartesian tree over the hashes is a compact window (l, c, r): every subsequence that starts in l..c and
ends in c..r has its minimum at c. Only windows of `least` shingles or more matter, about 2n / least
for each function, found level by level for a whole batch of texts at once.

1. The windows of a band's two functions are interval-joined inside each text: a cell is a run of starts
   whose subsequences of `least` shingles have the same two minima. Cells meet by these minima. Cells of
   one batch go to the shuffle once for each key, however often a passage repeats.
2. Cells that meet another document are interval-joined again, over two bands and over all of them. Equal
   passages have equal minima under every function, so a class over all bands holds whole passages and
   not parts of them, and its smallest document is one that holds the passage.
3. At each step a cell is linked to the smallest document of its class and to the one before its own (not
   to all pairs). Links of two documents on nearby diagonals that touch are a candidate.
4. Candidates are verified: the Jaccard similarity of the two passages' shingles is computed from the texts,
   trimmed to their matching part, and must reach the threshold.

A passage is reported against an earlier document that holds it; what is linked to nothing is clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import as_text, by_size, mixed, shingles, stored, word_hashes, words

K = 5
WORDS = 50
#: Pairs of hash functions; one pair that agrees makes a candidate.
BANDS = 6
PART, WHOLE = 80, 100
BATCH_CHARS = 6_000_000
#: Links that are verified beside one copy of a kept document.
LINKS = 256
#: Gap inside a passage, and shingles by which places of near passages may shift.
DRIFT = 12


def sequences(texts: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    encoded, starts = words(texts)
    return shingles(word_hashes(encoded), starts, k)


def compact_windows(hashes: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r), inclusive, of all windows with r - l + 1 >= least, over all texts at once. Equal hashes
    are ordered by a permutation of their places, which keeps the tree shallow."""
    n = len(hashes)
    bits = max(int(n).bit_length(), 1)
    low = np.uint64((1 << bits) - 1)
    odd = np.uint64(0x9E3779B1 | 1)
    inverse = np.uint64(pow(int(odd), -1, 1 << bits))
    place = (np.arange(n, dtype=np.uint64) * odd) & low
    value = (hashes & ~low) | place
    left, right = starts[:-1].astype(np.int64), starts[1:].astype(np.int64) - 1
    wide = right - left + 1 >= least
    left, right = left[wide], right[wide]
    found = []
    while len(left):
        bounds = np.stack([left, right + 1], 1).ravel()
        if bounds[-1] == n:
            bounds = bounds[:-1]
        smallest = np.minimum.reduceat(value, bounds)[::2]
        c = (((smallest & low) * inverse) & low).astype(np.int64)
        found.append((left, c, right))
        left, right = np.concatenate([left, c + 1]), np.concatenate([c - 1, right])
        wide = right - left + 1 >= least
        order = np.argsort(left[wide], kind="stable")
        left, right = left[wide][order], right[wide][order]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


#: Rows of integers travel as blobs of one kind and bucket: open cells wait for their class in the bucket of their key; cells that met
#: another document and links are dealt by their document.
PACKED = "bucket int, kind int, n int, data binary"
OPEN, MET, LINK = 0, 1, 2
KEY_BITS, DOC_BITS = 10, 8
#: Rows that a task takes together from whole buckets; more than MOST in one bucket are taken in parts. Shingles that it lays out at a time.
ROWS, MOST, LAID_OUT = 400_000, 1_600_000, 600_000


def packed(columns: list[np.ndarray]) -> bytes:
    """Integers of equal length, compressed: the first column by differences, the others from their smallest, all by byte places."""
    x = np.stack(columns)
    base = x.min(1)
    base[0] = x[0, 0]
    x[0, 1:] = x[0, 1:] - x[0, :-1]
    x[0, 0] = 0
    x[1:] -= base[1:, None]
    places = np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(*x.shape, 8).transpose(0, 2, 1))
    return base.astype("<i8").tobytes() + pa.Codec("zstd").compress(places, asbytes=True)


def unpacked(data: bytes, n: int, width: int) -> np.ndarray:
    """The columns of `packed`, one below the other."""
    places = pa.Codec("zstd").decompress(data[8 * width:], decompressed_size=8 * width * n, asbytes=True)
    x = np.frombuffer(places, np.uint8).reshape(width, 8, n).transpose(0, 2, 1).copy().view("<i8").reshape(width, n)
    x[0] = np.cumsum(x[0])
    return x + np.frombuffer(data[:8 * width], "<i8")[:, None]


def blobs(kind: int, bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket; the columns are ordered by bucket."""
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[:len(bucket)])
    last = np.append(first[1:], len(bucket))
    columns = [x.astype(np.int64) for x in columns]
    data = [packed([x[i:j] for x in columns]) for i, j in zip(first, last)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first].astype(np.int32)), pa.array(np.full(len(first), kind, np.int32)), pa.array((last - first).astype(np.int32)),
         pa.array(data, pa.binary())], ["bucket", "kind", "n", "data"])


def by_doc(kind: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    bucket = (mixed(columns[0].astype(np.uint64)) >> np.uint64(64 - DOC_BITS)).astype(np.int64)
    order = np.lexsort((columns[2], columns[1], columns[0], bucket))
    return blobs(kind, bucket[order], [x[order] for x in columns])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, np.ndarray]]:
    """Columns by kind of sorted blobs, whole buckets together until they hold ROWS rows. Blobs of more than MOST rows are
    unpacked once for each part of their first column's values, so that equal ones still meet."""
    width = {OPEN: 5, MET: 5, LINK: 6}

    def parts(held, n):
        of = np.uint64(-(-n // MOST))
        for part in range(int(of)):
            out = {}
            for kind, blob, rows in held:
                x = unpacked(blob, rows, width[kind])
                out.setdefault(kind, []).append(x[:, mixed(x[0].astype(np.uint64)) % of == part] if of > 1 else x)
            joined = {k: np.concatenate(x, 1) for k, x in out.items()}
            yield {k: x for k, x in joined.items() if x.shape[1]}

    held, size, last = [], 0, None
    for batch in batches:
        for bucket, kind, n, data in zip(*(x.to_pylist() for x in batch.columns)):
            if bucket != last and size >= ROWS:
                yield from parts(held, size)
                held, size = [], 0
            held.append((kind, data, n))
            size, last = size + n, bucket
    yield from parts(held, size)


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket")


def class_links(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For cells ordered by key and document: whether the class has several documents, and pairs (cell, cell
    of an earlier document): the first one of the class, and the last one of the document before."""
    at = np.arange(len(key))
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.maximum.accumulate(np.where(new, at, 0))
    own = np.maximum.accumulate(np.where(new | np.concatenate([[True], doc[1:] != doc[:-1]]), at, 0))
    other = doc != doc[first]
    several = np.logical_or.reduceat(other, np.flatnonzero(new))[np.cumsum(new) - 1]
    before = np.maximum(own - 1, 0)
    more = other & (doc[before] != doc[first])
    return several, np.concatenate([at[other], at[more]]), np.concatenate([first[other], before[more]])


def closed(key, doc, band, s, e) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of cells ordered by key, document and start those in classes with several documents: (doc, band, s, e, key),
    and their links: (doc, to, s, e, ts, te)."""
    several, at, to = class_links(key, doc)
    return [x[several] for x in (doc, band, s, e, key)], [doc[at], doc[to], s[at], e[at], s[to], e[to]]


def local_cells(key, doc, band, s, e, keep_cells: bool) -> Iterator[pa.RecordBatch]:
    """Classes inside one batch are closed here; of each class the first document's cells stay open."""
    if not len(key):
        return
    order = np.lexsort((s, doc, key))
    key, doc, band, s, e = (x[order] for x in (key, doc, band, s, e))
    met, links = closed(key, doc, band, s, e)
    deal = key[:1] >> (64 - KEY_BITS)
    for kind, cols in ((MET, met), (LINK, links)) if keep_cells else ((LINK, links),):
        if len(cols[0]):
            order = np.lexsort((cols[2], cols[1], cols[0]))
            yield blobs(kind, np.repeat(deal, len(order)), thin(kind, [x[order] for x in cols]))
    new = np.concatenate([[True], key[1:] != key[:-1]])
    own = doc == doc[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    cols = [x[own] for x in (key, doc, band, s, e)]
    yield blobs(OPEN, cols[0] >> (64 - KEY_BITS), thin(OPEN, cols))


def thin(kind: int, cols: list[np.ndarray]) -> list[np.ndarray]:
    """Ends as lengths, places in the other document as diagonals."""
    if kind == LINK:
        doc, to, s, e, ts, te = cols
        return [doc, to, s, e - s, ts - s, te - ts]
    return [*cols[:3], cols[3], cols[4] - cols[3]] if kind == OPEN else [cols[0], cols[1], cols[2], cols[3] - cols[2], cols[4]]


def whole(kind: int, cols: np.ndarray) -> list[np.ndarray]:
    """What `thin` was given."""
    if kind == LINK:
        doc, to, s, n, diagonal, m = cols
        return [doc, to, s, s + n, s + diagonal, s + diagonal + m]
    return [*cols[:3], cols[3], cols[3] + cols[4]] if kind == OPEN else [cols[0], cols[1], cols[2], cols[2] + cols[3], cols[4]]


def runs_of(key: np.ndarray, place: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of successive places of one text with the same key."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)])
    first = np.flatnonzero(new)
    return first, np.concatenate([first[1:], [len(key)]]) - 1


def minima(value: np.ndarray, starts: np.ndarray, f: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all subsequences of `least` shingles, and the minimum of each under function f."""
    own = mixed(value ^ np.uint64(0xA0761D6478BD642F * (f + 1) & (2**64 - 1)))
    l, c, r = compact_windows(own, starts, least)
    first, last = np.maximum(l, c - least + 1), np.minimum(c, r - least + 1)
    order = np.argsort(first, kind="stable")
    first, n, low = first[order], (last - first + 1)[order], own[c[order]]
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(low, n)


def band_cells(docs: DataFrame, bands: int, least: int, k: int) -> DataFrame:
    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            for batch in by_size(table, 1, BATCH_CHARS):
                value, starts = sequences(as_text(batch.column(1)), k)
                ids = batch.column(0).to_numpy()
                found = []
                for band in range(bands):
                    place, low = minima(value, starts, 2 * band, least)
                    _, high = minima(value, starts, 2 * band + 1, least)
                    key = mixed(mixed(low + np.uint64(band)) ^ high).astype(np.int64)
                    row = np.searchsorted(starts, place, side="right") - 1
                    a, b = runs_of(key, place, row)
                    base = starts[row[a]]
                    found.append((key[a], ids[row[a]], np.full(len(a), band), place[a] - base, place[b] - base))
                yield from local_cells(*(np.concatenate(x) for x in zip(*found)), True)
    return docs.mapInArrow(derive, PACKED)


def closed_classes(cells: DataFrame, keep_cells: bool) -> DataFrame:
    """Links of the classes, dealt by document, and their cells if wanted; what is closed already passes."""
    def star(batches):
        for held in gathered(batches):
            out = {k: [x] for k, x in held.items() if k == LINK or k == MET and keep_cells}
            if OPEN in held:
                cols = whole(OPEN, held.pop(OPEN))
                order = np.lexsort((cols[3], cols[1], cols[0]))
                met, links = closed(*(x[order] for x in cols))
                out.setdefault(LINK, []).append(np.stack(thin(LINK, links)))
                if keep_cells:
                    out.setdefault(MET, []).append(np.stack(thin(MET, met)))
            for kind, parts in out.items():
                cols = np.concatenate(parts, 1)
                if cols.shape[1]:
                    yield by_doc(kind, list(cols))
    return dealt(cells).mapInArrow(star, PACKED)


def wider_cells(cells: DataFrame, bands: int) -> DataFrame:
    """Cells over all bands, and over two neighbouring ones, where each band meets another document. Links pass, those
    that touch on one diagonal as one."""
    groups = [*([b, b + 1] for b in range(0, bands - 1, 2) if bands > 2), list(range(bands))]

    def laid_out(doc, band, s, e, key):
        heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        ids, low = doc[heads], np.minimum.reduceat(s, heads)
        size = np.maximum.reduceat(e, heads) - low + 1
        run = np.cumsum(size) // LAID_OUT
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        for i, j in zip(first, np.append(first[1:], len(ids))):
            cut = slice(heads[i], heads[j] if j < len(heads) else len(doc))
            own = np.repeat(np.arange(j - i), np.diff(np.append(heads[i:j], cut.stop)))
            base = np.cumsum(size[i:j]) - size[i:j] - low[i:j]
            n = e[cut] - s[cut] + 1
            at = np.repeat(base[own] + s[cut] - np.cumsum(n) + n, n) + np.arange(n.sum())
            keys = np.zeros((bands, int(size[i:j].sum())), np.int64)
            keys[np.repeat(band[cut], n), at] = np.repeat(key[cut], n)
            yield ids[i:j], base, np.repeat(np.arange(j - i), size[i:j]), keys

    def derive(batches):
        for held in gathered(batches):
            if LINK in held:
                yield by_doc(LINK, thin(LINK, touching(*whole(LINK, held.pop(LINK)))))
            if MET not in held:
                continue
            cols = whole(MET, held.pop(MET))
            order = np.argsort(cols[0], kind="stable")
            found = []
            for ids, base, row, keys in laid_out(*(x[order] for x in cols)):
                for g, own in enumerate(groups):
                    place = np.flatnonzero((keys[own] != 0).all(0))
                    joined = np.full(len(place), g + 1, np.uint64)
                    for b in own:
                        joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + keys[b, place].astype(np.uint64))
                    joined = joined.astype(np.int64)
                    a, z = runs_of(joined, place, row[place])
                    at_row, first, last = row[place[a]], place[a], place[z]
                    found.append((joined[a], ids[at_row], np.full(len(a), bands + g), first - base[at_row], last - base[at_row]))
            yield from local_cells(*(np.concatenate(x) for x in zip(*found)), False)
    return dealt(cells).mapInArrow(derive, PACKED)


def apart(group: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Of intervals ordered by group and start, those that begin beyond all before them in their group, by more than DRIFT."""
    reach = np.maximum.accumulate(e + (group << 32)) - (group << 32)
    return np.concatenate([[True], (group[1:] != group[:-1]) | (s[1:] > reach[:-1] + DRIFT)])


def touching(doc, to, s, e, ts, te) -> list[np.ndarray]:
    """Links of one pair on the same diagonal that touch as one; `merged` makes the same of them."""
    diagonal = ts - s
    order = np.lexsort((s, diagonal, to, doc))
    doc, to, s, e, ts, te, diagonal = (x[order] for x in (doc, to, s, e, ts, te, diagonal))
    group = np.cumsum(np.concatenate([[True], (doc[1:] != doc[:-1]) | (to[1:] != to[:-1]) | (diagonal[1:] != diagonal[:-1])]))
    at = np.flatnonzero(apart(group, s, e))
    return [doc[at], to[at], s[at], np.maximum.reduceat(e, at), ts[at], np.maximum.reduceat(te, at)]


def merged(doc, to, s, e, ts, te, least: int) -> list[np.ndarray]:
    """Candidates of links: those of one pair on nearby diagonals that touch are one. The passages in both
    documents, (start, end) inclusive, the other one with room for a shift."""
    diagonal = ts - s
    order = np.lexsort((diagonal, to, doc))
    doc, to, s, e, ts, te, diagonal = (x[order] for x in (doc, to, s, e, ts, te, diagonal))
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (to[1:] != to[:-1]) | (np.diff(diagonal) > least)])
    cluster = np.cumsum(new)
    order = np.lexsort((s, cluster))
    doc, to, s, e, ts, te, cluster = (x[order] for x in (doc, to, s, e, ts, te, cluster))
    at = np.flatnonzero(apart(cluster, s, e))
    return [doc[at], to[at], s[at], np.maximum.reduceat(e, at) + least - 1,
            np.maximum(np.minimum.reduceat(ts, at) - DRIFT, 0), np.maximum.reduceat(te, at) + least - 1 + DRIFT]


def candidate_passages(links: DataFrame, least: int) -> DataFrame:
    def join(batches):
        for held in gathered(batches):
            if LINK not in held:
                continue
            out = merged(*whole(LINK, held.pop(LINK)), least)
            yield pa.RecordBatch.from_arrays([pa.array(x if k < 2 else x.astype(np.int32)) for k, x in enumerate(out)], ["doc", "to", "s", "e", "ts", "te"])
    return dealt(links).mapInArrow(join, "doc long, to long, s int, e int, ts int, te int")


def slices(text: pa.Array, row: np.ndarray, first: np.ndarray, n: np.ndarray) -> Iterator[tuple[slice, pa.Array]]:
    """Words first..first + n - 1 of the texts `row`, lower-cased, each slice joined by single spaces; ends beyond a text are cut.
    Some slices at a time, with their places."""
    encoded, starts = words(text)
    first = np.minimum(starts[row] + first, starts[row + 1])
    n = np.minimum(n, starts[row + 1] - first)
    run = np.cumsum(n) // LAID_OUT
    cuts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])[:len(run)])
    for i, j in zip(cuts, np.append(cuts[1:], len(run))):
        offsets = np.concatenate([[0], np.cumsum(n[i:j])])
        taken = encoded.take(pa.array(np.repeat(first[i:j] - offsets[:-1], n[i:j]) + np.arange(offsets[-1]))).dictionary_decode()
        yield slice(i, j), pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), taken), pa.scalar(" ", pa.large_string()))


def spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places first..last - 1 of each pair, and the number of its pair."""
    n = np.maximum(last - first, 0)
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(np.arange(len(n)), n)


def tagged(value: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Equal for equal values of one item only."""
    return mixed(value + item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """np.isin by sorted values, which is several times as fast here."""
    if not len(x) or not len(y):
        return np.zeros(len(x), bool)
    order, y = np.argsort(x), np.sort(y)
    x = x[order]
    out = np.empty(len(x), bool)
    out[order] = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
    return out


def distinct(value: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(value)
    value = value[order]
    new = np.concatenate([[True], value[1:] != value[:-1]])[:len(value)]
    return value[new], item[order[new]]


def runs_with_gaps(item: np.ndarray, place: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the runs of places of one item that are at most `gap` apart."""
    first = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (np.diff(place) > gap)])[:len(item)])
    return first, np.append(first[1:], len(item)) - 1


def verified(own: np.ndarray, at: np.ndarray, end: np.ndarray, other: np.ndarray, there: np.ndarray, stop: np.ndarray, least: int,
             gap: int = DRIFT) -> list[np.ndarray]:
    """Matching passages of the shingle sequences own[at:end] and other[there:stop] of each pair: (pair, start, end, start there,
    end there, similarity), places within own and other. Runs of matches with gaps up to `gap`; a run that is not similar enough
    as a whole is tried in shorter runs, down to those without a gap."""
    pair, found = np.arange(len(at)), [[np.zeros(0, np.int64)] * 5 + [np.zeros(0)]]
    while len(pair):
        place, item = spread(at, end)
        facing, row = spread(there, stop)
        seen = among(tagged(own[place], item), tagged(other[facing], row))
        place, item = place[seen], item[seen]
        first, last = runs_with_gaps(item, place, gap)
        wide = place[last] - place[first] + 1 >= least
        run, a, b = item[first[wide]], place[first[wide]], place[last[wide]]
        pair, there, stop = pair[run], there[run], stop[run]
        place, item = spread(a, b + 1)
        mine = tagged(own[place], item)
        facing, row = spread(there, stop)
        theirs = tagged(other[facing], row)
        match = np.flatnonzero(among(theirs, mine))
        first, last = runs_with_gaps(row[match], facing[match], gap)
        order = np.lexsort((first, first - last, row[match[first]]))  # of each run the longest, and of these the first
        best = order[np.unique(row[match[first[order]]], return_index=True)[1]]
        x, y = facing[match[first[best]]], facing[match[last[best]]]
        inside = (facing >= x[row]) & (facing <= y[row])
        mine, item = distinct(mine, item)
        theirs, row = distinct(theirs[inside], row[inside])
        same = np.bincount(item[among(mine, theirs)], minlength=len(a))
        union = np.bincount(item, minlength=len(a)) + np.bincount(row, minlength=len(a)) - same
        good = (y - x + 1 >= least) & (WHOLE * same >= PART * union)
        found.append([z[good] for z in (pair, a, b, x, y, same / np.maximum(union, 1))])
        if gap <= 1:
            break
        pair, at, end, there, stop, gap = pair[~good], a[~good], b[~good] + 1, there[~good], stop[~good], gap // 3
    return [np.concatenate(z) for z in zip(*found)]


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_words: int = WORDS, k: int = K,
             bands: int = BANDS) -> DataFrame:
    """One row per verified passage: doc_id, start_word, n_words, keep_id, keep_start_word, keep_n_words,
    similarity; keep_id is an earlier document (smaller id) that holds the passage.

    Ids are integers; rows with a null id, null, empty and short texts have no passages; rows that repeat
    an id are one document. Repeats inside one document are not reported. Other columns are ignored.
    """
    least = least_words - k + 1
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    cells = closed_classes(band_cells(slim, bands, least, k), True)
    links = closed_classes(wider_cells(cells, bands), False)
    found = stored(candidate_passages(links, least), "op1-candidates")
    # a document needs its own passages and, as the kept one, one copy of itself for each salt of its links
    salts = found.groupBy("to").agg(F.ceil(F.count("*") / LINKS).cast("int").alias("salts"))
    found = found.join(salts, "to").withColumn("salt", F.pmod(F.xxhash64("doc"), "salts").cast("int"))
    own = found.groupBy("doc").agg(F.collect_list(F.struct("to", "salt", "s", "e", "ts", "te")).alias("spans"), F.lit(None).cast("array<int>").alias("copies"))
    kept = found.groupBy("to").agg(F.collect_set("salt").alias("copies")).select(F.col("to").alias("doc"), F.lit(None).cast(own.schema["spans"].dataType).alias("spans"), "copies")
    needs = own.unionByName(kept).groupBy("doc").agg(F.first("spans", True).alias("spans"), F.first("copies", True).alias("copies"))
    held = slim.join(needs, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "spans", "copies")

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def derive(batches):
        for table in batches:
            for batch in by_size(table, 1, BATCH_CHARS // 3):
                ids, spans, copies = batch.column(0).to_numpy(), batch.column(2), batch.column(3)
                row, copy = pc.list_parent_indices(spans).to_numpy(), pc.list_parent_indices(copies).to_numpy()
                to, salt, s, e, ts, te = (x.to_numpy() for x in spans.flatten().flatten())
                blank = np.zeros(len(copy), np.int64)
                at = np.concatenate([copy, row])
                cols = [np.concatenate(x) for x in ((ids[copy], to), (copies.flatten().to_numpy(), salt), (blank, ids[row]), (blank, s), (blank, ts), (blank, te))]
                n = np.concatenate([blank + 2**31, e.astype(np.int64) - s + k])
                none = np.arange(len(at)) < len(copy)
                for own, part in slices(as_text(batch.column(1)), at, cols[3], n):
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(x[own], t, mask=none[own] if c > 1 else None) for c, (x, t) in enumerate(zip(cols, types))], part.cast(pa.string())],
                        ["to", "salt", "doc", "s", "ts", "te", "part"])

    def check(batches):
        kept_id, text = None, np.zeros(0, np.uint64)
        for table in batches:
            for batch in by_size(table, 6, BATCH_CHARS // 3):
                value, starts = sequences(as_text(batch.column(6)), k)
                to, s = batch.column(0).to_numpy(), batch.column(3).fill_null(0).to_numpy().astype(np.int64)
                is_kept = batch.column(2).is_null().to_numpy(zero_copy_only=False)
                # the kept text of each row: the last one before it in this batch, or the one that the batch before ended with
                value = np.concatenate([value, text])
                begins, ends = np.append(starts[:-1], starts[-1]), np.append(starts[1:], len(value))
                holder = np.maximum.accumulate(np.where(is_kept, np.arange(len(to)), -1))
                holds = np.append(to, -1 if kept_id is None else kept_id)[holder]
                row = np.flatnonzero(~is_kept & (holds == to) & ((holder >= 0) | (kept_id is not None)))
                base, limit = begins[holder[row]], ends[holder[row]]
                there = np.minimum(base + batch.column(4).fill_null(0).to_numpy()[row], limit)
                stop = np.minimum(base + batch.column(5).fill_null(0).to_numpy()[row] + 1, limit)
                load = np.cumsum(ends[row] - begins[row] + stop - there) // LAID_OUT
                cuts = np.flatnonzero(np.concatenate([[True], load[1:] != load[:-1]])[:len(load)])
                for i, j in zip(cuts, np.append(cuts[1:], len(row))):
                    own = row[i:j]
                    pair, a, b, x, y, same = verified(value, begins[own], ends[own], value, there[i:j], stop[i:j], least)
                    own, origin = own[pair], base[i:j][pair]
                    cols = [batch.column(2).fill_null(0).to_numpy()[own], s[own] + a - begins[own], b - a + k, to[own], x - origin, y - x + k]
                    yield pa.RecordBatch.from_arrays([*[pa.array(z.astype(np.int64)) for z in cols], pa.array(same.astype(np.float64))],
                                                     ["doc_id", "start_word", "n_words", "keep_id", "keep_start_word", "keep_n_words", "similarity"])
                if len(to) and holder[-1] >= 0:
                    kept_id, text = to[holder[-1]], value[begins[holder[-1]]:ends[holder[-1]]].copy()

    parts = held.mapInArrow(derive, "to long, salt int, doc long, s int, ts int, te int, part string")
    halves = parts.repartition("to", "salt").sortWithinPartitions("to", "salt", F.col("doc").isNotNull())
    return halves.mapInArrow(check, "doc_id long, start_word long, n_words long, keep_id long, keep_start_word long, keep_n_words long, similarity double").distinct()
