"""Mixture-controlled packing by deficit round-robin (operator 7).

1. Documents are tokenized once; ids go to a table in the shared folder.
2. Documents are dealt to shards of about `shard_tokens` tokens by hash. One small row per
   (shard, source) gives each source's share of all tokens and, by prefix sums over the shards,
   the deficit with which each source enters a shard.
3. Each shard is packed on its own: in every window of `window` tokens, one sequence unless said
   otherwise, a source may send its share plus its deficit; it sends whole documents while its credit
   lasts and carries what is over or missing to the next window, and the last window's rest to the next
   shard. Shares are the sources' own, or `targets`; then proportions hold until a source has no more.
4. The stream of a shard is cut into sequences of `length` tokens; only a shard's last sequence
   is padded, so padding is at most `length` tokens in `shard_tokens`.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from .common import as_text, by_size, small, stored

LENGTH = 1024
END_ID = 0
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
BLANKS = r"\t\n\v\f\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A blank beside another kind of blank or at an end of the text.
ODD_BLANKS = rf"[ ][ {BLANKS}]|[{BLANKS}][ ]|^[ ]|[ ]$"
#: Shards whose sums are taken together before the spans are ordered.
SPAN = 4096
#: Characters of texts that are encoded together.
BATCH_CHARS = 2_000_000


class Encoder:
    """Ids of a text as the byte-level BPE of the tokenizer file gives them.

    A break before a single blank between two other characters never changes the ids, so texts
    are cut there and the distinct pieces of a batch are encoded once. Pieces of Latin letters are
    joined and go through the rank file of the same vocabulary; the byte lengths of its tokens tell
    where each piece ends. All other pieces, and texts with runs of blanks or the special token,
    go through the tokenizer file itself.
    """

    def __init__(self, json_file: str, rank_file: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(json_file)
        self.ranks = None
        if rank_file:
            import base64

            import tiktoken
            with open(rank_file, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
            self.n_bytes[list(ranks.values())] = [len(token) for token in ranks]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def pieces(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " " + piece for each piece, one after the other, and where each one starts."""
        foreign = pc.match_substring_regex(distinct, r"[^\x{00}-\x{24f}]").to_numpy(zero_copy_only=False)
        if self.ranks is None:
            foreign[:] = True
        latin = np.flatnonzero(~foreign)
        size = np.zeros(len(distinct), np.int64)
        parts = [np.zeros(0, np.uint32)]
        if len(latin):
            own = distinct.take(pa.array(latin))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own.cast(pa.string())), " ")[0].as_py()
            ids = np.asarray(self.ranks.encode_to_numpy(" " + joined), np.uint32)
            ends = np.cumsum(pc.binary_length(own).to_numpy() + 1)
            after = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1
            size[latin] = np.diff(np.concatenate([[0], after]))
            parts.append(ids)
        for k in np.flatnonzero(foreign):
            parts.append(self.whole(" " + distinct[k].as_py()))
            size[k] = len(parts[-1])
        order = np.concatenate([latin, np.flatnonzero(foreign)])
        start = np.zeros(len(distinct), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate(parts), np.stack([start, size])

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, END_ID last."""
        odd = pc.or_(pc.match_substring_regex(texts, ODD_BLANKS), pc.match_substring(texts, SPECIAL)).to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        end = np.array([END_ID], np.uint32)
        for k in np.flatnonzero(odd):
            out[k] = np.concatenate([self.whole(texts[k].as_py()), end])
        plain = np.flatnonzero(~odd)
        if not len(plain):
            return out
        lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
        flat, offsets = lists.flatten(), lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        rest = np.ones(len(flat), bool)
        rest[offsets[:-1]] = False  # the first piece of a text has no blank before it
        encoded = flat.filter(pa.array(rest)).dictionary_encode()
        pool, (begin, size) = self.pieces(encoded.dictionary)
        code = encoded.indices.to_numpy()
        per = size[code]
        ends = np.concatenate([[0], np.cumsum(per)])
        ids = pool[np.repeat(begin[code] - ends[:-1], per) + np.arange(ends[-1])]
        cut = ends[offsets - np.arange(len(offsets))]
        heads = flat.take(pa.array(offsets[:-1])).to_pylist()
        for i, k in enumerate(plain):
            out[k] = np.concatenate([self.whole(heads[i]), ids[cut[i]:cut[i + 1]], end])
        return out


def id_type(json_file: str) -> str:
    """Little-endian unsigned type of 16 bits, or of 32 if the tokenizer file has larger ids."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(json_file).get_vocab().values(), default=0) < 2 ** 16 else "<u4"


def tokenized(docs: DataFrame, id_col: str, text_col: str, source_col: str, files: tuple[str, str | None, str | None], kind: str = "<u4") -> DataFrame:
    """doc_id, source, n_tokens, ids (of type `kind`)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*files)
        for whole in batches:
            for batch in by_size(whole, 2, BATCH_CHARS):
                ids = encoder.batch(as_text(batch.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())], ["doc_id", "source", "n_tokens", "ids"])
            pa.default_memory_pool().release_unused()

    kinds = rows.schema
    return rows.mapInArrow(encode, f"doc_id {kinds['doc_id'].dataType.simpleString()}, source {kinds['source'].dataType.simpleString()}, n_tokens long, ids binary")


def round_robin(source: np.ndarray, size: np.ndarray, share: dict, deficit: dict, window: int) -> np.ndarray:
    """Order in which the documents leave their source queues."""
    queues: dict = {}
    for k, s in enumerate(source):
        queues.setdefault(s, deque()).append(k)
    credit = {s: float(deficit.get(s, 0.0)) for s in queues}
    names, order = sorted(queues), []
    while names:
        # windows in which nobody could send are skipped at once
        idle = min((-credit[s] // (share[s] * window) for s in names if share.get(s, 0.0) > 0), default=0.0)
        for s in names if idle > 0 else ():
            credit[s] += idle * share.get(s, 0.0) * window
        for s in names:
            credit[s] += share.get(s, 0.0) * window
            queue = queues[s]
            while queue and credit[s] > 0:
                k = queue.popleft()
                credit[s] -= size[k]
                order.append(k)
        left = [s for s in names if queues[s]]
        if left and not any(share.get(s, 0.0) > 0 for s in left):  # nobody who is left has a share
            order.extend(k for s in left for k in queues[s])
            break
        names = left
    return np.array(order, np.int64)


def cut_points(size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of a stream of documents cut at every multiple of `length`: which document, where
    the piece starts in the stream, where it ends."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    bounds = np.union1d(np.concatenate([[0], ends]), np.arange(0, total, length))
    begin, end = bounds[:-1], bounds[1:]
    return np.searchsorted(ends, begin, side="right"), begin, end


def earlier_sums(rows: DataFrame, values: list[str], keys: list[str] = []) -> DataFrame:
    """Each of `values` becomes its sum over the earlier shards (of the same keys). Spans of shards are summed
    first, so no task orders all shards."""
    spanned = rows.withColumn("span", F.floor(F.col("shard") / SPAN))
    by_span = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spanned.groupBy(*keys, "span").agg(*[F.sum(v).alias(v) for v in values])
    spans = spans.select(*keys, "span", *[F.coalesce(F.sum(v).over(by_span), F.lit(0)).alias(f"{v}_before") for v in values])
    inside = Window.partitionBy(*keys, "span").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = {v: (F.col(f"{v}_before") + F.coalesce(F.sum(v).over(inside), F.lit(0))).cast("long") for v in values}
    return spanned.join(spans, [*keys, "span"]).select("shard", *keys, *[sums[v].alias(v) for v in values])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
         tokenizer_files: tuple[str, str | None, str | None], length: int = LENGTH, window: int = LENGTH,
         shard_tokens: int = 1_000_000, targets: dict[str | None, float] | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are packed as their end id alone; a null source is a queue of its own;
    repeated rows are packed each; very long texts are cut over many sequences. `tokenizer_files`:
    tokenizer JSON, rank file of the same vocabulary and its split pattern (or None, None). `targets`: weight of
    each source in the sequences; sources that are not named come last in their shard.
    """
    kind_of_ids = id_type(tokenizer_files[0])
    tokens = stored(tokenized(docs, id_col, text_col, source_col, tokenizer_files, kind_of_ids), "op7-tokens")
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    dealt = tokens.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.crc32("ids"))), F.lit(shards)))
    dealt = dealt.withColumn("queue", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")))
    parts = stored(dealt.groupBy("shard", "queue").agg(F.sum("n_tokens").alias("n")), "op7-parts")
    sizes = parts.groupBy("queue").agg((F.sum("n") / F.lit(float(max(total, 1)))).alias("share"))
    if targets is not None:
        whole = sum(targets.values()) or 1.0
        given = [F.when(F.col("queue") == F.lit("n" if name is None else f"s{name}"), float(w) / whole) for name, w in targets.items()]
        sizes = sizes.withColumn("share", F.coalesce(*given, F.lit(0.0)))
    shares = small(stored(sizes, "op7-shares"))
    totals = parts.groupBy("shard").agg(F.sum("n").alias("ahead")).withColumn("first_sequence", F.ceil(F.col("ahead") / length))
    totals = stored(earlier_sums(totals, ["ahead", "first_sequence"]), "op7-totals")
    plan = (earlier_sums(parts.withColumnRenamed("n", "sent"), ["sent"], ["queue"]).join(small(totals), "shard").join(shares, "queue")
            .groupBy("shard", "first_sequence").agg(F.map_from_entries(F.collect_list(F.struct("queue", F.struct(
                "share", (F.col("share") * F.col("ahead") - F.col("sent")).alias("deficit"))))).alias("queues")))
    plan = stored(plan, "op7-plan")

    def pack_shard(rows: pd.DataFrame, settings: pd.DataFrame) -> pd.DataFrame:
        queues = {name: (s["share"], s["deficit"]) for name, s in dict(settings["queues"].iloc[0]).items()}
        rows = rows.sort_values(["doc_id", "n_tokens"], kind="stable", na_position="last").reset_index(drop=True)
        size = rows["n_tokens"].to_numpy()
        order = round_robin(rows["queue"].to_numpy(), size, {k: v[0] for k, v in queues.items()}, {k: v[1] for k, v in queues.items()}, window)
        size = size[order]
        stream = np.frombuffer(b"".join(rows["ids"].iloc[order]), kind_of_ids).astype("<u4")
        which, begin, end = cut_points(size, length)
        raw = memoryview(stream.tobytes())
        starts = np.cumsum(size) - size
        return pd.DataFrame({
            "doc_id": rows["doc_id"].iloc[order].iloc[which].to_numpy(), "start": begin - starts[which], "length": end - begin,
            "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), end.tolist())],
            "doc_tokens": size[which], "sequence_id": int(settings["first_sequence"].iloc[0]) + begin // length, "offset": begin % length})

    kind = docs.schema[id_col].dataType.simpleString()
    # ids travel as text: pandas would turn numbers with nulls among them into floats
    sent = dealt.select("shard", F.col("doc_id").cast("string"), "queue", "n_tokens", "ids")
    out = sent.groupBy("shard").cogroup(plan.groupBy("shard")).applyInPandas(
        pack_shard, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
