"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 5).

Every document gets an exponential key -ln(u) / quality, with u from a hash of its id, so reruns
agree. Documents of a source are ordered by key; the source's token budget is filled by complete
epochs first (each takes every document once) and then by the documents with the smallest keys,
found by prefix sums.

A source may hold a third of all rows, so its order is not made in one task: keys fall into slices,
`buckets` for each factor e, slice totals are summed first (one small row each), and only inside
a slice are rows ordered. Whatever the qualities, a slice holds at most about 1 / (e * buckets) of a source,
since that is the largest density of the logarithm of an exponential key of any scale. Sources are ranked and their targets found on one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import packed, small, stored, unpacked

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating; most epochs of a source.
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3


#: Key of the rows without a source; other sources have the prefix s.
NO_SOURCE = "n"


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(NO_SOURCE))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_quality(text: Column) -> Column:
    """Share of letters and blanks among the characters, at least 0.05."""
    marks = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\p{L}\s]+", ""))
    return F.greatest(F.lit(0.05), 1 - F.try_divide(marks, F.length(text))).cast("double")


def exponential_key(ident: Column, quality: Column, seed: int) -> Column:
    """-ln(u) / quality with u in (0, 1) from the id's hash."""
    bits = F.shiftrightunsigned(F.xxhash64(ident, F.lit(seed)), 11)
    u = (bits.cast("double") + 0.5) / F.lit(float(2 ** 53))
    return -F.log(u) / F.when(quality > 0, quality).otherwise(F.lit(1e-9))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size -> plus target: total words shared by weight, each source at most
    `most` times its size, the excess reshared by weight until none is above.

    The fixed point of the resharing is one level: target = min(cap, level * weight), so with
    sources ordered by cap / weight the saturated ones are a prefix. One row per source.
    """
    by_name = Window.orderBy(F.col("source") == NO_SOURCE, "source")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(listed, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    level = F.try_divide(
        F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levelled = ranked.withColumn("level", level)
    # levels rise over the saturated sources and fall after them: the largest free one holds
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    return (levelled.withColumn("level", F.max(free).over(everything))
            .select("source", "source_size",
                    F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target")))


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """Slices in the order of the keys, `buckets` for each factor e: a quality only shifts them."""
    return rows.withColumn("bucket", F.floor(F.log(F.greatest("key", F.lit(1e-300))) * buckets).cast("int"))


def _slices(keyed: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source and slice: totals of the source, target, whole epochs, the words that the
    last, fractional epoch has left for it and those that earlier slices use."""
    sums = stored(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("slice_size")), "op5-slices")
    per_source = sums.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    targets = stored(source_targets(per_source, weights, most), "op5-targets")
    words = F.round("target").cast("long")
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long"))
    targets = targets.withColumn("left", words - F.col("epochs") * F.col("source_size"))
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    with_before = sums.withColumn("before", F.coalesce(F.sum("slice_size").over(order), F.lit(0)))
    told = small(targets)
    return stored(with_before.join(told, "source").drop("slice_size"), "op5-plan")


def _taken(rows: DataFrame, plan: DataFrame, split: bool) -> DataFrame:
    """Adds source_size, target and taken to rows of (source, bucket, key, size, tie, ...)."""
    joined = rows.join(plan, ["source", "bucket"])
    order = Window.partitionBy("source", "bucket").orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("left") - F.col("before") - F.coalesce(F.sum("size").over(order), F.lit(0))
    if split:  # the document at the border gives the words still missing
        part = F.greatest(F.lit(0), F.least(F.col("size"), room))
    else:      # whole documents: the border document goes in if at least half of it fits
        part = F.when((F.col("size") > 0) & (room * 2 >= F.col("size")), F.col("size")).otherwise(F.lit(0))
    return joined.withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long"))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
               quality: Column | None = None, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS,
               buckets: int = 1024, seed: int = 5) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted).

    The document at the border of a budget gives part of its words, so every source meets its
    rounded target exactly. Null and empty texts have size 0 and give 0; a null source is a source
    of its own, ranked last. Equal ids (nulls too) have equal keys and are ordered by size.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), source_key(F.col(f"`{source_col}`")).alias("source"),
                       word_count(text).alias("size"), (letter_quality(text) if quality is None else quality).alias("quality"))
    rows = rows.select("doc_id", "source", "size", F.col("doc_id").alias("tie"),
                       exponential_key(F.col("doc_id"), F.coalesce("quality", F.lit(0.05)), seed).alias("key"))
    keyed = stored(_bucketed(rows, buckets), "op5-keys")
    out = _taken(keyed, _slices(keyed, weights, most_epochs), split=True)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
                  weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, buckets: int = 1024,
                  seed: int = 5) -> DataFrame:
    """The mix as rows of whole documents: each one once per epoch that takes it, all columns kept.

    The border document goes in if at least half of it fits. Documents without words are not in the mix.
    """
    text = F.col(f"`{text_col}`")
    columns = (F.col(f"`{id_col}`").alias("tie"), source_key(F.col(f"`{source_col}`")).alias("source"), word_count(text).alias("size"),
               exponential_key(F.col(f"`{id_col}`"), F.coalesce(letter_quality(text), F.lit(0.05)), seed).alias("key"))
    keyed = stored(_bucketed(docs.select(*columns), buckets), "op5-keys")
    plan = _slices(keyed, weights, most_epochs)
    whole = _taken(_bucketed(packed(docs, *columns), buckets), plan, split=False)
    copies = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return unpacked(whole.select("row", F.explode(F.array_repeat(F.lit(1), copies))))
