"""Exact deduplication by skew-safe combining (operator 2), in built-in functions only.

Texts are equal when their normalised forms are. Equal texts meet in three steps, and each step
groups by digest *and* full content, so a shared digest alone never merges two texts:

1. locally: the partial aggregate of every map task keeps one winner per text;
2. salted: winners meet by (digest, salt), so a text that a third of all rows share is spread
   over `salts` groups;
3. globally: the at most `salts` winners of a text are combined.

The contents travel through steps 2 and 3 only, reduced to one row per task and text. The group
table (no contents) is written to the shared folder; rows get their group by (digest, salt).
Where two texts should share a digest, their contents are kept in the group table and decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from .common import packed, stored, unpacked

SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_of(text: Column, bits: int = 256) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, bits // 8)


def winners(keyed: DataFrame, best: Column) -> DataFrame:
    """Steps 1 to 3 over (digest, salt, content, ...): one row per content with the smallest
    `best`, the number of rows and the salts that its rows have."""
    salted = keyed.groupBy("digest", "salt", "content").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"))
    return (salted.repartition("digest").groupBy("digest", "content")
            .agg(F.min("best").alias("best"), F.sum("n").alias("group_size"), F.collect_list("salt").alias("salts")))


def duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, salts: int = 64,
                     digest_bits: int = 256) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, so null and blank-free empty texts form one group. A null id is
    never chosen while the group has another. Rows that repeat both id and text count in
    group_size, and exactly one of them is kept. Other columns are ignored, whatever their names.
    `digest_bits` below 256 is for tests of shared digests.
    """
    content = normalised(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), content.alias("content"))
    keyed = rows.select("doc_id", "content", F.sha2("content", 256).alias("text_sha256"),
                        digest_of(F.col("content"), digest_bits).alias("digest"),
                        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"))
    found = winners(keyed, F.col("doc_id"))
    shared = Window.partitionBy("digest")
    groups = stored(
        found.withColumn("contents", F.count(F.lit(1)).over(shared))
        .select("digest", F.col("best").alias("keep_id"), "group_size", F.explode("salts").alias("salt"),
                F.when(F.col("contents") > 1, F.col("content")).alias("of_content")), "op2-groups")
    clash = not groups.where(F.col("of_content").isNotNull()).isEmpty()
    plain = groups.where(F.col("of_content").isNull()).drop("of_content")
    slim = keyed.drop("content")
    joined = slim.join(plain, ["digest", "salt"])
    if clash:
        told = groups.where(F.col("of_content").isNotNull())
        more = keyed.join(told, ["digest", "salt"]).where(F.col("content") == F.col("of_content"))
        joined = joined.unionByName(more.select(*joined.columns))
    order = Window.partitionBy("digest", "salt", "text_sha256", "doc_id").orderBy("doc_id")
    return (joined.withColumn("copy", F.row_number().over(order))
            .select("doc_id", "keep_id", F.col("group_size").cast("long"),
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, salts: int = 64) -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the one with the smallest id
    (nulls last), ties broken by the remaining columns. The winning row travels with its content
    through the three steps; its own spelling is carried only where it differs from the content."""
    kinds = dict(docs.dtypes)
    others = [c for c in docs.columns if c not in (id_col, text_col) and not kinds[c].startswith(("map", "variant"))]
    loose = [c for c in docs.columns if c not in (id_col, text_col, *others)]
    if loose:
        raise TypeError(f"columns without an order: {loose}")
    text = F.col(f"`{text_col}`")
    content = normalised(text)
    ident = F.col(f"`{id_col}`")
    row = F.struct(ident.isNull().alias("no_id"), ident.alias("id"),
                   *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)],
                   text.isNull().alias("no_text"), F.when(~text.eqNullSafe(content), text).alias("spelling"))
    keyed = docs.select(row.alias("row"), content.alias("content"), digest_of(content).alias("digest"),
                        F.pmod(F.xxhash64(ident), F.lit(salts)).alias("salt"))
    best = winners(keyed, F.col("row"))
    own = F.when(F.col("best.no_text"), F.lit(None)).otherwise(F.coalesce(F.col("best.spelling"), F.col("content")))
    back = {id_col: F.col("best.id"), text_col: own, **{c: F.col(f"best.c{k}") for k, c in enumerate(others)}}
    return best.select(*[back[c].alias(c) for c in docs.columns])


__all__ = ["drop_duplicates", "duplicate_report", "normalised", "packed", "unpacked"]
