"""Exact duplicates: group by a 128-bit content hash, keep the smallest id, compare bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import SPACES, fresh, named, stored, texts


def one_spaced(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, SPACES, " ")


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = one_spaced,
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Each document with its group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by hash and text, so two texts of one hash never share a group. Copies are combined before the
    shuffle: each task sends a text once, however often it holds it. Documents then find their group by the hash; only
    for a hash that several texts share (with 128 bits: practically never) by the text as well.

    NULL texts count as empty. NULL ids come after all others and stay only in a group without any other. Rows that
    repeat both id and text are one document, returned once; ``group_size`` counts rows. An empty table gives no rows.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", normalise(F.col("text")).alias("text"))
    rows = rows.select("doc_id", "text", hashed(F.col("text")).alias("content_hash"))

    def grouped(some: DataFrame) -> DataFrame:
        return some.groupBy("content_hash", "text").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )

    digest = F.sha2("text", 256).alias("text_sha256")
    groups = stored(grouped(rows).select("content_hash", "keep_id", "group_size", digest))
    shared = groups.groupBy("content_hash").count().filter("count > 1").select("content_hash")
    result = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")]
    result.append("text_sha256")

    ids = rows.select("content_hash", "doc_id").distinct()
    if shared.isEmpty():
        return ids.join(groups, "content_hash").select(result)
    alone = ids.join(shared, "content_hash", "left_anti").join(groups, "content_hash")
    told_apart = rows.join(shared, "content_hash", "left_semi")
    by_text = told_apart.distinct()
    collided = by_text.join(grouped(told_apart), ["content_hash", "text"]).withColumn("text_sha256", digest)
    return alone.select(result).unionByName(collided.select(result))


def drop_exact_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = one_spaced,
) -> DataFrame:
    """The documents that stay, with all their columns. Of rows that repeat both id and text one stays."""
    keep = exact_groups(docs, id_col, text_col, normalise).filter("kept")
    keys = fresh(docs, "dedup_id", "dedup_text")
    keep = keep.select(_id_key(F.col("doc_id")).alias(keys[0]), F.col("text_sha256").alias(keys[1]))
    text = normalise(F.coalesce(named(text_col), F.lit("")))
    keyed = docs.withColumns({keys[0]: _id_key(named(id_col)), keys[1]: F.sha2(text, 256)})
    return keyed.join(keep, keys, "left_semi").dropDuplicates(keys).drop(*keys)


def _id_key(column: Column) -> Column:
    """A key that is never NULL and differs for different ids."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))
