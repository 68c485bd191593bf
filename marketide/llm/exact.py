"""Exact duplicates by progressive refinement, in DataFrame operations alone.

Texts are first told apart by their length, then by a hash of their first characters,
and only what still has company is hashed in full. Only keys and ids are shuffled,
never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketide.llm.tables import free_names, kept, texts

#: Characters under the prefix hash.
PREFIX = 256


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space."""
    # Single spaces stay as they are, so the pattern need not match them.
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, hash_all: bool = False) -> DataFrame:
    """doc_id, keep_id (smallest doc_id of equal texts), group_size, kept and text_sha256 per row.

    Equal means equal after ``normalised``; a null text counts as empty, and empty texts
    are equal. text_sha256 is null for texts that length or prefix already tell from all
    others, unless ``hash_all``. Rows that repeat a doc_id with an equal text count in
    group_size and share one verdict. A row without doc_id is kept only if none of its
    equals has one.
    """
    text = normalised(F.col("text"))
    keyed = kept(
        texts(docs).select(
            "doc_id",
            F.octet_length(text).alias("length"),
            F.xxhash64(F.substring(text, 1, PREFIX)).alias("prefix"),
            (F.sha2(text, 256) if hash_all else F.lit(None).cast("string")).alias("text_sha256"),
        )
    )
    lengths = keyed.groupBy("length").count().where("count > 1").select("length")
    alike = keyed.join(lengths, "length", "left_semi")
    prefixes = kept(alike.groupBy("length", "prefix").count().where("count > 1").select("length", "prefix"))
    suspects = keyed if hash_all else _hash_suspects(docs, prefixes)
    hashed = suspects.join(prefixes, ["length", "prefix"], "left_semi")
    key = ["length", "prefix", "text_sha256"]
    groups = hashed.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    alone = keyed.join(prefixes, ["length", "prefix"], "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    return hashed.join(groups, key).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(columns).union(alone)


#: Bits of the filter that finds suspects in the scan: 2 MB in all.
FILTER_BITS = 1 << 24


def _hash_suspects(docs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """doc_id, length, prefix and full hash of at least all texts whose (length, prefix) is listed.

    Hashes of the listed keys make a bitmap of FILTER_BITS that is small enough for every
    task, so the scan knows which texts to hash in full; a stray hit only costs a hash.
    """
    text = normalised(F.col("text"))
    bit = F.pmod(F.xxhash64("length", "prefix"), F.lit(FILTER_BITS))
    bitmap = (
        prefixes.select(bit.alias("bit")).distinct()
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )
    keyed = texts(docs).select(
        "doc_id", "text", F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, PREFIX)).alias("prefix"),
    ).withColumn("bit", bit)
    place = F.bitmap_bit_position("bit")
    byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # At most FILTER_BITS / 32768 rows of 4 KB.
    found = keyed.join(F.broadcast(bitmap), F.bitmap_bucket_number("bit") == F.col("bucket"))
    hit = F.getbit(byte, (place % 8).cast("int")) == 1
    return found.where(hit).select("doc_id", "length", "prefix", F.sha2(text, 256).alias("text_sha256"))


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    gone_id, gone_hash = free_names(docs, "gone_id", "gone_hash")
    gone = exact_groups(docs).where("NOT kept").select(
        F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_hash)
    ).distinct()
    digest = F.sha2(normalised(F.coalesce(F.col("text").cast("string"), F.lit(""))), 256)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(gone_id)) & (digest == F.col(gone_hash))
    return docs.join(gone, same, "left_anti")
