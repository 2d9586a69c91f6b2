"""Fingerprints of documents as threshold-scaled sketches of their shingles, in DataFrame functions only.

A sketch retains every hash of a document's shingles that lies below a fixed fraction of the range of hashes, so that its
size follows the document's and two sketches of very unequal documents still hold the same part of both. A set of few
shingles is retained whole, which is the fraction 1. Sketches merge: the sketch of a union is made from the sketches of its
parts alone, whatever their fractions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.workspace import Scratch

SHINGLE_WORDS = 5
# One hash in so many is retained.
SCALE = 16
# Sets of up to so many shingles are retained whole.
SMALL = 128
# Hashes are signed; this is the end of the lowest part of their range.
LIMIT = -(1 << 63) + (1 << 64) // SCALE
# Rows of one bin of the order of documents, over the number of bins.
ROWS_PER_BIN_AND_BINS = 16

_BLANKS = "\x20\t\n\x0b\x0c\r"
_EMPTY = "array<bigint>"


def _below(hashes: Column) -> Column:
    return F.filter(hashes, lambda h: h < F.lit(LIMIT))


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the sketch of a text column: ``scale`` (1 or ``SCALE``) and ``hashes``, ascending.

    Shingles are the runs of five words of the lower-cased text, words being what blanks separate; fewer words make one
    shingle, none make none. A null text is an empty one.
    """
    words, codes, found = f"{name} words", f"{name} codes", f"{name} found"
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_BLANKS))
    parts = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    df = df.withColumn(words, parts)
    df = df.withColumn(codes, F.transform(words, lambda word: F.xxhash64(word))).drop(words)
    n = F.greatest(F.size(codes) - (SHINGLE_WORDS - 1), F.least(F.size(codes), F.lit(1)))
    # Beyond the last word there is NULL, which a hash passes over.
    shingle = lambda i: F.xxhash64(*(F.get(codes, i + k) for k in range(SHINGLE_WORDS)))
    shingles = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), shingle)).otherwise(F.array().cast(_EMPTY))
    df = df.withColumn(found, F.array_distinct(shingles)).drop(codes)
    whole = F.size(found) <= SMALL
    sketch = F.struct(
        F.when(whole, 1).otherwise(SCALE).alias("scale"),
        F.sort_array(F.when(whole, F.col(found)).otherwise(_below(F.col(found)))).alias("hashes"),
    )
    return df.withColumn(name, sketch).drop(found)


def merged(a: Column, b: Column) -> Column:
    """The sketch of the union of the two sets."""
    union = F.array_union(a["hashes"], b["hashes"])
    whole = (a["scale"] == 1) & (b["scale"] == 1) & (F.size(union) <= SMALL)
    return F.struct(
        F.when(whole, 1).otherwise(SCALE).alias("scale"),
        F.sort_array(F.when(whole, union).otherwise(_below(union))).alias("hashes"),
    )


def _at(sketch: Column, scale: Column) -> Column:
    """The hashes that the sketch would retain at a scale that is not below its own."""
    return F.when(sketch["scale"] == scale, sketch["hashes"]).otherwise(_below(sketch["hashes"]))


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of two sets: exact when both are retained whole. Equal sketches have 1, also empty
    ones; otherwise sketches without any hash in the common part have 0."""
    scale = F.greatest(a["scale"], b["scale"])
    shared, union = F.array_intersect(_at(a, scale), _at(b, scale)), F.array_union(_at(a, scale), _at(b, scale))
    same = (a["scale"] == b["scale"]) & (a["hashes"] == b["hashes"])
    return F.when(same, 1.0).when(F.size(union) == 0, 0.0).otherwise(F.size(shared) / F.size(union))


def containment(a: Column, b: Column) -> Column:
    """The estimated share of the first set that lies in the second; NULL when nothing of the first is in the common part."""
    scale = F.greatest(a["scale"], b["scale"])
    held, shared = _at(a, scale), F.array_intersect(_at(a, scale), _at(b, scale))
    return F.when(F.size(held) > 0, F.size(shared) / F.size(held))


def as_text(sketch: Column) -> Column:
    """``scale:hash,hash,...`` with hashes in hexadecimal digits."""
    hashes = F.transform(sketch["hashes"], lambda h: F.lower(F.hex(h)))
    return F.concat_ws(":", sketch["scale"].cast("string"), F.array_join(hashes, ","))


def from_text(fingerprint: Column) -> Column:
    """The sketch that ``as_text`` wrote."""
    hashes = F.filter(F.split(F.substring_index(fingerprint, ":", -1), ","), lambda h: h != "")
    signed = lambda h: F.conv(h, 16, -10).cast("bigint")
    return F.struct(
        F.substring_index(fingerprint, ":", 1).cast("int").alias("scale"), F.transform(hashes, signed).alias("hashes")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.sha2(text, 256))
    return docs.select(key.alias("key"), "doc_id", text.alias("text"))


def _followers(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``key, for_key, for_chars, for_copies``: each different row with the one that it follows, ids descending, nulls last
    and rows of one id by the digest of their texts; the first follows the last.

    Rows are dealt out by ranges of the order, at about the square root of their number. Within a range a window looks one row
    back; over the ends of ranges, one row each, another does.
    """
    slim = _keyed(docs).select("key", "doc_id", F.length("text").alias("chars")).groupBy("key")
    slim = slim.agg(F.first("doc_id").alias("doc_id"), F.first("chars").alias("chars"), F.count(F.lit(1)).alias("copies"))
    slim = scratch.settle(slim, "keys")
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    bins = max(1, math.isqrt(slim.count() // ROWS_PER_BIN_AND_BINS))
    binned = slim.repartitionByRange(bins, *order).withColumn("bin", F.spark_partition_id())
    binned = scratch.settle(binned, "order")
    within = Window.partitionBy("bin").orderBy(*order)
    row = F.struct("key", "chars", "copies")
    back = binned.select("bin", "key", row.alias("row"), F.lag(row).over(within).alias("before"))
    back = back.withColumn("first", F.col("before").isNull())
    # The last row of each bin, and of these the one before; the first bin's is the last of all.
    last = Window.partitionBy("bin").orderBy(F.col("doc_id").asc_nulls_first(), F.col("key").desc())
    ends = binned.withColumn("place", F.row_number().over(last)).where("place = 1").select("bin", row.alias("end"))
    over = Window.orderBy("bin")
    every = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("bin", F.coalesce(F.lag("end").over(over), F.last("end").over(every)).alias("end"))
    at_first = back.where("first").join(ends, "bin").select("key", F.col("end").alias("before"))
    both = back.where("NOT first").select("key", "before").unionByName(at_first)
    names = [F.col(f"before.{c}").alias(f"for_{c}") for c in ("key", "chars", "copies")]
    return both.select("key", *names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, sketch, fingerprint`` of every row."""
    found = with_sketch(docs.select("doc_id", "text"), "text", "sketch").drop("text")
    return found.withColumn("fingerprint", as_text(F.col("sketch")))


def edited_documents(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (``doc_id, text``; other columns are left out) with its fingerprint, that of its text after an
    edit, and how like these and the next row's are.

    The edit replaces the last third of the code points by the first ones of the next row's text, in descending order of
    ids. Null texts are empty; null ids come last; rows of one id follow each other by the digest of their texts; equal rows
    follow each other. The only row of a table is its own next. Texts without words have empty sketches, whose likeness is 1
    to each other and 0 to others. An empty table gives no rows.

    Texts move twice: once to their id, and a third of them on to the row that they follow.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    followers = _followers(docs, scratch)
    # Both uses below read the same shuffled rows, so they ask for the same columns.
    rows = with_sketch(_keyed(docs), "text", "sketch").groupBy("key")
    rows = rows.agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("sketch").alias("sketch"))
    given = rows.join(followers, "key").select(
        F.col("for_key").alias("key"), F.col("for_copies").alias("copies"), F.col("doc_id").alias("next_doc_id"),
        F.substring("text", F.lit(1), F.floor(F.col("for_chars") / 3).cast("int")).alias("given"),
        F.col("sketch").alias("next_sketch"),
    )
    rows = rows.join(given, "key").withColumn("n_chars", F.length("text").cast("long"))
    # Equal rows follow each other, and only the last of them is followed by another.
    own = F.when(F.col("copies") > 1, F.array(F.col("copies") - 1, F.lit(0).cast("long")))
    rows = rows.withColumn("own", F.explode(own.otherwise(F.array(F.lit(0).cast("long")))))
    cut, repeated = F.floor(F.col("n_chars") / 3), F.col("own") > 0
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int"))
    again = F.substring("text", F.lit(1), cut.cast("int"))
    rows = rows.withColumns(
        {
            "edited": F.concat(kept, F.when(repeated, again).otherwise(F.col("given"))),
            "next_sketch": F.when(repeated, F.col("sketch")).otherwise(F.col("next_sketch")),
            "next_doc_id": F.when(repeated, F.col("doc_id")).otherwise(F.col("next_doc_id")),
        }
    ).drop("text", "given")
    rows = with_sketch(rows, "edited", "edited_sketch")
    sketch, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    rows = rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(sketch).alias("fingerprint"),
        as_text(edited).alias("edited_fingerprint"), likeness(sketch, edited).alias("near_edited"),
        likeness(sketch, following).alias("near_next"), containment(sketch, edited).alias("contained_edited"),
        "next_doc_id", F.greatest("own", F.lit(1)).alias("times"),
    )
    return rows.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times", "time")
