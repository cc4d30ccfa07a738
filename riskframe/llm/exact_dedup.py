"""Exact dedup by content-defined chunk recipes, with DataFrame functions only.

A text without its white space is cut at places that its own characters choose. Each distinct chunk is moved once, to
prove that its 64-bit hash names no other chunk; a document is then its ordered list of chunk identifiers (its recipe),
and only recipes are compared. Chunks whose hash is shared get a number beside the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import drop_listed, small
from riskframe.session import materialise

#: A chunk ends behind the first of these pairs after SHORTEST characters, at LONGEST at the latest.
ANCHOR, SHORTEST, LONGEST = "[aeiou][nrst]", 256, 2048
_CHUNK = rf"(?s).{{{SHORTEST},{LONGEST - 2}}}?{ANCHOR}|.{{1,{LONGEST}}}"
_SPACE = r"[\x20\x09-\x0D]"


def _chunks(normal: Column) -> Column:
    return F.regexp_extract_all(normal, F.lit(_CHUNK), F.lit(0))


def _name(chunk: Column, hash_bits: int) -> Column:
    h = F.xxhash64(chunk)
    return h if hash_bits == 64 else F.pmod(h, F.lit(1 << hash_bits))


def recipes(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """row_id, doc_id, text_hash, n_points, text_sha256 and the recipe of every row of ``docs`` (doc_id, text); written.

    ``hash_bits`` below 64 is for tests of shared hashes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    normal = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.length(text).cast("long").alias("n_points"),
        F.regexp_replace(text, _SPACE, "").alias("normal"))
    chunk = F.explode(_chunks(F.col("normal")))
    distinct = normal.select(chunk.alias("chunk")).select(_name(F.col("chunk"), hash_bits).alias("h"), "chunk").distinct()
    counted = distinct.groupBy("h").count().filter("count > 1").select("h")
    shared = materialise(counted, "shared-hashes")
    facts = [F.monotonically_increasing_id().alias("row_id"), "doc_id", "text_hash", "n_points",
             F.sha2(F.encode("normal", "UTF-8"), 256).alias("text_sha256")]
    if shared.isEmpty():
        names = F.transform(_chunks(F.col("normal")), lambda c: _name(c, hash_bits))
        return materialise(normal.select(*facts, names.alias("recipe")), "recipes")
    return _with_shared(normal, facts, distinct, small(shared), hash_bits)


def _with_shared(normal, facts, distinct, shared, hash_bits) -> DataFrame:
    """Recipes where some hashes name several chunks: those chunks are told apart by their place among them."""
    several = distinct.join(shared, "h").groupBy("h").agg(F.sort_array(F.collect_set("chunk")).alias("all"))
    several = materialise(several, "shared-chunks")
    base = materialise(normal.select(*facts, _chunks(F.col("normal")).alias("chunks")), "chunked")
    parts = base.select("row_id", F.posexplode("chunks").alias("at", "chunk"))
    parts = parts.withColumn("h", _name(F.col("chunk"), hash_bits)).join(small(several), "h", "left")
    number = F.coalesce(F.array_position("all", F.col("chunk")), F.lit(0)).cast("long")
    lists = parts.groupBy("row_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "h", number.alias("number")))),
                    lambda x: F.array(x["h"], x["number"])).alias("pairs"))
    joined = base.drop("chunks").join(lists, "row_id", "left")
    recipe = F.coalesce(F.flatten("pairs"), F.array().cast("array<bigint>"))
    return materialise(joined.select(*[c for c in base.columns if c != "chunks"], recipe.alias("recipe")), "recipes")


def exact_dedup(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """For every row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, text_hash, keep_text_hash.

    Texts are equal when identical without white space; null counts as empty. The row with most code points stays, then
    the smallest doc_id (null ids last), then the first of rows repeated as a whole. An empty table gives no rows; other
    columns are ignored.
    """
    rows = recipes(docs, hash_bits)
    first = F.struct(
        (-F.col("n_points")).alias("fewest"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("keep_id"),
        F.col("row_id").alias("keep_row"))
    groups = rows.groupBy("recipe").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    groups = materialise(groups.filter("group_size > 1"), "groups")  # a written side, so that a hot recipe can be split
    out, alone = rows.join(groups, "recipe", "left"), F.col("group_size").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("row_id") == F.col("first.keep_row"))).alias("kept"), "text_sha256", "text_hash")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    told = materialise(exact_dedup(docs).select("doc_id", "text_hash", "kept"), "exact-dedup")
    return one_of_each(docs, told)


def one_of_each(docs: DataFrame, told: DataFrame) -> DataFrame:
    """``docs`` without the rows that the written table ``told`` (doc_id, text_hash, kept) drops."""
    same = told.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    same = materialise(same.filter("not kept or n > 1"), "dropped")
    return drop_listed(docs, same.filter("not kept"), same.filter("kept and n > 1"))
