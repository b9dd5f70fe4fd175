"""Operator 7: exact deduplication by content-defined chunk recipes, with DataFrame functions only.

A text, without the characters [\\x20\\x09-\\x0D], is cut where its own characters say so (a pair of letters, after
MIN_CHARS and before MAX_CHARS), so equal passages give equal chunks wherever they stand. A chunk's identifier is two
64-bit hashes; chunk_store() holds each chunk once, and identifiers are verified by comparing contents: should two
contents ever share one, all are drawn anew with another seed. A document is then its recipe, the ordered identifiers;
equal recipes are equal texts, and only recipes are grouped and joined. Copies are counted before the shuffle, and the
join back is an ordinary join that may split a large group.

A null text is empty, and empty texts are copies of each other. Rows without doc_id take part but stay only if no row
with one has their text. Rows that share a doc_id and text are one document and fare alike. Other columns are ignored.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

MIN_CHARS, MAX_CHARS = 512, 4096
_CUT = f"(?s).{{{MIN_CHARS},{MAX_CHARS - 1}}}?(?<=[acns][einru])|.{{1,{MAX_CHARS}}}"


def chunked(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars (code points of the text as given), text_sha256 (binary, of the text without spaces), chunks."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long"), F.length(text).alias("n_chars"), F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "").alias("plain"))
    return plain.select("doc_id", "n_chars", F.unhex(F.sha2(F.col("plain").cast("binary"), 256)).alias("text_sha256"), F.regexp_extract_all("plain", F.lit(_CUT), F.lit(0)).alias("chunks"))


def _identifier(chunk, seed: int):
    return F.struct(F.xxhash64(F.lit(seed), chunk).alias("a"), F.xxhash64(F.lit(seed + 1), chunk).alias("b"))


def recipes(texts: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n_chars, text_sha256, recipe of texts as chunked() gives them."""
    return texts.select("doc_id", "n_chars", "text_sha256", F.transform("chunks", lambda c: _identifier(c, seed)).alias("recipe"))


def chunk_store(texts: DataFrame, seed: int = 1) -> DataFrame:
    """id, chunk, uses: each different chunk once."""
    chunks = texts.select(F.explode("chunks").alias("chunk"))
    return chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("uses")).select(_identifier(F.col("chunk"), seed).alias("id"), "chunk", "uses")


def shared_identifiers(texts: DataFrame, seed: int = 1) -> DataFrame:
    """Identifiers that stand for more than one content: none, save for a collision of 128 bits."""
    return chunk_store(texts, seed).groupBy("id").count().where("count > 1")


def verified_recipes(docs: DataFrame) -> DataFrame:
    """Texts are cut once; the chunks are written, as both their verification and the recipes read them."""
    texts, seed = stored(chunked(docs), "chunks"), 1
    while not shared_identifiers(texts, seed).isEmpty():
        seed += 2
    return stored(recipes(texts, seed), "recipes")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: of equal texts the one with the most code points, then the smallest doc_id, stays."""
    found = verified_recipes(docs)
    best = F.max(F.struct("n_chars", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("minus")))
    groups = found.groupBy("recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select(F.col("recipe").alias("same"), F.bitwise_not("best.minus").alias("keep_id"), "group_size")
    groups = stored(groups, "groups")  # so that the join deals both sides itself and may split a large group
    joined = found.join(groups, F.col("recipe") == F.col("same"))
    return joined.select("doc_id", "keep_id", F.col("group_size").cast("long"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("text_sha256")).alias("text_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = """
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t FROM documents
), named AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY n_chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM plain
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM named
"""
