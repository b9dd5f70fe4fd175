"""The corpus pipeline: toxic texts go, then copies, then near copies, then long passages that stand earlier; what is left is packed.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written as Parquet and read
again. All but the last return the columns of docs. Rows without doc_id go in the first stage. Of rows that share a doc_id,
each is judged by its own text.
"""

import public_tokenizers
from pyspark.sql import functions as F

from gradus.llm import exact_dedup, near_dedup, packing, suffix_dedup, toxicity
from gradus.llm.shared import fold, numbered, stored

#: SQL can't express the classifier, the near-duplicate components, the removal of passages or the tokens; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def drop_toxic(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id") != 0).select("doc_id", "toxic")
    return toxicity.without_toxic(docs, toxicity.train(docs.where(fold("doc_id") != 0).select("doc_id", "text"), labels))


def keyed(docs):
    """(doc_id, text, row: all else): a doc_id for each different (doc_id, text), so that rows that share an id are judged by their own text."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    return numbered(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", rest))[0]


def unkeyed(rows, docs):
    return rows.select(*[F.col(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def drop_copies(spark, docs, sf_dir):
    rows = keyed(docs)
    kept = exact_dedup.exact_duplicates(rows.select("doc_id", "text")).where("kept").select("doc_id").distinct()
    return unkeyed(rows.join(kept, "doc_id", "left_semi"), docs)


def drop_near_copies(spark, docs, sf_dir):
    rows = keyed(docs)
    kept = near_dedup.near_duplicates(rows.select("doc_id", "text")).where("kept").select("doc_id").distinct()
    return unkeyed(rows.join(kept, "doc_id", "left_semi"), docs)


def cut_repeats(spark, docs, sf_dir):
    """Long passages stay where they stand first; a character that a passage holds in part stays whole."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    rows = docs.where("doc_id is not null").select("doc_id", "text", rest)
    left = suffix_dedup.remove_repeats(rows, whole_characters=True).withColumn("left", F.col("kept").cast("string"))
    new = {"text": F.col("left")} | ({"n_chars": F.length("left").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return left.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def pack(spark, docs, sf_dir):
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies), ("suffix dedup", cut_repeats), ("packing", pack)]


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        if i:
            docs = stored(docs, "stage")
        docs = stage(spark, docs, sf_dir)
    return docs
