"""A corpus from raw documents to token ids, in five stages.

Each stage reads what the one before has written. The first four return documents with the columns they
came with; the last returns a row per document with its ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.llm import byte_bpe, exact_dedup, jaccard_join, quality, source_mix
from settle.llm.common import Scratch, table
from settle.llm.queries import BYTE_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the perplexity band of their language accept.

    Rows are judged by a hash of id, language and text, so rows without an id and rows that repeat one
    get the verdict of their own text.
    """
    row = F.xxhash64("doc_id", "lang", "text")
    judged = quality.quality(docs.select(row.alias("doc_id"), "lang", "text"), Scratch(spark))
    kept = judged.filter("kept").select(F.col("doc_id").alias("kept_row"))
    return docs.join(kept, row == F.col("kept_row"), "left_semi")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id; of rows that repeat both, one."""
    judged = Scratch(spark).save(exact_dedup.deduplicate(docs, Scratch(spark)), "judged")
    digest = F.sha2(exact_dedup.normalised(F.col("text")), 256)

    def among(rows: DataFrame) -> DataFrame:
        keys = rows.select(F.col("doc_id").alias("kept_id"), "text_sha256")
        same = docs["doc_id"].eqNullSafe(keys["kept_id"]) & (digest == keys["text_sha256"])
        return docs.join(keys, same, "left_semi")

    kept = among(judged.filter("kept"))
    again = judged.filter(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if again.isEmpty():  # as a rule: ids do not repeat
        return kept
    once = among(again).withColumn(_DIGEST, digest).dropDuplicates(["doc_id", _DIGEST])
    keys = again.select(F.col("doc_id").alias("kept_id"), "text_sha256")
    same = kept["doc_id"].eqNullSafe(keys["kept_id"]) & (digest == keys["text_sha256"])
    return kept.join(keys, same, "left_anti").unionByName(once.drop(_DIGEST))


_DIGEST = "__text_digest"


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id.

    Documents without an id stay. Rows that repeat an id are judged each by its own text; where the
    smallest id of a component is that of several rows, the one with the smallest hash stays.
    """
    scratch = Scratch(spark)
    found = jaccard_join.with_components(docs, scratch)
    firsts = scratch.save(
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))), "firsts"
    )
    alone = firsts.filter("component IS NULL").select(F.col("doc_id").alias("kept_id"), "key")
    one = firsts.filter("component IS NOT NULL").groupBy("component", F.col("doc_id").alias("kept_id"))
    kept = alone.unionByName(one.agg(F.min("key").alias("key")).select("kept_id", "key"))
    same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (jaccard_join.text_key() == kept["key"])
    return docs.join(kept, same, "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources up to twice, so that sources weigh more alike."""
    return source_mix.mixed_documents(docs, Scratch(spark), repetition=2.0)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, with counts and digests of the ids and of what they decode to."""
    return byte_bpe.round_trip(
        docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("source_mix", mix_sources),
    ("byte_bpe", token_ids),
]

#: The perplexity band and the merges of the vocabulary are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to what the one before has written.

    What a stage has put aside goes when its result is written, and a result when the next one is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        result = Scratch(spark)
        mark = len(Scratch.opened)
        docs = result.save(stage(spark, docs, sf_dir), name)
        Scratch.drop_since(mark)
        if before is not None:
            before.drop()
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
