"""The registered query of each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.llm import (
    byte_bpe,
    exact_dedup,
    hard_negatives,
    html_text,
    jaccard_join,
    language_id,
    quality,
    secret_scan,
    source_mix,
    substring_dedup,
    token_files,
    url_cascade,
    whitening,
)
from settle.llm.common import Scratch, table

BYTE_BPE = "byte_bpe_50k.tiktoken"
WORD_BPE, END_ID = "word_bpe_49k.json", 1

#: Verdict, host and path of the rules.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"), Scratch(spark))


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    manifest = token_files.write(
        table(spark, sf_dir, "documents"),
        scratch,
        f"{scratch.path}/tokens",
        public_tokenizers.path(WORD_BPE),
        END_ID,
    )
    return token_files.counted(token_files.read(token_files.placed(manifest)))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_cascade.rule_table(spark, URL_RULES)
    return url_cascade.judge(table(spark, sf_dir, "pages"), rules, Scratch(spark))


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document once and small sources up to twice; see ``source_mix.mix``."""
    scratch = Scratch(spark)
    rows = source_mix.prepared(table(spark, sf_dir, "documents"), ["doc_id"])
    mixed = source_mix.mix(scratch.save(rows, "counted"), scratch, repetition=2.0)
    return mixed.select("row.doc_id", "source", "n_tokens", "pass", "block", "block_key")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), Scratch(spark))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_BPE),
        public_tokenizers.PATTERN,
    )


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_BPE),
        public_tokenizers.PATTERN,
    )


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), Scratch(spark))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), Scratch(spark), most=4)


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, Scratch(spark), F.col("vec_id") % 50 == 0)
