"""A training corpus from raw documents, in five stages; each writes Parquet that the next one reads.

The order: quality classifier, line dedup, MinHash near-dedup, benchmark decontamination, byte-level BPE. The first four
return the columns of ``documents``, of any names beside doc_id and text; the last returns the tokens of what is left. An empty table gives an empty one. Intermediate tables go to the folder that
``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm import bpe, decontam, lines, minhash, quality
from brightledger.llm.common import table, without
from brightledger.sources.targets import stage

RANKS = "byte_bpe_50k.tiktoken"
#: Share of the usual memory for the last stage's tables: executors still hold what the stages before it needed.
TABLES = 0.25


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the classifier rejects as low quality or toxic. Rows with a null id stay; null and empty texts are judged by their site; rows that share an id go together."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut; ``n_chars`` follows. Documents of which no word is left go."""
    out = lines.clean(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group at 80 in 100 shared five-word shingles: the one with the smallest id. Rows with a null id, and null or empty texts, stay; rows that share an id go together."""
    found = minhash.near_duplicates(docs, percent=80)
    return without(docs, "doc_id", found.where("NOT kept").select("doc_id"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item. Rows with a null id, and null or empty texts, stay."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): token ids, and the text they decode to; one row per row, a null text has no ids and decodes to an empty one."""
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, share=TABLES)


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", without_repeats),
    ("minhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("byte_bpe", tokenized),
]

#: None: SQL can't state a trained classifier, chained text edits or merges of byte pairs. Tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir))
    return docs
