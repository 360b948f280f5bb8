"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage is written as Parquet to the shared checkpoint folder and read again.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinegraph.llm import decontamination, mixing, simhash, token_files, toxicity
from cinegraph.llm.common import hashed_fold, table
from cinegraph.llm.queries import END_ID, tokenizer_path
from cinegraph.session import materialize, scratch_path

#: a smaller piece table than op8's: the executors' memory still holds what earlier stages touched
PIECES = 400_000
#: and smaller stripes, which a writer holds until they are full
STRIPE_BYTES = 16 << 20
#: rows that JVM and Python hand each other at once; a row carries all ids of a document
ARROW_ROWS = "1000"


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.  Null and empty texts are judged as texts
    without features, rows of null ids and repeated rows like any other; no documents, or no
    labels, give all rows back."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), hashed_fold(F.col("doc_id"), 5) != 0)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.  Null and
    empty texts are one group (fingerprint zero); rows without an id are kept only where no
    row of their group has one; a repeated row stays once; no documents give none."""
    return simhash.keep_one(docs)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.  Rows go by id and text, null ids too; null and empty
    texts stay; without items all rows stay; no documents give none."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.  Null sources are one source; rows of null or
    shared ids and repeated rows draw each for itself; texts without words are taken by the
    same rate; no documents give none."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in ORC, read back: (doc_id, start, n_tokens, ids_crc32), one row
    per row: null and empty texts have the end id alone, null ids come last, repeated rows
    follow each other, other columns are not read; no documents give none."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    path = scratch_path(spark, "pipeline-token-files")
    token_files.write_tokens(docs, path, tokenizer_path(), END_ID, pieces=PIECES, stripe_bytes=STRIPE_BYTES)
    return token_files.with_checksums(token_files.read_tokens(spark, path))


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", benchmark_filter),
    ("mixing", source_mix),
    ("token_output", token_output),
]

#: SQL can express neither the classifier nor the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
