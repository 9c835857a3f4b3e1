"""A training corpus from raw documents, in five stages.

Languages are identified and unreadable texts leave; repeated passages of three
lines and more go but for their first place; one document of each group of near
copies stays; credentials are masked; the rest is packed into sequences.

Every stage takes the whole table its predecessor kept and returns the columns
of the documents, the last one the packed pieces. Nulls, empty texts, repeated
rows and empty tables are handled as the operators' modules state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import credentials, hamming, language, lines, packing
from starloom.sources.workspace import Workspace

VOCABULARY = "word_bpe_49k.json"
# Texts that pass between Spark and Python at once, and words that packing remembers.
BATCH_ROWS = 250
REMEMBERED = 1 << 15

_WORKSPACES: list[Workspace] = []


def _workspace(spark: SparkSession, docs: DataFrame, stage: str) -> Workspace:
    """A stage's folder. Those of former stages go first, unless ``docs`` still reads them:
    once a stage's result is stored elsewhere, nothing refers to its inner tables."""
    read = docs.inputFiles() if _WORKSPACES else []
    for former in list(_WORKSPACES):
        if former.spark is not spark:
            _WORKSPACES.remove(former)
        elif not any(former.root in path for path in read):
            former.remove()
            _WORKSPACES.remove(former)
    _WORKSPACES.append(Workspace(spark, f"pipeline-{stage}"))
    return _WORKSPACES[-1]


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows in an Arrow batch while a stage writes its inner tables: both
    sides hold whole batches, and executors carry what all stages leave."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that no language model accepts."""
    with _small_batches(spark):
        return language.filtered(docs, _workspace(spark, docs, "language"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; a text that loses all its words goes."""
    cleaned = lines.remove_repeats(docs, _workspace(spark, docs, "lines"))
    removed = cleaned.columns[-1]
    left = (F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return cleaned.filter(left).select(*docs.columns)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on five-word shingles."""
    with _small_batches(spark):
        return hamming.keep_one(docs, _workspace(spark, docs, "copies"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with credentials masked, widely copied examples aside."""
    return credentials.redact(docs, _workspace(spark, docs, "secrets"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    work = _workspace(spark, docs, "packing")
    vocabulary = public_tokenizers.path(VOCABULARY)
    with _small_batches(spark):
        packed = packing.pack(docs, vocabulary, work, keep_ids=False, batch_bytes=1 << 21, remember=REMEMBERED)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("near dedup", remove_near_copies),
    ("secret scan", mask_secrets),
    ("packing", pack_sequences),
]

# Language models and tokens are beyond SQL; tests compare near copies and tokens of clean texts with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            work.discard(f"stage-{number - 1}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
