"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, piece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents. ``run`` writes each stage's rows as Parquet into the shared
checkpoint folder and reads them back for the next.

Defined cases, in every stage: an empty table gives an empty one; a null text stays null
and is kept (near-dedup keeps one of all rows that share a null text and have an id, and
every row without an id); an empty text has the toxicity score of texts without a known
term; rows that share an id and a text are judged alike, and near-dedup keeps the first;
very long texts are read whole; columns beside those of documents pass through, whatever
their names, except that the last stage sets ``piece_ids``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bagminhash, decontaminate, line_dedup, pieces_bpe, toxicity
from tidemark.llm.common import ensure_checkpoint_dir, fold, remove

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold of 0.3."""
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold("doc_id", 4) != 2)
    return toxicity.accepted(docs, index)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the three-line windows that stand earlier; n_chars follows the text."""
    out = line_dedup.line_dedup(docs, counts=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near copies."""
    return bagminhash.deduplicated(docs).select(*docs.columns)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents and the ids of the text's pieces, which decode to the text."""
    return pieces_bpe.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_benchmark_text),
    ("piece encoding", encode_pieces),
]

#: SQL can express neither the toxicity model nor near-dedup; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{n}")
        docs = spark.read.parquet(f"{base}/{n}")
        if n:
            remove(spark, f"{base}/{n - 1}")  # the next stage reads what is written now
    return docs
