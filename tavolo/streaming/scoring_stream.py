"""Streaming spam scoring (L2): new emails are cleaned, turned into mean
vectors and scored by a fitted classifier, micro-batch by micro-batch.

The word lists are collected for broadcasting, so the work runs in ``foreachBatch`` on each
micro-batch as a batch DataFrame. The sink is idempotent: every micro-batch writes
a folder of its own, named by its number, and overwrites it. A micro-batch that runs again
after a failure between its write and the commit leaves one copy, and
``read_scores`` reads the folders as one table. The word vectors are made ready once,
before the first micro-batch; a micro-batch takes as many files as there are cores, so that all of them have work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavolo.operators.models import score_spam
from tavolo.operators.text import VectorShards, clean_text, mean_vectors

EMAIL_STREAM_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
])


def score_batch(batch: DataFrame, lemmas: DataFrame, stopwords: DataFrame, word_vectors: DataFrame | VectorShards,
                indexer, model) -> DataFrame:
    clean = clean_text(batch, lemmas, stopwords)
    vecs = mean_vectors(clean, word_vectors)
    return score_spam(indexer, model, vecs).select("doc_id", "predicted", "verdict")


def run_scoring_stream(spark: SparkSession, emails_dir: str, out_dir: str, checkpoint_dir: str,
                       lemmas: DataFrame, stopwords: DataFrame, word_vectors: DataFrame | VectorShards,
                       indexer, model, files_per_trigger: int | None = None) -> None:
    """Score every file now available, then stop; ``files_per_trigger``: files of a micro-batch, by default one a core."""
    files_per_trigger = files_per_trigger or max(1, spark.sparkContext.defaultParallelism)
    if not isinstance(word_vectors, VectorShards):
        word_vectors = VectorShards(word_vectors)
    src = (spark.readStream.schema(EMAIL_STREAM_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
           .parquet(emails_dir))

    q = (src.writeStream.foreachBatch(batch_writer(out_dir, lemmas, stopwords, word_vectors, indexer, model))
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()


def batch_writer(out_dir: str, lemmas: DataFrame, stopwords: DataFrame, word_vectors: DataFrame | VectorShards, indexer, model):
    def each(batch: DataFrame, batch_id: int) -> None:
        (score_batch(batch, lemmas, stopwords, word_vectors, indexer, model)
         .write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}"))

    return each


def read_scores(spark: SparkSession, out_dir: str) -> DataFrame:
    """(doc_id, predicted, verdict, batch_id) of all micro-batches."""
    return spark.read.parquet(out_dir).withColumn("batch_id", F.col("batch_id").cast("long"))
