"""From raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes every stage's result to the shared
checkpoint folder and reads it back as the next one's documents. All but the
last stage return the columns of their input.

1. quality: a document the quality classifier rejects goes. It is fitted on the
   labels in ``sf_dir`` and the stage's own documents.
2. line dedup: later copies of repeated line runs go from the texts;
   ``n_chars`` follows the text. A document that loses all its lines stays, empty.
3. SimHash near-dedup: one document of each group stays.
4. mixing: each document as often as the mix takes it.
5. packing: pieces of token sequences.

Defined results, stage by stage; in all of them very long texts are read whole,
an empty table stays empty, and input columns may have any names beside doc_id,
text and source:

1. A null text is scored as an empty one, a null id like any other; repeated rows
   are judged each, alike; a score equal to the threshold stays.
2. A null text stays null; rows with equal id and text are one document, treated
   alike; rows with equal id and different texts go by the hash of the text, null ids last.
3. Texts without a word have fingerprint zero and are one group; of a group the
   row with the smallest id stays, of equal ids one row; null ids come last.
4. A null text has size 0; a null source is a source of its own, the last one; equal
   rows are drawn separately.
5. A null text is an empty one, which has its end id alone; repeated rows are packed each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavolo.llm.linededup import dedup_lines
from tavolo.llm.mixing import mix_documents
from tavolo.llm.packing import pack_documents
from tavolo.llm.quality import fit_quality, score_quality
from tavolo.llm.shared import table, written
from tavolo.llm.simhash import keep_one_of_each
from tavolo.session import ensure_checkpoint_dir


def _like(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in docs.columns])


def _aside(docs: DataFrame) -> DataFrame:
    """doc_id and text by name; the other columns by place, so that no operator's column replaces them."""
    return docs.select([F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"__{i}") for i, c in enumerate(docs.columns)])


def _back(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select([F.col(c if c in ("doc_id", "text") else f"__{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return _back(score_quality(_aside(docs), model).where("predicted = 1"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(_aside(docs))
    if "n_chars" not in docs.columns:
        return _back(cleaned, docs)
    place = f"__{docs.columns.index('n_chars')}"
    return _back(cleaned.withColumn(place, F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col(place)).cast(docs.schema["n_chars"].dataType)), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(keep_one_of_each(docs), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like(mix_documents(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: Scores, fingerprints and balanced samples have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{i + 1}")
    return docs
