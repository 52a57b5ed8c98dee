"""Spam topics and semantic distances (Q10, Q11; I8-I10, F7, C6, H17-H19).

Bag of words and LDA come from Spark ML (``CountVectorizer``, ``LDA``);
topic vectors reuse the mean-vector job; the distance table is built from
blocks of vectors, pairs formed inside block-pair rows (one row when the
vectors are few, as topics and classes are).
"""

from __future__ import annotations

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavolo.functions.vectors import cosine_distance
from tavolo.operators.ranking import global_rank
from tavolo.operators.text import VectorShards, mean_vector_of_words, words

BLOCK = 512  # vectors packed per row when building the pair table


def _pairs(a, b, same_block: bool, id_col: str, places: int):
    """All (x in a, y in b) pairs with x.i < y.i, computed inside one row."""
    def inner(x):
        ys = F.filter(b, lambda y: y["i"] > x["i"]) if same_block else b
        return F.transform(ys, lambda y: F.struct(
            x["i"].alias(f"{id_col}_i"), y["i"].alias(f"{id_col}_j"),
            (F.round(cosine_distance(x["v"], y["v"]), places) + F.lit(0.0)).alias("distance")))
    return F.flatten(F.transform(a, inner))


def pairwise_distances(vectors: DataFrame, id_col: str = "id", vec_col: str = "vector",
                       places: int = 6, block: int = BLOCK) -> DataFrame:
    """Cosine distance for every unordered pair i < j.

    The pair table is the feature itself (n * (n - 1) / 2 rows). Vectors are
    ranked by id and packed ``block`` to a row; each block row meets its own
    and every later block by an equi-join on generated partner block numbers,
    and the pairs of two blocks are built inside that row. Few vectors
    (topics, classes) make one block and one row; many vectors spread over
    (n / block)^2 block pairs, with no cross join and no cap.
    """
    ranked = global_rank(vectors.select(F.col(id_col).alias("i"), F.col(vec_col).cast("array<double>").alias("v")),
                         [F.col("i").asc()], "_r")
    n = ranked.count()
    if n < 2:
        return vectors.sparkSession.createDataFrame(
            [], f"{id_col}_i {vectors.schema[id_col].dataType.simpleString()}, "
                f"{id_col}_j {vectors.schema[id_col].dataType.simpleString()}, distance double")
    last = (n - 1) // block
    blocks = (ranked.withColumn("b", (F.col("_r") / block).cast("long"))
              .groupBy("b").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("a")))
    left = blocks.select("b", "a", F.explode(F.sequence(F.col("b"), F.lit(last))).alias("pb"))
    right = blocks.select(F.col("b").alias("pb"), F.col("a").alias("a2"))
    joined = left.join(right, "pb")
    pairs = F.when(F.col("b") == F.col("pb"), _pairs(F.col("a"), F.col("a"), True, id_col, places)) \
        .otherwise(_pairs(F.col("a"), F.col("a2"), False, id_col, places))
    return joined.select(F.inline(pairs))


def class_mean_vectors(df: DataFrame, label: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Mean vector per class, by ``Summarizer`` (no explode of dimensions)."""
    return (df.groupBy(label).agg(Summarizer.mean(array_to_vector(F.col(vec_col))).alias("_m"))
            .select(F.col(label).alias("id"), vector_to_array("_m", "float64").alias("vector")))


def with_zero_vector(vectors: DataFrame, zero_id: int = 99) -> DataFrame:
    """Add one all-zero vector of the same length (the N38 edge case)."""
    z = vectors.limit(1).select(F.lit(zero_id).cast(vectors.schema["id"].dataType).alias("id"),
                                F.transform("vector", lambda x: F.lit(0.0)).alias("vector"))
    return vectors.unionByName(z)


# ---------------------------------------------------------------- LDA

def fit_topics(clean: DataFrame, k: int = 5, vocab_size: int = 1000, min_df: float = 5.0,
               seed: int = 42, max_iter: int = 10, col: str = "clean_text"):
    """Bag of words (tokens of >= 2 characters, N39) and online LDA."""
    toks = clean.select("doc_id", F.filter(words(clean, col), lambda w: F.length(w) >= 2).alias("tokens"))
    cv = CountVectorizer(inputCol="tokens", outputCol="features", vocabSize=vocab_size, minDF=min_df)
    cv_model = cv.fit(toks)
    bow = cv_model.transform(toks).select("doc_id", "features").orderBy("doc_id").cache()
    lda = LDA(k=k, seed=seed, maxIter=max_iter, optimizer="online", subsamplingRate=1.0,
              optimizeDocConcentration=False, featuresCol="features")
    model = lda.fit(bow)
    bow.unpersist()
    return cv_model, model


def topic_words(cv_model, lda_model, top: int = 10) -> DataFrame:
    """(topic, rank, word, weight): the ``top`` heaviest words of each topic,
    heaviest first (F7); topics numbered from 1."""
    vocab = cv_model.vocabulary
    spark = lda_model.describeTopics(top).sparkSession
    terms = lda_model.describeTopics(top).select(
        (F.col("topic") + 1).alias("topic"),
        F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank0", "tw"))
    vocab_df = spark.createDataFrame(list(enumerate(vocab)), "term_index int, word string")
    return (terms.select("topic", (F.col("rank0") + 1).alias("rank"),
                         F.col("tw.termIndices").alias("term_index"), F.col("tw.termWeights").alias("weight"))
            .join(F.broadcast(vocab_df), "term_index").drop("term_index"))


def topic_distances(topic_words_df: DataFrame, word_vectors: DataFrame, places: int = 6) -> DataFrame:
    """Mean vector of each topic's words, then the pairwise distances."""
    lists = topic_words_df.groupBy("topic").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda s: s["word"]).alias("words"))
    vectors = VectorShards(word_vectors, only=topic_words_df)  # of the topics' words, not of the whole corpus
    vecs = mean_vector_of_words(lists, vectors, "topic", "words", places=None)
    return pairwise_distances(vecs.select(F.col("topic").alias("id"), "vector"), "id", "vector", places) \
        .withColumnRenamed("id_i", "topic_i").withColumnRenamed("id_j", "topic_j")
