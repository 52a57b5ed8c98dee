"""Supervised models: split, spam classifier, random forest, importances,
recursive feature elimination, scoring (I1, I7, I11-I14, B12, B15).

Fits are Spark ML estimators; the driver only loops over fits (folds, feature
counts) and keeps the small fitted metadata. Forests of more than a few thousand
rows are grown by ``tavolo.operators.forest``, whose trees stay in the cluster.
Forests are fitted on one table in canonical form: features cut into bins at
exact quantiles once, rows dealt to partitions by their rank in the order of id.
Bagging draws by partition and place, so the same rows give the same forest
however they came, and all folds and feature counts of a selection read the
same table.
Numbers are never promised equal to another library's: solvers and
initialisations differ (SURVEY hard point 4).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavolo.operators import forest
from tavolo.operators.evaluate import balanced_accuracy
from tavolo.operators.ranking import global_rank, group_quantiles
from tavolo.session import ensure_checkpoint_dir


# ---------------------------------------------------------------- I1 split

def split_flag(id_col: Column, test_fraction: float, seed: int) -> Column:
    """``test`` / ``train`` by a hash of the id (md5, which SQL engines share):
    stable under any repartitioning, unlike ``randomSplit``. Sizes are approximate."""
    digits = F.substring(F.md5(F.concat_ws(":", id_col.cast("string"), F.lit(str(seed)))), 1, 8)
    bucket = F.conv(digits, 16, 10).cast("bigint") % 10000
    return F.when(bucket < int(round(test_fraction * 10000)), F.lit("test")).otherwise(F.lit("train"))


def train_test_split(df: DataFrame, id_col: str, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    return df.withColumn("split", split_flag(F.col(id_col), test_fraction, seed))


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 0) -> DataFrame:
    """``fold`` in 0..k-1, dealt round-robin inside each class in a hashed
    order: exact stratification, computed with the distributed global rank
    (a class with a third of all rows is spread over many tasks)."""
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    ranked = global_rank(df.withColumn("_h", h), [F.col(label).asc(), F.col("_h").asc(), F.col(id_col).asc()], "_r")
    starts = ranked.groupBy(label).agg(F.min("_r").alias("_r0"))
    return (ranked.join(starts, label)
            .withColumn("fold", ((F.col("_r") - F.col("_r0")) % k).cast("int"))
            .drop("_h", "_r", "_r0"))


# ---------------------------------------------------------------- I7 spam classifier

def fit_spam_classifier(train: DataFrame, label: str = "label", vec_col: str = "vector",
                        hidden: int = 100, max_iter: int = 100, tol: float = 0.005, seed: int = 42):
    """MLP with one sigmoid hidden layer of ``hidden`` units (I7); Spark's
    solver is L-BFGS (adam is not offered)."""
    indexer = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc").fit(train)
    staged = indexer.transform(train).withColumn("_x", array_to_vector(F.col(vec_col)))
    dim = len(staged.select(vec_col).first()[0])
    n_classes = len(indexer.labels)
    mlp = MultilayerPerceptronClassifier(layers=[dim, hidden, max(n_classes, 2)], maxIter=max_iter, tol=tol,
                                         seed=seed, featuresCol="_x", labelCol="_y", predictionCol="_p")
    return indexer, mlp.fit(staged.orderBy("doc_id"))


def score_spam(indexer, model, rows: DataFrame, vec_col: str = "vector") -> DataFrame:
    """Predicted label and the verdict text for any rows with vectors."""
    staged = rows.withColumn("_x", array_to_vector(F.col(vec_col)))
    back = IndexToString(inputCol="_p", outputCol="predicted", labels=indexer.labels)
    out = back.transform(model.transform(staged))
    return out.withColumn("verdict", F.when(F.col("predicted") == "spam", F.lit("SPAM"))
                          .otherwise(F.lit("NON-SPAM"))).drop("_x", "_p", "rawPrediction", "probability")


# ---------------------------------------------------------------- I11-I13 forest

def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_x").transform(df)


#: Bins of a feature, and rows of a partition of the canonical table, about.
FOREST_BINS, PART_ROWS = 64, 100_000
#: Trees of one part of a grown forest; rows up to which Spark's own forest is quick and its trees small enough for the driver.
FIT_TREES, ONE_FIT_ROWS = 10, 5_000

Bins = dict[str, list[float]]


def fit_bins(df: DataFrame, features: Sequence[str], bins: int = FOREST_BINS) -> Bins:
    """Inner borders of each feature's bins: exact quantiles, all features in one pass."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])).alias("f")).select("f.*")
    found: Bins = {c: [] for c in features}
    for r in group_quantiles(long, ["feature"], "value", [i / bins for i in range(1, bins)]).collect():  # bins a feature
        found[r["feature"]].append(float(r["q"]))
    return {c: sorted(set(qs)) for c, qs in found.items()}


def binned(df: DataFrame, features: Sequence[str], bins: Bins) -> DataFrame:
    """``df`` with each feature as the number of its bin; nulls fall into the first."""
    cut = [c for c in features if bins[c]]
    out = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))).alias(c) if c in features else F.col(c) for c in df.columns])
    if cut:
        splits = [[float("-inf"), *bins[c], float("inf")] for c in cut]
        out = Bucketizer(splitsArray=splits, inputCols=cut, outputCols=[f"_bin_{c}" for c in cut], handleInvalid="keep").transform(out)
    return out.select(*[(F.col(f"_bin_{c}") if c in cut else F.lit(0.0) if c in features else F.col(c)).alias(c) for c in df.columns])


def canonical(df: DataFrame, id_col: str, part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` and each row's ``forest.PLACE``, written in partitions that depend on the rows alone: by rank in the order of id (then of the other columns)."""
    ensure_checkpoint_dir(df.sparkSession)
    ranked = global_rank(df, [F.col(id_col).asc(), *[F.col(c).asc() for c in df.columns if c != id_col]], "_r")
    parts = max(1, -(-ranked.count() // part_rows))
    return (ranked.withColumn("_p", F.floor(F.col("_r") / part_rows)).repartition(parts, "_p").sortWithinPartitions("_r")
            .drop("_p").withColumnRenamed("_r", forest.PLACE).checkpoint(eager=True))


class Forest:
    """A forest of Spark ML, as the only part."""

    def __init__(self, parts: list):
        self.parts = parts


def fit_forest(train: DataFrame, features: Sequence[str], label: str = "Cluster", num_trees: int = 100,
               max_depth: int = 30, seed: int = 0, max_bins: int = FOREST_BINS) -> Forest | forest.GrownForest:
    """Random forest as the reference's defaults allow in Spark: 100 trees,
    sqrt features per split, depth capped at Spark's 30 (I11). ``train`` is canonical and binned.
    Spark ML's forest holds all its trees on the driver and sums all bins of every node, so beyond
    ``ONE_FIT_ROWS`` rows the same algorithm runs where the rows are (``forest.grow_forest``)."""
    y = F.col(label).cast("double")
    r = train.agg(F.count(F.lit(1)).alias("n"), F.max(y).alias("top"), F.count_if(y.isNull() | (y < 0) | (y > 255) | (y != F.floor(y))).alias("odd")).first()
    if r["n"] <= ONE_FIT_ROWS:
        rf = RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed, maxBins=max_bins,
                                    featuresCol="_x", labelCol="_y", rawPredictionCol="_raw0", probabilityCol="", predictionCol="",
                                    cacheNodeIds=True, maxMemoryInMB=1024)
        return Forest([rf.fit(_assembled(train, features).withColumn("_y", y))])
    if r["odd"]:
        raise ValueError(f"{label} must hold whole numbers from 0 to 255")
    return forest.grow_forest(train, features, label, r["n"], int(r["top"]) + 1, num_trees, max_depth, seed, max_bins, FIT_TREES)


def forest_predict(model: Forest | forest.GrownForest, rows: DataFrame, features: Sequence[str], label: str = "Cluster") -> DataFrame:
    """The class with most votes; the smallest of equal ones."""
    if isinstance(model, forest.GrownForest):
        return forest.predict(model, rows, features, label)
    votes = vector_to_array(F.col(model.parts[0].getRawPredictionCol()))
    out = model.parts[0].transform(_assembled(rows, features)).withColumn("_votes", votes)
    return out.select(F.col(label).alias("label"), (F.array_position("_votes", F.array_max("_votes")) - 1).cast("int").alias("prediction"))


def importances(model: Forest | forest.GrownForest, features: Sequence[str]) -> list[tuple[str, float]]:
    found = model.importances if isinstance(model, forest.GrownForest) else model.parts[0].featureImportances
    return [(f, float(found[i])) for i, f in enumerate(features)]


def importance_table(model, features: Sequence[str], spark) -> DataFrame:
    """(feature, importance), ascending as in the bar chart."""
    return spark.createDataFrame(importances(model, features), "feature string, importance double") \
        .orderBy("importance", "feature")


def rfecv(train: DataFrame, features: Sequence[str], label: str = "Cluster", id_col: str = "CUST_ID",
          folds: int = 5, num_trees: int = 100, max_depth: int = 30, seed: int = 0) -> DataFrame:
    """Recursive feature elimination with stratified k-fold cross-validation,
    balanced accuracy, one feature dropped per step (I13). Returns (feature,
    rank, selected): rank 1 = kept; higher = eliminated earlier. One binned
    table in canonical order serves every fit."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    train = train.select(id_col, label, *features).checkpoint(eager=True)
    dealt = stratified_folds(binned(train, features, fit_bins(train, features)), label, id_col, folds, seed)
    data = canonical(dealt, id_col)
    n = len(features)

    def one_fold(f: int) -> dict[int, float]:
        tr = data.filter(F.col("fold") != f)
        te = data.filter(F.col("fold") == f)
        cur, out = list(features), {}
        while cur:
            model = fit_forest(tr, cur, label, num_trees, max_depth, seed)
            out[len(cur)] = balanced_accuracy(forest_predict(model, te, cur, label))
            if len(cur) == 1:
                break
            cur.remove(min(importances(model, cur), key=lambda t: (t[1], t[0]))[0])
        return out

    def elimination_order() -> list[str]:
        """Features of all training rows, least important first (the final RFE;
        stopping it at the chosen count gives the same first steps)."""
        cur, order = list(features), []
        while len(cur) > 1:
            model = fit_forest(data, cur, label, num_trees, max_depth, seed)
            drop = min(importances(model, cur), key=lambda t: (t[1], t[0]))[0]
            order.append(drop)
            cur.remove(drop)
        return order + cur

    # the fold chains and the final chain are independent: their fits are
    # submitted as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=folds + 1) as pool:
        final = pool.submit(elimination_order)
        per_fold = list(pool.map(one_fold, range(folds)))
        order = final.result()
    scores = {m: [r[m] for r in per_fold if m in r] for m in range(1, n + 1)}
    mean = {m: sum(v) / len(v) for m, v in scores.items() if v}
    best = max(mean.values())
    n_best = min(m for m, s in mean.items() if s == best)
    # rank 1 = selected; the last feature eliminated before the cut gets 2, and so on
    n_drop = n - n_best
    ranks = {f_: (n_drop - i + 1 if i < n_drop else 1) for i, f_ in enumerate(order)}
    rows = [(f_, ranks[f_], ranks[f_] == 1, float(mean[n_best])) for f_ in features]
    return spark.createDataFrame(rows, "feature string, rank int, selected boolean, cv_score double")
