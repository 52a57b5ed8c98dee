
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tavolo.operators import models, ranking, segments, topics
from tavolo.plans.registry import QUERIES
from tavolo.sources.fixtures import card_customers
from tavolo.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_global_rank_is_row_number(spark):
    rows = [(i % 7, random.Random(i).random()) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = ranking.global_rank(df, [F.col("v").desc()], "r").select("v", "r").collect()
    exp = df.select("v", (F.row_number().over(Window.orderBy(F.col("v").desc())) - 1).alias("r")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, exp))


def test_group_quantiles_equal_percentile_with_hot_group(spark):
    rnd = random.Random(1)
    rows = [("hot", rnd.random()) for _ in range(3000)] + [(f"k{i}", rnd.random()) for i in range(300)]
    rows += [("one", 5.0), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["p"]): r["q"] for r in ranking.group_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75]).collect()}
    exp = df.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.75]).alias("p")).collect()
    for r in exp:
        if r["p"] is None:
            assert not any(k[0] == r["g"] for k in got)
            continue
        for p, q in zip([0.25, 0.5, 0.75], r["p"]):
            assert abs(got[(r["g"], p)] - q) < 1e-12


def test_stratified_folds_balance(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "id long, label int")
    f = models.stratified_folds(df, "label", "id", 5).groupBy("label", "fold").count().collect()
    assert {r["count"] for r in f} == {20}


def test_pairwise_distances_bounds(spark):
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.0]), (4, [0.0, 0.0])],
                                 "id int, vector array<double>")
    d = {(r["id_i"], r["id_j"]): r["distance"] for r in topics.pairwise_distances(vecs).collect()}
    assert len(d) == 6 and d[(1, 2)] == 1.0 and d[(1, 3)] == 2.0 and d[(1, 4)] == 1.0
    assert all(0.0 <= v <= 2.0 for v in d.values())


def test_scaler_and_sse(spark):
    clean = segments.card_clean(card_customers(Tables(spark, SF)))
    scaled = segments.standardize(clean)
    stats = scaled.agg(*[F.avg(c).alias(c) for c in segments.FEATURES]).first()
    assert all(abs(stats[c]) < 1e-9 for c in segments.FEATURES)
    sse = segments.total_sse(scaled).first()["sse"]
    n = clean.count()
    assert abs(sse - n * len(segments.FEATURES)) < 1e-6


def test_model_queries_run(spark):
    var = QUERIES["card_pca_variance"](spark, SF).collect()
    assert abs(sum(r[1] for r in var) - 1.0) < 1e-5  # eight ratios to 6 places
    imp = QUERIES["forest_importances"](spark, SF).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9
    seg = QUERIES["card_segments"](spark, SF)
    assert seg.select("Cluster").distinct().count() <= 7
    top = QUERIES["spam_topics"](spark, SF).collect()
    assert len(top) == 50 and {r["rank"] for r in top} == set(range(1, 11))
    dist = QUERIES["topic_distances"](spark, SF).collect()
    assert len(dist) == 10 and all(0.0 <= r["distance"] <= 2.0 for r in dist)
    rep = QUERIES["spam_classifier_report"](spark, SF).collect()
    assert any(r["label"] == "accuracy" for r in rep)


def test_rfecv_small(spark):
    clean = segments.card_clean(card_customers(Tables(spark, SF)))
    labeled = clean.withColumn("Cluster", (F.col("BALANCE") > 5000).cast("int"))
    out = models.rfecv(labeled, segments.FEATURES, num_trees=5, max_depth=4).collect()
    assert len(out) == 8 and any(r["selected"] for r in out)
    assert "BALANCE" in {r["feature"] for r in out if r["selected"]}


def test_pairwise_distances_blocked_equals_single_block(spark):
    rnd = random.Random(3)
    vecs = spark.createDataFrame([(i, [rnd.random() - 0.5 for _ in range(4)]) for i in range(37)],
                                 "id int, vector array<double>")
    one = sorted(map(tuple, topics.pairwise_distances(vecs).collect()))
    many = sorted(map(tuple, topics.pairwise_distances(vecs, block=5).collect()))
    assert len(one) == 37 * 36 // 2 and one == many


def test_broadcast_check_falls_back(spark):
    from tavolo.operators.joins import broadcast_if_small
    small = spark.range(10)
    big = spark.range(1000)
    a = small.join(broadcast_if_small(small, 100), "id")
    b = big.join(broadcast_if_small(big, 100), "id")
    assert "broadcast" in a._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in b._jdf.queryExecution().logical().toString().lower()
    assert a.count() == 10 and b.count() == 1000


def test_incident_reports_share_one_clean(spark):
    from tavolo.operators.incidents import incident_reports
    from tavolo.sources import fixtures as fx
    t = Tables(spark, SF)
    reps = incident_reports(fx.incidents_raw(t), fx.america_countries(t))
    single = QUERIES["fatalities_by_type"](spark, SF)
    assert sorted(map(tuple, reps["fatalities_by_type"].collect())) == sorted(map(tuple, single.collect()))
    assert len(reps["by_country_top11"].collect()) <= 11
    reps["clean"].unpersist()


def test_sinks(spark, tmp_path):
    import pytest
    from pyspark.sql.utils import AnalysisException
    from tavolo.operators import ledger
    from tavolo.sources.tables import save_table_once, write_text_lines
    from tavolo.sources import fixtures as fx
    lines = ledger.catalog_lines(ledger.stock(ledger.decisions(fx.shop_events(Tables(spark, SF)))))
    out = str(tmp_path / "catalog")
    write_text_lines(lines, out)
    text = spark.read.text(out).collect()
    expected = [r["line"] for r in lines.orderBy("line_no").collect()]
    got = sorted(r[0] for r in text)
    assert got == sorted(expected) and expected[0].startswith("Product")
    name = f"tavolo_once_{tmp_path.name.replace('-', '_')}"
    df = spark.range(3)
    save_table_once(df, name)
    with pytest.raises(AnalysisException):
        save_table_once(df, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_global_cumsum_matches_window(spark):
    rnd = random.Random(5)
    rows = [("hot", i, rnd.randint(-5, 9)) for i in range(4000)] + \
           [(f"k{i % 40}", i, rnd.randint(-5, 9)) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, s long, v long")
    got = ranking.global_cumsum(df, ["k"], "s", "v", "c").select("k", "s", "c").collect()
    w = Window.partitionBy("k").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "s", F.sum("v").over(w).alias("c")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, exp))


def test_email_reports_share_one_clean(spark):
    from tavolo.operators.text import email_reports
    from tavolo.sources import fixtures as fx
    t = Tables(spark, SF)
    reps = email_reports(fx.emails(t), fx.lemmas(spark), fx.stopwords(spark), fx.word_vectors(t),
                         fx.organizations(t))
    for key, name in [("mean_vectors", "email_mean_vector"), ("spam_vocabulary", "email_vocabulary"),
                      ("ham_organizations", "ham_organizations")]:
        got = sorted(map(str, reps[key].collect()))
        exp = sorted(map(str, QUERIES[name](spark, SF).collect()))
        assert got == exp, key
    reps["clean"].unpersist()


def test_streaming_scoring_equals_batch(spark):
    from tavolo.operators.models import score_spam
    from tavolo.operators.text import clean_text, mean_vectors
    from tavolo.plans.registry import _spam_model
    from tavolo.session import scratch_path
    from tavolo.sources import fixtures as fx
    from tavolo.streaming.scoring_stream import run_scoring_stream
    t = Tables(spark, SF)
    data, indexer, model = _spam_model(spark, SF)
    test_ids = data.filter(F.col("split") == "test").select("doc_id")
    emails = fx.emails(t).join(test_ids, "doc_id").select("doc_id", "text")
    wv = fx.word_vectors(t)
    batch = score_spam(indexer, model, mean_vectors(clean_text(emails, fx.lemmas(spark), fx.stopwords(spark)), wv))
    base = scratch_path(spark, "scoring-test")
    emails.repartition(3).write.parquet(f"{base}/in")
    run_scoring_stream(spark, f"{base}/in", f"{base}/out", f"{base}/state", fx.lemmas(spark),
                       fx.stopwords(spark), wv, indexer, model)
    got = sorted(map(tuple, spark.read.parquet(f"{base}/out").select("doc_id", "verdict").collect()))
    exp = sorted(map(tuple, batch.select("doc_id", "verdict").collect()))
    assert got == exp and len(got) > 0
