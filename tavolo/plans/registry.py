"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tavolo.sources import fixtures as fx
from tavolo.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- Q1 bank

@query("client_age")
def _client_age(spark, d):
    from tavolo.operators.clients import client_age
    return client_age(fx.cliente(Tables(spark, d)))


@query("client_account_count")
def _client_account_count(spark, d):
    from tavolo.operators.clients import client_account_count
    return client_account_count(fx.conto(Tables(spark, d)))


@query("client_accounts_by_type")
def _client_accounts_by_type(spark, d):
    from tavolo.operators.clients import client_accounts_by_type
    t = Tables(spark, d)
    return client_accounts_by_type(fx.conto(t), fx.tipo_conto(spark))


@query("client_transaction_totals")
def _client_transaction_totals(spark, d):
    from tavolo.operators.clients import client_transaction_totals
    t = Tables(spark, d)
    return client_transaction_totals(fx.transazioni(t), fx.conto(t), fx.tipo_transazione(spark))


@query("client_transactions_by_type")
def _client_transactions_by_type(spark, d):
    from tavolo.operators.clients import client_transactions_by_type
    t = Tables(spark, d)
    return client_transactions_by_type(fx.transazioni(t), fx.conto(t), fx.tipo_conto(spark),
                                       fx.tipo_transazione(spark))


@query("client_features")
def _client_features(spark, d):
    from tavolo.operators.clients import client_features
    return client_features(**fx.bank(Tables(spark, d)))


@query("stored_client_features")
def _stored_client_features(spark, d):
    """The feature table registered as a view, persisted once as a catalog table and read from there."""
    import uuid
    from tavolo.operators.clients import client_features
    from tavolo.sources.tables import register_view, save_table_once
    name = f"client_features_{uuid.uuid4().hex}"
    view = register_view(client_features(**fx.bank(Tables(spark, d))), f"{name}_view")
    save_table_once(view, name)
    return spark.table(name)


# ---------------------------------------------------------------- Q2-Q6 accidents

def _clean_incidents(spark, d):
    from tavolo.operators.incidents import clean_incidents
    return clean_incidents(fx.incidents_raw(Tables(spark, d)))


@query("null_profile")
def _null_profile(spark, d):
    from tavolo.sources.tables import null_profile
    return null_profile(fx.incidents_raw(Tables(spark, d)))


@query("column_profile")
def _column_profile(spark, d):
    from tavolo.sources.tables import column_profile
    return column_profile(fx.incidents_raw(Tables(spark, d)))


@query("incidents_clean")
def _incidents_clean(spark, d):
    return _clean_incidents(spark, d)


@query("incidents_per_year")
def _incidents_per_year(spark, d):
    from tavolo.operators.incidents import incidents_per_year
    return incidents_per_year(_clean_incidents(spark, d))


@query("incidents_by_country_top11")
def _incidents_by_country(spark, d):
    from tavolo.operators.incidents import top_countries
    return top_countries(_clean_incidents(spark, d))


@query("incidents_by_weekday")
def _incidents_by_weekday(spark, d):
    from tavolo.operators.incidents import incidents_by_weekday
    return incidents_by_weekday(_clean_incidents(spark, d))


@query("operators_fewest_incidents")
def _operators_fewest(spark, d):
    from tavolo.operators.incidents import fewest_incidents
    return fewest_incidents(_clean_incidents(spark, d), "operator", 10)


@query("fatalities_by_operator_top10")
def _fatalities_operator(spark, d):
    from tavolo.operators.incidents import fatalities_by
    return fatalities_by(_clean_incidents(spark, d), "operator", 10)


@query("fatalities_by_type")
def _fatalities_type(spark, d):
    from tavolo.operators.incidents import fatalities_by
    return fatalities_by(_clean_incidents(spark, d), "type", None)


@query("fatalities_by_category_top10")
def _fatalities_category(spark, d):
    from tavolo.operators.incidents import fatalities_by
    return fatalities_by(_clean_incidents(spark, d), "cat", 10)


@query("incidents_after_by_year")
def _after_by_year(spark, d):
    from tavolo.operators.incidents import yearly_counts_in_era
    return yearly_counts_in_era(_clean_incidents(spark, d), "after")


@query("incidents_before_by_year")
def _before_by_year(spark, d):
    from tavolo.operators.incidents import yearly_counts_in_era
    return yearly_counts_in_era(_clean_incidents(spark, d), "before", min_year=1946)


@query("incidents_before_by_count")
def _before_by_count(spark, d):
    from tavolo.operators.incidents import years_by_count
    return years_by_count(_clean_incidents(spark, d), "before", min_year=1946)


@query("incidents_after_by_date")
def _after_by_date(spark, d):
    from tavolo.operators.incidents import rows_by_date
    return rows_by_date(_clean_incidents(spark, d), "after")


@query("mean_incidents_by_era")
def _mean_by_era(spark, d):
    from tavolo.operators.incidents import mean_incidents_by_era
    return mean_incidents_by_era(_clean_incidents(spark, d))


@query("mean_incidents_by_era_country")
def _mean_by_era_country(spark, d):
    from tavolo.operators.incidents import mean_incidents_by_era
    t = Tables(spark, d)
    return mean_incidents_by_era(_clean_incidents(spark, d), countries=fx.america_countries(t))


# ---------------------------------------------------------------- A1 CSV sources, with a quarantine

def _checked_csv(spark, d, write, schema, multi_line=False):
    from tavolo.session import scratch_path
    from tavolo.sources.tables import read_csv
    path = write(Tables(spark, d), scratch_path(spark, "csv"))
    return read_csv(spark, path, schema, multi_line=multi_line, header=False, checked=True)


@query("incidents_csv")
def _q_incidents_csv(spark, d):
    from tavolo.sources.tables import INCIDENT_SCHEMA
    return _checked_csv(spark, d, fx.write_incidents_csv, INCIDENT_SCHEMA)


@query("emails_csv")
def _q_emails_csv(spark, d):
    from tavolo.sources.tables import EMAIL_SCHEMA
    return _checked_csv(spark, d, fx.write_emails_csv, EMAIL_SCHEMA, multi_line=True)


@query("cards_csv")
def _q_cards_csv(spark, d):
    from pyspark.sql import types as T
    from tavolo.sources.tables import CARD_SCHEMA
    return _checked_csv(spark, d, fx.write_cards_csv, T.StructType([CARD_SCHEMA[c] for c in fx.CARD_CSV_COLUMNS]))


# ---------------------------------------------------------------- Q7-Q11 emails

@query("email_clean")
def _email_clean(spark, d):
    return fx.clean_emails(Tables(spark, d))


@query("email_clean_long_lists")
def _email_clean_long_lists(spark, d):
    """The cleaner with lists as long as the corpus gives: singulars for plurals, the most frequent words as stopwords."""
    from tavolo.operators.text import clean_text
    t = Tables(spark, d)
    lemmas, stopwords = fx.corpus_lists(t)
    return clean_text(fx.emails(t), lemmas, stopwords)


@query("word_vectors_text")
def _word_vectors_text(spark, d):
    """The embeddings as a text file of word vectors, read back (A3)."""
    from tavolo.session import scratch_path
    from tavolo.sources.tables import read_word_vectors_text
    return read_word_vectors_text(spark, fx.write_word_vectors_text(Tables(spark, d), scratch_path(spark, "vectors")))


@query("email_mean_vector")
def _email_mean_vector(spark, d):
    from tavolo.operators.text import mean_vectors
    t = Tables(spark, d)
    clean = fx.clean_emails(t).checkpoint(eager=True)  # cleaned once, read by the dictionary and the vectors
    return mean_vectors(clean, fx.word_vectors(t, clean))


@query("email_vocabulary")
def _email_vocabulary(spark, d):
    from pyspark.sql import functions as F
    from tavolo.operators.text import vocabulary
    spam = fx.clean_emails(Tables(spark, d)).filter(F.col("label") == "spam")
    return vocabulary(spam, min_df=5, max_features=1000)


@query("ham_organizations")
def _ham_organizations(spark, d):
    from pyspark.sql import functions as F
    from tavolo.operators.text import organizations_in
    t = Tables(spark, d)
    clean = fx.clean_emails(t).checkpoint(eager=True)  # cleaned once, read by the gazetteer and the search
    return organizations_in(clean.filter(F.col("label") == "ham"), fx.organizations(t, clean))


# ---------------------------------------------------------------- Q12-Q14 segments

def _card_clean(spark, d):
    from tavolo.operators.segments import card_clean
    return card_clean(fx.card_customers(Tables(spark, d)))


def _card_scaled(spark, d):
    from tavolo.operators.segments import standardize
    return standardize(_card_clean(spark, d))


@query("card_clean")
def _q_card_clean(spark, d):
    return _card_clean(spark, d)


@query("card_standardized")
def _q_card_standardized(spark, d):
    from tavolo.operators.segments import standardize
    return standardize(_card_clean(spark, d), places=6)


@query("card_total_sse")
def _q_card_total_sse(spark, d):
    from pyspark.sql import functions as F
    from tavolo.operators.segments import total_sse
    return total_sse(_card_scaled(spark, d)).select("k", F.round("sse", 4).alias("sse"))


@query("card_pca_variance")
def _q_card_pca_variance(spark, d):
    from pyspark.sql import functions as F
    from tavolo.operators.segments import pca_variance
    return pca_variance(_card_scaled(spark, d)).select(
        "component", (F.round("explained_variance_ratio", 6) + F.lit(0.0)).alias("explained_variance_ratio"))


@query("card_elbow")
def _q_card_elbow(spark, d):
    from tavolo.operators.segments import elbow
    return elbow(_card_scaled(spark, d))


@query("card_segments")
def _q_card_segments(spark, d):
    from tavolo.operators.segments import segments
    return segments(_card_scaled(spark, d))


def _profile_input(spark, d):
    from tavolo.operators.segments import drop_incomplete
    return drop_incomplete(fx.card_customers(Tables(spark, d))).withColumnRenamed("NATION", "Cluster")


@query("segment_profile")
def _q_segment_profile(spark, d):
    from tavolo.operators.segments import segment_profile
    return segment_profile(_profile_input(spark, d))


@query("segment_profile_transposed")
def _q_segment_profile_transposed(spark, d):
    from tavolo.operators.segments import segment_profile, transpose_profile
    return transpose_profile(segment_profile(_profile_input(spark, d)))


@query("segment_box_stats")
def _q_segment_box_stats(spark, d):
    from tavolo.operators.segments import box_stats
    return box_stats(Tables(spark, d).events, "event_type", "value")


@query("event_outliers")
def _q_event_outliers(spark, d):
    from tavolo.operators.segments import outliers
    return outliers(Tables(spark, d).events, "event_type", "value", whisker=0.5).select(
        "event_id", "event_type", "value", "lo", "hi")


@query("customer_outliers")
def _q_customer_outliers(spark, d):
    """Outliers at the usual 1.5 interquartile ranges, per market segment."""
    from pyspark.sql import functions as F
    from tavolo.operators.segments import outliers
    found = outliers(fx.card_customers(Tables(spark, d)), "SEGMENT", "CASH_ADVANCE")
    return found.select("CUST_ID", "SEGMENT", "CASH_ADVANCE", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query("classification_report")
def _q_classification_report(spark, d):
    from pyspark.sql import functions as F
    from tavolo.operators.evaluate import classification_report
    e = Tables(spark, d).embeddings
    scored = e.select("label", ((F.col("label") + (F.col("vec_id") % 7 == 0).cast("int")) % 10)
                      .alias("prediction"))
    return classification_report(scored)


@query("vector_distances")
def _q_vector_distances(spark, d):
    from tavolo.operators.topics import class_mean_vectors, pairwise_distances, with_zero_vector
    vecs = with_zero_vector(class_mean_vectors(Tables(spark, d).embeddings))
    return pairwise_distances(vecs, "id", "vector").withColumnRenamed(
        "id_i", "label_i").withColumnRenamed("id_j", "label_j")


# ---------------------------------------------------------------- Q15 ledger

def _decisions(spark, d):
    from tavolo.operators.ledger import decisions
    return decisions(fx.shop_events(Tables(spark, d)))


@query("ledger_quarantine")
def _q_ledger_quarantine(spark, d):
    from tavolo.operators.ledger import quarantine
    return quarantine(fx.shop_events(Tables(spark, d)))


@query("ledger_sales")
def _q_ledger_sales(spark, d):
    from tavolo.operators.ledger import sales
    return sales(_decisions(spark, d))


@query("ledger_receipts")
def _q_ledger_receipts(spark, d):
    from tavolo.operators.ledger import receipts, sales
    return receipts(sales(_decisions(spark, d)))


@query("ledger_profit")
def _q_ledger_profit(spark, d):
    from tavolo.operators.ledger import decisions, live_events, profits, receipts, sales
    live = live_events(fx.shop_events(Tables(spark, d)))
    return profits(receipts(sales(decisions(live))), live)


@query("ledger_stock")
def _q_ledger_stock(spark, d):
    from tavolo.operators.ledger import stock
    return stock(_decisions(spark, d))


@query("catalog_text")
def _q_catalog_text(spark, d):
    from tavolo.operators.ledger import catalog_lines, stock
    return catalog_lines(stock(_decisions(spark, d)))


# ---------------------------------------------------------------- Q7, Q8, Q10, Q11 models on emails

def _spam_model_and_vectors(spark, d):
    """Split mean vectors, the fitted classifier, and the word vectors, made once for all texts."""
    from pyspark.sql import functions as F
    from tavolo.operators.models import fit_spam_classifier, train_test_split
    from tavolo.operators.text import VectorShards, mean_vectors
    t = Tables(spark, d)
    clean = fx.clean_emails(t).checkpoint(eager=True)  # cleaned once, read by the dictionary and the vectors
    vectors = VectorShards(fx.word_vectors(t, clean))
    data = train_test_split(mean_vectors(clean, vectors, keep=("label",)), "doc_id", 0.2, 42).checkpoint(eager=True)
    indexer, model = fit_spam_classifier(data.filter((F.col("split") == "train") & F.col("label").isNotNull()))
    return data, indexer, model, vectors


def _spam_model(spark, d):
    return _spam_model_and_vectors(spark, d)[:3]


def _unseen(data):
    """What the classifier was not fitted on: held-out emails, and all without a label."""
    from pyspark.sql import functions as F
    return data.filter((F.col("split") == "test") | F.col("label").isNull())


@query("spam_classifier_report")
def _q_spam_report(spark, d):
    from pyspark.sql import functions as F
    from tavolo.operators.evaluate import classification_report
    from tavolo.operators.models import score_spam
    data, indexer, model = _spam_model(spark, d)
    scored = score_spam(indexer, model, data.filter((F.col("split") == "test") & F.col("label").isNotNull()))
    return classification_report(scored, "label", "predicted")


@query("spam_scores")
def _q_spam_scores(spark, d):
    from pyspark.sql import functions as F
    from tavolo.operators.models import score_spam
    data, indexer, model = _spam_model(spark, d)
    return score_spam(indexer, model, _unseen(data)).select(
        "doc_id", "label", "predicted", "verdict")


def _topics(clean):
    from pyspark.sql import functions as F
    from tavolo.operators.topics import fit_topics, topic_words
    cv_model, lda_model = fit_topics(clean.filter(F.col("label") == "spam"))
    return topic_words(cv_model, lda_model, 10)


@query("spam_topics")
def _q_spam_topics(spark, d):
    from pyspark.sql import functions as F
    return _topics(fx.clean_emails(Tables(spark, d))).withColumn("weight", F.round("weight", 6))


@query("topic_distances")
def _q_topic_distances(spark, d):
    from tavolo.operators.topics import topic_distances
    t = Tables(spark, d)
    clean = fx.clean_emails(t).checkpoint(eager=True)  # cleaned once, read by the topics and the dictionary
    return topic_distances(_topics(clean), fx.word_vectors(t, clean))


# ---------------------------------------------------------------- Q14 forest on segments

def _labeled_cards(spark, d):
    from pyspark.sql import functions as F
    from tavolo.operators.models import train_test_split
    from tavolo.operators.segments import standardize
    from tavolo.operators.segments import segments as seg
    clean = _card_clean(spark, d).checkpoint(eager=True)  # built once for the segments and the forest
    labels = seg(standardize(clean)).select("CUST_ID", "Cluster")
    data = train_test_split(clean.join(labels, "CUST_ID"), "CUST_ID", 0.3, 0).checkpoint(eager=True)
    return data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")


def _forest_tables(spark, d):
    """Training rows, binned and in canonical order, and test rows in the same bins."""
    from tavolo.operators.models import binned, canonical, fit_bins
    from tavolo.operators.segments import FEATURES
    train, test = _labeled_cards(spark, d)
    bins = fit_bins(train, FEATURES)
    return canonical(binned(train, FEATURES, bins), "CUST_ID"), binned(test, FEATURES, bins)


@query("train_test_split")
def _q_train_test_split(spark, d):
    from tavolo.operators.models import train_test_split
    return train_test_split(_card_clean(spark, d), "CUST_ID", 0.3, 0)


@query("forest_report")
def _q_forest_report(spark, d):
    from tavolo.operators.evaluate import classification_report
    from tavolo.operators.models import fit_forest, forest_predict
    from tavolo.operators.segments import FEATURES
    train, test = _forest_tables(spark, d)
    model = fit_forest(train, FEATURES)
    return classification_report(forest_predict(model, test, FEATURES))


@query("forest_importances")
def _q_forest_importances(spark, d):
    from tavolo.operators.models import fit_forest, importance_table
    from tavolo.operators.segments import FEATURES
    train, _ = _forest_tables(spark, d)
    return importance_table(fit_forest(train, FEATURES), FEATURES, spark)


@query("selected_features")
def _q_selected_features(spark, d):
    from tavolo.operators.models import rfecv
    from tavolo.operators.segments import FEATURES
    train, _ = _labeled_cards(spark, d)
    return rfecv(train, FEATURES)


# ---------------------------------------------------------------- streaming forms (L1, L2)

@query("ledger_stream")
def _q_ledger_stream(spark, d):
    """The sale decisions of the streaming ledger, read back from its sink;
    equal to ``ledger_sales`` on the same events."""
    from pyspark.sql import functions as F
    from tavolo.operators.ledger import sales
    from tavolo.session import scratch_path
    from tavolo.streaming.ledger_stream import run_ledger_stream, stage_event_files
    events = fx.shop_events(Tables(spark, d))
    base = scratch_path(spark, "ledger-stream")
    stage_event_files(events, f"{base}/in", steps=3, files=8)
    run_ledger_stream(spark, f"{base}/in", f"{base}/out", f"{base}/state", files_per_trigger=8)
    cents = lambda c: (F.col(c).cast("decimal(38,2)") / F.lit(100)).cast("decimal(38,2)")
    dec = spark.read.parquet(f"{base}/out").select(
        "seq", "epoch", "op", "basket_id", "product", cents("qty_c").alias("quantity"), "accepted", "reason",
        cents("pp_c").alias("purchase_price"), cents("sp_c").alias("selling_price"))
    return sales(dec)


@query("spam_scores_stream")
def _q_spam_scores_stream(spark, d):
    """Held-out emails scored by the streaming job (files -> foreachBatch)."""
    from pyspark.sql import functions as F
    from tavolo.session import scratch_path
    from tavolo.streaming.scoring_stream import read_scores, run_scoring_stream
    t = Tables(spark, d)
    data, indexer, model, vectors = _spam_model_and_vectors(spark, d)
    test_ids = _unseen(data).select("doc_id")
    base = scratch_path(spark, "scoring-stream")
    fx.emails(t).join(test_ids, "doc_id").select("doc_id", "text").write.parquet(f"{base}/in")
    run_scoring_stream(spark, f"{base}/in", f"{base}/out", f"{base}/state", fx.lemmas(spark),
                       fx.stopwords(spark), vectors, indexer, model)
    return read_scores(spark, f"{base}/out").drop("batch_id")


# ---------------------------------------------------------------- Q13 on the k-means segments

def _customers_with_segments(spark, d):
    from tavolo.operators.segments import drop_incomplete, segments, standardize
    customers = drop_incomplete(fx.card_customers(Tables(spark, d)))
    labels = segments(standardize(_card_clean(spark, d))).select("CUST_ID", "Cluster")
    return customers.join(labels, "CUST_ID")


@query("segment_profile_clusters")
def _q_segment_profile_clusters(spark, d):
    """The profile of the actual k-means segments (ids are arbitrary)."""
    from tavolo.operators.segments import segment_profile
    return segment_profile(_customers_with_segments(spark, d))


@query("segment_box_stats_clusters")
def _q_segment_box_stats_clusters(spark, d):
    """Box statistics of BALANCE per k-means segment."""
    from tavolo.operators.segments import box_stats
    return box_stats(_customers_with_segments(spark, d), "Cluster", "BALANCE")
