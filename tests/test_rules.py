
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tavolo.functions.parse import parse_date_strict, parse_number
from tavolo.functions.text import left_pad, normalize_name, pre_tokens, remove_digits, split_whitespace
from tavolo.functions.vectors import cosine_distance
from tavolo.operators import clients, evaluate, incidents, ledger, segments, text
from tavolo.sources.fixtures import ACCOUNT_TYPES, TRANSACTION_TYPES

INC_COLS = "date string, type string, registration string, operator string, fatalities string, " \
           "location string, country string, cat string, year string"


def inc_row(**kw):
    base = dict(date="05-SEP-2001", type="T", registration="R1", operator="op", fatalities="1",
                location="L", country="C", cat="A1", year="2001")
    base.update(kw)
    return tuple(base[c] for c in ["date", "type", "registration", "operator", "fatalities",
                                    "location", "country", "cat", "year"])


def test_n1_null_passes_sentinel_filter(spark):
    df = spark.createDataFrame([inc_row(country=None), inc_row(country="Unknown country")], INC_COLS)
    out = incidents.clean_incidents(df).collect()
    assert len(out) == 1 and out[0]["country"] is None


def test_n2_nan_token_read_as_null(spark, tmp_path):
    from tavolo.sources.tables import read_incidents_csv
    p = tmp_path / "a.csv"
    p.write_text("date,type,registration,operator,fatalities,location,country,cat,year\n"
                 "05-SEP-2001,T,NaN,op,1,L,C,A1,2001\n05-SEP-2001,T,,op,1,L,C,A1,2001\n"
                 "05-SEP-2001,T,R,op,1,L,C,A1,2001\n")
    raw = read_incidents_csv(spark, str(p))
    assert raw.filter(F.col("registration").isNull()).count() == 2
    assert incidents.clean_incidents(raw).count() == 1


def test_n4_all_null_sum_is_zero(spark):
    df = spark.createDataFrame([inc_row(operator="x", fatalities="0+2")], INC_COLS)
    out = incidents.fatalities_by(incidents.clean_incidents(df), "operator", None).collect()
    assert out[0]["fatalities"] == 0.0


def test_n5_year_without_parsed_date_counts_zero(spark):
    df = spark.createDataFrame([inc_row(date="??-JUN-1950", year="1950")], INC_COLS)
    out = incidents.incidents_per_year(incidents.clean_incidents(df)).collect()
    assert [(r["year"], r["count"]) for r in out] == [(1950, 0)]


def test_n9_number_guard(spark):
    df = spark.createDataFrame([("1d",), (" 12 ",), ("1e2",), ("abc",)], "x string")
    got = [r[0] for r in df.select(parse_number(F.col("x"))).collect()]
    assert got == [None, 12.0, 100.0, None]


def test_n10_day_digits_and_month_case(spark):
    df = spark.createDataFrame([("5-SEP-2001",), ("05-SEP-2001",), ("05-Sep-2001",)], "x string")
    got = {r[0] for r in df.select(parse_date_strict(F.col("x"))).collect()}
    assert got == {dt.date(2001, 9, 5)}


def test_n12_cutoff_day_in_neither_era(spark):
    df = spark.createDataFrame([inc_row(date="11-SEP-2001"), inc_row(date="10-SEP-2001"),
                                inc_row(date="12-SEP-2001"), inc_row(date="??-SEP-2001")], INC_COLS)
    c = incidents.clean_incidents(df)
    eras = sorted(str(r[0]) for r in c.select(incidents.era(F.col("date"))).collect())
    assert eras == ["None", "None", "after", "before"]


def test_n13_n14_top11_with_ties(spark):
    rows = [inc_row(country=f"c{i:02d}") for i in range(13) for _ in range(2 if i < 5 else 1)]
    out = incidents.top_countries(incidents.clean_incidents(spark.createDataFrame(rows, INC_COLS))).collect()
    assert len(out) == 11
    assert [r["country"] for r in out][5:] == ["c05", "c06", "c07", "c08", "c09", "c10"]


def _bank(spark):
    cliente = spark.createDataFrame(
        [(1, "a", "b", dt.date(2000, 2, 29)), (2, "c", "d", dt.date(1990, 1, 1)), (3, "e", "f", None)],
        "id_cliente long, nome string, cognome string, data_nascita date")
    conto = spark.createDataFrame([(10, 1, "1-URGENT"), (11, 1, "5-LOW"), (12, 2, "2-HIGH")],
                                  "id_conto long, id_cliente long, id_tipo_conto string")
    tc = spark.createDataFrame(ACCOUNT_TYPES, "id_tipo_conto string, desc_tipo_conto string")
    tx = spark.createDataFrame(
        [(10, "A", Decimal("5.00")), (10, "R", Decimal("2.00")), (11, "A", Decimal("7.00")),
         (12, "R", None), (99, "A", Decimal("1.00")), (10, "N", Decimal("3.00"))],
        "id_conto long, id_tipo_trans string, importo decimal(18,2)")
    tt = spark.createDataFrame(TRANSACTION_TYPES, "id_tipo_transazione string, segno string")
    return cliente, conto, tc, tx, tt


def test_n15_to_n20_client_features(spark):
    cliente, conto, tc, tx, tt = _bank(spark)
    out = {r["id_cliente"]: r for r in clients.client_features(
        cliente, conto, tc, tx, tt, as_of=dt.date(2024, 2, 28)).collect()}
    assert len(out) == 3                                   # one row per client
    assert out[3]["numero_conti_posseduti"] is None        # N17: no accounts -> null
    assert out[3]["conto_base"] == 0                       # N15
    assert out[1]["conto_base"] == 1 and out[1]["numero_conti_posseduti"] == 2
    assert out[1]["transazioni_entrata_totali"] == 2       # unknown account type still counts in totals
    assert out[1]["importo_entrata_totale"] == Decimal("12.00")
    assert out[1]["importo_entrata_conto_base"] == Decimal("5.00")
    assert out[1]["importo_uscita_totale"] == Decimal("2.00")   # N19: not negated
    assert out[2]["transazioni_uscita_totali"] == 1 and out[2]["importo_uscita_totale"] == Decimal("0")  # N18
    assert out[1]["eta"] == 23 and out[2]["eta"] == 34      # N20: floor(days / 365.25)
    assert out[3]["eta"] is None


def test_n16_orphan_transactions_form_null_group(spark):
    cliente, conto, tc, tx, tt = _bank(spark)
    t = clients.client_transaction_totals(tx, conto, tt).collect()
    assert any(r["id_cliente"] is None for r in t)


def test_n22_collation_option(spark):
    _, conto, _, _, _ = _bank(spark)
    tc = spark.createDataFrame([("1-URGENT", "conto base")], "id_tipo_conto string, desc_tipo_conto string")
    binary = clients.client_accounts_by_type(conto, tc).filter("id_cliente = 1").first()
    ci = clients.client_accounts_by_type(conto, tc, collation="UTF8_LCASE").filter("id_cliente = 1").first()
    assert binary["conto_base"] == 0 and ci["conto_base"] == 1


def test_n23_mean_vector_counts_known_words_only(spark):
    docs = spark.createDataFrame([(1, "a a zz"), (2, "zz qq"), (3, "")], "doc_id long, clean_text string")
    wv = spark.createDataFrame([("a", [1.0, 3.0])], "word string, vector array<float>")
    out = {r["doc_id"]: r for r in text.mean_vectors(docs, wv).collect()}
    assert out[1]["vector"] == [1.0, 3.0] and out[1]["n_unknown"] == 1
    assert out[2]["vector"] == [0.0, 0.0] and out[3]["vector"] == [0.0, 0.0]
    assert out[3]["n_words"] == 0


def test_n24_to_n26_cleaning_order(spark):
    docs = spark.createDataFrame([(1, "Don't 123 a1 été x ٣ The!")], "doc_id long, text string")
    lem = spark.createDataFrame([("x", "the")], "word string, lemma string")
    stop = spark.createDataFrame([("the",), ("a",)], "word string")
    out = text.clean_text(docs, lem, stop).first()["clean_text"]
    # punctuation -> space (don t), x -> the -> dropped, a1 -> a after digits (kept), digits removed last
    assert out == "don t  a été "


def test_cleaning_paths_agree(spark):
    docs = spark.createDataFrame([(1, "This was the test, 42 times!"), (2, ""), (3, "the the"), (4, None), (5, "w7x W4000 w12")],
                                 "doc_id long, text string")
    lem = spark.createDataFrame([("was", "is"), ("was", "be"), ("this", "these"), (None, "x"), ("y", None)]
                                + [(f"w{i}", f"v{i}") for i in range(5000)], "word string, lemma string")
    stop = spark.createDataFrame([("the",), ("the",), (None,), ("v12",)], "word string")
    listed = sorted(tuple(r) for r in text.clean_text(docs, lem, stop).collect())
    joined = sorted(tuple(r) for r in text.clean_text(docs, lem, stop, dictionary_rows=2000).collect())
    assert listed == joined == [(1, "these be test  times"), (2, ""), (3, ""), (4, ""), (5, "wx v")]


def test_epochs_above_the_exact_range_of_doubles(spark):
    from tavolo.operators.ledger import with_epoch

    high = 1 << 53
    events = spark.createDataFrame([(high + i, "reset" if i in (2, 5) else "add") for i in range(8)], "seq long, op string")
    want = [0, 0, 1, 1, 1, 2, 2, 2]
    assert [r["epoch"] for r in with_epoch(events).orderBy("seq").collect()] == want


def test_checkpoint_folder_is_named_on_a_cluster():
    import pytest

    from tavolo.session import private_checkpoint_dir

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        private_checkpoint_dir("spark://host:7077")


def test_equal_emails_stay_two_rows(spark, tmp_path):
    from tavolo.operators.text import mean_vectors
    from tavolo.sources.tables import read_emails_csv

    (tmp_path / "mail.csv").write_text('text,label\n"apple, pear",ham\n"apple, pear",ham\n"two\nlines",spam\n')
    mails = read_emails_csv(spark, str(tmp_path / "mail.csv"))
    assert mails.count() == 3 == mails.select("doc_id").distinct().count()
    lem = spark.createDataFrame([], "word string, lemma string")
    vec = spark.createDataFrame([("apple", [1.0, 0.0])], "word string, vector array<float>")
    clean = text.clean_text(mails, lem, lem.select("word"))
    got = sorted((r["n_words"], r["n_unknown"]) for r in mean_vectors(clean, vec).collect())
    assert got == [(2, 1), (2, 1), (2, 2)]


def test_nan_in_a_numeric_column_is_null(spark, tmp_path):
    from tavolo.sources.tables import read_cards_csv

    (tmp_path / "cards.csv").write_text("CUST_ID,BALANCE,PURCHASES\nA,NaN,1.5\nB,2,nan\nC,,N/A\n")
    rows = {r["CUST_ID"]: r for r in read_cards_csv(spark, str(tmp_path / "cards.csv")).collect()}
    assert (rows["A"]["BALANCE"], rows["A"]["PURCHASES"], rows["B"]["BALANCE"], rows["B"]["PURCHASES"]) == (None, 1.5, 2.0, None)
    assert rows["C"]["BALANCE"] is None and rows["C"]["PURCHASES"] is None


def test_quantiles_of_tied_values(spark):
    """Nine tenths of the values are equal: they are one row with a count before anything is ordered."""
    from tavolo.operators.ranking import group_quantiles
    from tavolo.operators.segments import outliers

    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "a").alias("g"),
                                    F.when(F.col("id") % 10 < 9, 0.0).otherwise(F.col("id").cast("double")).alias("v"))
    got = {(r["g"], r["p"]): r["q"] for r in group_quantiles(df, ["g"], "v", [0.0, 0.5, 0.95, 1.0]).collect()}
    for g, rest in (("a", []), (None, [i for i in range(20_000) if i % 10 == 9])):
        values = sorted([0.0] * (10_000 - len(rest)) + [float(x) for x in rest])
        for p in (0.0, 0.5, 0.95, 1.0):
            h = 9999 * p
            lo, hi = values[int(h)], values[min(9999, int(h) + 1)]
            assert abs(got[g, p] - (lo + (h - int(h)) * (hi - lo))) < 1e-6
    few = spark.createDataFrame([("x", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double")
    assert [(r["v"], r["lo"], r["hi"]) for r in outliers(few, "g", "v").collect()] == [(100.0, -1.0, 7.0)]


def test_years_by_count(spark):
    import datetime as dt

    from tavolo.operators.incidents import years_by_count

    days = [dt.date(y, 1, 1) for y, n in ((1950, 2), (1951, 3), (1952, 2), (1940, 9), (2005, 4)) for _ in range(n)]
    rows = years_by_count(spark.createDataFrame([(d,) for d in days], "date date"), "before", min_year=1946).collect()
    assert [(r["rank"], r["year"], r["count_of_incident"]) for r in rows] == [(1, 1951, 3), (2, 1950, 2), (3, 1952, 2)]


def test_whitespace_and_names(spark):
    df = spark.createDataFrame([("  Apple\t",)], "x string")
    r = df.select(normalize_name(F.col("x")).alias("n"), split_whitespace(F.col("x")).alias("w"),
                  pre_tokens(F.lit("A-b")).alias("t"), remove_digits(F.lit("a٣1")).alias("d")).first()
    assert r["n"] == "apple" and r["w"] == ["Apple"] and r["t"] == ["a", "b"] and r["d"] == "a"


def test_n32_one_row_group_has_null_std(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0, 3.0, 4.0, 5.0), (1, 1.0, 2.0, 3.0, 4.0, 5.0),
                                (1, 3.0, 2.0, 3.0, 4.0, 5.0)],
                               "Cluster int, BALANCE double, PURCHASES double, CREDIT_LIMIT double, "
                               "CASH_ADVANCE double, TENURE double")
    out = {r["Cluster"]: r for r in segments.segment_profile(df).collect()}
    assert out[0]["BALANCE_std"] is None and out[1]["BALANCE_median"] == 2.0


def test_n33_padding_never_truncates(spark):
    r = spark.range(1).select(left_pad(F.lit("a" * 20), 17).alias("x"), left_pad(F.lit("ab"), 4).alias("y")).first()
    assert r["x"] == "a" * 20 and r["y"] == "ab  "


SHOP = "seq long, op string, basket_id long, product string, quantity string, " \
       "purchase_price string, selling_price string"


def test_n34_to_n37_ledger(spark):
    ev = spark.createDataFrame([
        (1, "add", None, " Apple ", "5", "1", "2"),
        (2, "add", None, "apple", "3", "9", "9"),        # N34: prices of the first add stay
        (3, "sale", 10, "APPLE", "10", None, None),      # N35: refused, stock 8
        (4, "sale", 10, "apple", "6", None, None),       # accepted, stock 2
        (5, "sale", 11, "pear", "1", None, None),        # unknown product, basket of refusals (N36)
        (6, "reset", None, None, None, None, None),
        (7, "sale", 12, "apple", "1", None, None),       # after reset: unknown
        (8, "sale", 12, "apple", "abc", None, None),     # quarantined
        (9, "add", None, "kiwi", "0", "1", "1"),         # quarantined
    ], SHOP)
    dec = ledger.decisions(ev)
    s = {r["seq"]: r for r in ledger.sales(dec).collect()}
    assert (s[3]["accepted"], s[3]["reason"]) == (False, "insufficient stock")
    assert s[4]["accepted"] and s[4]["selling_price"] == Decimal("2.00")
    assert s[5]["reason"] == "unknown product" and s[7]["reason"] == "unknown product"
    assert s[7]["epoch"] == 1
    r = {(x["epoch"], x["basket_id"]): x for x in ledger.receipts(ledger.sales(dec)).collect()}
    assert r[(0, 10)]["gross"] == Decimal("12") and r[(0, 10)]["net"] == Decimal("6")
    assert r[(0, 11)]["gross"] == 0
    st = ledger.stock(dec).collect()
    assert [(x["product"], x["quantity"], x["purchase_price"]) for x in st] == [("apple", Decimal("2.00"), Decimal("1.00"))]
    q = {x["seq"]: x["reason"] for x in ledger.quarantine(ev).collect()}
    assert q == {8: "invalid quantity", 9: "invalid quantity"}
    prof = {x["epoch"]: x for x in ledger.profits(ledger.receipts(ledger.sales(dec)), ev).collect()}
    assert prof[0]["net_profit"] == Decimal("6") and prof[1]["is_current"] and prof[1]["gross_profit"] == 0


def test_n38_zero_vector_distance_is_one(spark):
    df = spark.createDataFrame([([0.0, 0.0], [0.0, 0.0]), ([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(cosine_distance(F.col("a"), F.col("b"))).collect()] == [1.0, 1.0]


def test_d14_never_predicted_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "label int, prediction int")
    rep = {r["label"]: r for r in evaluate.classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0 and rep["1"]["f1_score"] == 0.0
    assert rep["accuracy"]["f1_score"] == round(2 / 3, 6)


def test_j3_gazetteer_suffix_and_hook(spark):
    docs = spark.createDataFrame([(1, "acme inc bought big data co and big data"), (2, "nothing here")],
                                 "doc_id long, clean_text string")
    gaz = spark.createDataFrame([("big data",)], "name string")
    suf = spark.createDataFrame([("inc",), ("co",)], "word string")
    out = {r["doc_id"]: r["organizations"] for r in text.organizations_in(docs, gaz, suffixes=suf).collect()}
    assert out[1] == ["acme inc", "big data", "data co", "big data"] and out[2] == []
    hook = text.organizations_by_model(docs, lambda s: [[w for w in t.split() if w == "acme"] for t in s])
    assert {r["doc_id"]: r["organizations"] for r in hook.collect()}[1] == ["acme"]


def test_k7_epochs(spark):
    ev = spark.createDataFrame([(1, "add"), (2, "reset"), (3, "sale"), (4, "reset"), (5, "reset"),
                                (6, "add"), (7, "sale")], "seq long, op string")
    got = sorted(tuple(r) for r in ledger.with_epoch(ev).select("seq", "epoch").collect())
    assert got == [(1, 0), (2, 1), (3, 1), (4, 2), (5, 3), (6, 3), (7, 3)]


def test_readers(spark, tmp_path):
    from tavolo.sources.tables import (default_stopwords, read_cards_csv, read_emails_csv,
                                       read_word_vectors_text)
    (tmp_path / "e.csv").write_text('text,label\n"Hello, ""world""\nline two",ham\nbuy now,spam\n')
    e = read_emails_csv(spark, str(tmp_path / "e.csv")).orderBy("label").collect()
    assert [r["label"] for r in e] == ["ham", "spam"] and e[0]["text"] == 'Hello, "world"\nline two'
    (tmp_path / "c.csv").write_text("CUST_ID,BALANCE,TENURE\nC1,10.5,12\nC2,NA,\n")
    c = read_cards_csv(spark, str(tmp_path / "c.csv")).orderBy("CUST_ID").collect()
    assert c[0]["BALANCE"] == 10.5 and c[0]["TENURE"] == 12.0
    assert c[1]["BALANCE"] is None and c[1]["TENURE"] is None and c[0]["PURCHASES"] is None
    (tmp_path / "g.txt").write_text("the 0.5 -1.0\ncat 1 2\n")
    g = {r["word"]: r["vector"] for r in read_word_vectors_text(spark, str(tmp_path / "g.txt")).collect()}
    assert g == {"the": [0.5, -1.0], "cat": [1.0, 2.0]}
    assert default_stopwords(spark).filter(F.col("word") == "the").count() == 1
