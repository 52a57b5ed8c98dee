"""Input views of FIXTURES.md, derived from the driver tables with Spark.

Each view is a lazy DataFrame over the parquet tables, so every job that uses
it grows with the data. The same derivations are written independently as
DuckDB SQL in ``tavolo.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavolo.sources.tables import Tables

# ---------------------------------------------------------------- bank (BANK)

# fixed values: account type code -> description; 5-LOW has no row on purpose
ACCOUNT_TYPES = [
    ("1-URGENT", "Conto Base"),
    ("2-HIGH", "Conto Business"),
    ("3-MEDIUM", "Conto Privati"),
    ("4-NOT SPECIFIED", "Conto Famiglie"),
]
# fixed values: transaction type code -> sign; N has no row on purpose
TRANSACTION_TYPES = [("A", "+"), ("R", "-")]

BIRTH_ORIGIN = _dt.date(1950, 1, 1)


def cliente(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        c.c_custkey.alias("id_cliente"),
        c.c_name.alias("nome"),
        c.c_mktsegment.alias("cognome"),
        F.date_add(F.lit(BIRTH_ORIGIN), (c.c_custkey * 17 % 18000).cast("int")).alias("data_nascita"),
    )


def conto(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        o.o_orderkey.alias("id_conto"),
        o.o_custkey.alias("id_cliente"),
        o.o_orderpriority.alias("id_tipo_conto"),
    )


def tipo_conto(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ACCOUNT_TYPES, "id_tipo_conto string, desc_tipo_conto string")


def transazioni(t: Tables) -> DataFrame:
    """Every line; a tenth of the orders' lines belong to accounts that do not exist."""
    li = t.lineitem
    return li.select(
        F.when(li.l_orderkey % 10 == 7, -li.l_orderkey).otherwise(li.l_orderkey).alias("id_conto"),
        li.l_returnflag.alias("id_tipo_trans"),
        li.l_extendedprice.cast("decimal(18,2)").alias("importo"),
    )


def tipo_transazione(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRANSACTION_TYPES, "id_tipo_transazione string, segno string")


def bank(t: Tables) -> dict[str, DataFrame]:
    return {
        "cliente": cliente(t),
        "conto": conto(t),
        "tipo_conto": tipo_conto(t.spark),
        "transazioni": transazioni(t),
        "tipo_transazione": tipo_transazione(t.spark),
    }


# ---------------------------------------------------------------- accidents (AVIA)

def incidents_raw(t: Tables) -> DataFrame:
    """The accident CSV as text columns, with sentinels and nulls planted."""
    li, p, s, n = t.lineitem, t.part, t.supplier, t.nation
    j = (li.join(p, li.l_partkey == p.p_partkey)
         .join(s, li.l_suppkey == s.s_suppkey)
         .join(F.broadcast(n), s.s_nationkey == n.n_nationkey))
    k50 = F.col("l_orderkey") % 50
    # a third of the ship dates lies eight years later, so both eras have full years
    day = F.col("l_shipdate").cast("date")
    day = F.when(F.col("l_orderkey") % 3 == 0, F.add_months(day, 96)).otherwise(day)
    return j.select(
        F.when(k50 == 0, F.lit("date unk."))
         .when(k50 == 1, F.lit("??-JUN-1997"))
         .otherwise(F.upper(F.date_format(day, "dd-MMM-yyyy"))).alias("date"),
        F.col("p_type").alias("type"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("REG-"), F.col("l_suppkey").cast("string"))).alias("registration"),
        F.col("s_name").alias("operator"),
        F.when(F.col("l_orderkey") % 40 == 3, F.lit("0+2"))
         .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("fatalities"),
        F.when(F.col("l_orderkey") % 60 == 5, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("LOC-"), F.col("p_size").cast("string"))).alias("location"),
        F.when(F.col("n_nationkey") == 3, F.lit(None).cast("string"))
         .when(F.col("n_nationkey") == 4, F.lit("Unknown country"))
         .otherwise(F.col("n_name")).alias("country"),
        F.col("p_brand").alias("cat"),
        F.when(k50 == 0, F.lit("unknown"))
         .otherwise(F.year(day).cast("string")).alias("year"),
    )


def america_countries(t: Tables) -> DataFrame:
    """Country names of region AMERICA (the filter of G2)."""
    return (t.nation.join(t.region, t.nation.n_regionkey == t.region.r_regionkey)
            .filter(F.col("r_name") == "AMERICA").select(F.col("n_name").alias("country")))


# ---------------------------------------------------------------- emails (SPAM)

# fixed values: the stand-in lemma pairs and stopwords of the fixture
LEMMA_PAIRS = [("was", "be"), ("are", "be"), ("this", "these")]
STOPWORDS = ["the", "and", "that"]


def emails(t: Tables) -> DataFrame:
    """Every document; the label is null where there is none."""
    from tavolo.operators.joins import broadcast_if_small
    d, lab = t.documents, broadcast_if_small(t.labels)  # few marks leave the texts where they are
    return d.join(lab, "doc_id", "left").select(
        "doc_id", "text",
        F.when((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit("spam"))
         .when(F.col("quality").isNotNull(), F.lit("ham")).alias("label"),
    )


def lemmas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEMMA_PAIRS, "word string, lemma string")


def stopwords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOPWORDS], "word string")


def clean_emails(t: Tables) -> DataFrame:
    from tavolo.operators.text import clean_text
    return clean_text(emails(t), lemmas(t.spark), stopwords(t.spark))


def corpus_lists(t: Tables, n_stop: int = 100) -> tuple[DataFrame, DataFrame]:
    """Lemmas and stopwords from the documents themselves: a word of four letters or more
    that ends in s, if it occurs without it, too; and the ``n_stop`` most frequent words."""
    from tavolo.functions.text import pre_tokens
    counts = (t.documents.select(F.explode(pre_tokens(F.col("text"))).alias("word")).groupBy("word")
              .agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True))
    plural = counts.where(F.col("word").endswith("s") & (F.length("word") >= 4)).select("word", F.expr("substring(word, 1, length(word) - 1)").alias("lemma"))
    known = counts.select(F.col("word").alias("lemma"))
    stop = counts.orderBy(F.col("n").desc(), "word").limit(n_stop).select("word")
    return plural.join(known, "lemma", "left_semi").select("word", "lemma"), stop


def write_word_vectors_text(t: Tables, folder: str) -> str:
    """``word v1 v2 ...`` lines, a word for each vector."""
    numbers = F.transform("embedding", lambda x: x.cast("string"))
    t.embeddings.select(F.concat_ws(" ", F.concat(F.lit("word"), F.col("vec_id").cast("string")), F.array_join(numbers, " ")).alias("value")).write.text(folder)
    return folder


def word_vectors(t: Tables, clean: DataFrame | None = None) -> DataFrame:
    """Cleaned email tokens (length >= 2) ranked by (count desc, word); the
    word of rank r takes the embedding with vec_id r."""
    from tavolo.operators.ranking import global_rank
    from tavolo.functions.text import split_whitespace
    toks = ((clean_emails(t) if clean is None else clean)
            .select(F.explode(split_whitespace(F.col("clean_text"))).alias("word"))
            .filter(F.length("word") >= 2)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    ranked = global_rank(toks, [F.col("n").desc(), F.col("word").asc()], "rank")
    e = t.embeddings
    return ranked.join(e, ranked["rank"] == e["vec_id"]).select(
        "word", F.col("embedding").alias("vector"))


def organizations(t: Tables, clean: DataFrame | None = None, min_count: int = 10) -> DataFrame:
    """Gazetteer: every two-word string that stands ``min_count`` times in the
    cleaned documents of all languages."""
    from tavolo.operators.ngrams import bucket_bits, frequent_ngrams
    from tavolo.operators.text import words
    clean = clean_emails(t) if clean is None else clean
    chars = clean.agg(F.sum(F.length("clean_text"))).first()[0] or 0
    return frequent_ngrams(clean, words(clean), 2, min_count, bucket_bits(chars / 4)).select("name")


# ---------------------------------------------------------------- card customers (CARD)

def card_customers(t: Tables) -> DataFrame:
    """One row per customer; line measures are aggregated per order first,
    so the order-line fan-out never reaches the customer join."""
    li, o, c = t.lineitem, t.orders, t.customer
    price = li.l_extendedprice.cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(price).alias("purchases"),
        F.max(price).alias("oneoff"),
        F.sum(F.when(li.l_quantity < 10, price).otherwise(zero)).alias("installments"),
        F.sum(F.when(li.l_returnflag == "R", price).otherwise(zero)).alias("cash_advance"),
        F.sum(F.when(li.l_linestatus == "F", price).otherwise(zero)).alias("payments"),
    )
    orders = o.select("o_orderkey", "o_custkey", o.o_totalprice.cast("decimal(18,2)").alias("tp"),
                      F.year("o_orderdate").alias("oy"))
    per_cust = (orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
                .groupBy("o_custkey").agg(
                    F.coalesce(F.sum("purchases"), zero).alias("purchases"),
                    F.coalesce(F.max("oneoff"), zero).alias("oneoff"),
                    F.coalesce(F.sum("installments"), zero).alias("installments"),
                    F.coalesce(F.sum("cash_advance"), zero).alias("cash_advance"),
                    F.coalesce(F.sum("payments"), zero).alias("payments"),
                    F.max("tp").alias("max_tp"),
                    F.min("tp").alias("min_tp"),
                    F.count_distinct("oy").alias("tenure"),
                ))
    j = c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
    dbl = lambda x: x.cast("double")
    return j.select(
        F.col("c_custkey").alias("CUST_ID"),
        F.col("c_nationkey").alias("NATION"),
        F.col("c_mktsegment").alias("SEGMENT"),
        dbl(F.col("c_acctbal")).alias("BALANCE"),
        dbl(F.col("purchases")).alias("PURCHASES"),
        dbl(F.col("oneoff")).alias("ONEOFF_PURCHASES"),
        dbl(F.col("installments")).alias("INSTALLMENTS_PURCHASES"),
        dbl(F.col("cash_advance")).alias("CASH_ADVANCE"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("double"))
         .otherwise(dbl(F.col("max_tp"))).alias("CREDIT_LIMIT"),
        dbl(F.col("payments")).alias("PAYMENTS"),
        F.when(F.col("c_custkey") % 33 == 0, F.lit(None).cast("double"))
         .otherwise(dbl(F.col("min_tp"))).alias("MINIMUM_PAYMENTS"),
        dbl(F.coalesce(F.col("tenure"), F.lit(0))).alias("TENURE"),
    )


# ---------------------------------------------------------------- CSV files (A1)

CARD_CSV_COLUMNS = ("CUST_ID", "BALANCE", "PURCHASES", "ONEOFF_PURCHASES", "INSTALLMENTS_PURCHASES", "CASH_ADVANCE",
                    "CREDIT_LIMIT", "PAYMENTS", "MINIMUM_PAYMENTS", "TENURE")
_CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _csv_lines(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(F.to_csv(F.struct(*columns), _CSV_OPTIONS).alias("value"))


def _write_lines(lines: DataFrame, planted: DataFrame, folder: str) -> str:
    lines.unionByName(planted).write.text(folder)
    return folder


def write_incidents_csv(t: Tables, folder: str) -> str:
    """The accident table as CSV lines, and by it one line of a single field for every
    supplier and one of too many fields for every nation."""
    short = t.supplier.select(F.concat(F.lit("cut off "), F.col("s_suppkey").cast("string")).alias("value"))
    long = t.nation.select(F.concat(F.col("n_name"), F.lit(",a,b,c,d,e,f,g,h,i,j")).alias("value"))
    columns = ["date", "type", "registration", "operator", "fatalities", "location", "country", "cat", "year"]
    return _write_lines(_csv_lines(incidents_raw(t), columns), short.unionByName(long), folder)


def write_emails_csv(t: Tables, folder: str) -> str:
    """The emails as CSV records with line breaks inside quotes, and a line of one field for every nation."""
    return _write_lines(_csv_lines(emails(t), ["text", "label"]), t.nation.select(F.concat(F.lit("no label "), "n_name").alias("value")), folder)


def write_cards_csv(t: Tables, folder: str) -> str:
    """The card customers as CSV lines, a line with a text for a number for every supplier, and a
    line of one field for every nation."""
    text = t.supplier.select(F.concat(F.lit("bad-"), F.col("s_suppkey").cast("string"), F.lit(",12x4,1,1,1,1,1,1,1,1")).alias("value"))
    short = t.nation.select(F.concat(F.lit("cut off "), "n_name").alias("value"))
    return _write_lines(_csv_lines(card_customers(t), list(CARD_CSV_COLUMNS)), text.unionByName(short), folder)


# ---------------------------------------------------------------- shop events (SHOP)

SHOP_EVENT_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("basket_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("purchase_price", T.StringType()),
    T.StructField("selling_price", T.StringType()),
])


def shop_events(t: Tables) -> DataFrame:
    """Register commands as an event table: signup = add, purchase = sale,
    every 3000th event a reset; quantities and prices arrive as text. The other
    event types are bad commands: an unknown or missing op, a blank product, a
    quantity that is no positive number."""
    e = t.events
    is_reset = e.event_id % 3000 == 2999
    bad = F.when(~is_reset & ~e.event_type.isin("signup", "purchase"), e.event_id % 4)
    op = (F.when(is_reset, F.lit("reset"))
          .when(e.event_type == "signup", F.lit("add"))
          .when(e.event_type == "purchase", F.lit("sale"))
          .when(bad == 0, e.event_type).when(bad == 1, F.lit("add")).when(bad == 2, F.lit("sale")))
    pp = e.event_id % 50 + 1
    return (e.select(
        e.event_id.alias("seq"),
        op.alias("op"),
        F.floor(e.event_id / 5).cast("bigint").alias("basket_id"),
        F.when(bad == 1, F.lit("  ")).otherwise(e.user_id.cast("string")).alias("product"),
        F.when((bad == 2) & (e.event_id % 8 == 2), F.lit("-3")).when(bad == 2, F.lit("many"))
         .otherwise(F.round(e.value * 100).cast("bigint").cast("string")).alias("quantity"),
        pp.cast("string").alias("purchase_price"),
        (pp * 2).cast("string").alias("selling_price"),
    ))
