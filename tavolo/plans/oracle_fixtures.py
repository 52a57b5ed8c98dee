"""The FIXTURES.md input views as DuckDB SQL, written independently of the
Spark derivations in ``tavolo.sources.fixtures``. Each entry is one CTE body;
``with_views`` prepends the ones a query needs (and their dependencies)."""

from __future__ import annotations

PUNCT = "[!-/:-@\\[-`{-~]"
WS = (
    "[\\t\\n\\x{0B}\\f\\r\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
)

VIEWS: dict[str, str] = {
    # ---------------------------------------------------------------- bank
    "cliente": """
        SELECT c_custkey AS id_cliente, c_name AS nome, c_mktsegment AS cognome,
               CAST(DATE '1950-01-01' + CAST(c_custkey * 17 % 18000 AS INTEGER) AS DATE) AS data_nascita
        FROM customer""",
    "conto": """
        SELECT o_orderkey AS id_conto, o_custkey AS id_cliente, o_orderpriority AS id_tipo_conto
        FROM orders""",
    "tipo_conto": """
        SELECT * FROM (VALUES ('1-URGENT', 'Conto Base'), ('2-HIGH', 'Conto Business'),
                              ('3-MEDIUM', 'Conto Privati'), ('4-NOT SPECIFIED', 'Conto Famiglie'))
               AS t(id_tipo_conto, desc_tipo_conto)""",
    "transazioni": """
        SELECT CASE WHEN l_orderkey % 10 = 7 THEN -l_orderkey ELSE l_orderkey END AS id_conto, l_returnflag AS id_tipo_trans,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS importo
        FROM lineitem""",
    "tipo_transazione": """
        SELECT * FROM (VALUES ('A', '+'), ('R', '-')) AS t(id_tipo_transazione, segno)""",
    # ---------------------------------------------------------------- accidents
    "incidents": """
        SELECT
          CASE WHEN l_orderkey % 50 = 0 THEN 'date unk.'
               WHEN l_orderkey % 50 = 1 THEN '??-JUN-1997'
               ELSE upper(strftime(day, '%d-%b-%Y')) END AS date,
          p_type AS type,
          CASE WHEN l_linenumber = 7 THEN NULL ELSE 'REG-' || CAST(l_suppkey AS VARCHAR) END AS registration,
          s_name AS operator,
          CASE WHEN l_orderkey % 40 = 3 THEN '0+2'
               ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS fatalities,
          CASE WHEN l_orderkey % 60 = 5 THEN NULL ELSE 'LOC-' || CAST(p_size AS VARCHAR) END AS location,
          CASE WHEN n_nationkey = 3 THEN NULL WHEN n_nationkey = 4 THEN 'Unknown country'
               ELSE n_name END AS country,
          p_brand AS cat,
          CASE WHEN l_orderkey % 50 = 0 THEN 'unknown'
               ELSE CAST(year(day) AS VARCHAR) END AS year
        FROM (SELECT *, CAST(CASE WHEN l_orderkey % 3 = 0 THEN CAST(l_shipdate AS DATE) + INTERVAL 96 MONTH
                                  ELSE l_shipdate END AS DATE) AS day FROM lineitem) JOIN part ON l_partkey = p_partkey
             JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey""",
    "incidents_clean": """
        SELECT d AS date, type, registration, operator,
               CASE WHEN regexp_matches(fatalities_raw, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')
                    THEN TRY_CAST(trim(fatalities_raw) AS DOUBLE) END AS fatalities,
               location, country, cat, year,
               CASE WHEN d IS NULL THEN NULL ELSE dayname(d) END AS day_of_week
        FROM (
          SELECT type, registration, operator, fatalities AS fatalities_raw,
                 location, country, cat, year,
                 CAST(try_strptime(date, '%d-%b-%Y') AS DATE) AS d
          FROM incidents
          WHERE country IS DISTINCT FROM 'Unknown country'
            AND date IS DISTINCT FROM 'date unk.'
            AND fatalities IS NOT NULL
            AND registration IS NOT NULL AND registration IS DISTINCT FROM 'NaN'
            AND operator IS NOT NULL
            AND year IS DISTINCT FROM 'unknown'
            AND location IS NOT NULL)""",
    # ---------------------------------------------------------------- emails
    "emails": """
        SELECT d.doc_id, d.text,
               CASE WHEN l.toxic = 1 OR l.quality = 0 THEN 'spam' WHEN l.quality IS NOT NULL THEN 'ham' END AS label
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "lemma_table": """
        SELECT * FROM (VALUES ('was', 'be'), ('are', 'be'), ('this', 'these')) AS t(word, lemma)""",
    "stop_table": """
        SELECT * FROM (VALUES ('the'), ('and'), ('that')) AS t(word)""",
    "email_tokens": """
        SELECT doc_id, pos, tok FROM (
          SELECT doc_id,
                 unnest(toks) AS tok,
                 unnest(range(1, len(toks) + 1)) AS pos
          FROM (SELECT doc_id,
                       list_filter(regexp_split_to_array(
                         regexp_replace(lower(text), '__PUNCT__', ' ', 'g'), '__WS__'), lambda x: x <> '') AS toks
                FROM emails))""",
    "email_clean": """
        SELECT e.doc_id, e.label, coalesce(c.clean_text, '') AS clean_text
        FROM emails e LEFT JOIN (
          SELECT doc_id,
                 regexp_replace(string_agg(lem, ' ' ORDER BY pos), '\\p{Nd}', '', 'g') AS clean_text
          FROM (SELECT t.doc_id, t.pos, coalesce(l.lemma, t.tok) AS lem
                FROM email_tokens t LEFT JOIN lemma_table l ON t.tok = l.word)
          WHERE lem NOT IN (SELECT word FROM stop_table)
          GROUP BY doc_id) c ON e.doc_id = c.doc_id""",
    "email_words": """
        SELECT doc_id, label, pos, word FROM (
          SELECT doc_id, label, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos
          FROM (SELECT doc_id, label,
                       list_filter(regexp_split_to_array(clean_text, '__WS__'), lambda x: x <> '') AS ws
                FROM email_clean))""",
    "word_vectors": """
        SELECT r.word, e.embedding AS vector
        FROM (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS rnk
              FROM (SELECT word, count(*) AS n FROM email_words WHERE length(word) >= 2 GROUP BY word)) r
        JOIN embeddings e ON e.vec_id = r.rnk""",
    "organizations": """
        SELECT gram AS name FROM (
          SELECT gram, count(*) AS n FROM (
            SELECT ws[i] || ' ' || ws[i + 1] AS gram
            FROM (SELECT ws, unnest(range(1, len(ws))) AS i
                  FROM (SELECT list_filter(regexp_split_to_array(clean_text, '__WS__'), lambda x: x <> '') AS ws
                        FROM email_clean)))
          GROUP BY gram HAVING count(*) >= 10)""",
    # ---------------------------------------------------------------- card customers
    "card_customers": """
        WITH per_order AS (
          SELECT l_orderkey,
                 sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS purchases,
                 max(CAST(l_extendedprice AS DECIMAL(18,2))) AS oneoff,
                 sum(CASE WHEN l_quantity < 10 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS installments,
                 sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS cash_advance,
                 sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS payments
          FROM lineitem GROUP BY l_orderkey),
        per_cust AS (
          SELECT o_custkey,
                 coalesce(sum(purchases), 0) AS purchases, coalesce(max(oneoff), 0) AS oneoff,
                 coalesce(sum(installments), 0) AS installments,
                 coalesce(sum(cash_advance), 0) AS cash_advance,
                 coalesce(sum(payments), 0) AS payments,
                 max(CAST(o_totalprice AS DECIMAL(18,2))) AS max_tp,
                 min(CAST(o_totalprice AS DECIMAL(18,2))) AS min_tp,
                 count(DISTINCT year(o_orderdate)) AS tenure
          FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
          GROUP BY o_custkey)
        SELECT c_custkey AS CUST_ID, c_nationkey AS NATION, c_mktsegment AS SEGMENT,
               CAST(c_acctbal AS DOUBLE) AS BALANCE,
               CAST(purchases AS DOUBLE) AS PURCHASES,
               CAST(oneoff AS DOUBLE) AS ONEOFF_PURCHASES,
               CAST(installments AS DOUBLE) AS INSTALLMENTS_PURCHASES,
               CAST(cash_advance AS DOUBLE) AS CASH_ADVANCE,
               CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE CAST(max_tp AS DOUBLE) END AS CREDIT_LIMIT,
               CAST(payments AS DOUBLE) AS PAYMENTS,
               CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE CAST(min_tp AS DOUBLE) END AS MINIMUM_PAYMENTS,
               CAST(coalesce(tenure, 0) AS DOUBLE) AS TENURE
        FROM customer LEFT JOIN per_cust ON c_custkey = o_custkey""",
    "card_clean": """
        SELECT CUST_ID, BALANCE, PURCHASES, ONEOFF_PURCHASES, INSTALLMENTS_PURCHASES, CASH_ADVANCE,
               CREDIT_LIMIT, PAYMENTS, MINIMUM_PAYMENTS
        FROM card_customers WHERE MINIMUM_PAYMENTS IS NOT NULL AND CREDIT_LIMIT IS NOT NULL""",
    # ---------------------------------------------------------------- shop events
    "shop_events": """
        SELECT event_id AS seq,
               CASE WHEN event_id % 3000 = 2999 THEN 'reset'
                    WHEN event_type = 'signup' THEN 'add'
                    WHEN event_type = 'purchase' THEN 'sale'
                    WHEN bad = 0 THEN event_type WHEN bad = 1 THEN 'add' WHEN bad = 2 THEN 'sale' END AS op,
               CAST(floor(event_id / 5) AS BIGINT) AS basket_id,
               CASE WHEN bad = 1 THEN '  ' ELSE CAST(user_id AS VARCHAR) END AS product,
               CASE WHEN bad = 2 AND event_id % 8 = 2 THEN '-3' WHEN bad = 2 THEN 'many'
                    ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS quantity,
               CAST(event_id % 50 + 1 AS VARCHAR) AS purchase_price,
               CAST((event_id % 50 + 1) * 2 AS VARCHAR) AS selling_price
        FROM (SELECT *, CASE WHEN event_id % 3000 <> 2999 AND event_type NOT IN ('signup', 'purchase')
                             THEN event_id % 4 END AS bad FROM events)""",
}

DEPENDS: dict[str, list[str]] = {
    "incidents_clean": ["incidents"],
    "email_tokens": ["emails"],
    "email_clean": ["email_tokens", "lemma_table", "stop_table", "emails"],
    "email_words": ["email_clean"],
    "word_vectors": ["email_words"],
    "organizations": ["email_clean"],
    "card_clean": ["card_customers"],
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str) -> str:
    """``WITH <views> <body>``; ``body`` may start with its own ``, x AS (...)``."""
    parts = []
    for n in _order(names):
        sql = VIEWS[n].replace("__PUNCT__", PUNCT).replace("__WS__", WS)
        parts.append(f"{n} AS ({sql})")
    body = body.replace("__PUNCT__", PUNCT).replace("__WS__", WS)
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
