"""Oracle SQL for DuckDB, one statement per registered query, over the driver
tables (pre-registered views). Written from the reference semantics, not
from the Spark code: the bank part follows the original script shape (five
separate passes, then a left star), so it also checks the merged Spark plan."""

from __future__ import annotations

from tavolo.plans.oracle_fixtures import with_views

ORACLE: dict[str, str] = {}

BANK = ["cliente", "conto", "tipo_conto", "transazioni", "tipo_transazione"]
TYPES = [("base", "Conto Base"), ("business", "Conto Business"),
         ("privati", "Conto Privati"), ("famiglie", "Conto Famiglie")]
SIGNS = [("uscita", "-"), ("entrata", "+")]


def _bank_parts() -> str:
    type_counts = ",\n".join(
        f"SUM(CASE WHEN tc.desc_tipo_conto = '{d}' THEN 1 ELSE 0 END)::BIGINT AS conto_{s}"
        for s, d in TYPES)
    totals = ",\n".join(
        [f"SUM(CASE WHEN tt.segno = '{g}' THEN 1 ELSE 0 END)::BIGINT AS transazioni_{w}_totali"
         for w, g in SIGNS]
        + [f"CAST(SUM(CASE WHEN tt.segno = '{g}' THEN t.importo ELSE 0 END) AS DECIMAL(38,2)) "
           f"AS importo_{w}_totale" for w, g in SIGNS])
    by_type = ",\n".join(
        [f"SUM(CASE WHEN tt.segno = '{g}' AND tc.desc_tipo_conto = '{d}' THEN 1 ELSE 0 END)::BIGINT "
         f"AS trans_{w}_conto_{s}" for w, g in SIGNS for s, d in TYPES]
        + [f"CAST(SUM(CASE WHEN tt.segno = '{g}' AND tc.desc_tipo_conto = '{d}' THEN t.importo ELSE 0 END) "
           f"AS DECIMAL(38,2)) AS importo_{w}_conto_{s}" for w, g in SIGNS for s, d in TYPES])
    return f""",
    temp_eta AS (
      SELECT id_cliente,
             CAST(floor(datediff('day', data_nascita, DATE '2024-01-01') / 365.25) AS INTEGER) AS eta
      FROM cliente),
    temp_numero_conti AS (
      SELECT id_cliente, COUNT(DISTINCT id_conto) AS numero_conti_posseduti
      FROM conto GROUP BY id_cliente),
    temp_conti_tipologia AS (
      SELECT co.id_cliente, {type_counts}
      FROM conto co LEFT JOIN tipo_conto tc ON co.id_tipo_conto = tc.id_tipo_conto
      GROUP BY co.id_cliente),
    temp_transazioni_totali AS (
      SELECT co.id_cliente, {totals}
      FROM transazioni t
      LEFT JOIN conto co ON t.id_conto = co.id_conto
      LEFT JOIN tipo_transazione tt ON t.id_tipo_trans = tt.id_tipo_transazione
      GROUP BY co.id_cliente),
    temp_transazioni_tipologia AS (
      SELECT co.id_cliente, {by_type}
      FROM transazioni t
      LEFT JOIN conto co ON t.id_conto = co.id_conto
      LEFT JOIN tipo_conto tc ON co.id_tipo_conto = tc.id_tipo_conto
      LEFT JOIN tipo_transazione tt ON t.id_tipo_trans = tt.id_tipo_transazione
      GROUP BY co.id_cliente)
    """


def _final_columns() -> str:
    cols = [f"conto_{s}" for s, _ in TYPES]
    cols += [f"transazioni_{w}_totali" for w, _ in SIGNS] + [f"importo_{w}_totale" for w, _ in SIGNS]
    cols += [f"trans_{w}_conto_{s}" for w, _ in SIGNS for s, _ in TYPES]
    cols += [f"importo_{w}_conto_{s}" for w, _ in SIGNS for s, _ in TYPES]
    return ",\n".join(f"IFNULL({c}, 0) AS {c}" for c in cols)


ORACLE["client_age"] = with_views(BANK, _bank_parts() + "SELECT * FROM temp_eta")
ORACLE["client_account_count"] = with_views(BANK, _bank_parts() + "SELECT * FROM temp_numero_conti")
ORACLE["client_accounts_by_type"] = with_views(BANK, _bank_parts() + "SELECT * FROM temp_conti_tipologia")
ORACLE["client_transaction_totals"] = with_views(
    BANK, _bank_parts() + "SELECT * FROM temp_transazioni_totali")
ORACLE["client_transactions_by_type"] = with_views(
    BANK, _bank_parts() + "SELECT * FROM temp_transazioni_tipologia")
ORACLE["client_features"] = with_views(BANK, _bank_parts() + f"""
    SELECT cl.id_cliente, nome, cognome, data_nascita, eta, numero_conti_posseduti,
           {_final_columns()}
    FROM cliente cl
    LEFT JOIN temp_eta tec ON cl.id_cliente = tec.id_cliente
    LEFT JOIN temp_numero_conti tnc ON cl.id_cliente = tnc.id_cliente
    LEFT JOIN temp_conti_tipologia tct ON cl.id_cliente = tct.id_cliente
    LEFT JOIN temp_transazioni_totali ttt ON cl.id_cliente = ttt.id_cliente
    LEFT JOIN temp_transazioni_tipologia tttt ON cl.id_cliente = tttt.id_cliente""")


# ---------------------------------------------------------------- accidents
INC = ["incidents"]
CLEAN = ["incidents_clean"]
_INC_COLS = ["date", "type", "registration", "operator", "fatalities", "location", "country", "cat", "year"]

ORACLE["null_profile"] = with_views(INC, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulls FROM incidents"
    for c in _INC_COLS) + ")")
ORACLE["column_profile"] = with_views(INC, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 'string' AS type, count(\"{c}\") AS non_null FROM incidents"
    for c in _INC_COLS) + ")")
ORACLE["incidents_clean"] = with_views(CLEAN, "SELECT * FROM incidents_clean")
ORACLE["incidents_per_year"] = with_views(CLEAN, """
    SELECT CAST(year AS INTEGER) AS year, count(date) AS count
    FROM incidents_clean WHERE year IS NOT NULL GROUP BY year""")
ORACLE["incidents_by_country_top11"] = with_views(CLEAN, """
    SELECT country, count(*) AS count FROM incidents_clean WHERE country IS NOT NULL
    GROUP BY country ORDER BY count DESC, country LIMIT 11""")
ORACLE["incidents_by_weekday"] = with_views(CLEAN, """
    SELECT day_of_week, count(*) AS count FROM incidents_clean WHERE day_of_week IS NOT NULL
    GROUP BY day_of_week""")
ORACLE["operators_fewest_incidents"] = with_views(CLEAN, """
    SELECT operator, count(*) AS count FROM incidents_clean WHERE operator IS NOT NULL
    GROUP BY operator ORDER BY count ASC, operator LIMIT 10""")
ORACLE["fatalities_by_operator_top10"] = with_views(CLEAN, """
    SELECT operator, coalesce(sum(fatalities), 0.0) AS fatalities FROM incidents_clean
    WHERE operator IS NOT NULL GROUP BY operator ORDER BY fatalities DESC, operator LIMIT 10""")
ORACLE["fatalities_by_type"] = with_views(CLEAN, """
    SELECT type, coalesce(sum(fatalities), 0.0) AS fatalities FROM incidents_clean
    WHERE type IS NOT NULL GROUP BY type""")
ORACLE["fatalities_by_category_top10"] = with_views(CLEAN, """
    SELECT cat, coalesce(sum(fatalities), 0.0) AS fatalities FROM incidents_clean
    WHERE cat IS NOT NULL GROUP BY cat ORDER BY fatalities DESC, cat LIMIT 10""")
ORACLE["incidents_after_by_year"] = with_views(CLEAN, """
    SELECT CAST(year(date) AS INTEGER) AS year, count(date) AS count_of_incident
    FROM incidents_clean WHERE date > DATE '2001-09-11' GROUP BY 1""")
ORACLE["incidents_before_by_count"] = with_views(CLEAN, """
    SELECT *, row_number() OVER (ORDER BY count_of_incident DESC, year) AS rank
    FROM (SELECT CAST(year(date) AS INTEGER) AS year, count(date) AS count_of_incident
          FROM incidents_clean WHERE date < DATE '2001-09-11' AND year(date) > 1946 GROUP BY 1)""")
ORACLE["incidents_after_by_date"] = with_views(CLEAN, """
    SELECT *, row_number() OVER (ORDER BY date DESC, cat NULLS LAST, country NULLS LAST, day_of_week NULLS LAST,
        fatalities NULLS LAST, location NULLS LAST, operator NULLS LAST, registration NULLS LAST, type NULLS LAST,
        year NULLS LAST) AS rank
    FROM incidents_clean WHERE date > DATE '2001-09-11'""")
ORACLE["incidents_before_by_year"] = with_views(CLEAN, """
    SELECT * FROM (SELECT CAST(year(date) AS INTEGER) AS year, count(date) AS count_of_incident
                   FROM incidents_clean WHERE date < DATE '2001-09-11' GROUP BY 1)
    WHERE year > 1946""")
_ERA = """
    SELECT era, count(*) AS years, CAST(sum(n) AS BIGINT) AS incidents, round(avg(n), 6) AS mean_incidents
    FROM (SELECT CASE WHEN date < DATE '2001-09-11' THEN 'before' ELSE 'after' END AS era,
                 year(date) AS y, count(date) AS n
          FROM incidents_clean
          WHERE date <> DATE '2001-09-11' AND date IS NOT NULL AND year(date) NOT IN (2001, 2023) {extra}
          GROUP BY 1, 2)
    GROUP BY era"""
ORACLE["mean_incidents_by_era"] = with_views(CLEAN, _ERA.format(extra=""))
ORACLE["mean_incidents_by_era_country"] = with_views(CLEAN, _ERA.format(extra="""
          AND country IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey
                          WHERE r_name = 'AMERICA')"""))


# ---------------------------------------------------------------- emails
ORACLE["email_clean"] = with_views(["email_clean"], "SELECT doc_id, label, clean_text FROM email_clean")
ORACLE["email_mean_vector"] = with_views(["email_words", "word_vectors"], """,
    dim AS (SELECT max(len(vector)) AS d FROM word_vectors),
    spine AS (SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(clean_text, '__WS__'), lambda x: x <> ''))
                                  AS BIGINT) AS n_words FROM email_clean),
    cnt AS (SELECT doc_id, word, count(*) AS cnt FROM email_words GROUP BY doc_id, word),
    known AS (SELECT c.doc_id, c.cnt, w.vector FROM cnt c JOIN word_vectors w ON c.word = w.word),
    nk AS (SELECT doc_id, sum(cnt) AS n_known FROM known GROUP BY doc_id),
    elem AS (SELECT doc_id, i, sum(cnt * CAST(v AS DOUBLE)) AS s
             FROM (SELECT doc_id, cnt, unnest(vector) AS v, generate_subscripts(vector, 1) AS i FROM known)
             GROUP BY doc_id, i),
    vec AS (SELECT e.doc_id, list(round(e.s / nk.n_known, 6) + 0.0 ORDER BY e.i) AS vector
            FROM elem e JOIN nk ON e.doc_id = nk.doc_id GROUP BY e.doc_id)
    SELECT s.doc_id, s.n_words, CAST(s.n_words - coalesce(nk.n_known, 0) AS BIGINT) AS n_unknown,
           coalesce(v.vector, list_transform(range((SELECT d FROM dim)), lambda x: 0.0)) AS vector
    FROM spine s LEFT JOIN nk ON s.doc_id = nk.doc_id LEFT JOIN vec v ON s.doc_id = v.doc_id""")
ORACLE["email_vocabulary"] = with_views(["email_words"], """
    SELECT word, term_count, doc_freq,
           row_number() OVER (ORDER BY term_count DESC, word) AS rank
    FROM (SELECT word, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_freq
          FROM (SELECT doc_id, word, count(*) AS tf FROM email_words
                WHERE label = 'spam' AND length(word) >= 2 GROUP BY doc_id, word)
          GROUP BY word HAVING count(*) >= 5
          ORDER BY term_count DESC, word LIMIT 1000)""")
ORACLE["ham_organizations"] = with_views(["email_clean", "organizations"], """,
    ham_lists AS (SELECT doc_id, list_filter(regexp_split_to_array(clean_text, '__WS__'), lambda x: x <> '') AS ws
                  FROM email_clean WHERE label = 'ham'),
    grams AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] AS gram
              FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM ham_lists)),
    hits AS (SELECT doc_id, list(gram ORDER BY i) AS orgs
             FROM grams JOIN organizations ON gram = name GROUP BY doc_id)
    SELECT h.doc_id, coalesce(hits.orgs, CAST([] AS VARCHAR[])) AS organizations
    FROM ham_lists h LEFT JOIN hits ON h.doc_id = hits.doc_id""")


# ---------------------------------------------------------------- CSV sources
# fixed values: the tokens that a pandas CSV reader turns into null
_NULLS = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', "
          "'n/a', 'nan', 'null'")


def _token(c: str, as_: str | None = None) -> str:
    return f"CASE WHEN {c} NOT IN ({_NULLS}) THEN {c} END AS {as_ or c}"


def _rejected(columns: list[str], kinds: dict[str, str], problem: str, rejected: str, table: str) -> str:
    nulls = ", ".join(f"CAST(NULL AS {kinds.get(c, 'VARCHAR')}) AS {c}" for c in columns)
    return f" UNION ALL SELECT {nulls}, '{problem}' AS problem, {rejected} AS rejected FROM {table}"


_INCIDENT_COLUMNS = ["date", "type", "registration", "operator", "fatalities", "location", "country", "cat", "year"]
ORACLE["incidents_csv"] = with_views(["incidents"], f"""
    SELECT {", ".join(map(_token, _INCIDENT_COLUMNS))}, CAST(NULL AS VARCHAR) AS problem, CAST(NULL AS VARCHAR) AS rejected FROM incidents
    """ + _rejected(_INCIDENT_COLUMNS, {}, "malformed line", "'cut off ' || s_suppkey", "supplier")
    + _rejected(_INCIDENT_COLUMNS, {}, "malformed line", "n_name || ',a,b,c,d,e,f,g,h,i,j'", "nation"))
ORACLE["emails_csv"] = with_views(["emails"], f"""
    SELECT {_token("text")}, label, CAST(NULL AS VARCHAR) AS problem, CAST(NULL AS VARCHAR) AS rejected FROM emails
    """ + _rejected(["text", "label"], {}, "malformed line", "'no label ' || n_name", "nation"))
_CARD_CSV = ["BALANCE", "PURCHASES", "ONEOFF_PURCHASES", "INSTALLMENTS_PURCHASES", "CASH_ADVANCE", "CREDIT_LIMIT", "PAYMENTS", "MINIMUM_PAYMENTS", "TENURE"]
_CARD_KINDS = {c: "DOUBLE" for c in _CARD_CSV}
ORACLE["cards_csv"] = with_views(["card_customers"], f"""
    SELECT CAST(CUST_ID AS VARCHAR) AS CUST_ID, {", ".join(_CARD_CSV)}, CAST(NULL AS VARCHAR) AS problem, CAST(NULL AS VARCHAR) AS rejected FROM card_customers
    """ + _rejected(["CUST_ID", *_CARD_CSV], _CARD_KINDS, "bad value in BALANCE", "'12x4'", "supplier")
    + _rejected(["CUST_ID", *_CARD_CSV], _CARD_KINDS, "malformed line", "'cut off ' || n_name", "nation"))

# ---------------------------------------------------------------- segments
FEATS = ["BALANCE", "PURCHASES", "ONEOFF_PURCHASES", "INSTALLMENTS_PURCHASES",
         "CASH_ADVANCE", "CREDIT_LIMIT", "PAYMENTS", "MINIMUM_PAYMENTS"]
_STATS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATS)
_SCALED = ", ".join(
    f"(c.{c} - s.m_{c}) / CASE WHEN s.s_{c} = 0 OR s.s_{c} IS NULL THEN 1 ELSE s.s_{c} END AS {c}"
    for c in FEATS)

ORACLE["card_clean"] = with_views(["card_clean"], "SELECT * FROM card_clean")
ORACLE["card_standardized"] = with_views(["card_clean"], f""",
    stats AS (SELECT {_STATS} FROM card_clean),
    scaled AS (SELECT c.CUST_ID, {_SCALED} FROM card_clean c, stats s)
    SELECT CUST_ID, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in FEATS)} FROM scaled""")
ORACLE["card_total_sse"] = with_views(["card_clean"], f""",
    stats AS (SELECT {_STATS} FROM card_clean),
    scaled AS (SELECT c.CUST_ID, {_SCALED} FROM card_clean c, stats s)
    SELECT 1 AS k, round({" + ".join(f"var_pop({c}) * count({c})" for c in FEATS)}, 4) AS sse
    FROM scaled""")

# Integers on a grid; means rounded down; the starting centres, the farthest of a sample by md5.
_GRID = 1_000_000
_STEPS = 200


def _far(a: str, b: str, n: int) -> str:
    return " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, n + 1))


def _kmeans(ks: list[int], n: int) -> str:
    """CTEs from ``points(id, x)``: the last step's ``centres(k, j, c)`` and ``assigned(id, x, k, j, d)``."""
    chosen = "chosen1 AS (SELECT 1 AS j, x FROM sample ORDER BY m, id, x LIMIT 1)"
    for j in range(2, max(ks) + 1):
        chosen += f""", chosen{j} AS (
          SELECT * FROM chosen{j - 1} UNION ALL
          SELECT {j}, x FROM (SELECT s.m, s.id, s.x, min({_far("s.x", "c.x", n)}) AS far FROM sample s, chosen{j - 1} c GROUP BY s.m, s.id, s.x
                              ORDER BY far DESC, m, id LIMIT 1) WHERE far > 0)"""
    down = ", ".join(f"CAST((s{i} - ((s{i} % n) + n) % n) // n AS BIGINT)" for i in range(1, n + 1))
    sums = ", ".join(f"sum(CAST(x[{i}] AS HUGEINT)) AS s{i}" for i in range(1, n + 1))
    nearest = f"""SELECT p.id, any_value(p.x) AS x, c.it, c.k, min(struct_pack(d := {_far("p.x", "c.c", n)}, j := c.j)) AS b
                  FROM points p, {{0}} c WHERE c.it < {{1}} GROUP BY p.id, c.it, c.k"""
    return f"""
    sample AS (SELECT md5(CAST(id AS VARCHAR)) AS m, id, x FROM points ORDER BY m, id LIMIT 100), {chosen},
    moved AS (
      WITH RECURSIVE c(it, k, j, c) AS (
        SELECT 0, k, j, x FROM chosen{max(ks)}, (SELECT unnest({list(ks)}) AS k) WHERE j <= k
        UNION ALL
        SELECT o.it + 1, o.k, o.j, CASE WHEN m.c IS NULL THEN o.c ELSE m.c END
        FROM c o LEFT JOIN (SELECT k, j, [{down}] AS c
                            FROM (SELECT k, b.j AS j, count(*) AS n, {sums} FROM ({nearest.format("c", _STEPS)}) GROUP BY k, b.j)) m
          ON o.k = m.k AND o.j = m.j
        WHERE o.it < {_STEPS})
      SELECT * FROM c),
    centres AS (SELECT * FROM moved WHERE it = {_STEPS}),
    assigned AS (SELECT id, x, k, b.j AS j, b.d AS d FROM ({nearest.format("centres", _STEPS + 1)}))"""


_ON_GRID = "[" + ", ".join(f"CAST(round({c} * {_GRID}) AS BIGINT)" for c in FEATS) + "]"
_SCALED_CTE = f""",
    stats AS (SELECT {_STATS} FROM card_clean),
    scaled AS (SELECT c.CUST_ID, {_SCALED} FROM card_clean c, stats s)"""


def _axes(k: int) -> str:
    """CTEs from ``scaled``: total variance, and ``axis1`` .. ``axisk`` (variance, v: loadings), by squaring and deflation."""
    d = len(FEATS)
    cov = ", ".join(f"CAST(n * p{min(i, j)}_{max(i, j)} - s{i} * s{j} AS DOUBLE) / (n * n)" for i in range(d) for j in range(d))
    trace = lambda m: " + ".join(f"{m}[{i * d + i + 1}]" for i in range(d))
    out = f""",
    grid AS (SELECT {_ON_GRID} AS x FROM scaled),
    sums AS (SELECT CAST(count(*) AS HUGEINT) AS n, {", ".join(f"sum(CAST(x[{i + 1}] AS HUGEINT)) AS s{i}" for i in range(d))},
                    {", ".join(f"sum(CAST(x[{i + 1}] AS HUGEINT) * x[{j + 1}]) AS p{i}_{j}" for i in range(d) for j in range(i, d))} FROM grid),
    rest1 AS (SELECT [{cov}] AS a FROM sums),
    total AS (SELECT {trace("a")} AS variance FROM rest1)"""
    for c in range(1, k + 1):
        product = f"list_transform(range({d * d}), lambda e: list_sum(list_transform(range({d}), lambda t: m[(e // {d}) * {d} + t + 1] * m[t * {d} + e % {d} + 1])))"
        out += f""",
    power{c} AS (
      WITH RECURSIVE p(step, m) AS (
        SELECT 0, list_transform(a, lambda e: e / ({trace("a")})) FROM rest{c}
        UNION ALL
        SELECT step + 1, list_transform(w, lambda e: e / ({trace("w")})) FROM (SELECT step, {product} AS w FROM p WHERE step < 40))
      SELECT m FROM p WHERE step = 40),
    axis{c} AS (
      SELECT m, variance, CASE WHEN list_extract(v, big) < 0 THEN list_transform(v, lambda e: -e) ELSE v END AS v FROM (
        SELECT *, list_position(list_transform(v, lambda e: abs(round(e, 9))), list_max(list_transform(v, lambda e: abs(round(e, 9))))) AS big FROM (
          SELECT m, variance, list_transform(range({d}), lambda r: m[r * {d} + top] / sqrt(m[(top - 1) * {d} + top])) AS v FROM (
            SELECT m, list_sum(list_transform(range({d * d}), lambda e: m[e + 1] * a[e + 1])) AS variance,
                   list_position(list_transform(range({d}), lambda r: m[r * {d} + r + 1]), list_max(list_transform(range({d}), lambda r: m[r * {d} + r + 1]))) AS top
            FROM power{c}, rest{c})))),
    rest{c + 1} AS (SELECT list_transform(range({d * d}), lambda e: a[e + 1] - variance * m[e + 1]) AS a FROM rest{c}, axis{c})"""
    return out


ORACLE["card_pca_variance"] = with_views(["card_clean"], _SCALED_CTE + _axes(8) + " " + " UNION ALL ".join(
    f"SELECT CAST({c} AS INTEGER) AS component, round(axis{c}.variance / total.variance, 6) + 0.0 AS explained_variance_ratio FROM axis{c}, total"
    for c in range(1, 9)))
ORACLE["card_elbow"] = with_views(["card_clean"], _SCALED_CTE + f""",
    points AS (SELECT CUST_ID AS id, {_ON_GRID} AS x FROM scaled),""" + _kmeans(list(range(1, 10)), 8) + f"""
    SELECT CAST(k AS INTEGER) AS k, round(CAST(sum(CAST(d AS HUGEINT)) AS DOUBLE) / {_GRID * _GRID}, 4) AS sse FROM assigned GROUP BY k""")
_SEGMENTS = _SCALED_CTE + _axes(2) + f""",
    scores AS (SELECT CUST_ID, {", ".join(" + ".join(f"{c} * axis{j}.v[{i}]" for i, c in enumerate(FEATS, start=1)) + f" AS pc{j}" for j in (1, 2))}
               FROM scaled, axis1, axis2),
    points AS (SELECT CUST_ID AS id, [{", ".join(f"CAST(round(pc{j} * {_GRID}) AS BIGINT)" for j in (1, 2))}] AS x FROM scores),""" + _kmeans([7], 2) + f""",
    numbered AS (SELECT j, CAST(row_number() OVER (ORDER BY c[1], c[2]) - 1 AS INTEGER) AS cluster FROM centres),
    card_segments AS (SELECT id AS CUST_ID, CAST(x[1] AS DOUBLE) / {_GRID} AS pc1, CAST(x[2] AS DOUBLE) / {_GRID} AS pc2, cluster AS "Cluster"
                      FROM assigned a JOIN numbered n ON a.j = n.j)"""
ORACLE["card_segments"] = with_views(["card_clean"], _SEGMENTS + " SELECT * FROM card_segments")

_PROFILE = [("BALANCE", ["mean", "median", "std", "min", "max"]), ("PURCHASES", ["mean", "median", "std"]),
            ("CREDIT_LIMIT", ["mean", "std"]), ("CASH_ADVANCE", ["mean", "sum"]), ("TENURE", ["mean", "std"])]
_FN = {"mean": "avg", "median": "quantile_cont({c}, 0.5)", "std": "stddev_samp", "min": "min",
       "max": "max", "sum": "sum"}


def _stat(c: str, s: str) -> str:
    f = _FN[s]
    expr = f.format(c=c) if "{c}" in f else f"{f}({c})"
    return f"round({expr}, 6) AS {c}_{s}"


_PROFILE_SQL = (", profile AS (SELECT NATION AS Cluster, "
                + ", ".join(_stat(c, s) for c, ss in _PROFILE for s in ss)
                + " FROM card_customers WHERE MINIMUM_PAYMENTS IS NOT NULL AND CREDIT_LIMIT IS NOT NULL"
                + " GROUP BY NATION)")
_PROFILE_NAMES = [f"{c}_{s}" for c, ss in _PROFILE for s in ss]
ORACLE["segment_profile"] = with_views(["card_customers"], _PROFILE_SQL + " SELECT * FROM profile")
ORACLE["segment_profile_clusters"] = with_views(["card_customers", "card_clean"], _SEGMENTS + """
    SELECT s."Cluster", """ + ", ".join(_stat(c, s) for c, ss in _PROFILE for s in ss) + """
    FROM card_customers c JOIN card_segments s ON c.CUST_ID = s.CUST_ID
    WHERE c.MINIMUM_PAYMENTS IS NOT NULL AND c.CREDIT_LIMIT IS NOT NULL GROUP BY s."Cluster\"""")
ORACLE["segment_box_stats_clusters"] = with_views(["card_customers", "card_clean"], _SEGMENTS + """,
    labelled AS (SELECT s."Cluster", c.BALANCE AS value FROM card_customers c JOIN card_segments s ON c.CUST_ID = s.CUST_ID
                 WHERE c.MINIMUM_PAYMENTS IS NOT NULL AND c.CREDIT_LIMIT IS NOT NULL AND c.BALANCE IS NOT NULL),
    q AS (SELECT "Cluster", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
          FROM labelled GROUP BY "Cluster"),
    f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT f."Cluster", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
           round(min(CASE WHEN e.value >= lo THEN e.value END), 6) AS lower_whisker,
           round(max(CASE WHEN e.value <= hi THEN e.value END), 6) AS upper_whisker,
           count(*) FILTER (WHERE e.value < lo OR e.value > hi) AS n_outliers, count(*) AS n
    FROM labelled e JOIN f ON e."Cluster" = f."Cluster" GROUP BY f."Cluster", q1, median, q3, iqr""")
# The groups are the 25 nation keys; a PIVOT without a value list cannot stand in a view.
ORACLE["segment_profile_transposed"] = with_views(["card_customers"], _PROFILE_SQL + ", long AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS stat, Cluster, CAST({n} AS DOUBLE) AS value FROM profile" for n in _PROFILE_NAMES)
    + ") SELECT stat, " + ", ".join(f'max(CASE WHEN Cluster = {i} THEN value END) AS "{i}"' for i in range(25))
    + " FROM long GROUP BY stat")
ORACLE["segment_box_stats"] = """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                      quantile_cont(value, 0.75) AS q3
               FROM events WHERE value IS NOT NULL GROUP BY event_type),
    f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT f.event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(iqr, 6) AS iqr,
           round(min(CASE WHEN e.value >= lo THEN e.value END), 6) AS lower_whisker,
           round(max(CASE WHEN e.value <= hi THEN e.value END), 6) AS upper_whisker,
           count(*) FILTER (WHERE e.value < lo OR e.value > hi) AS n_outliers,
           count(*) AS n
    FROM events e JOIN f ON e.event_type = f.event_type
    WHERE e.value IS NOT NULL
    GROUP BY f.event_type, q1, median, q3, iqr"""
ORACLE["train_test_split"] = with_views(["card_clean"], """
    SELECT *, CASE WHEN CAST('0x' || substr(md5(CAST(CUST_ID AS VARCHAR) || ':0'), 1, 8) AS BIGINT) % 10000 < 3000
                   THEN 'test' ELSE 'train' END AS split
    FROM card_clean""")
ORACLE["event_outliers"] = """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
               FROM events WHERE value IS NOT NULL GROUP BY event_type),
    f AS (SELECT event_type, q1 - 0.5 * (q3 - q1) AS lo, q3 + 0.5 * (q3 - q1) AS hi FROM q)
    SELECT event_id, e.event_type, value, lo, hi FROM events e JOIN f ON e.event_type = f.event_type
    WHERE value < lo OR value > hi"""
ORACLE["customer_outliers"] = with_views(["card_customers"], """,
    q AS (SELECT SEGMENT, quantile_cont(CASH_ADVANCE, 0.25) AS q1, quantile_cont(CASH_ADVANCE, 0.75) AS q3 FROM card_customers GROUP BY SEGMENT),
    f AS (SELECT SEGMENT, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT c.CUST_ID, c.SEGMENT, c.CASH_ADVANCE, round(lo, 6) AS lo, round(hi, 6) AS hi FROM card_customers c JOIN f ON c.SEGMENT = f.SEGMENT
    WHERE CASH_ADVANCE < lo OR CASH_ADVANCE > hi""")
ORACLE["stored_client_features"] = ORACLE["client_features"]
ORACLE["word_vectors_text"] = "SELECT 'word' || vec_id AS word, embedding AS vector FROM embeddings"
ORACLE["email_clean_long_lists"] = with_views(["email_tokens"], """,
    counts AS (SELECT tok AS word, count(*) AS n FROM email_tokens GROUP BY tok),
    lemma_list AS (SELECT p.word, k.word AS lemma FROM counts p JOIN counts k ON k.word = substr(p.word, 1, length(p.word) - 1)
                   WHERE p.word LIKE '%s' AND length(p.word) >= 4),
    stop_list AS (SELECT word FROM counts ORDER BY n DESC, word LIMIT 100)
    SELECT e.doc_id, e.label, coalesce(c.clean_text, '') AS clean_text
    FROM emails e LEFT JOIN (
      SELECT doc_id, regexp_replace(string_agg(lem, ' ' ORDER BY pos), '\\p{Nd}', '', 'g') AS clean_text
      FROM (SELECT t.doc_id, t.pos, coalesce(l.lemma, t.tok) AS lem FROM email_tokens t LEFT JOIN lemma_list l ON t.tok = l.word)
      WHERE lem NOT IN (SELECT word FROM stop_list) GROUP BY doc_id) c ON e.doc_id = c.doc_id""")
ORACLE["classification_report"] = """
    WITH s AS (SELECT CAST(label AS VARCHAR) AS t,
                      CAST((label + CAST(vec_id % 7 = 0 AS INTEGER)) % 10 AS VARCHAR) AS p
               FROM embeddings),
    classes AS (SELECT t AS c FROM s UNION SELECT p FROM s),
    per AS (SELECT c AS label,
                   count(*) FILTER (WHERE s.t = c AND s.p = c) AS tp,
                   count(*) FILTER (WHERE s.t = c) AS support,
                   count(*) FILTER (WHERE s.p = c) AS predicted
            FROM classes, s GROUP BY c),
    m AS (SELECT label, support, tp,
                 CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
                 CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall
          FROM per),
    m2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                          ELSE 2 * precision * recall / (precision + recall) END AS f1_score FROM m),
    allrows AS (
      SELECT label, precision, recall, f1_score, support FROM m2
      UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM m2
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM m2
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                       sum(recall * support) / sum(support), sum(f1_score * support) / sum(support),
                       sum(support) FROM m2
      UNION ALL SELECT 'balanced accuracy', NULL, avg(recall), NULL, sum(support)
                FROM m2 WHERE support > 0)
    SELECT label, round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall,
           round(f1_score, 6) + 0.0 AS f1_score, CAST(support AS BIGINT) AS support
    FROM allrows"""
ORACLE["vector_distances"] = """
    WITH elem AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m
                  FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i
                        FROM embeddings) GROUP BY label, i),
    means AS (SELECT label, list(m ORDER BY i) AS vec FROM elem GROUP BY label),
    withzero AS (SELECT * FROM means
                 UNION ALL SELECT 99, (SELECT list_transform(vec, lambda x: 0.0) FROM means LIMIT 1)),
    pairs AS (SELECT a.label AS label_i, b.label AS label_j,
                     list_dot_product(a.vec, b.vec) AS dot,
                     sqrt(list_dot_product(a.vec, a.vec)) * sqrt(list_dot_product(b.vec, b.vec)) AS nn
              FROM withzero a JOIN withzero b ON a.label < b.label)
    SELECT label_i, label_j,
           round(1.0 - CASE WHEN nn = 0 THEN 0.0 ELSE dot / nn END, 6) + 0.0 AS distance
    FROM pairs"""


# ---------------------------------------------------------------- ledger
_NUM = "'^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$'"


def _dec(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {_NUM}) THEN TRY_CAST(trim({c}) AS DECIMAL(18,2)) END"


_LEDGER = f""",
    ev AS (SELECT seq, lower(trim(op)) AS op, basket_id,
                  lower(regexp_replace(product, '^__WS__|__WS__$', '', 'g')) AS product,
                  {_dec("quantity")} AS qty, {_dec("purchase_price")} AS pp, {_dec("selling_price")} AS sp
           FROM shop_events),
    evp AS (SELECT *, CASE WHEN op IS NULL OR op NOT IN ('add', 'sale', 'reset') THEN 'unknown op'
                           WHEN op = 'reset' THEN NULL
                           WHEN product IS NULL OR product = '' THEN 'missing product'
                           WHEN qty IS NULL OR qty <= 0 THEN 'invalid quantity' END AS problem
            FROM ev),
    resets AS (SELECT DISTINCT seq FROM evp WHERE op = 'reset' AND problem IS NULL),
    live AS (SELECT e.*, (SELECT count(*) FROM resets r WHERE r.seq <= e.seq) AS epoch
             FROM evp e WHERE problem IS NULL),
    moves AS (SELECT *, row_number() OVER (PARTITION BY epoch, product ORDER BY seq) AS rn
              FROM live WHERE op IN ('add', 'sale')),
    fold AS (
      WITH RECURSIVE f(epoch, product, rn, seq, op, basket_id, qty, known, stock, cpp, csp, first_seq,
                       accepted, reason) AS (
        SELECT epoch, product, rn, seq, op, basket_id, qty,
               op = 'add' AND pp IS NOT NULL AND sp IS NOT NULL,
               CAST(CASE WHEN op = 'add' AND pp IS NOT NULL AND sp IS NOT NULL THEN qty ELSE 0 END AS DECIMAL(38,2)),
               CASE WHEN op = 'add' AND sp IS NOT NULL THEN pp END,
               CASE WHEN op = 'add' AND pp IS NOT NULL THEN sp END,
               CASE WHEN op = 'add' AND pp IS NOT NULL AND sp IS NOT NULL THEN seq END,
               op = 'add' AND pp IS NOT NULL AND sp IS NOT NULL,
               CASE WHEN op = 'add' AND (pp IS NULL OR sp IS NULL) THEN 'invalid price'
                    WHEN op = 'sale' THEN 'unknown product' END
        FROM moves WHERE rn = 1
        UNION ALL
        SELECT m.epoch, m.product, m.rn, m.seq, m.op, m.basket_id, m.qty,
               f.known OR (m.op = 'add' AND m.pp IS NOT NULL AND m.sp IS NOT NULL),
               CAST(CASE WHEN m.op = 'add' AND f.known THEN f.stock + m.qty
                         WHEN m.op = 'add' AND m.pp IS NOT NULL AND m.sp IS NOT NULL THEN m.qty
                         WHEN m.op = 'sale' AND f.known AND f.stock >= m.qty THEN f.stock - m.qty
                         ELSE f.stock END AS DECIMAL(38,2)),
               CASE WHEN f.known THEN f.cpp WHEN m.op = 'add' AND m.sp IS NOT NULL THEN m.pp END,
               CASE WHEN f.known THEN f.csp WHEN m.op = 'add' AND m.pp IS NOT NULL THEN m.sp END,
               CASE WHEN f.known THEN f.first_seq
                    WHEN m.op = 'add' AND m.pp IS NOT NULL AND m.sp IS NOT NULL THEN m.seq END,
               CASE WHEN m.op = 'add' THEN f.known OR (m.pp IS NOT NULL AND m.sp IS NOT NULL)
                    ELSE f.known AND f.stock >= m.qty END,
               CASE WHEN m.op = 'add' AND NOT f.known AND (m.pp IS NULL OR m.sp IS NULL) THEN 'invalid price'
                    WHEN m.op = 'sale' AND NOT f.known THEN 'unknown product'
                    WHEN m.op = 'sale' AND f.stock < m.qty THEN 'insufficient stock' END
        FROM f JOIN moves m ON m.epoch = f.epoch AND m.product = f.product AND m.rn = f.rn + 1)
      SELECT * FROM f),
    sale_lines AS (
      SELECT seq, epoch, basket_id, product, CAST(qty AS DECIMAL(38,2)) AS quantity, accepted, reason,
             CAST(CASE WHEN accepted THEN csp END AS DECIMAL(38,2)) AS selling_price,
             CAST(CASE WHEN accepted THEN cpp END AS DECIMAL(38,2)) AS purchase_price
      FROM fold WHERE op = 'sale'),
    receipts AS (
      SELECT epoch, basket_id,
             CAST(coalesce(sum(CASE WHEN accepted THEN quantity * selling_price END), 0) AS DECIMAL(38,4)) AS gross,
             CAST(coalesce(sum(CASE WHEN accepted THEN quantity * purchase_price END), 0) AS DECIMAL(38,4)) AS cost,
             count(*) FILTER (WHERE accepted) AS accepted_lines, count(*) AS lines
      FROM sale_lines GROUP BY epoch, basket_id),
    stock AS (
      SELECT epoch, product, stock AS quantity, CAST(cpp AS DECIMAL(38,2)) AS purchase_price,
             CAST(csp AS DECIMAL(38,2)) AS selling_price, first_seq
      FROM (SELECT *, row_number() OVER (PARTITION BY epoch, product ORDER BY seq DESC) AS k FROM fold
            WHERE first_seq IS NOT NULL) WHERE k = 1)
"""
ORACLE["ledger_quarantine"] = with_views(["shop_events"], _LEDGER + """
    SELECT seq, op, basket_id, product, problem AS reason FROM evp WHERE problem IS NOT NULL""")
ORACLE["ledger_sales"] = with_views(["shop_events"], _LEDGER + "SELECT * FROM sale_lines")
ORACLE["ledger_receipts"] = with_views(["shop_events"], _LEDGER + """
    SELECT *, CAST(gross - cost AS DECIMAL(38,4)) AS net FROM receipts""")
ORACLE["ledger_profit"] = with_views(["shop_events"], _LEDGER + """,
    epochs AS (SELECT DISTINCT epoch FROM live)
    SELECT e.epoch, CAST(coalesce(sum(r.gross), 0) AS DECIMAL(38,4)) AS gross_profit,
           CAST(coalesce(sum(r.gross - r.cost), 0) AS DECIMAL(38,4)) AS net_profit,
           e.epoch = (SELECT max(epoch) FROM epochs) AS is_current
    FROM epochs e LEFT JOIN receipts r ON e.epoch = r.epoch GROUP BY e.epoch""")
ORACLE["ledger_stock"] = with_views(["shop_events"], _LEDGER + "SELECT * FROM stock")
ORACLE["catalog_text"] = with_views(["shop_events"], _LEDGER + """,
    cur AS (SELECT * FROM stock WHERE epoch = (SELECT max(epoch) FROM stock))
    SELECT CAST(0 AS BIGINT) AS line_no,
           'Product          Quantity         Purchase Price        Selling Price' AS line
    UNION ALL
    SELECT row_number() OVER (ORDER BY first_seq) AS line_no,
           printf('%-17s %-17s %-20s %s', product, CAST(quantity AS VARCHAR), CAST(purchase_price AS VARCHAR),
                  CAST(selling_price AS VARCHAR)) AS line
    FROM cur""")
ORACLE["ledger_stream"] = ORACLE["ledger_sales"]
