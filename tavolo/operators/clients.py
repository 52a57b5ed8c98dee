"""One-row-per-client feature table (Q1; H1-H3, C1-C4, D1-D4, B9-B11).

Plan, designed for a large transaction table:

* transactions are first reduced to one row per (account, transaction type)
  with map-side partial aggregation, so a hot account shrinks to a handful of
  rows before any join or shuffle by client;
* the two transaction passes of the original (totals, and sign x account
  type) are merged into one join and one aggregate of 20 measures; that is
  exact only when the two lookup tables have unique keys, which is asserted;
* every part is an aggregate on ``id_cliente``, so the final left star over
  the client spine joins co-partitioned inputs.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavolo.operators.joins import broadcast_if_small
from tavolo.operators.pivot import assert_unique, count_when, fill_zero, left_star, sum_when

# fixed values: account type descriptions and their column suffix
ACCOUNT_TYPE_NAMES = ("Conto Base", "Conto Business", "Conto Privati", "Conto Famiglie")
# fixed values: sign symbol and its column word (out, in)
SIGNS = (("uscita", "-"), ("entrata", "+"))

DEFAULT_AS_OF = _dt.date(2024, 1, 1)
AMOUNT_TYPE = "decimal(38,2)"


def _suffix(type_name: str) -> str:
    return type_name.split()[-1].lower()


def _eq(c: Column, value: str, collation: str | None) -> Column:
    """String equality, binary by default; ``collation`` e.g. ``UTF8_LCASE``
    reproduces a case-insensitive server collation (N22)."""
    if collation:
        return F.collate(c, collation) == F.collate(F.lit(value), collation)
    return c == F.lit(value)


def client_age(cliente: DataFrame, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """``FLOOR(DATEDIFF(as_of, birth) / 365.25)`` as int."""
    return cliente.select(
        "id_cliente",
        F.floor(F.datediff(F.lit(as_of), F.col("data_nascita")) / F.lit(365.25)).cast("int").alias("eta"),
    )


def _accounts(conto: DataFrame, tipo_conto: DataFrame) -> DataFrame:
    """Account -> type description (C1); the type lookup is broadcast after a
    size check, else AQE plans the join."""
    return conto.join(broadcast_if_small(tipo_conto), "id_tipo_conto", "left").select(
        "id_conto", "id_cliente", "desc_tipo_conto")


def client_account_count(conto: DataFrame) -> DataFrame:
    """Distinct accounts per client."""
    return conto.groupBy("id_cliente").agg(
        F.count_distinct("id_conto").alias("numero_conti_posseduti"))


def _account_type_counts(types: Sequence[str], collation: str | None) -> list[Column]:
    return [count_when(_eq(F.col("desc_tipo_conto"), t, collation)).alias(f"conto_{_suffix(t)}")
            for t in types]


def client_accounts_by_type(conto: DataFrame, tipo_conto: DataFrame,
                            types: Sequence[str] = ACCOUNT_TYPE_NAMES,
                            collation: str | None = None) -> DataFrame:
    """Accounts per client and type, unmatched types count 0."""
    return _accounts(conto, tipo_conto).groupBy("id_cliente").agg(
        *_account_type_counts(types, collation))


def _accounts_summary(conto: DataFrame, tipo_conto: DataFrame, types: Sequence[str],
                      collation: str | None) -> DataFrame:
    """Distinct count and the type pivot in one aggregate over one scan."""
    return _accounts(conto, tipo_conto).groupBy("id_cliente").agg(
        F.count_distinct("id_conto").alias("numero_conti_posseduti"),
        *_account_type_counts(types, collation))


def _transactions_per_account(transazioni: DataFrame) -> DataFrame:
    """Rows and amount per (account, transaction type): the pre-aggregation."""
    return transazioni.groupBy("id_conto", "id_tipo_trans").agg(
        F.count(F.lit(1)).alias("n"), F.sum("importo").alias("amt"))


def _transactions_joined(transazioni: DataFrame, conto: DataFrame, tipo_transazione: DataFrame,
                         tipo_conto: DataFrame | None) -> DataFrame:
    """Transaction groups -> account (-> type) -> sign, all left joins."""
    acc = (_accounts(conto, tipo_conto) if tipo_conto is not None
           else conto.select("id_conto", "id_cliente"))
    tt = tipo_transazione.withColumnRenamed("id_tipo_transazione", "id_tipo_trans")
    return (_transactions_per_account(transazioni)
            .join(acc, "id_conto", "left")
            .join(broadcast_if_small(tt), "id_tipo_trans", "left"))


def _total_measures(collation: str | None) -> list[Column]:
    out = []
    for word, sign in SIGNS:
        out.append(sum_when(_eq(F.col("segno"), sign, collation), F.col("n")).cast("bigint")
                   .alias(f"transazioni_{word}_totali"))
    for word, sign in SIGNS:
        out.append(sum_when(_eq(F.col("segno"), sign, collation), F.col("amt")).cast(AMOUNT_TYPE)
                   .alias(f"importo_{word}_totale"))
    return out


def _type_measures(types: Sequence[str], collation: str | None) -> list[Column]:
    counts, amounts = [], []
    for word, sign in SIGNS:
        for t in types:
            cond = _eq(F.col("segno"), sign, collation) & _eq(F.col("desc_tipo_conto"), t, collation)
            counts.append(sum_when(cond, F.col("n")).cast("bigint")
                          .alias(f"trans_{word}_conto_{_suffix(t)}"))
            amounts.append(sum_when(cond, F.col("amt")).cast(AMOUNT_TYPE)
                           .alias(f"importo_{word}_conto_{_suffix(t)}"))
    return counts + amounts


def client_transaction_totals(transazioni: DataFrame, conto: DataFrame,
                              tipo_transazione: DataFrame, collation: str | None = None) -> DataFrame:
    """Count and amount by sign per client; amounts summed as stored."""
    j = _transactions_joined(transazioni, conto, tipo_transazione, None)
    return j.groupBy("id_cliente").agg(*_total_measures(collation))


def client_transactions_by_type(transazioni: DataFrame, conto: DataFrame, tipo_conto: DataFrame,
                                tipo_transazione: DataFrame,
                                types: Sequence[str] = ACCOUNT_TYPE_NAMES,
                                collation: str | None = None) -> DataFrame:
    """16 measures: count and amount by sign x account type."""
    j = _transactions_joined(transazioni, conto, tipo_transazione, tipo_conto)
    return j.groupBy("id_cliente").agg(*_type_measures(types, collation))


def client_features(cliente: DataFrame, conto: DataFrame, tipo_conto: DataFrame,
                    transazioni: DataFrame, tipo_transazione: DataFrame,
                    as_of: _dt.date = DEFAULT_AS_OF,
                    types: Sequence[str] = ACCOUNT_TYPE_NAMES,
                    collation: str | None = None, check_lookups: bool = True) -> DataFrame:
    """The 30-column client table, one row per client (Q1).

    ``eta`` and ``numero_conti_posseduti`` keep null for clients without a
    birth date or accounts (N17); every other measure defaults to 0.
    """
    if check_lookups:
        assert_unique(tipo_conto, "id_tipo_conto", "tipo_conto")
        assert_unique(tipo_transazione, "id_tipo_transazione", "tipo_transazione")
    accounts = _accounts_summary(conto, tipo_conto, types, collation)
    tx = (_transactions_joined(transazioni, conto, tipo_transazione, tipo_conto)
          .groupBy("id_cliente").agg(*_total_measures(collation), *_type_measures(types, collation)))
    spine = cliente.select(
        "id_cliente", "nome", "cognome", "data_nascita",
        F.floor(F.datediff(F.lit(as_of), F.col("data_nascita")) / F.lit(365.25)).cast("int").alias("eta"))
    out = left_star(spine, "id_cliente", [accounts, tx])
    zero_cols = ([f"conto_{_suffix(t)}" for t in types]
                 + [f"transazioni_{w}_totali" for w, _ in SIGNS]
                 + [f"importo_{w}_totale" for w, _ in SIGNS]
                 + [f"trans_{w}_conto_{_suffix(t)}" for w, _ in SIGNS for t in types]
                 + [f"importo_{w}_conto_{_suffix(t)}" for w, _ in SIGNS for t in types])
    out = fill_zero(out, zero_cols)
    return out.select("id_cliente", "nome", "cognome", "data_nascita", "eta",
                      "numero_conti_posseduti", *zero_cols)
