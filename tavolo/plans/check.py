"""Run registered queries next to their DuckDB oracle and compare.

Comparison: columns sorted by name, row count, a coarse type family per
column, and an order-insensitive hash of the rows. Usage::

    python -m tavolo.plans.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import json
import sys
import time

import duckdb

from tavolo.sources.tables import DRIVER_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if v != v:
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(_norm(x)) for x in v) + "]"
    if isinstance(v, dict):
        return json.dumps({k: _norm(x) for k, x in sorted(v.items())})
    return str(v)


def _family(t: str) -> str:
    t = t.lower()
    for key, fam in (("decimal", "decimal"), ("double", "float"), ("float", "float"),
                     ("bigint", "int"), ("int", "int"), ("long", "int"), ("hugeint", "int"),
                     ("smallint", "int"), ("tinyint", "int"), ("varchar", "string"),
                     ("string", "string"), ("timestamp", "timestamp"), ("date", "date"),
                     ("bool", "bool"), ("array", "list"), ("[]", "list"), ("struct", "struct")):
        if key in t:
            return fam
    return t


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
                  "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
                  "smallint": "SMALLINT", "tinyint": "TINYINT"}


def duck_type_of(spark_type: str) -> str:
    """The DuckDB spelling of a Spark simple type string (for strict checks)."""
    if spark_type.startswith("decimal"):
        return spark_type.upper().replace(" ", "")
    if spark_type.startswith("array<") and spark_type.endswith(">"):
        return duck_type_of(spark_type[6:-1]) + "[]"
    return _SPARK_TO_DUCK.get(spark_type, spark_type.upper())


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(lines), h


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    s_cols = df.columns
    s_types = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    out = {"name": name, "rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    d_types = {c[0]: _family(str(c[1])) for c in rel.description}
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    strict_s = {f.name: duck_type_of(f.dataType.simpleString()) for f in df.schema.fields}
    strict_d = {c[0]: str(c[1]).replace(" ", "") for c in rel.description}
    strict = {c: (strict_s[c], strict_d[c]) for c in s_cols if strict_s[c] != strict_d[c]}
    if strict:
        out["strict_types"] = strict
    n1, h1 = digest(s_cols, s_rows)
    n2, h2 = digest(d_cols, d_rows)
    if n1 != n2:
        out["status"] = f"row count differs {n1} vs {n2}"
    elif h1 != h2:
        out["status"] = "hash differs"
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ls = sorted("|".join(str(_norm(r[i])) for i in order_s) for r in s_rows)
        ld = sorted("|".join(str(_norm(r[i])) for i in order_d) for r in d_rows)
        diff = [(a, b) for a, b in zip(ls, ld) if a != b][:3]
        out["example"] = diff
        out["columns"] = [s_cols[i] for i in order_s]
    else:
        out["status"] = "match"
    if bad_types:
        out["types"] = bad_types
    return out


def main(argv: list[str]) -> None:
    from tavolo.plans.oracle import ORACLE
    from tavolo.plans.registry import QUERIES
    from tavolo.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    for n in names:
        try:
            r = compare(spark, sf_dir, n, QUERIES[n], ORACLE.get(n), con)
        except Exception as e:  # report and go on with the next query
            r = {"name": n, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        print(json.dumps(r, default=str), flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
