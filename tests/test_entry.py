"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_flagship(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert len(df.columns) == 30 and df.columns[0] == "id_cliente"
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()


def test_queries_and_oracle_keys():
    m = _entry_module()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50 and len(o) >= 39
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())
