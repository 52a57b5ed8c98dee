"""CSV readers: bad lines and bad values go to the quarantine, good rows stay."""

from pyspark.sql import types as T

from tavolo.sources.tables import accepted, quarantined, read_csv

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("note", T.StringType())])


def _write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_quarantine(spark, tmp_path):
    path = _write(tmp_path, "a.csv", 'id,x,note\na,1.5,"say ""hi"""\nb,NaN,NA\nshort\nc,1,2,3,4\nd,12x4,ok\n,,\ne,2,"last, one"\n')
    rows = read_csv(spark, path, SCHEMA, checked=True)
    assert rows.columns == ["id", "x", "note", "problem", "rejected"]
    good = sorted(map(tuple, accepted(rows).collect()), key=str)
    assert good == sorted([("a", 1.5, 'say "hi"'), ("b", None, None), (None, None, None), ("e", 2.0, "last, one")], key=str)
    bad = sorted(map(tuple, quarantined(rows).collect()))
    assert bad == [("bad value in x", "12x4"), ("malformed line", "c,1,2,3,4"), ("malformed line", "short")]
    # one column alone is judged like all of them
    assert sorted(str(r["id"]) for r in accepted(rows).select("id").collect()) == sorted(["a", "b", "None", "e"])


def test_without_header_and_with_line_breaks(spark, tmp_path):
    path = _write(tmp_path, "b.csv", 'a,1,"two\nlines"\nb,2,plain\nbroken\n')
    rows = read_csv(spark, path, SCHEMA, multi_line=True, header=False, checked=True)
    assert sorted(map(tuple, accepted(rows).collect())) == [("a", 1.0, "two\nlines"), ("b", 2.0, "plain")]
    assert quarantined(rows).count() == 1
    plain = read_csv(spark, path, SCHEMA, multi_line=True, header=False)
    assert plain.columns == ["id", "x", "note"] and plain.count() == 3
