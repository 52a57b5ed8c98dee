"""Personal data: base patterns against plain regular expressions, disclosure on planted terms."""

import hashlib
import random
import re
import time

from tavolo.llm import pii as P


def _plain(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_spans():
    rng = random.Random(5)
    for letters in ("ab1.@-+%_ é", "0123. ", "12 -+().", "a@.", "01.+-( )9@x"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
            assert [s[:3] for s in P.base_spans(text)] == _plain(text), text


def test_long_texts_take_linear_time():
    began = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "+1" * 150_000, "a." * 100_000 + "@", "a@" * 100_000, "a@b" * 100_000, "1 " * 150_000):
        P.mentions(text, P.base_spans(text))
    assert time.time() - began < 20


def test_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = P.op6_pii_disclosure(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = _plain(texts[r["doc_id"]])
        joined = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(",")) and (want or r["spans"] == "")


def test_terms_that_reveal_an_entity(spark):
    rows = [(i, f"alpha{i} beta contact Giovanna{'' if i % 2 else ','} at gio@x.org for w{i} z{i * 7}", 0.1) for i in range(10)]
    rows += [(50 + i, "the same copy Copyname copy@x.org of one text", 0.1) for i in range(10)]  # copies prove nothing
    rows += [(100 + i, f"plain text number {i} with contact at home and beta", 0.1) for i in range(300)]
    rows += [(500, None, 0.1), (None, "x gio@x.org", 0.1), (501, "", 0.1), (0, rows[0][1], 0.1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, base_spans double")
    got = P.sanitise(df).collect()
    assert len(got) == len(rows)
    texts = {r["doc_id"]: r["text"] for r in got}
    assert "Giovanna" not in texts[3] and "contact" in texts[3] and "beta" in texts[3] and "<email>" in texts[3]
    assert "Copyname" in texts[55] and "<email>" in texts[55] and texts[100] == rows[20][1] and texts[500] is None and texts[501] == ""
    assert texts[None] == "x <email>"


def test_disclosure_values(spark):
    """Counts and thresholds by hand, over all documents."""
    rows = [(i, f"q{i} Marta m@x.org r{i}") for i in range(4)] + [(9 + i, "Marta alone here") for i in range(4)] + [(20 + i, f"other {i}") for i in range(56)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # N 64, n(e) 4, n(t) 8, n(e, t) 4: IC 4 bits, PMI log2(64 * 4 / 32) = 3 bits
    for at, marked in ((0.75, True), (0.76, False)):
        kinds = {s["kind"] for r in P.find_personal_data(df, generalise_at=at, remove_at=2.0).where("doc_id = 1").collect() for s in r["all_spans"]}
        assert kinds == ({0, P.KINDS.index("generalised")} if marked else {0})
    assert P.general_form("Marta") == "<name>" and P.general_form("b12") == "<number>" and P.general_form("word") == "<word>"


def test_lone_mentions_count(spark):
    """A document that holds the entity and no usable term counts for n(e)."""
    rows = [(i, f"q{i} Marta m@x.org r{i}") for i in range(4)] + [(9 + i, "Marta alone here") for i in range(4)]
    rows += [(20 + i, "m@x.org") for i in range(4)] + [(30 + i, f"other {i}") for i in range(52)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # N 64, n(e) 8, n(t) 8, n(e, t) 4: IC 3 bits, PMI 2 bits
    for at, marked in ((0.66, True), (0.67, False)):
        kinds = {s["kind"] for r in P.find_personal_data(df, generalise_at=at, remove_at=2.0).where("doc_id = 1").collect() for s in r["all_spans"]}
        assert kinds == ({0, P.KINDS.index("generalised")} if marked else {0})


def test_terms_far_from_the_mention(spark):
    """A name in the heading and the address 30 words on: counted, and marked at both places of each document."""
    def filler(i, k):
        return " ".join(f"x{i}y{k}z{j}" for j in range(30))

    rows = [(i, f"Marta heading {filler(i, 0)} m@x.org {filler(i, 1)} signed Marta.") for i in range(4)]
    rows += [(9, "Marta alone here")] + [(10 + i, f"Copyname {filler(99, 0)} c@x.org") for i in range(4)]  # copies prove nothing
    rows += [(20 + i, f"other {i} heading signed") for i in range(55)]
    got = {r["doc_id"]: r["text"] for r in P.sanitise(spark.createDataFrame(rows, "doc_id long, text string"), generalise_at=0.9, remove_at=2.0).collect()}
    for i in range(4):
        assert got[i] == f"<name> heading {filler(i, 0)} <email> {filler(i, 1)} signed <name>."
    assert got[9] == "Marta alone here" and got[10].startswith("Copyname ") and got[20] == "other 0 heading signed"


def test_terms_of():
    text = "mail:a@b.org,foo (Bar) a@b.org"
    assert list(P.terms_of(text, [(s[0], s[2]) for s in P.base_spans(text)])) == [("mail", 0, 4), ("foo", 13, 16), ("bar", 18, 21)]


def test_empty_and_clashing(spark, clashing, nothing):
    assert P.find_personal_data(clashing).count() == clashing.count() and P.find_personal_data(nothing).count() == 0
