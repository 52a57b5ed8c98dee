"""Line dedup by winnowing: later copies of repeated line runs go.

A document is its sequence of lines with a word; a *window* is the shortest
run of lines from some line on, or up to some line, that holds at least
``min_words`` words. Every window selects its smallest line hash, the leftmost
of equal ones, as a fingerprint. A window's choice depends on its own lines
alone, so a passage of ``min_words`` words or more that two places share has a
common fingerprint in both: the guarantee of winnowing, with windows measured in
words, so that one long line and several short ones count alike.

The selected positions are joined on the fingerprint with its first position, in
the order of document id and line, and the match is extended both ways, line by
line, as far as the lines agree and the windows that selected the position
reach (a neighbouring fingerprint's windows go on from there). An extended match of
``min_words`` words or more is a later copy, and all its lines are deleted.
Windows of a position that disagree with the first one may still agree with
another earlier position, where the same line stands in other surroundings: these alone
are compared by hashes of all their lines, and every one but the first
of its kind is a later copy, too. Copies meet a first one as one row each; no
pairs within a group are made. The first occurrence of a line is never deleted.

The result equals the plain definition: delete each line that lies in a run of
at least ``min_words`` words which also starts at an earlier place. Let such a
run be [a, b] and j a line of it: if [a, j] holds ``min_words`` words, the window
up to j lies in it, else the window from a on reaches over j, and both recur
where the run does. Either the first position of such a window's fingerprint
has the window around it, and the extension covers it, or none of the positions
whose window it is was covered, and their windows meet. Blank lines between two lines of a
run lie in such a window too, except between two lines that are windows alone:
these also count as a pair.

Defined results: null text stays null; empty and blank lines belong to no
window, and go with the lines around them when they lie inside a deleted run;
lines are compared exactly (by 96 bits of hashes); rows with equal id and text
are one document, reduced to one before anything else meets and treated alike;
rows with equal id and different text are ordered by text hash; null ids come
last. An empty table gives an empty result. Input columns whose names the output
uses are replaced; any other names may occur.

Everything here is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavolo.llm.shared import table, without, word_count, written

#: Words of a passage from which it counts as repeated.
MIN_WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def worded_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, th, line, words, h, g): the lines with a word, of each different (id, text) once."""
    named = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    lines = (named.select("id", F.xxhash64("text").alias("th"), F.posexplode(_lines(F.col("text"))).alias("line", "content"))
             .withColumn("words", word_count(F.col("content"))).where("words > 0")
             .select("id", "th", "line", "words", F.xxhash64("content").alias("h"), F.hash("content", "words").alias("g")))
    # Repeated rows fall together line by line, so none of them makes a large group.
    return lines.groupBy("id", "th", "line").agg(F.min("words").alias("words"), F.min("h").alias("h"), F.min("g").alias("g"))


def selected(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per selected position: id, th, line, fp, the lines on both sides and the windows that selected it.

    ``left`` and ``right`` begin with the line itself and go outwards as far as
    its windows reach; a window is (before, after) lines around it, with its hashes.
    """
    document = Window.partitionBy("id", "th")
    in_order = document.orderBy("line")
    lines = lines.withColumn("at", F.coalesce(F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    lines = lines.withColumn("until", F.col("at") + F.col("words"))
    # Lines whose first word is less than min_words after this line's first word, and whose last word is less than min_words before its last.
    onward = document.orderBy("at").rangeBetween(0, min_words - 1)
    back = document.orderBy("until").rangeBetween(1 - min_words, 0)
    line = F.struct("h", "line", "g", "words")
    words = F.aggregate("inside", F.lit(0).cast("long"), lambda t, x: t + x["words"])
    # A line that is a window alone goes with the one before, for the blank lines between two of them.
    pair = F.array_compact(F.array(F.lag(line).over(in_order), line))
    both = lines.select("id", "th", "words", F.collect_list(line).over(onward).alias("on"),
                        F.when(F.col("words") >= min_words, pair).otherwise(F.collect_list(line).over(back)).alias("back"))
    # A window up to a line that is too short without it is a window from a line on, too.
    found = (both.select("id", "th", F.explode(F.array(F.struct(F.col("on").alias("inside"), F.lit(0).cast("long").alias("less")),
                                                       F.struct(F.col("back").alias("inside"), F.col("words").alias("less")))).alias("w"))
             .select("id", "th", "w.inside", "w.less").where(words - F.col("less") >= min_words)
             .withColumn("least", F.array_min("inside"))
             .withColumn("before", F.size(F.filter("inside", lambda x: x["line"] < F.col("least.line"))))
             .withColumn("after", F.size("inside") - F.col("before") - 1))
    window = F.struct("before", "after", F.get("inside", F.lit(0))["line"].alias("start"), F.element_at("inside", -1)["line"].alias("end"),
                      F.xxhash64(F.transform("inside", lambda x: x["h"])).alias("h"), F.hash(F.transform("inside", lambda x: x["g"])).alias("g"))
    return (found.withColumn("window", window)
            .withColumn("left", F.reverse(F.slice("inside", 1, F.col("before") + 1)))
            .withColumn("right", F.slice("inside", F.col("before") + 1, F.col("after") + 1))
            .groupBy("id", "th", F.col("least.line").alias("line"))
            .agg(F.min("least.h").alias("fp"), F.max_by("left", "before").alias("left"), F.max_by("right", "after").alias("right"),
                 F.collect_list("window").alias("windows")))


def _agreeing(a: str, b: str) -> Column:
    """Lines from the first on in which two arrays agree."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["h"] == y["h"]) & (x["g"] == y["g"]), F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs == 0, F.size(a)).otherwise(differs.cast("int") - 1)


def extended(positions: DataFrame, min_words: int) -> DataFrame:
    """Later positions of repeated fingerprints: (id, th, fp, start, end) of the match with the first one, null if too short, and the windows beyond it."""
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("th").alias("th"), F.col("line").alias("line"))
    placed = positions.withColumn("place", place)
    ends = placed.groupBy("fp").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    # Written before anything is grouped, so a hot fingerprint's rows may be split among tasks.
    repeated = written(placed.join(ends.where("first <> last").drop("last"), "fp"), "winnow-repeated")
    first = repeated.where("place = first").select("fp", F.col("left").alias("first_left"), F.col("right").alias("first_right"))
    words = lambda c, n: F.aggregate(F.slice(c, 1, n), F.lit(0).cast("long"), lambda t, x: t + x["words"])
    met = (repeated.where("place <> first").join(first, "fp")
           .withColumn("n_left", _agreeing("left", "first_left")).withColumn("n_right", _agreeing("right", "first_right"))
           .withColumn("both", words("left", F.col("n_left")) + words("right", F.col("n_right")) - F.get("left", F.lit(0))["words"]))
    copied = (F.col("n_left") > 0) & (F.col("n_right") > 0) & (F.col("both") >= min_words)
    beyond = F.filter("windows", lambda w: (w["before"] >= F.col("n_left")) | (w["after"] >= F.col("n_right")))
    return met.select("id", "th", "fp", F.when(copied, F.get("left", F.col("n_left") - 1)["line"]).alias("start"),
                      F.when(copied, F.get("right", F.col("n_right") - 1)["line"]).alias("end"), beyond.alias("beyond"))


def later_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, th, start, end): disjoint runs of lines to delete, from the first to the last line of each."""
    positions = written(selected(worded_lines(docs, doc_id, text), min_words), "winnow")
    met = written(extended(positions, min_words), "winnow-met")
    rest = met.select("id", "th", "fp", F.explode("beyond").alias("w")).select("id", "th", "fp", "w.start", "w.end", "w.h", "w.g")
    kind = ["fp", "h", "g"]
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("th").alias("th"), F.col("start").alias("start"))
    first = rest.groupBy(*kind).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    again = rest.join(first, kind).where(place != F.col("first")).select("id", "th", "start", "end")
    later = met.where("start is not null").select("id", "th", "start", "end").unionByName(again)
    in_order = Window.partitionBy("id", "th").orderBy("start")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return (later.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
            .withColumn("run", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("id", "th", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the kept text, and the columns n_lines, n_removed and removed (array of first, last line)."""
    runs = (later_runs(docs, doc_id, text, min_words).groupBy(F.col("id").alias("__id"), F.col("th").alias("__of"))
            .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__runs")))
    rows = without(docs, "n_lines", "n_removed", "removed", "__id", "__of", "__th", "__runs", "__lines")
    body = F.col(f"`{text}`")
    joined = (rows.withColumn("__th", F.xxhash64(body))
              .join(runs, F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("__of")), "left")
              .withColumn("__lines", _lines(body)))
    n = F.size("__runs")

    def piece(i: Column) -> Column:
        """The lines between the deleted runs i - 1 and i."""
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get("__runs", i - 1)["end"] + 1)
        end = F.when(i == n, F.size("__lines")).otherwise(F.get("__runs", i)["start"])
        return F.slice("__lines", begin + 1, end - begin)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n), piece)), "\n")
    removed = F.coalesce("__runs", F.expr("cast(array() as array<struct<start: int, end: int>>)"))
    return joined.select(
        *[F.when(F.col("__runs").isNull(), body).otherwise(kept).alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in rows.columns],
        F.when(F.col("__lines").isNull(), 0).otherwise(F.size("__lines")).cast("long").alias("n_lines"),
        F.aggregate(removed, F.lit(0).cast("long"), lambda t, r: t + r["end"] - r["start"] + 1).alias("n_removed"), removed.alias("removed"))


def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed",
                                    F.array_join(F.transform("removed", lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))), ",").alias("removed"))


#: Both kinds of windows by their whole text, with no fingerprints, extension or hashes.
ORACLE = {"op2_line_dedup": rf"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, text, unnest(str_split(text, chr(10))) AS content, generate_subscripts(str_split(text, chr(10)), 1) - 1 AS line FROM docs),
counted AS (
  SELECT *, len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) AS words FROM lines),
placed AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY doc_id, text ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM counted WHERE words > 0),
ended AS (SELECT *, pos + words AS until FROM placed),
win AS (
  SELECT doc_id, text, line AS first_line, max(line) OVER w AS last_line, sum(words) OVER w AS total, list(content) OVER w AS whole
  FROM ended WINDOW w AS (PARTITION BY doc_id, text ORDER BY pos RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)
  UNION ALL
  SELECT doc_id, text, min(line) OVER w, line, sum(words) OVER w, list(content) OVER w
  FROM ended WINDOW w AS (PARTITION BY doc_id, text ORDER BY until RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)
  UNION ALL
  SELECT doc_id, text, min(line) OVER w, line, sum(words) OVER w, list(content) OVER w
  FROM ended WINDOW w AS (PARTITION BY doc_id, text ORDER BY line ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
later AS (
  SELECT DISTINCT doc_id, text, first_line, last_line
  FROM (SELECT *, dense_rank() OVER (PARTITION BY whole ORDER BY doc_id, first_line) AS nth FROM win WHERE total >= {MIN_WORDS})
  WHERE nth > 1),
gone AS (
  SELECT l.doc_id, l.text, l.line, any_value(l.content) AS content,
         bool_or(w.doc_id IS NOT NULL) AS gone
  FROM lines l LEFT JOIN later w ON l.doc_id = w.doc_id AND l.text = w.text AND l.line BETWEEN w.first_line AND w.last_line
  GROUP BY l.doc_id, l.text, l.line),
grown AS (
  SELECT *, coalesce(max(last_line) OVER (PARTITION BY doc_id, text ORDER BY first_line, last_line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS reached
  FROM later),
islands AS (
  SELECT *, sum(CASE WHEN first_line <= reached THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, text ORDER BY first_line, last_line ROWS UNBOUNDED PRECEDING) AS run FROM grown),
runs AS (
  SELECT doc_id, text, run, min(first_line) AS a, max(last_line) AS b FROM islands GROUP BY doc_id, text, run),
removed AS (
  SELECT doc_id, text, string_agg(a || '-' || b, ',' ORDER BY a) AS removed FROM runs GROUP BY doc_id, text),
kept AS (
  SELECT doc_id, text, coalesce(string_agg(content, chr(10) ORDER BY line) FILTER (NOT gone), '') AS kept,
         count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
  FROM gone GROUP BY doc_id, text)
SELECT d.doc_id, k.kept AS text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed, coalesce(r.removed, '') AS removed
FROM documents d
LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.text = k.text
LEFT JOIN removed r ON d.doc_id IS NOT DISTINCT FROM r.doc_id AND d.text = r.text"""}
