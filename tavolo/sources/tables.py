"""Readers, sinks and column profiles.

Parquet is read lazily: Catalyst prunes columns and pushes filters into the
scan, so readers never select or filter themselves. CSV sources always get
an explicit schema (no ``inferSchema``: an extra pass and unstable types) and
an explicit list of null tokens, so that ``NaN``, ``NA`` and friends become
null as the original CSV reader made them (rule N2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy access to the parquet tables of one folder: ``Tables(spark, d).lineitem``.

    With ``spread=True`` (default) a table whose scan has fewer splits than
    the default parallelism (one small file, one row group) is round-robined
    to that many partitions, so the narrow CPU work after it (parsing, text
    cleaning) is not one task. A large table has many splits and is read as
    is. The check looks at the bare scan, so it never executes anything.
    """

    def __init__(self, spark: SparkSession, base_dir: str, spread: bool = True):
        self.spark = spark
        self.base_dir = base_dir.rstrip("/")
        self.spread = spread
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            df = self.spark.read.parquet(f"{self.base_dir}/{name}.parquet")
            self._cache[name] = spread_scan(df) if self.spread else df
        return self._cache[name]


def spread_scan(scan: DataFrame) -> DataFrame:
    """Round-robin a bare scan that has fewer splits than the default
    parallelism; any other scan is returned unchanged (no shuffle)."""
    try:
        target = scan.sparkSession.sparkContext.defaultParallelism
        current = scan.rdd.getNumPartitions()
    except Exception:  # a session without RDD access (Spark Connect): read as is
        return scan
    if current >= target:
        return scan
    return scan.repartition(target)


# ---------------------------------------------------------------- CSV sources (A1)

# fixed values: the tokens a pandas CSV reader turns into null by default
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

INCIDENT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in
     ["date", "type", "registration", "operator", "fatalities", "location", "country", "cat", "year"]]
)

EMAIL_SCHEMA = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("label", T.StringType())]
)

CARD_COLUMNS = [
    "BALANCE", "BALANCE_FREQUENCY", "PURCHASES", "ONEOFF_PURCHASES", "INSTALLMENTS_PURCHASES",
    "CASH_ADVANCE", "PURCHASES_FREQUENCY", "ONEOFFPURCHASESFREQUENCY",
    "PURCHASESINSTALLMENTSFREQUENCY", "CASHADVANCEFREQUENCY", "CASHADVANCETRX", "PURCHASES_TRX",
    "CREDIT_LIMIT", "PAYMENTS", "MINIMUM_PAYMENTS", "PRCFULLPAYMENT", "TENURE",
]
CARD_SCHEMA = T.StructType(
    [T.StructField("CUST_ID", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in CARD_COLUMNS]
)


# fixed values: why a CSV row is rejected
MALFORMED_LINE, BAD_VALUE = "malformed line", "bad value in "


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             null_tokens: list[str] | None = None, multi_line: bool = False,
             header: bool = True, checked: bool = False) -> DataFrame:
    """CSV with a declared schema; each null token becomes null.

    Spark's reader takes one ``nullValue``; the rest of the token list is
    mapped to null by one projection right after the scan. Declared numeric
    columns are read as text and parsed there, so that a token (``NaN`` too) is
    null in them as well. ``multi_line`` is for files with line breaks inside
    quotes: such a file is read by one task, others are split. Without a
    ``header`` the columns are those of the schema, by position.

    With ``checked`` nothing is lost silently: ``problem`` says why a row
    cannot be used (a line with too few or too many fields, a text where a number
    belongs) and ``rejected`` holds the line, or that text. ``accepted`` and
    ``quarantined`` part the two kinds.
    """
    tokens = PANDAS_NULL_TOKENS if null_tokens is None else null_tokens
    # the header gives the column order; each column takes its declared type by
    # name (a CSV schema is otherwise applied by position), unknown columns stay text
    reader = spark.read.option("header", header).option("multiLine", multi_line).option("escape", '"')
    names = reader.csv(path).columns if header else [f.name for f in schema.fields]
    declared = {f.name: f.dataType for f in schema.fields}
    read = [T.StructField(c, T.StringType()) for c in names]
    if checked:  # without pruning, so that every line is held against all columns
        reader = reader.option("columnNameOfCorruptRecord", "_line").option("columnPruning", False)
        read.append(T.StructField("_line", T.StringType()))
    df = reader.schema(T.StructType(read)).option("nullValue", "").csv(path)

    def known(c: str):
        return F.when(F.col(c).isin(tokens), F.lit(None)).otherwise(F.col(c)) if tokens else F.col(c)

    def value(c: str):
        kind = declared.get(c, T.StringType())
        return known(c) if isinstance(kind, T.StringType) else known(c).try_cast(kind)

    if not checked:
        return df.select(*[value(c).alias(c) for c in names])
    problem, rejected = F.when(F.col("_line").isNotNull(), F.lit(MALFORMED_LINE)), F.when(F.col("_line").isNotNull(), F.col("_line"))
    for c in names:
        if not isinstance(declared.get(c, T.StringType()), T.StringType):
            bad = known(c).isNotNull() & value(c).isNull()
            problem, rejected = problem.when(bad, F.lit(BAD_VALUE + c)), rejected.when(bad, F.col(c))
    staged = df.withColumn("_problem", problem).withColumn("_rejected", rejected)
    return staged.select(*[F.when(F.col("_problem").isNull(), value(c)).alias(c) for c in names],
                         F.col("_problem").alias("problem"), F.col("_rejected").alias("rejected"))


def accepted(rows: DataFrame) -> DataFrame:
    """The usable rows of a checked read."""
    return rows.filter(F.col("problem").isNull()).drop("problem", "rejected")


def quarantined(rows: DataFrame) -> DataFrame:
    """(problem, rejected) of the others."""
    return rows.filter(F.col("problem").isNotNull()).select("problem", "rejected")


def read_incidents_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, INCIDENT_SCHEMA)


def read_emails_csv(spark: SparkSession, path: str) -> DataFrame:
    """(text, label, doc_id). Every row has an id of its own, equal rows too: its
    place in the input, written once so that the ids stay what they are."""
    df = read_csv(spark, path, EMAIL_SCHEMA, multi_line=True)
    return df.withColumn("doc_id", F.monotonically_increasing_id()).checkpoint(eager=True)


def read_cards_csv(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, CARD_SCHEMA)
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in CARD_SCHEMA.fields])


def read_word_vectors_text(spark: SparkSession, path: str) -> DataFrame:
    """GloVe-style text: ``word v1 v2 ...`` per line -> (word, vector array<float>)."""
    parts = F.split(F.col("value"), " ")
    return (spark.read.text(path)
            .select(parts.getItem(0).alias("word"),
                    F.transform(F.slice(parts, 2, F.size(parts) - 1),
                                lambda x: x.cast("float")).alias("vector")))


# ---------------------------------------------------------------- sinks

def register_view(df: DataFrame, name: str) -> DataFrame:
    """Named intermediate result, replaced if present."""
    df.createOrReplaceTempView(name)
    return df


def save_table_once(df: DataFrame, name: str) -> None:
    """Persistent result table that fails when it already exists."""
    df.write.mode("errorifexists").saveAsTable(name)


def write_text_lines(lines: DataFrame, path: str, order_col: str = "line_no",
                     text_col: str = "line") -> None:
    """Overwrite a text file folder with ``lines`` in ``order_col`` order.

    The range sort keeps the write distributed; lines come out in order across
    the part files.
    """
    (lines.repartitionByRange(order_col).sortWithinPartitions(order_col)
     .select(text_col).write.mode("overwrite").text(path))


# ---------------------------------------------------------------- profiles

def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def _profile(df: DataFrame, measure, name: str, with_type: bool) -> DataFrame:
    """One aggregate pass; the per-column results are exploded to rows."""
    rows = []
    for f in df.schema.fields:
        fields = [F.lit(f.name).alias("column")]
        if with_type:
            fields.append(F.lit(f.dataType.simpleString()).alias("type"))
        fields.append(measure(F.col(f"`{f.name}`")).alias(name))
        rows.append(F.struct(*fields))
    return df.agg(F.array(*rows).alias("p")).select(F.inline("p"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, as rows (column, nulls)."""
    return _profile(df, lambda c: F.count_if(c.isNull()), "nulls", with_type=False)


def column_profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null) for every column (A10)."""
    return _profile(df, F.count, "non_null", with_type=True)


def default_stopwords(spark: SparkSession, language: str = "english") -> DataFrame:
    """A stopword table from Spark ML's built-in list (A4); the reference's
    list differs slightly, so jobs take the table as an argument."""
    from pyspark.ml.feature import StopWordsRemover
    words = StopWordsRemover.loadDefaultStopWords(language)
    return spark.createDataFrame([(w,) for w in words], "word string")
