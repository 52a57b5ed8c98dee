"""Accident cleaning, trends and rankings.

Plan shape for all rankings: scan -> Project(safe parse) -> Filter -> partial
HashAggregate -> exchange on the key -> final HashAggregate ->
TakeOrderedAndProject (a bounded top-k heap per partition, never a full sort).
A hot key (one operator with a third of all rows) is absorbed by the map-side
partial aggregate. Null keys are dropped before grouping (N3); sums of
all-null groups are 0 (N4); counts count parsed dates, never rows (N5).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavolo.functions.parse import (not_equal_keep_null, parse_date_free, parse_date_strict,
                                    parse_number, weekday_name)
from tavolo.operators.ranking import global_rank

# fixed values: the sentinels of the accident data
UNKNOWN_COUNTRY = "Unknown country"
UNKNOWN_DATE = "date unk."
UNKNOWN_YEAR = "unknown"
NAN_TEXT = "NaN"

CUTOFF = _dt.date(2001, 9, 11)


def clean_filter(df: DataFrame) -> DataFrame:
    """The eight-predicate cleaning filter (B4): sentinel tests keep nulls
    (N1); not-null tests run on raw text, before any coercion (N6)."""
    cond = (not_equal_keep_null(F.col("country"), UNKNOWN_COUNTRY)
            & not_equal_keep_null(F.col("date"), UNKNOWN_DATE)
            & F.col("fatalities").isNotNull()
            & F.col("registration").isNotNull()
            & not_equal_keep_null(F.col("registration"), NAN_TEXT)
            & F.col("operator").isNotNull()
            & not_equal_keep_null(F.col("year"), UNKNOWN_YEAR)
            & F.col("location").isNotNull())
    return df.filter(cond)


def clean_incidents(raw: DataFrame) -> DataFrame:
    """Q2: filter, weekday from the strict parse (H4, H6), date from the
    free-format parse (H5, N11), fatalities as a number (H9, N9)."""
    kept = clean_filter(raw)
    return kept.select(
        parse_date_free(F.col("date")).alias("date"),
        "type", "registration", "operator",
        parse_number(F.col("fatalities")).alias("fatalities"),
        "location", "country", "cat", "year",
        weekday_name(parse_date_strict(F.col("date"))).alias("day_of_week"),
    )


def incidents_per_year(clean: DataFrame) -> DataFrame:
    """Q3: parsed dates per text year, as int, ascending."""
    return (clean.filter(F.col("year").isNotNull())
            .groupBy("year").agg(F.count("date").alias("count"))
            .select(F.col("year").cast("int").alias("year"), "count")
            .orderBy("year"))


def frequency(clean: DataFrame, key: str) -> DataFrame:
    """Rows per non-null key, highest first; key breaks ties."""
    return (clean.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(key).asc()))


def top_countries(clean: DataFrame, k: int = 11) -> DataFrame:
    """Q4: the label-inclusive ``.loc[:10]`` is 11 rows."""
    return frequency(clean, "country").limit(k)


def incidents_by_weekday(clean: DataFrame) -> DataFrame:
    return frequency(clean, "day_of_week")


def fewest_incidents(clean: DataFrame, key: str = "operator", k: int = 10) -> DataFrame:
    """Q4: the k keys with the fewest rows, key ascending on ties."""
    return (clean.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").asc(), F.col(key).asc()).limit(k))


def fatalities_by(clean: DataFrame, key: str, k: int | None = 10) -> DataFrame:
    """Q5: summed fatalities per key, nulls skipped, all-null -> 0."""
    out = (clean.filter(F.col(key).isNotNull())
           .groupBy(key).agg(F.coalesce(F.sum("fatalities"), F.lit(0.0)).alias("fatalities"))
           .orderBy(F.col("fatalities").desc(), F.col(key).asc()))
    return out.limit(k) if k is not None else out


def era(date_col: Column, cutoff: _dt.date = CUTOFF) -> Column:
    """``before`` / ``after`` the cutoff day; the day itself and null dates
    are in neither (B6, N12)."""
    cut = F.lit(cutoff)
    return F.when(date_col < cut, F.lit("before")).when(date_col > cut, F.lit("after"))


def yearly_counts_in_era(clean: DataFrame, which: str, cutoff: _dt.date = CUTOFF,
                         min_year: int | None = None) -> DataFrame:
    """Q6: incidents per calendar year of the date, in one era, newest first
    (B6, H7, D5, B7, F6); ``min_year`` is the HAVING-like filter on the key.

    The era and year conditions are counted inside the aggregate, and only
    the counts are filtered (> 0, the years a row filter would keep). A row
    filter on them would be pushed below the projection that parses the date
    and repeat the parse once per predicate.
    """
    year = F.year("date")
    cond = era(F.col("date"), cutoff) == which
    if min_year is not None:
        cond = cond & (year > min_year)
    out = (clean.groupBy(year.alias("year")).agg(F.count_if(cond).alias("count_of_incident"))
           .filter(F.col("count_of_incident") > 0))
    return out.orderBy(F.col("year").desc())


def years_by_count(clean: DataFrame, which: str, cutoff: _dt.date = CUTOFF, min_year: int | None = None) -> DataFrame:
    """Yearly counts of one era by count, highest first, ties by year, with their rank.

    The window runs over one row per year.
    """
    order = [F.col("count_of_incident").desc(), F.col("year").asc()]
    return (yearly_counts_in_era(clean, which, cutoff, min_year)
            .withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
            .orderBy("rank"))


def rows_by_date(clean: DataFrame, which: str, cutoff: _dt.date = CUTOFF) -> DataFrame:
    """Incidents of one era, latest first, with their rank (F6); equal dates by the other columns, nulls last.

    A distributed rank: no single-task sort.
    """
    others = sorted(c for c in clean.columns if c != "date")
    order = [F.col("date").desc(), *(F.col(c).asc_nulls_last() for c in others)]
    return global_rank(clean.where(era(F.col("date"), cutoff) == which), order, "rank").withColumn("rank", F.col("rank") + 1).orderBy("rank")


def mean_incidents_by_era(clean: DataFrame, cutoff: _dt.date = CUTOFF,
                          exclude_years: Sequence[int] = (2001, 2023),
                          countries: DataFrame | None = None) -> DataFrame:
    """Mean yearly incidents before and after the cutoff, leaving out
    partial years; ``countries`` (one column ``country``) restricts rows by a
    left-semi join, which Catalyst plans as a broadcast when it is small.
    Conditions are counted per year (see ``yearly_counts_in_era``); years
    without an incident in an era do not count towards its mean."""
    rows = clean
    if countries is not None:
        rows = rows.join(countries, "country", "left_semi")
    year = F.year("date")
    e = era(F.col("date"), cutoff)
    kept = ~year.isin(list(exclude_years))
    per_year = rows.groupBy(year.alias("year")).agg(
        F.count_if((e == "before") & kept).alias("before"),
        F.count_if((e == "after") & kept).alias("after"))
    yearly = (per_year.unpivot("year", ["before", "after"], "era", "n")
              .filter(F.col("n") > 0))
    return yearly.groupBy("era").agg(
        F.count(F.lit(1)).alias("years"),
        F.sum("n").alias("incidents"),
        F.round(F.avg("n"), 6).alias("mean_incidents"),
    )


def incident_reports(raw: DataFrame, countries: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every accident table of Q3-Q6 and G1/G2 from one cleaning pass.

    The cleaned frame feeds all the rankings, so it is persisted once
    (memory, spilling to disk) and every report reads it; an executor loss
    only recomputes the lost blocks from the scan. Call ``unpersist`` on
    ``reports["clean"]`` when done.
    """
    from pyspark import StorageLevel

    clean = clean_incidents(raw).persist(StorageLevel.MEMORY_AND_DISK)
    out = {
        "clean": clean,
        "per_year": incidents_per_year(clean),
        "by_country_top11": top_countries(clean),
        "by_weekday": incidents_by_weekday(clean),
        "operators_fewest": fewest_incidents(clean, "operator", 10),
        "fatalities_by_operator_top10": fatalities_by(clean, "operator", 10),
        "fatalities_by_type": fatalities_by(clean, "type", None),
        "fatalities_by_category_top10": fatalities_by(clean, "cat", 10),
        "after_by_year": yearly_counts_in_era(clean, "after"),
        "before_by_year": yearly_counts_in_era(clean, "before", min_year=1946),
        "mean_by_era": mean_incidents_by_era(clean),
    }
    if countries is not None:
        out["mean_by_era_country"] = mean_incidents_by_era(clean, countries=countries)
    return out
