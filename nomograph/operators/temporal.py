"""Versions by date: the one in force on a day, and what happened while one was."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomograph.functions import text
from nomograph.sources.corpus import Corpus

#: Days of a bucket in which intervals and dates meet.
DAYS = 64


def versions(corpus: Corpus) -> DataFrame:
    """act (its year, kind and number), from_date and version (the CELEX; of several of one day the greatest) of every consolidated version."""
    celex = F.col("celex")
    found = corpus["works"].where(text.is_consolidated(celex)).select(text.act_core(celex).alias("act"), F.to_date(text.consolidation_date(celex)).alias("from_date"), celex.alias("version"))
    return found.where("act IS NOT NULL AND from_date IS NOT NULL").groupBy("act", "from_date").agg(F.max("version").alias("version"))


def as_of(requests: DataFrame, versions: DataFrame) -> DataFrame:
    """requests: act, date, and others; versions: act, from_date, version. The requests with version and from_date of the version in force on that date, null before the first.

    An as-of join by one pass: each act's dates and versions in one order, where a date takes the last version before it. Only
    distinct dates of an act go through it, so a window holds no more rows than there are days and versions, however often
    an act is asked for; requests then join their date by equality."""
    days = requests.where("act IS NOT NULL AND date IS NOT NULL").select("act", "date").distinct()
    none = F.lit(None)
    line = days.select("act", "date", none.cast("string").alias("version"), none.cast("date").alias("from_date")).unionByName(versions.select("act", F.col("from_date").alias("date"), "version", "from_date"))
    # a version counts from its own day on: of one day, versions come first
    before = Window.partitionBy("act").orderBy("date", F.col("version").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = F.last(F.when(F.col("version").isNotNull(), F.struct("version", "from_date")), ignorenulls=True).over(before)
    known = line.select("act", "date", F.col("version").isNull().alias("asked"), latest.alias("v")).where("asked").select("act", "date", "v.version", "v.from_date")
    return requests.join(known, ["act", "date"], "left")


def validity(versions: DataFrame) -> DataFrame:
    """versions with to_date, the day of the act's next version (exclusive); null if there is none."""
    return versions.withColumn("to_date", F.lead("from_date").over(Window.partitionBy("act").orderBy("from_date")))


def _bucket(date: Column) -> Column:
    return F.floor(F.unix_date(date) / DAYS)


def within(intervals: DataFrame, dates: DataFrame) -> DataFrame:
    """intervals: from_date, to_date (exclusive; null: open) and others; dates: date and others. A row for each date within an interval.

    An interval join by equality: an interval stands in each bucket of days that it touches, a date in one, so long intervals
    are split and each pair is found once. Open intervals end behind the last date."""
    last = dates.agg(F.max("date")).first()[0]
    end = F.coalesce(F.date_sub("to_date", 1), F.lit(last).cast("date"))
    cut = intervals.withColumn("_end", end).where("_end >= from_date")
    cut = cut.withColumn("_bucket", F.explode(F.sequence(_bucket(F.col("from_date")), _bucket(F.col("_end"))))).drop("_end")
    near = dates.withColumn("_bucket", _bucket(F.col("date")))
    return cut.join(near, "_bucket").where((F.col("date") >= F.col("from_date")) & (F.col("to_date").isNull() | (F.col("date") < F.col("to_date")))).drop("_bucket")


def cases_while_in_force(corpus: Corpus) -> DataFrame:
    """version, from_date, to_date, n_cases, n_days of every consolidated version: cases of its time, and days with cases. Cases are counted by day first."""
    cases = corpus["works"].where(F.startswith("celex", F.lit("6")) & F.col("doc_date").isNotNull()).groupBy(F.col("doc_date").alias("date")).agg(F.count("*").alias("n"))
    every = validity(versions(corpus))
    met = within(every, cases).groupBy("version", "from_date").agg(F.sum("n").alias("n_cases"), F.count("*").alias("n_days"))
    return every.join(met, ["version", "from_date"], "left").select("version", "from_date", "to_date", F.coalesce("n_cases", F.lit(0)).alias("n_cases"), F.coalesce("n_days", F.lit(0)).alias("n_days"))
