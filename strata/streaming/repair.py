"""Repair of closed Gold hours.

Append-mode Gold writes an hour once, when the watermark passes its end. Rows
that come later are in Silver but not in that hour. A repair reconciles both:
it compares the closed hours of Gold with Silver, rebuilds those that differ
from Silver with the same aggregate, and publishes them as a correction (a
table of whole hours, :mod:`strata.streaming.versions`). Readers of closed Gold
take a corrected hour from its newest correction
(:func:`strata.sources.tables.read_gold_closed`). The stream and its sink log
are left alone, and a repair beside it changes nothing that it writes.

What a run reads follows the new data. Silver files that are not newer than
the last repair cannot have changed an hour, so only the dates of newer files
are looked at (the filter on the files' times skips the others unopened; the
rest is a filter on the date partition). For those dates two columns give the
row counts; only hours whose counts differ, or that hold rows without an id,
which the counts of Gold do not show, are aggregated again. Hours whose counts
differ have other rows; of the others only those whose rows turn out to differ
are published. Lists of hours are broadcast, so rows of Silver and Gold are
picked where they are scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.gold import GOLD_ORDER, gold_hourly
from strata.schemas import EVENT_DATE, EVENT_TS, GOLD_KEYS
from strata.sources.tables import hour_end, newest_closed, read_gold, read_gold_closed, read_silver
from strata.streaming.layers import LayerPaths
from strata.streaming.versions import HOUR, HOURS, published, replace_hours, sweep

#: Averages that differ by less than this share are the same: sums of doubles depend on their order.
SAME = 1e-9


def silver_hours(silver: DataFrame) -> DataFrame:
    """``(date_hour, hour, events, no_id)``: the rows of each hour, with and without an event id."""
    return silver.groupBy(F.col(EVENT_DATE).alias("date_hour"), F.hour(EVENT_TS).alias("hour")).agg(
        F.count("event_id").alias("events"), F.count_if(F.col("event_id").isNull()).alias("no_id")
    )


def hours_to_check(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """``(date_hour, hour, differs)``: hours whose counts of events differ
    between Silver and Gold, also hours that only one of them has
    (``differs``), and hours with rows that a count of ids leaves out."""
    of_gold = gold.groupBy(*HOUR).agg(F.sum("event_count").alias("emitted"))
    both = silver_hours(silver).join(of_gold, list(HOUR), "full_outer")
    return both.withColumn("differs", F.expr("NOT (events <=> emitted)")).filter("differs OR no_id > 0").select(*HOUR, "differs")


def _other(column: str) -> Column:
    a, b = F.col(f"a.{column}"), F.col(f"b.{column}")
    if not column.startswith("avg_"):
        return ~a.eqNullSafe(b)
    near = F.abs(a - b) <= F.lit(SAME) * F.greatest(F.abs(a), F.abs(b))
    return ~F.coalesce(near, a.isNull() & b.isNull())


def hours_that_differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(date_hour, hour)`` in which two Gold tables hold other rows."""
    keys = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in GOLD_KEYS]
    on = keys[0]
    for k in keys[1:]:
        on &= k
    differs = F.col("a.event_count").isNull() | F.col("b.event_count").isNull()
    for c in GOLD_ORDER:
        if c not in GOLD_KEYS:
            differs |= _other(c)
    pairs = a.alias("a").join(b.alias("b"), on, "full_outer").filter(differs)
    return pairs.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in HOUR]).distinct()


def _of_hours(df: DataFrame, hours: DataFrame, date: str, hour: Column) -> DataFrame:
    """Rows of these hours. The date is a partition column, so Spark prunes by the dates found."""
    h = F.broadcast(hours.select(F.col("date_hour").alias("_date"), F.col("hour").alias("_hour")))
    return df.join(h, (F.col(date) == F.col("_date")) & (hour == F.col("_hour")), "left_semi")


def repair_gold(
    spark: SparkSession, paths: LayerPaths, start_date: str | None = None, end_date: str | None = None, grace: float = 3600.0
) -> list[tuple]:
    """Bring closed Gold hours in line with Silver; returns the (date, hour)
    pairs rewritten. Without dates, the dates of the Silver files written since
    the last such run are checked; with them, these dates.

    Run it beside the stream, one at a time. Superseded corrections stay for
    ``grace`` seconds for readers that began before. Gold must come from this
    Silver: an hour that Silver does not hold any more would be emptied, so
    give a start date once old Silver dates have been removed."""
    emitted = read_gold(spark, paths.gold)
    newest = newest_closed(emitted)
    if newest is None:
        return []
    silver = read_silver(spark, paths.silver, start_date, end_date).filter((F.col(EVENT_DATE) <= F.lit(newest[0])) & (F.col(EVENT_TS) < hour_end(*newest)))
    last = published(spark, paths.gold_corrections)
    mark = last.mark if last else 0
    if start_date is None and end_date is None:
        time_of = F.unix_millis("_metadata.file_modification_time")
        whole = read_silver(spark, paths.silver)
        # Files of the newest time seen before are looked at again: more may share it.
        seen = whole.filter(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(mark)))
        new = seen.groupBy(EVENT_DATE).agg(F.max(time_of).alias("at")).collect()  # one row a date
        dates = sorted(r[EVENT_DATE] for r in new if r[EVENT_DATE] is not None and r[EVENT_DATE] <= newest[0])
        mark = max([mark, *(r["at"] for r in new)])
        if not dates:
            return []
        some = ", ".join(f"DATE '{d}'" for d in dates)
        silver, within = silver.filter(f"{EVENT_DATE} IN ({some})"), f"date_hour IN ({some})"
        closed = read_gold_closed(spark, paths).filter(within)
    else:
        closed = read_gold_closed(spark, paths, start_date, end_date)

    hour_of = F.hour(EVENT_TS)
    found: list[tuple] = []
    suspects = hours_to_check(silver, closed).collect()  # at most as many as the checked dates have
    found = [(r["date_hour"], r["hour"]) for r in suspects if r["differs"]]
    doubtful = [(r["date_hour"], r["hour"]) for r in suspects if not r["differs"]]
    if doubtful:
        hours = spark.createDataFrame(doubtful, HOURS)
        rebuilt = gold_hourly(_of_hours(silver, hours, EVENT_DATE, hour_of))
        found += [tuple(r) for r in hours_that_differ(rebuilt, _of_hours(closed, hours, "date_hour", F.col("hour"))).collect()]
    if found:
        found.sort()
        changed = spark.createDataFrame(found, HOURS)
        rows = gold_hourly(_of_hours(silver, changed, EVENT_DATE, hour_of))
        replace_hours(spark, paths.gold_corrections, rows.repartitionByRange(*GOLD_KEYS), changed, mark)
    if not found and mark > (last.mark if last else 0):  # nothing to correct up to here
        none = emitted.filter("false")
        replace_hours(spark, paths.gold_corrections, none, none, mark)
    sweep(spark, paths.gold_corrections, grace)
    return found
