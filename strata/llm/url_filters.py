"""URL filters as a temporal list join.

A list is a log of dated entries: a key was added to or removed from it at a
time. Entries become validity intervals, and an as-of join evaluates every
capture against the entries that were active when it was fetched.

Keys are ``d:<domain>``, which covers a host and all hosts below it (``d:org``
covers every host that ends in org), and ``p:<host>/<segments>``, which covers
URLs below a path. An IP address is a domain as a whole: ``d:10.0.0.1``,
``d:[2001:db8::1]``; no part of it is one.

DataFrame functions only. The join is an equality on the key, on a span of
``SPAN_DAYS`` days and on a salt, so neither a host that holds a third of all
captures nor a key with a long history makes a large group: captures of a key
are dealt over ``SALTS`` tasks, intervals are copied to these and to the spans
they reach into, of those that hold captures at all: one capture with a date
far off adds one span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_DAYS = 32
SALTS = 16
IP = r"^(\[.*|\d{1,3}(\.\d{1,3}){3})$"


def host(url: Column) -> Column:
    """The host in lower case, without user, port and trailing dot; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:@]+)", 1))
    return F.nullif(F.regexp_replace(found, r"\.+$", ""), F.lit(""))


def url_keys(url: Column, segments: int | None = None, last_label: bool = True) -> Column:
    """The keys that cover a URL (an empty array if it has no host): paths of at
    most ``segments`` segments (None: of any depth), and a last label alone
    (``d:org``) unless ``last_label`` is off and the host has more."""
    h = host(url)
    labels = F.when(h.rlike(IP), F.array(h)).otherwise(F.split(h, r"\."))
    n = F.size(labels)
    last = n if last_label else F.greatest(n - 1, F.lit(1))
    domains = F.transform(F.sequence(F.lit(1), last), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, n), ".")))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    many = F.size(parts) if segments is None else F.least(F.size(parts), F.lit(segments))
    paths = F.when(many >= 1, F.transform(F.sequence(F.lit(1), F.greatest(many, F.lit(1))), lambda i: F.concat(F.lit("p:"), h, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))
    none = F.array().cast("array<string>")
    return F.when(h.isNull(), none).otherwise(F.array_distinct(F.concat(domains, F.coalesce(paths, none))))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``(list, key, valid_from, valid_to)`` of ``entries`` (list, key, action,
    at); ``valid_to`` is null while the entry stands.

    Repeated entries count once; of an addition and a removal at the same
    time the removal holds. Additions to a standing entry and removals of none
    change nothing. Entries with a null in any column or another action are
    left out. Entries are first reduced to one for each list, key and time, so
    the window that pairs them holds at most a key's distinct times.
    """
    known = entries.select("list", "key", F.lower("action").alias("action"), "at").dropna().filter(F.col("action").isin("add", "remove"))
    changes = known.groupBy("list", "key", "at").agg(F.bool_and(F.col("action") == "add").alias("on"))
    by_key = Window.partitionBy("list", "key").orderBy("at")
    turns = changes.withColumn("was", F.coalesce(F.lag("on").over(by_key), F.lit(False))).filter(F.col("on") != F.col("was"))
    closed = turns.withColumn("valid_to", F.lead("at").over(by_key))
    return closed.filter("on").select("list", "key", F.col("at").alias("valid_from"), "valid_to")


def _span(time: Column) -> Column:
    return F.floor(F.unix_timestamp(time) / (SPAN_DAYS * 86400)).cast("int")


def _segments(entries: DataFrame) -> int:
    """Path segments of the longest path key in ``entries``."""
    many = entries.filter(F.col("key").startswith("p:")).agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0]
    return many or 0


def copied(intervals: DataFrame, spans: list[int]) -> DataFrame:
    """``intervals`` for each salt and each of ``spans`` that they reach into."""
    known = F.array(*[F.lit(x) for x in spans]).cast("array<int>")
    start, end = _span(F.col("valid_from")), _span(F.col("valid_to"))
    reached = intervals.withColumn("from", start).withColumn("to", end).withColumn(
        "span", F.explode(F.filter(known, lambda x: (x >= F.col("from")) & (F.col("to").isNull() | (x <= F.col("to")))))
    )
    return reached.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def evaluate(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at", last_label: bool = True
) -> DataFrame:
    """``(page_id, url, fetched_at, n_active, lists, entry, since, blocked)``
    for every capture.

    ``n_active`` counts the entries active at fetch time that cover the URL
    (paths of any depth; an entry for a last label alone, ``d:org``, covers the
    hosts below it unless ``last_label`` is off),
    ``lists`` names their lists in order, ``entry`` is the most specific one
    (the longest key; ties by list, then key) and ``since`` the start of its
    interval. An interval holds from its first moment to before its last. A
    null URL or time, or a URL without a host, matches nothing. Repeated rows
    stay repeated and null ids are kept. Other columns are not read.
    """
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched_at"))
    seen = rows.filter("url IS NOT NULL AND fetched_at IS NOT NULL").select("url", "fetched_at").distinct()
    keyed = (
        seen.withColumn("key", F.explode(url_keys(F.col("url"), _segments(entries), last_label)))
        .withColumn("span", _span(F.col("fetched_at")))
        .withColumn("salt", F.pmod(F.xxhash64("url", "fetched_at"), F.lit(SALTS)).cast("int"))
    )
    # At most some hundred numbers a decade.
    spans = sorted(r[0] for r in seen.select(_span(F.col("fetched_at")).alias("span")).distinct().collect())
    intervals = copied(validity_intervals(entries), spans).select("list", "key", "valid_from", "valid_to", "span", "salt")
    active = (F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    # Merged, whatever the planner makes of the entries: it goes by the size of
    # their files, the copies are hundreds of times that, and a broadcast would
    # pass all of them through the driver.
    matches = keyed.join(intervals.hint("merge"), ["key", "span", "salt"]).filter(active)
    best = F.min(F.struct((-F.length("key")).alias("l"), F.col("list"), F.col("key"), F.col("valid_from")))
    found = matches.groupBy("url", "fetched_at").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), best.alias("best")
    )
    return rows.join(found, ["url", "fetched_at"], "left").select(
        "page_id", "url", "fetched_at", F.coalesce("n", F.lit(0)).cast("long").alias("n_active"), F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("best.key").alias("entry"), F.col("best.valid_from").alias("since"), F.col("n").isNotNull().alias("blocked"),
    )


# ------------------------------------------------------------ input of the registered query


def digits(text: Column, salt: str, modulo: int) -> Column:
    """A number below ``modulo`` from md5("salt:text")."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}:"), text)), 1, 8), 16, 10).cast("long") % modulo


DAY_ZERO = "2024-01-01 00:00:00"


def captures_of(pages: DataFrame) -> DataFrame:
    """``pages`` with a fetch time in 2024 that follows from its id."""
    minute = F.when(F.col("page_id").isNotNull(), digits(F.col("page_id").cast("string"), "fetch", 365 * 1440))
    return pages.select("page_id", "url", F.timestamp_seconds(F.unix_timestamp(F.lit(DAY_ZERO)) + minute * 60).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated lists over the keys that occur in ``pages``: each key in one of
    three lists or none, added, perhaps removed, and perhaps added again."""
    keys = pages.select(F.explode(url_keys(F.col("url"))).alias("key")).distinct()
    k = F.col("key")
    listed = keys.withColumn("pick", digits(k, "list", 12)).filter("pick < 3")
    day = [digits(k, f"day{i}", 200) for i in range(3)]
    at = [day[0], day[0] + 1 + day[1], day[0] + 2 + day[1] + day[2]]
    steps = F.array(
        F.struct(F.lit("add").alias("action"), at[0].alias("day")),
        F.struct(F.lit("remove").alias("action"), F.when(digits(k, "removed", 2) == 0, at[1]).alias("day")),
        F.struct(F.lit("add").alias("action"), F.when(digits(k, "again", 4) == 0, at[2]).alias("day")),
    )
    time = F.timestamp_seconds(F.unix_timestamp(F.lit(DAY_ZERO)) + F.col("s.day") * 86400)
    names = F.element_at(F.array(F.lit("adult"), F.lit("malware"), F.lit("optout")), (F.col("pick") + 1).cast("int"))
    return listed.withColumn("s", F.explode(steps)).filter("s.day IS NOT NULL").select(names.alias("list"), "key", F.col("s.action").alias("action"), time.alias("at"))


def _sql_digits(text: str, salt: str, modulo: int) -> str:
    return f"(('0x' || substr(md5('{salt}:' || {text}), 1, 8))::BIGINT % {modulo})"


#: DuckDB SQL for the registered query.
SQL = f"""
WITH c AS (
  SELECT page_id, url, TIMESTAMP '{DAY_ZERO}' + to_minutes({_sql_digits("page_id::VARCHAR", "fetch", 365 * 1440)}) AS fetched_at,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?(\\[[^\\]/?#]*\\]|[^/?#:@]+)', 1)), '\\.+$', ''), '') AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS segments
  FROM pages
), labels AS (
  SELECT *, CASE WHEN regexp_matches(host, '{IP}') THEN [host] ELSE string_split(host, '.') END AS labels FROM c
), k AS (
  SELECT DISTINCT url, fetched_at, unnest(list_concat(
    list_transform(range(1, len(labels) + 1), lambda i: 'd:' || array_to_string(labels[i:], '.')),
    list_transform(range(1, len(segments) + 1), lambda i: 'p:' || host || '/' || array_to_string(segments[1:i], '/'))
  )) AS key FROM labels WHERE host IS NOT NULL
), listed AS (
  SELECT key, ['adult', 'malware', 'optout'][({_sql_digits("key", "list", 12)} + 1)::INTEGER] AS list,
    {_sql_digits("key", "day0", 200)} AS d0, {_sql_digits("key", "day1", 200)} AS d1, {_sql_digits("key", "day2", 200)} AS d2,
    {_sql_digits("key", "removed", 2)} = 0 AS removed, {_sql_digits("key", "again", 4)} = 0 AS again
  FROM (SELECT DISTINCT key FROM k) WHERE {_sql_digits("key", "list", 12)} < 3
), i AS (
  SELECT list, key, d0 AS a, CASE WHEN removed THEN d0 + 1 + d1 END AS b FROM listed
  UNION ALL
  SELECT list, key, d0 + 2 + d1 + d2, NULL FROM listed WHERE removed AND again
), t AS (
  SELECT list, key, TIMESTAMP '{DAY_ZERO}' + to_days(a::INTEGER) AS valid_from, TIMESTAMP '{DAY_ZERO}' + to_days(b::INTEGER) AS valid_to FROM i
), m AS (
  SELECT url, fetched_at, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
    first(key ORDER BY length(key) DESC, list, key) AS entry, first(valid_from ORDER BY length(key) DESC, list, key) AS since
  FROM k JOIN t USING (key) WHERE valid_from <= fetched_at AND (valid_to IS NULL OR fetched_at < valid_to) GROUP BY ALL
)
SELECT page_id, url, fetched_at, coalesce(n, 0)::BIGINT AS n_active, coalesce(lists, '') AS lists, entry, since, n IS NOT NULL AS blocked
FROM c LEFT JOIN m USING (url, fetched_at)
"""
