"""URL filters by dated lists (operator 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardflow.sources.tables import read_table

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def with_host(captures: DataFrame) -> DataFrame:
    """Add the lower-case host of ``url``; null where there is none."""
    host = F.regexp_extract(F.lower("url"), HOST, 1)
    return captures.withColumn("host", F.when(host != "", host))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Intervals [valid_from, valid_to) in which (list, key) is active; an open end is null.

    ``entries`` (list, key, action, at) are dated ``add`` and ``remove``
    entries.  An add while active and a remove while inactive change nothing;
    of entries of one key at one time the add wins.  Entries without key or date count for nothing.
    """
    key = Window.partitionBy("list", "key").orderBy("at")
    state = (entries.where("key IS NOT NULL AND at IS NOT NULL").groupBy("list", "key", "at")
             .agg(F.max(F.col("action") == "add").alias("active")))
    changes = (state.withColumn("was", F.lag("active", 1, False).over(key))
               .where("active <> was").withColumn("valid_to", F.lead("at").over(key)))
    return changes.where("active").select("list", "key", F.col("at").alias("valid_from"), "valid_to")


def _months(col: str) -> str:
    return f"(year({col}) * 12 + month({col}))"


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every capture (page_id, url, fetch_time) against the entries active at its fetch time.

    A key names a host and all hosts below it.  The as-of join meets on (key,
    month), so a key with a long history is matched with the intervals of one
    month only; each distinct (host, time) is judged once, so that a frequent
    host costs no more than its distinct times.  Captures without host or time are not blocked.
    Returns page_id, url, fetch_time, host, blocked, list, key (of the first list and the longest key).
    """
    seen = with_host(captures.select("page_id", "url", "fetch_time"))
    asked = seen.where("host IS NOT NULL AND fetch_time IS NOT NULL").select("host", "fetch_time").distinct()
    parts = asked.withColumn("key", F.explode(F.expr(
        "transform(sequence(1, size(split(host, '[.]'))), "
        "i -> array_join(slice(split(host, '[.]'), i, 1000), '.'))"))).withColumn(
        "month", F.expr(_months("fetch_time")))
    horizon = asked.agg(F.max("fetch_time").alias("t"))
    last = horizon.select(F.expr(_months("t"))).scalar()
    spans = (validity_intervals(entries).withColumn("last", last)
             .withColumn("until", F.expr(f"least(coalesce({_months('valid_to')}, last), last)"))
             .where(f"until >= {_months('valid_from')}")
             .withColumn("month", F.explode(F.expr(f"sequence({_months('valid_from')}, until)")))
             .select("list", "key", "month", "valid_from", "valid_to"))
    hits = (parts.join(spans, ["key", "month"])
            .where("valid_from <= fetch_time AND (valid_to IS NULL OR fetch_time < valid_to)")
            .groupBy("host", "fetch_time")
            .agg(F.min(F.struct("list", F.expr("-length(key) AS n"), "key")).alias("hit")))
    return seen.join(hits, ["host", "fetch_time"], "left").select(
        "page_id", "url", "fetch_time", "host", F.col("hit").isNotNull().alias("blocked"),
        F.col("hit.list").alias("list"), F.col("hit.key").alias("key"))


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``pages`` as captures; the table has no fetch time, so page_id gives one within 2024."""
    return read_table(spark, sf_dir, "pages").select(
        "page_id", "url", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(page_id * 37 % 360 AS int), "
                                 "cast(page_id % 24 AS int))").alias("fetch_time"))


def listed_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated entries derived from the pages' own hosts.

    Three tenths of the hosts, by checksum, are listed as ``review``
    once, taken off after a while and partly listed again; names of spam
    farms and pill shops are on the ``spam`` list from spring on.
    """
    hosts = (with_host(read_table(spark, sf_dir, "pages").select("url")).where("host IS NOT NULL").select("host").distinct()
             .withColumn("c", F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int")))
    day = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast({0} AS int))"
    review = hosts.where("c % 10 < 3").withColumn("e", F.explode(F.expr(
        f"filter(array(struct('add' AS action, {day.format('c % 200')} AS at), "
        f"struct('remove' AS action, {day.format('c % 200 + 40 + c % 31')} AS at), "
        f"if(c % 2 = 0, struct('add' AS action, {day.format('c % 200 + 100')} AS at), null)), x -> x IS NOT NULL)")))
    spam = hosts.where("host RLIKE 'spam|pills'").selectExpr(
        "'spam' AS list", "regexp_replace(host, '^(www|blog|m)[.]', '') AS key", "'add' AS action",
        "timestamp_ntz'2024-04-01 00:00:00' AS at")
    return review.select(F.lit("review").alias("list"), F.col("host").alias("key"), "e.action", "e.at").unionByName(spam)


def op8_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the lists as they were when it was fetched."""
    return judge_captures(page_captures(spark, sf_dir), listed_hosts(spark, sf_dir))


# Brute force: every capture against every entry, the state being the latest entry by its time.
OP8_SQL = rf"""
WITH seen AS (
  SELECT page_id, url, nullif(regexp_extract(lower(url), '{HOST}', 1), '') AS host,
         TIMESTAMP '2024-01-01' + to_days(CAST(page_id * 37 % 360 AS INTEGER)) + to_hours(page_id % 24) AS fetch_time
  FROM pages),
hosts AS (SELECT DISTINCT host, CAST('0x' || substr(md5(host), 1, 6) AS INTEGER) AS c FROM seen WHERE host IS NOT NULL),
entries AS (
  SELECT 'review' AS list, host AS key, 1 AS adds, TIMESTAMP '2024-01-01' + to_days(c % 200) AS at FROM hosts WHERE c % 10 < 3
  UNION ALL SELECT 'review', host, 0, TIMESTAMP '2024-01-01' + to_days(c % 200 + 40 + c % 31) FROM hosts WHERE c % 10 < 3
  UNION ALL SELECT 'review', host, 1, TIMESTAMP '2024-01-01' + to_days(c % 200 + 100) FROM hosts WHERE c % 10 < 3 AND c % 2 = 0
  UNION ALL SELECT 'spam', regexp_replace(host, '^(www|blog|m)[.]', ''), 1, TIMESTAMP '2024-04-01' FROM hosts
            WHERE regexp_matches(host, 'spam|pills')),
asked AS (SELECT DISTINCT host, fetch_time FROM seen WHERE host IS NOT NULL),
state AS (
  SELECT a.host, a.fetch_time, e.list, e.key, arg_max(e.adds, struct_pack(at := e.at, adds := e.adds)) AS active
  FROM asked a JOIN entries e ON (a.host = e.key OR suffix(a.host, '.' || e.key)) AND e.at <= a.fetch_time
  GROUP BY ALL),
hit AS (
  SELECT host, fetch_time, list, key,
         row_number() OVER (PARTITION BY host, fetch_time ORDER BY list, length(key) DESC, key) AS k
  FROM state WHERE active = 1)
SELECT s.page_id, s.url, s.fetch_time, s.host, h.host IS NOT NULL AS blocked, h.list, h.key
FROM seen s LEFT JOIN hit h ON h.host = s.host AND h.fetch_time = s.fetch_time AND h.k = 1
"""
