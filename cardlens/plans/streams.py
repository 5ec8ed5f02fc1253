"""Event-time queries: batch runs of the functions that also run on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.plans.base import query
from cardlens.sources.adapters import log_rows, table
from cardlens.streaming import harvest as H
from cardlens.streaming.matching import match_table


def _events(spark, sf) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("""WITH n AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS nw, event_id FROM events),
s AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM n)
SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS "start", CAST(floor(epoch(max(ts))) + 21600 AS BIGINT) AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, sf) -> DataFrame:
    out = H.sessions(_events(spark, sf), "ts", "user_id", "6 hours")
    return out.select("user_id", F.unix_timestamp("start").alias("start"), F.unix_timestamp("end").alias("end"), "n")


@query("SELECT event_type, CAST(floor(epoch(time_bucket(INTERVAL 1 DAY, ts))) AS BIGINT) AS \"start\", count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, sf) -> DataFrame:
    out = H.windowed_counts(_events(spark, sf), "ts", "event_type", "1 day")
    return out.select("event_type", F.unix_timestamp("start").alias("start"), "n")


@query("SELECT user_id, count(DISTINCT event_type) AS n FROM events GROUP BY 1")
def distinct_event_types(spark, sf) -> DataFrame:
    """The set that a stream's seen-state holds in the end."""
    return table(spark, sf, "events").dropDuplicates(["user_id", "event_type"]).groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = p.page_id AND d.lang = 'en')")
def retry_gap(spark, sf) -> DataFrame:
    done = table(spark, sf, "documents").filter("lang = 'en'").select(F.col("doc_id").alias("page_id"))
    return H.retry_gap(table(spark, sf, "pages"), done, "page_id").select("page_id", "url")


@query()
def match_loop(spark, sf) -> DataFrame:
    """What became of every query that the logs of all devices sent, with two days for each."""
    return match_table(log_rows(spark, sf), 48 * 3_600_000)
