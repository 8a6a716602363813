"""Log dashboards: top terms, filter buckets, time histograms, metrics and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ledger import running


def top_terms(logs: DataFrame, term: str, n: int) -> DataFrame:
    """the n most frequent values; ties by value."""
    return logs.groupBy(term).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), term).limit(n)


def nested_top(logs: DataFrame, outer: str, inner: str, n: int = 5) -> DataFrame:
    """the n most frequent outer values, and in each its n most frequent inner values."""
    pairs = logs.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"))
    tops = pairs.groupBy(outer).agg(F.sum("n").alias("total")).orderBy(F.desc("total"), outer).limit(n)
    w = Window.partitionBy(outer).orderBy(F.desc("n"), inner)
    return pairs.join(tops, outer).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def filter_buckets(logs: DataFrame, filters: dict[str, Column], term: str, n: int = 5) -> DataFrame:
    """named filters (a row may pass none), and in each bucket the n most frequent terms."""
    hit = F.array(*[F.when(c, F.lit(name)) for name, c in filters.items()])
    rows = logs.select(term, F.explode(F.array_compact(hit)).alias("bucket")).groupBy("bucket", term).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("bucket").orderBy(F.desc("n"), term)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def bucket(width: int) -> Column:
    return (F.floor(F.col("sec") / width) * width).cast("long").alias("bucket")


def histogram_terms(logs: DataFrame, term: str, width: int, n: int = 5) -> DataFrame:
    """by time bucket, its n most frequent terms; empty buckets don't appear."""
    rows = logs.groupBy(bucket(width), term).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("bucket").orderBy(F.desc("n"), term)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def histogram_share(logs: DataFrame, term: str, width: int, n: int = 20) -> DataFrame:
    """as F14, in percent of all rows of the bucket."""
    rows = logs.groupBy(bucket(width), term).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("bucket")
    w = whole.orderBy(F.desc("n"), term)
    rows = rows.withColumns({"rank": F.row_number().over(w), "share": F.round(100.0 * F.col("n") / F.sum("n").over(whole), 6)})
    return rows.filter(F.col("rank") <= n)


def histogram_valid(logs: DataFrame, width: int) -> DataFrame:
    """F16: valid and invalid rows by time bucket."""
    return logs.groupBy(bucket(width)).agg(F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"))


def rolling_totals(logs: DataFrame, key: str, spans: list[int]) -> DataFrame:
    """for each row, how many rows of its key lie in the last `span` seconds, itself included, and how many of them failed.

    A count up to a second less the count up to the second before the span: both are running sums (see running()) over the distinct seconds of a
    key, at which rows were counted or are asked for. Time grows with rows and spans, not with what a span holds.
    """
    per = logs.groupBy(F.col(key).alias("__key"), F.col("sec").alias("__sec")).agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("success")).alias("fail"))
    asked = per.select("__key", "__sec", F.explode(F.array(*[F.lit(s) for s in [-1, *spans]])).alias("span"))
    marks = per.select("__key", F.col("__sec").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("int").alias("span"), "__sec", "total", "fail")
    marks = marks.unionByName(asked.select("__key", (F.col("__sec") - F.col("span") - 1).alias("at"), F.lit(1).alias("kind"), F.col("span").cast("int").alias("span"), "__sec", F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("fail")))
    upto = running(marks, ["__key"], "at", ["at", "kind", "span", "__sec"], ["total", "fail"]).filter("kind = 1")  # span -1 asks for the second itself
    pick = lambda s, v: F.max(F.when(F.col("span") == s, F.col(f"run_{v}")))
    found = upto.groupBy("__key", "__sec").agg(*[(pick(-1, v) - pick(s, v)).alias(f"{v}_{s}") for s in spans for v in ("total", "fail")])
    return logs.join(found, F.col(key).eqNullSafe(F.col("__key")) & (F.col("sec") == F.col("__sec"))).drop("__key", "__sec")


def link_totals(logs: DataFrame, status: str, spans: list[int], width: int) -> DataFrame:
    """by time bucket and status, the mean of the rolling totals of that status (`total_<span>`)."""
    rolled = rolling_totals(logs, status, spans)
    return rolled.groupBy(bucket(width), status).agg(*[F.round(F.avg(f"total_{s}"), 6).alias(f"avg_total_{s}") for s in spans])


def queue_backlog(points: DataFrame, queue: str, width: int) -> DataFrame:
    """by time bucket and queue, the mean backlog: the running sum of `value` at each of its messages."""
    at = running(points, [queue], "us", ["us", "event_id"], ["value"], 3_600_000_000)
    return at.groupBy(bucket(width), queue).agg(F.round(F.avg("run_value"), 6).alias("avg_backlog"))


def histogram_averages(rows: DataFrame, width: int, columns: list[str]) -> DataFrame:
    """the mean of each column by time bucket."""
    return rows.groupBy(bucket(width)).agg(*[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in columns])


def single_metrics(spiders: DataFrame) -> DataFrame:
    """greatest lifetime, mean spider count, mean unique spider count."""
    return spiders.agg(F.max("lifetime").alias("max_lifetime"), F.round(F.avg("spiders"), 6).alias("avg_spiders"), F.round(F.avg("unique_spiders"), 6).alias("avg_unique_spiders"))


#: Bucket widths to choose from, in seconds.
WIDTHS = (1, 5, 10, 30, 60, 300, 600, 1800, 3600, 7200, 10800, 43200, 86400, 604800, 2592000)


def auto_width(logs: DataFrame, buckets: int = 100) -> int:
    """the least of WIDTHS that needs no more than `buckets` for the rows' time span (one small row is read)."""
    span = logs.agg((F.max("sec") - F.min("sec")).alias("s")).first()["s"] or 0
    return next((w for w in WIDTHS if span / w <= buckets), WIDTHS[-1])


def auto_histogram(logs: DataFrame, buckets: int = 100) -> DataFrame:
    width = auto_width(logs, buckets)
    return logs.groupBy(bucket(width)).agg(F.count(F.lit(1)).alias("n")).withColumn("width", F.lit(width).cast("long"))


def saved_search(logs: DataFrame, logger: str, columns: list[str]) -> DataFrame:
    """one logger's rows, the chosen columns, newest first."""
    return logs.filter(F.col("logger") == logger).orderBy(F.desc("us"), "event_id").select(*columns)


def retention(rows: DataFrame, stamp: str, as_of: int, days: Column) -> DataFrame:
    """Rows go whose string timestamp is at or before the cutoff, `days` (a column) before as_of."""
    cutoff = F.date_format(F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=F.lit(as_of) - days * 86400), "yyyy-MM-dd HH:mm:ss")
    return rows.filter(F.col(stamp) > cutoff)
