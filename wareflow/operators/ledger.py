"""Crawl ledger, reports and queues: aggregates over crawl events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ledger(events: DataFrame) -> DataFrame:
    """counters of each crawl; `start` is the first event, `update` the last."""
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("long")
    return events.groupBy("crawlid").agg(
        of("scheduled").alias("total"), of("crawled").alias("crawled"), of("failed_pages").alias("failed_pages"), of("failed_pipeline").alias("failed_pipeline"), of("dropped").alias("dropped"), F.min("sec").alias("start"), F.max("sec").alias("update")
    )


def report(led: DataFrame) -> DataFrame:
    """minutes (2 decimals), pages a minute, success in percent, missing pages.

    Rates divide by the rounded minutes; what can't be divided is 0.
    """
    failed = F.col("failed_pages") + F.col("failed_pipeline")
    x = led.withColumn("minutes", F.round((F.col("update") - F.col("start")) / 60, 2)).withColumn("failed", failed)
    return x.select(
        "crawlid",
        "minutes",
        F.coalesce(F.round(F.try_divide(F.col("crawled").cast("double"), F.col("minutes")), 2), F.lit(0.0)).alias("per_minute"),
        F.coalesce(F.round(F.try_divide(F.col("crawled") * 100.0, F.col("total")), 2), F.lit(0.0)).alias("success"),
        (F.col("total") - F.col("crawled") - F.col("failed") - F.col("dropped")).alias("missing"),
    )


def finished(as_of: int) -> Column:
    """all pages are accounted for, or pages came without a total, or nothing came for a day."""
    done = F.col("crawled") + F.col("failed_pages") + F.col("failed_pipeline")
    return ((F.col("total") > 0) & (F.col("total") <= done)) | ((F.col("total") == 0) & (done > 0)) | (F.lit(as_of) - F.col("update") >= 86400)


def finish_rule(led: DataFrame, as_of: int) -> DataFrame:
    """`finished`, and `missing` shown as 0 while a crawl goes on."""
    missing = F.col("total") - F.col("crawled") - F.col("failed_pages") - F.col("failed_pipeline")
    x = led.withColumn("finished", finished(as_of))
    return x.select("crawlid", "finished", F.when(F.col("finished"), missing).otherwise(F.lit(0)).cast("long").alias("missing"))


def task_list(led: DataFrame) -> DataFrame:
    """the latest update first; a crawl without one counts as of 1970."""
    return led.withColumn("update", F.coalesce("update", F.lit(0).cast("long"))).orderBy(F.desc("update"), "crawlid")


def task_lookup(led: DataFrame, ids: str, as_of: int) -> DataFrame:
    """the crawls named in `a|b|c` with status finished or crawled."""
    return led.filter(F.col("crawlid").cast("string").isin(ids.split("|"))).select("crawlid", F.when(finished(as_of), "finished").otherwise("crawled").alias("status"))


def failure_details(events: DataFrame) -> DataFrame:
    """for each crawl and type the latest reason of every URL, its first line and count of lines."""
    bad = events.filter(F.col("kind").startswith("failed"))
    last = bad.groupBy("crawlid", "kind", "url").agg(F.max_by("reason", F.struct("us", "event_id")).alias("reason"), F.count(F.lit(1)).alias("times"))
    lines = F.split("reason", r"\|")
    return last.select("crawlid", "kind", "url", "times", lines[0].alias("line"), F.size(lines).cast("long").alias("lines"))


def failure_counts(events: DataFrame) -> DataFrame:
    """failures and distinct failed URLs by crawl and type; the first is never the smaller."""
    return events.filter(F.col("kind").startswith("failed")).groupBy("crawlid", "kind").agg(F.count(F.lit(1)).alias("failures"), F.countDistinct("url").alias("urls"))


def feed_rate(feeds: DataFrame, batch: str, ok: str) -> DataFrame:
    """success and failure in percent (2 decimals) by batch."""
    good = F.round(F.avg(F.when(F.col(ok), 1.0).otherwise(0.0)) * 100, 2)
    return feeds.groupBy(batch).agg(good.alias("success_rate"), F.round(F.avg(F.when(F.col(ok), 0.0).otherwise(1.0)) * 100, 2).alias("failure_rate"))


def quality_report(items: DataFrame) -> DataFrame:
    """items without browse nodes or without a brand."""
    no_nodes, no_brand = F.coalesce(F.size("nodes"), F.lit(0)) <= 0, F.coalesce("brand", F.lit("")) == ""
    return items.filter(no_nodes | no_brand).select("product_id", no_nodes.alias("no_nodes"), no_brand.alias("no_brand"))


def refresh_counts(events: DataFrame, width: int = 86400) -> DataFrame:
    """F8: by site and window, the ids in which roc_<digits> is found anywhere."""
    return events.filter(F.col("crawl_name").rlike("roc_[0-9]+")).groupBy("site", (F.floor(F.col("sec") / width) * width).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def admission(requests: DataFrame, most: int = 200) -> DataFrame:
    """a spider with more than `most` waiting requests is refused."""
    return requests.groupBy("spiderid").agg(F.count(F.lit(1)).alias("waiting")).withColumn("admitted", F.col("waiting") <= most)


def task_summary(results: DataFrame) -> DataFrame:
    """rows, errors and success (errors < rows) by site."""
    g = results.groupBy("site").agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("ok")).alias("errors"))
    return g.withColumn("success", F.col("errors") < F.col("total"))


def purge_crawl(led: DataFrame, requests: DataFrame, purged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Without the purged crawls' ledger rows and queued requests (those of one spider, if it is given)."""
    gone = F.broadcast(purged) if purged.isLocal() else purged
    kept = led.join(gone.select("crawlid").distinct(), "crawlid", "left_anti")
    p = gone.select(F.col("crawlid").alias("__c"), F.col("spiderid").alias("__s"))
    return kept, requests.join(p, (F.col("crawlid") == F.col("__c")) & (F.col("__s").isNull() | (F.col("spiderid") == F.col("__s"))), "left_anti")


def running(rows: DataFrame, keys: list[str], at: str, order: list[str], values: list[str], width: int = 86400) -> DataFrame:
    """rows with `run_<value>`: sums over a key's rows up to this one, in order (`at` first).

    Time is cut into buckets of `width`: sums by bucket, then their prefix sums (a row a bucket), then windows within a bucket. So no task
    has the whole history of a hot key.
    """
    x = rows.withColumn("__b", F.floor(F.col(at) / width))
    sums = x.groupBy(*keys, "__b").agg(*[F.sum(v).alias(f"__s_{v}") for v in values])
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    names = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    sums = sums.select(*names, F.col("__b").alias("__kb"), *[F.coalesce(F.sum(f"__s_{v}").over(before), F.lit(0)).alias(f"__p_{v}") for v in values])
    within = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"run_{v}": F.sum(v).over(within) for v in values})
    same = F.col("__b").eqNullSafe(F.col("__kb"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    x = x.join(sums, same).withColumns({f"run_{v}": (F.col(f"run_{v}") + F.col(f"__p_{v}")).cast("long") for v in values})
    return x.select(*rows.columns, *[f"run_{v}" for v in values])


def in_flight(points: DataFrame) -> DataFrame:
    """Running signed sum by app and site, and over all apps of the site."""
    order, hour = ["us", "event_id"], 3_600_000_000
    x = running(points, ["app", "site"], "us", order, ["value"], hour).withColumnRenamed("run_value", "backlog")
    return running(x, ["site"], "us", order, ["value"], hour).withColumnRenamed("run_value", "site_backlog")


def endpoint_health(log: DataFrame, most: int = 5, width: int = 1 << 16) -> DataFrame:
    """Failures since the last success; an endpoint with more than `most` at any time is dropped.

    An endpoint's log is cut into blocks of `width` sequence numbers. A block is reduced to what can be put together again: whether it has a success, its failures
    before the first and after the last one, and its longest run. Prefixes over the blocks (a row each) say how long a run enters a block. So no task has the
    whole log of a hot endpoint.
    """
    bad = F.when(F.col("ok"), 0).otherwise(1)
    block = ["endpoint", "__block"]
    x = log.withColumn("__block", F.floor(F.col("seq") / width))
    x = x.withColumn("__run", F.sum(1 - bad).over(Window.partitionBy(*block).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)))
    runs = x.groupBy(*block, "__run").agg(F.sum(bad).alias("__n"))
    blocks = runs.groupBy(*block).agg(
        (F.max("__run") > 0).cast("int").alias("__any"),
        F.coalesce(F.max(F.when(F.col("__run") == 0, F.col("__n"))), F.lit(0)).alias("__head"),
        F.max_by("__n", "__run").alias("__tail"),
        F.max("__n").alias("__worst"),
    )
    order = Window.partitionBy("endpoint").orderBy("__block")
    blocks = blocks.withColumn("__since", F.sum("__any").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    since = Window.partitionBy("endpoint", "__since").orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumn("__after", F.sum("__tail").over(since))  # a block without a success only adds to the run that enters it
    enters = F.coalesce(F.lag("__after").over(order), F.lit(0))
    blocks = blocks.withColumn("__longest", F.greatest("__worst", enters + F.col("__head")))
    worst = F.max("__longest")
    return blocks.groupBy("endpoint").agg(F.max_by("__after", "__block").cast("long").alias("failures"), worst.cast("long").alias("worst"), (worst > most).alias("dropped"))
