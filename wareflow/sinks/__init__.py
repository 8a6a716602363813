"""Sinks: task files, routed topics and collections, metric points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tasks(items: DataFrame, path: str, version: str) -> str:
    """JSON lines by spider and crawl, under a version of their own; older output stays beside it."""
    to = f"{path}/version={version}"
    items.repartition("spiderid", "crawlid").write.partitionBy("spiderid", "crawlid").json(to)
    return to


def route_topics(messages: DataFrame, topics: dict[str, str], default: str) -> DataFrame:
    """`topic` by command, and `stamp`: without a command the epoch seconds as yyyyMMddHHmmss (UTC)."""
    table = F.create_map(*[F.lit(x) for pair in topics.items() for x in pair])
    none = F.coalesce("command", F.lit("")) == ""
    whole = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=F.floor("timestamp").cast("decimal(18,6)"))
    stamp = F.when(none, F.date_format(whole, "yyyyMMddHHmmss")).otherwise(F.floor("timestamp").cast("string"))
    return messages.withColumns({"topic": F.coalesce(F.try_element_at(table, F.coalesce("command", F.lit(""))), F.lit(default)), "stamp": stamp})


def write_topics(messages: DataFrame, path: str | None = None, servers: str | None = None, batch: str | None = None) -> None:
    """To Kafka by the column `topic`, or to folders by topic.

    With the name of a `batch`, folders replace what they have under that name, and Kafka messages carry it as a header, by which a reader knows what came twice.
    """
    out = messages.select("topic", F.to_json(F.struct(*[c for c in messages.columns if c != "topic"])).alias("value"))
    if servers:
        if batch is not None:
            out = out.withColumn("headers", F.array(F.struct(F.lit("batch").alias("key"), F.lit(batch).cast("binary").alias("value"))))
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    elif batch is None:
        out.write.mode("append").partitionBy("topic").text(path)
    else:
        out.write.mode("overwrite").partitionBy("topic").text(f"{path}/{BATCH}={batch}")


#: The folder level that has a batch's name.
BATCH = "batch_id"


def append_by(rows: DataFrame, path: str, column: str, batch: str | None = None) -> None:
    """Append, a folder for each value of the column (collection or logger).

    With the name of a `batch`, what is there under that name is replaced, so that a batch that is written again is there once.
    """
    if batch is None:
        rows.write.mode("append").partitionBy(column).parquet(path)
    else:
        rows.write.mode("overwrite").partitionBy(column).parquet(f"{path}/{BATCH}={batch}")


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that append_by wrote."""
    return spark.read.parquet(path).drop(BATCH)


def metric_points(items: DataFrame, measurement: str, tags: list[str], value: Column) -> DataFrame:
    """(measurement, tags, time, value) of rows with a site; the others are skipped."""
    return items.filter(F.coalesce(F.col("site").cast("string"), F.lit("")) != "").select(F.lit(measurement).alias("measurement"), *tags, "sec", value.alias("value"))
