"""Sources: logs, topics, feeds, spreadsheets, relational scans, file manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields of a log record; fields that are absent are null, and all codes stay strings.
LOG_SCHEMA = "event_id long, logger string, level string, message string, appid string, crawlid string, spiderid string, host string, status_code string, parsed boolean, valid boolean, success boolean, ts string"


def read_logs(spark: SparkSession, path: str, stream: bool = False, schema: str = LOG_SCHEMA) -> DataFrame:
    """A1: JSON lines with a given schema, in batch or as a stream; a malformed line gives nulls."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).json(path)


def read_topic(spark: SparkSession, topic: str, schema: str, servers: str | None = None, path: str | None = None, options: dict | None = None) -> DataFrame:
    """A2: a stream of JSON messages, from Kafka or, without `servers`, from the files of a folder.

    Offsets are kept in the query's checkpoint. What doesn't parse has a null `message` and its text in
    `raw`, for split_errors() or streaming.consume(). options go to the source.
    """
    reader = spark.readStream.options(**(options or {}))
    if servers:
        raw = reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load().select(F.col("value").cast("string").alias("raw"))
    else:
        raw = reader.format("text").load(f"{path}/{topic}").select(F.col("value").alias("raw"))
    return raw.select("raw", F.from_json("raw", schema, {"mode": "PERMISSIVE"}).alias("message"))


def split_errors(messages: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """A2: what parsed, as columns; and what gave nothing, as text for the error route."""
    good = F.col(f"message.{key}").isNotNull()
    return messages.filter(good).select("message.*"), messages.filter(~good | F.col("message").isNull()).select("raw")


def read_feed(spark: SparkSession, path: str, mode: str = "url", crawlid: str = "") -> DataFrame:
    """A3: one URL or code a line, or (mode crawl) `crawlid    url`; BOM, CR and blank lines go, equal lines count once."""
    line = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), "[\r\n]+$", "")
    lines = spark.read.text(path).select(line.alias("line")).filter(F.trim("line") != "").distinct()
    if mode == "crawl":
        parts = F.split("line", "    ", 2)
        return lines.select(parts[0].alias("crawlid"), F.get(parts, F.lit(1)).alias("url"))
    return lines.select(F.lit(crawlid).alias("crawlid"), F.col("line").alias("url"))


def read_sheet(spark: SparkSession, path: str, keys=("Catalog Number", "parent_productid", "productid")) -> DataFrame:
    """A4: a sheet with a header; rows by the first non-empty key, each group as a list of row structs."""
    rows = spark.read.option("header", True).csv(path)
    have = [k for k in keys if k in rows.columns]
    key = F.coalesce(*[F.nullif(F.trim(F.col(f"`{k}`")), F.lit("")) for k in have])
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.select(key.alias("parent"), row.alias("row")).filter("parent is not null").groupBy("parent").agg(F.array_sort(F.collect_list("row")).alias("rows"))


#: Windows of a relational scan at most: the driver has a predicate for each.
MOST_WINDOWS = 4_096


def even_windows(ids: DataFrame, column: str, windows: int) -> list[str]:
    """Half-open windows of about equally many ids (a table of one column), as predicates on `column`, cut at their approximate quantiles. Null ids are in the first one."""
    at = [n / windows for n in range(1, windows)]
    cuts = sorted(set(ids.agg(F.percentile_approx(ids.columns[0], at, max(10_000, 20 * windows)).alias("q")).first()["q"] or [])) if at else []
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} > {a} and {column} <= {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"({column} <= {cuts[0]} or {column} is null)", *inner, f"{column} > {cuts[-1]}"]


def read_relational(spark: SparkSession, url: str, table: str, column: str, low: int | None = None, high: int | None = None, width: int = 10_000, where: str = "true", options: dict | None = None) -> DataFrame:
    """A5: id windows of one relational table, each a task; the filter runs in the database.

    With `low` and `high` the windows are half-open and `width` ids wide. Without them they have about `width` rows each, however the ids lie: the database says how many rows
    there are and between which ids, their ids alone are read in equal steps, and the windows are cut at the quantiles. There are MOST_WINDOWS at most.
    """
    options = options or {}
    if low is not None and high is not None:
        windows = [f"{column} >= {a} and {column} < {min(a + width, high)} and ({where})" for a in range(low, high, width)]
        return spark.read.jdbc(url, table, predicates=windows, properties=options)
    held = spark.read.jdbc(url, f"(select min({column}) as lo, max({column}) as hi, count(*) as n from {table} where {where}) b", properties=options).first()
    n = min(MOST_WINDOWS, -(-held[2] // width))
    if n > 1 and held[0] is not None:
        ids = spark.read.jdbc(url, f"(select {column} from {table} where {where}) i", column=column, lowerBound=held[0], upperBound=held[1] + 1, numPartitions=n, properties=options)
        windows = even_windows(ids, column, n)
    else:
        windows = ["1 = 1"]
    return spark.read.jdbc(url, table, predicates=[f"{w} and ({where})" for w in windows], properties=options)


def windowed_scan(rows: DataFrame, column: str, width: int, where: str) -> DataFrame:
    """A5 over a columnar table: the filter reaches the scan, and `window` is the row's id window."""
    return rows.filter(where).withColumn("window", F.floor(F.col(column) / width).cast("long"))


def read_manifest(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """A row a file: path, size and the MD5 of its content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.md5("content").alias("digest"))


def without_digest(manifest: DataFrame, digests: DataFrame) -> DataFrame:
    """Files whose digest is not on the list yet."""
    return manifest.join(digests.select("digest").distinct(), "digest", "left_anti")
