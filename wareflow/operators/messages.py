"""Message transformation: stages from message table to message table."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pages import storage_path


def compose(messages: DataFrame, stages: list[Callable[[DataFrame], DataFrame]], payload: str = "body") -> DataFrame:
    """H1: stages one after the other; a message whose result is empty is dropped after each."""
    for stage in stages:
        messages = messages.transform(stage).filter(F.coalesce(payload, F.lit("")) != "")
    return messages


def heavy(kind: Column, seed: Column, crawlid: Column) -> Column:
    """H2: seeds and explore messages take the heavy branch, unless the crawl id is a number of up to 5 digits."""
    return (seed | (kind == "explore")) & ~crawlid.rlike("^[0-9]{1,5}$")


def route(messages: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    c = F.coalesce(condition, F.lit(False))
    return messages.filter(c), messages.filter(~c)


def build_images(items: DataFrame, spider: str = "spiderid", urls: str = "image_urls") -> DataFrame:
    """H3: `images` (url, path, origin) of each item's image URLs, which go."""
    images = F.transform(urls, lambda u: F.struct(u.alias("url"), storage_path(F.col(spider), u, "filter").alias("path"), F.lit("source").alias("origin")))
    return items.withColumn("images", images).drop(urls)


def intake(entities: DataFrame, kind: str, target: str, order: str) -> DataFrame:
    """H4: entities of one type that lack the target value, one for each (item_id, item_type)."""
    want = entities.filter((F.split("item_type", "::")[0] == kind) & (F.coalesce(target, F.lit("")) == ""))
    rest = [c for c in want.columns if c not in ("item_id", "item_type", order)]
    one = want.groupBy("item_id", "item_type").agg(F.min(F.struct(order, *rest)).alias("f"))
    return one.select("item_id", "item_type", *[F.col(f"f.{c}").alias(c) for c in (order, *rest)])


#: Bytes of a memory, and words of the texts' most used ones, that every task may hold.
MEMORY_BYTES, HEAVY = 64 << 20, 200_000


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df as a new table in the folder that driver and executors share, so that it is computed once, and its path."""
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="spark-scratch-")
    path = f"{shared}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a table that _written() made and nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def _table(entries: DataFrame) -> dict[str, str]:
    """(src, dst) as a dict; without a dst a word stands for itself."""
    x = entries.select("src", F.coalesce("dst", "src").alias("dst")).toArrow()
    return dict(zip(x["src"].to_pylist(), x["dst"].to_pylist(), strict=True))


def _looked_up(rows: DataFrame, column: str, table: Broadcast, own: str | None = None) -> DataFrame:
    """(id, column) of rows with each segment of an array column replaced by its entry in a table that every task has, or (own) in a column of entries of its row.

    Entries are the memory's, the same in all rows, so those of a batch's rows are looked up together.
    """

    def replace(batches):
        known = table.value
        for b in batches:
            lists = b.column(column)
            rare = dict(zip(*(x.to_pylist() for x in b.column(own).flatten().flatten()), strict=True)) if own else {}
            different = lists.flatten().dictionary_encode()  # each word of the batch is looked up once
            words = pa.array([known.get(w, rare.get(w, w)) for w in different.dictionary.to_pylist()], pa.string()).take(different.indices)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32), mask=np.append(lists.is_null().to_numpy(zero_copy_only=False), False))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(offsets, words)], names=["id", column])

    return rows.mapInArrow(replace, rows.select("id", column).schema)


def _most_used(words: DataFrame, most: int) -> DataFrame:
    """Of (src, count) the words that occur most, `most` of them at most: as many whole steps of counts, each a sixteenth of a doubling, as have room."""
    step = F.floor(F.log2("count") * 16)
    least, room = None, most
    for r in sorted(words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        room -= r["n"]
        if room < 0:
            break
        least = r["step"]
    return words.filter(F.lit(False) if least is None else step >= least)


def _with_memory(rows: DataFrame, cut: Callable[[DataFrame], DataFrame], column: str, memory: DataFrame, most: int, heavy: int) -> DataFrame:
    """rows (id and what `cut` makes an array of segments of, in `column`) with the segments that a memory (src, dst; of equal src the least dst) knows replaced.

    A memory of `most` bytes at most is sent to all tasks, and nothing is shuffled. Of a larger one the entries of the `heavy` words that occur most are, and that a frequent word
    has none; then each row's other words are looked up once by a join, in which no word is frequent, and come back to their row as its own entries. Rows are shuffled for that
    before they are cut. ids are different. The memory is computed once, into a table that stays behind the result if it is a larger one.
    """
    spark = rows.sparkSession
    pairs = memory.filter("src is not null and dst is not null").groupBy("src", "dst").count().filter("count > 0")  # counted by hash; a least text alone would sort all rows of the memory
    one, path = _written(pairs.groupBy("src").agg(F.min("dst").alias("dst")), "memory")
    size = one.agg(F.sum(F.octet_length("src") + F.octet_length("dst") + 16)).first()[0] or 0
    if size <= most:
        held = spark.sparkContext.broadcast(_table(one))
        _drop(spark, path)
        return _looked_up(cut(rows), column, held)

    def counted(batches):
        for b in batches:
            words, n = pc.value_counts(b.column(column).flatten().drop_null()).flatten()
            yield pa.RecordBatch.from_arrays([words, n], names=["src", "n"])

    words = cut(rows).select(column).mapInArrow(counted, "src string, n long")
    used, counts = _written(words.groupBy("src").agg(F.sum("n").alias("count")), "words")
    held = spark.sparkContext.broadcast(_table(_most_used(used, heavy).join(one, "src", "left")))
    _drop(spark, counts)

    def rest(batches):
        known = held.value
        for b in batches:
            lists = b.column(column)
            words = lists.flatten().dictionary_encode()
            n = len(words.dictionary)
            rare = np.array([w not in known for w in words.dictionary.to_pylist()] + [False])
            code = pc.fill_null(words.indices, n).to_numpy()
            found = rare[code]
            at = np.unique(pc.list_parent_indices(lists).to_numpy()[found] * (n + 1) + code[found])  # a row's word once
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at // (n + 1))), words.dictionary.take(pa.array(at % (n + 1)))], names=["id", "src"])

    other = cut(rows).select("id", column).mapInArrow(rest, f"id {rows.schema['id'].dataType.simpleString()}, src string")
    own = other.join(one, "src").groupBy("id").agg(F.collect_list(F.struct("src", "dst")).alias("__own"))
    return _looked_up(cut(rows.join(own, "id", "left")), column, held, "__own")


def _rejoined(segments: DataFrame) -> DataFrame:
    """(id, text) of segments (id, pos, text) that follow one another as they were taken out of their row, so nothing is shuffled; another order is an error."""

    def joined(parts: list[pa.Table]):
        x = pa.concat_tables(parts).combine_chunks()
        begins = np.flatnonzero(pc.equal(x["pos"], 0).to_numpy())
        edges = np.append(begins, x.num_rows)
        if not len(begins) or begins[0] or not np.array_equal(x["pos"].to_numpy(), np.arange(x.num_rows) - np.repeat(begins, np.diff(edges))):
            raise ValueError("segments out of order")
        lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), x["text"].combine_chunks())
        return pa.table({"id": x["id"].take(pa.array(begins)), "text": pc.binary_join(lists, " ")}).to_batches()

    def run(batches):
        held: list[pa.Table] = []  # of a text that may go on
        for b in batches:
            b = pa.Table.from_batches([b])
            begins = np.flatnonzero(pc.equal(b["pos"], 0).to_numpy())
            if len(begins) and (held or begins[-1]):
                yield from joined([*held, b.slice(0, begins[-1])])
                held, b = [], b.slice(begins[-1])
            held.append(b)
        if held:
            yield from joined(held)

    return segments.mapInArrow(run, f"id {segments.schema['id'].dataType.simpleString()}, text string")


def translate(texts: DataFrame, memory: DataFrame | None, split: str = "[ \n]+", function: Callable[[Column], Column] | None = None, most: int = MEMORY_BYTES, heavy: int = HEAVY) -> DataFrame:
    """H5: (id, text) by segments: looked up in the memory (src, dst), or given to a user's function.

    Segments without an entry stay as they are; their order is kept. A text's segments stay in its row: with a memory of `most` bytes they are looked up where they are,
    with a larger one a row's different rare words are shuffled, and the texts once to meet what was found. A user's function gets the segments as rows, and they are put together again where they are. A null text gives no row.
    """
    if function is None:
        cut = lambda x: x.withColumn("parts", F.split("text", split)).drop("text")
        return _with_memory(texts.filter("text is not null").select("id", "text"), cut, "parts", memory, most, heavy).select("id", F.array_join("parts", " ").alias("text"))
    parts = texts.filter("text is not null").select("id", F.split("text", split).alias("parts"))
    done = parts.select("id", F.posexplode("parts").alias("pos", "src")).withColumn("dst", function(F.col("src")))
    return _rejoined(done.select("id", "pos", F.coalesce("dst", "src").alias("text")))


def translate_pairs(specs: DataFrame, memory: DataFrame, most: int = MEMORY_BYTES, heavy: int = HEAVY) -> DataFrame:
    """H5: a JSON list of texts taken by twos as name and value; an odd tail is dropped; the shape comes back. A list of less than two gives no row."""
    even = F.slice("s", F.lit(1), (F.floor(F.size("s") / 2) * 2).cast("int"))
    cut = lambda x: x.withColumn("s", F.from_json("specs", "array<string>")).drop("specs").withColumn("s", even).filter(F.size("s") > 0)
    return _with_memory(specs.select("id", "specs"), cut, "s", memory, most, heavy).select("id", F.to_json("s").alias("specs"))


def tag_segments(pages: DataFrame, key: str, html: str) -> DataFrame:
    """H6: the texts between tags (blank ones skipped), and the template in which {n} stands for text n."""
    marked = F.regexp_replace(html, "(<[^>]*>)", "\u0001$1\u0001")
    parts = F.filter(F.split(marked, "\u0001"), lambda x: x != "")
    x = pages.select(key, parts.alias("parts"))
    is_text = lambda p: ~p.rlike("^<[^>]*>$") & (F.trim(p) != "")
    texts = F.filter("parts", is_text)
    return x.select(key, "parts", texts.alias("texts"))


def fill_template(segments: DataFrame, key: str, translated: DataFrame) -> DataFrame:
    """H6: the page with its n-th text replaced by (key, pos, text) of `translated`, tags and blanks untouched."""
    p = segments.select(key, F.posexplode("parts").alias("at", "part"))
    text = ~F.col("part").rlike("^<[^>]*>$") & (F.trim("part") != "")
    n = F.sum(F.when(text, 1).otherwise(0)).over(Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    p = p.withColumn("pos", F.when(text, n - 1))
    j = p.join(translated.select(F.col(key), F.col("pos"), F.col("text").alias("__t")), [key, "pos"], "left")
    seg = F.struct("at", F.coalesce("__t", "part").alias("t"))
    return j.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(seg)), lambda x: x["t"]), "").alias("html"))


def merge_results(results: DataFrame, attempts: DataFrame, most: int = 10) -> DataFrame:
    """H7: success is an ENRICH row; failure is retried while under `most` attempts, then abandoned."""
    j = results.join(attempts, "item_id", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)) + F.when(F.col("ok"), 0).otherwise(1))
    return j.withColumn("outcome", F.when(F.col("ok"), "ENRICH").when(F.col("attempts") < most, "retry").otherwise("abandoned"))
