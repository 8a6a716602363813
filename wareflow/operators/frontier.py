"""Frontier and refresh planning: dispatch, de-duplication, due items, retries, search reports."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ledger import running


def _cut(counts: DataFrame, keys: list[str], by: str, order: Column, most: str) -> DataFrame:
    """Of counted rows (keys, by, __n) those that begin before a key's `most` rows are full, with `__left`: how many rows are left for them."""
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("__left", F.col(most) - before).filter("__left > 0")


def dispatch_plan(requests: DataFrame, per_minute: Column, minutes: int, width: int = 1 << 12) -> DataFrame:
    """G1: by spider the k requests of highest priority, k = pace * minutes (a column; a spider's largest holds until the end); ties by insertion (`seq`, a number).

    A queue is not sorted. Its requests are counted by priority, which tells the priority at which k is full; those of that priority are counted by
    `width` sequence numbers, which tells the ones that can still be of the k. Only what is left, k requests and a last step's, is ranked.
    """
    x = requests.withColumn("__k", per_minute * minutes)
    spider = x["spiderid"]
    levels = x.groupBy("spiderid", "priority").agg(F.count(F.lit(1)).alias("__n"), F.max("__k").alias("__most"))
    levels = levels.withColumn("__most", F.max("__most").over(Window.partitionBy("spiderid")))
    levels = _cut(levels, ["spiderid"], "priority", F.desc("priority"), "__most")
    levels = levels.select(F.col("spiderid").alias("__s"), F.col("priority").alias("__p"), F.col("__n").alias("__of"), "__left")
    x = x.join(levels, spider.eqNullSafe(F.col("__s")) & x["priority"].eqNullSafe(F.col("__p")))
    whole, last = x.filter("__of <= __left"), x.filter("__of > __left").withColumn("__step", F.floor(F.col("seq") / width))
    steps = last.groupBy("spiderid", "__step").agg(F.count(F.lit(1)).alias("__n"), F.max("__left").alias("__most"))
    steps = _cut(steps, ["spiderid"], "__step", F.asc("__step"), "__most").select(F.col("spiderid").alias("__s2"), F.col("__step").alias("__t"))
    last = last.join(steps, F.col("spiderid").eqNullSafe(F.col("__s2")) & F.col("__step").eqNullSafe(F.col("__t")), "left_semi")
    left = whole.select(*requests.columns, "__k").unionByName(last.select(*requests.columns, "__k"))
    rank = F.row_number().over(Window.partitionBy("spiderid").orderBy(F.desc("priority"), "seq"))
    return left.withColumn("rank", rank).filter("rank <= __k").drop("__k")


def derived_priority(kind: Column, parent: Column, adjust: int = -1) -> Column:
    """An item is 20 below its parent, a next page equal to it, a follow-up one above, a retry adjusted."""
    return F.when(kind == "item", parent - 20).when(kind == "next", parent).when(kind == "follow", parent + 1).otherwise(parent + adjust)


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. The least order is an aggregate, so a hot key costs no more than others."""
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("f"))
    return first.select(*keys, *[F.col(f"f.{c}").alias(c) for c in rest])


def distinct_in_order(values: Column) -> Column:
    """An array's distinct values in the order of their first place."""
    return F.array_distinct(values)


def distinct_by(rows: DataFrame, outer: str, key: str, keep: str, order: str) -> DataFrame:
    """By identity `key`, the value `keep` of its first row, in order."""
    first = rows.groupBy(outer, key).agg(F.min(F.struct(order, keep)).alias("f"))
    return first.groupBy(outer).agg(F.transform(F.array_sort(F.collect_list("f")), lambda x: x[keep]).alias("kept"))


def latest_messages(messages: DataFrame, ts: list[str]) -> DataFrame:
    """The latest message of each id, unless it is a delete."""
    rest = [c for c in messages.columns if c != "item_id"]
    last = messages.groupBy("item_id").agg(F.max_by(F.struct(*rest), F.struct(*ts)).alias("m"))
    return last.select("item_id", *[F.col(f"m.{c}").alias(c) for c in rest]).filter("event <> 'delete'")


def due_items(messages: DataFrame, delays: DataFrame, now: int, default: int) -> DataFrame:
    """Due is the explicit date, else the last message plus the site's delay (default where 0 or missing)."""
    wait = F.coalesce(F.nullif(F.col("update_interval"), F.lit(0)), F.lit(default))
    x = messages.join(delays, "site", "left").withColumn("due", F.coalesce("due_date", F.col("sec") + wait).cast("long"))
    return x.filter(F.col("due") <= now)


def refresh_batches(due: DataFrame, now: int, closed: dict[str, int], size: int = 5000, schedule: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Due items by site in chunks; one row an id, no blank site, and no site on its closed weekday (0 = Monday).

    schedule (U4), where given, is a further predicate of a site and the time (a timestamp column): its rows stay due where it is false or null.
    """
    weekday = (now // 86400 + 3) % 7
    shut = [s for s, d in closed.items() if d == weekday]
    if schedule is not None:
        due = due.filter(schedule(F.col("site"), F.timestamp_seconds(F.lit(now))))
    one = due.filter((F.coalesce("site", F.lit("")) != "") & ~F.col("site").isin(shut)).groupBy("item_id").agg(F.min_by(F.struct("site", "due"), F.struct("due", "site")).alias("x")).select("item_id", "x.site", "x.due")
    at = running(one.withColumn("__one", F.lit(1)), ["site"], "due", ["due", "item_id"], ["__one"])
    return at.select(*one.columns, F.floor((F.col("run___one") - 1) / size).cast("long").alias("chunk"))


def redelay(sent: DataFrame, results: DataFrame, now: int, cycle: int) -> DataFrame:
    """What was sent is due in the next cycle, what failed (or got no answer) at once."""
    return sent.join(results, "item_id", "left").select("item_id", F.when(F.coalesce("ok", F.lit(False)), F.lit(now + cycle)).otherwise(F.lit(now)).cast("long").alias("due"))


def reconcile_store(stored: DataFrame, queues: list[DataFrame]) -> DataFrame:
    """Stored - (input + output + scheduled), of counts: one row."""
    counts = [stored.agg(F.count(F.lit(1)).alias("stored"))] + [q.agg(F.count(F.lit(1)).alias(f"q{i}")) for i, q in enumerate(queues)]
    row = counts[0]
    for c in counts[1:]:
        row = row.crossJoin(c)  # single rows
    lost = F.col("stored")
    for i in range(len(queues)):
        lost = lost - F.col(f"q{i}")
    return row.select("stored", lost.alias("difference"), (lost != 0).alias("wrong"))


def retry_plan(log: DataFrame, most: int, adjust: int = -10) -> DataFrame:
    """URLs without a success: requeued with a lower priority up to `most` attempts, then failed; listings always requeued."""
    g = log.groupBy("url_key").agg(F.count(F.lit(1)).alias("attempts"), F.max("ok").alias("done"), F.max_by("listing", "attempt_seq").alias("listing")).filter("not done")
    again = F.col("listing") | (F.col("attempts") <= most)
    return g.select("url_key", "attempts", "listing", F.when(again, "requeue").otherwise("failed").alias("action"), F.when(again, F.col("attempts") * adjust).cast("long").alias("priority"), F.when(F.col("listing"), 1).otherwise(0).alias("extra_total"))


def search_positions(listings: DataFrame, own: DataFrame, n: int) -> DataFrame:
    """1-based rank in listing order, of own shops' rows only, on the first min(pages, 2n) pages.

    Later pages don't change a rank, so they go before the ranking, which thus sees 2n pages a query.
    """
    w = Window.partitionBy("query").orderBy("page", "pos")
    x = listings.filter(F.col("page") <= 2 * n).withColumn("rank", F.row_number().over(w))
    return x.join(own, "shop", "left_semi").select("query", "shop", "page", "rank")


def _without(needle: str, state: int, text: str) -> tuple[str, int]:
    """text without a needle, from the left, when its first `state` letters stand open before it; what is certain of it, and the letters that are open after it."""
    if not needle:
        return text, 0
    pieces = (needle[:state] + text).split(needle)
    last = pieces[-1]
    held = next((k for k in range(min(len(needle) - 1, len(last)), 0, -1) if last.endswith(needle[:k])), 0)
    out = "".join(pieces)
    return out[: len(out) - held], held


#: Bytes of an Arrow batch of chunks.
BATCH = 2 << 20


def _bounded(spark: SparkSession) -> None:
    """Let Arrow batches of this session be of BATCH bytes, unless it has a size of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name).rstrip("b") == str(64 << 20):  # Spark's default
        spark.conf.set(name, BATCH)


def residue_chunks(titles: DataFrame, group: str, word: Column, stop: list[str], keep: str = "[^a-z]", width: int = 64) -> DataFrame:
    """G14 in chunks: (group, chunk, residue); a group's residues in the order of its chunks are its whole residue. A chunk has the titles of `width` positions.

    A word may begin in one chunk and end in a later one. For each number of its letters that may stand open before a chunk, the chunk says how many are open after it; these small
    tables are put one after the other by group, which gives what stands open before each chunk, and the chunk's text is then cut by itself. So the words are removed one after the
    other, as from one text, and no task has the text of a group.
    """
    _bounded(titles.sparkSession)
    x = titles.select(group, "pos", F.regexp_replace(F.lower("title"), keep, "").alias("title"), F.coalesce(word, F.lit("")).alias("__w"), F.floor(F.col("pos") / width).cast("long").alias("chunk"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))), lambda t: t["title"]), "")
    chunks = x.groupBy(group, "chunk").agg(text.alias("text"), F.max("__w").alias("__w"))
    kind = f"`{group}` {titles.schema[group].dataType.simpleString()}"

    def cut(row: dict, n: int) -> str:
        """The chunk's text after the first n words, by what stood open before it; the group's last chunk has no letters open."""
        text = row["text"]
        for needle, state in zip([row["__w"], *stop][:n], row["open"] or [], strict=True):
            text, held = _without(needle, state, text)
            text += needle[:held] if row["last"] else ""
        return text

    def leads(n: int):
        def run(batches):
            for b in batches:
                rows = b.to_pylist()
                words = [[r["__w"], *stop][n] for r in rows]
                ends = [[_without(w, s, t)[1] for s in range(max(1, len(w)))] for w, t in zip(words, (cut(r, n) for r in rows), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(group), b.column("chunk"), pa.array(ends, pa.list_(pa.int32()))], names=[group, "chunk", "ends"])

        return run

    def follow(batches):
        for b in batches:
            opens = []
            for ends in b.column("ends").to_pylist():
                state, out = 0, []
                for e in ends:
                    out.append(state)
                    state = e[state]
                opens.append(out)
            yield b.append_column("open", pa.array(opens, pa.list_(pa.int32())))

    last = chunks.groupBy(F.col(group).alias("__g")).agg(F.max("chunk").alias("__last"))
    known = chunks.select(group, "chunk").join(last, F.col(group).eqNullSafe(F.col("__g"))).select(group, "chunk", (F.col("chunk") == F.col("__last")).alias("last"), F.array().cast("array<int>").alias("open"))

    def at(known):
        k = known.select(F.col(group).alias("__g"), F.col("chunk").alias("__c"), "last", "open")
        return chunks.join(k, chunks[group].eqNullSafe(k["__g"]) & (chunks["chunk"] == k["__c"])).select(group, "chunk", "text", "__w", "last", "open")

    for n in range(1 + len(stop)):
        ends = at(known).mapInArrow(leads(n), f"{kind}, chunk long, ends array<int>")
        lists = ends.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("chunk", "ends"))).alias("c")).select(group, F.col("c.chunk").alias("chunks"), F.col("c.ends").alias("ends"))
        found = lists.mapInArrow(follow, f"{kind}, chunks array<long>, ends array<array<int>>, open array<int>")
        found = found.select(F.col(group).alias("__g"), F.explode(F.arrays_zip("chunks", "open")).alias("z")).select("__g", F.col("z.chunks").alias("__c"), F.col("z.open").alias("__o"))
        known = known.join(found, known[group].eqNullSafe(found["__g"]) & (known["chunk"] == found["__c"])).select(group, "chunk", "last", F.array_append("open", F.col("__o")).alias("open"))

    def done(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(group), b.column("chunk"), pa.array([cut(r, 1 + len(stop)) for r in b.to_pylist()], pa.string())], names=[group, "chunk", "residue"])

    return at(known).mapInArrow(done, f"{kind}, chunk long, residue string")


#: Letters of a residue that is given as one text.
RESIDUE = 1 << 28


def keyword_residue(titles: DataFrame, group: str, word: Column, stop: list[str], keep: str = "[^a-z]", most: int = RESIDUE, width: int = 64) -> DataFrame:
    """A group's titles in one text, without the search word, stop words and characters outside the class.

    The residue is made in chunks; as one text it has `most` letters at most, more are an error, and residue_chunks() has no such bound. A group's search word is the same in all its rows.
    """
    chunks = residue_chunks(titles, group, word, stop, keep, width)
    size = F.sum(F.length("residue"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "residue"))), lambda c: c["residue"]), "")
    return chunks.groupBy(group).agg(F.when(size > most, F.raise_error(F.lit(f"a residue of more than {most} letters"))).otherwise(text).alias("residue"))
