"""K-d tree sharding by distributed weighted medians, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, read

#: Positions lie in [0, 2**SPAN_BITS): a 24-bit coordinate and a 24-bit tie; a cut is found in histograms of 2**HALF buckets.
SPAN_BITS, HALF = 48, 12
#: Slots are counted in this many blocks a shard, so that no shard is numbered by one task.
BLOCKS = 64
#: Distinct values of a string among which ranks are taken.
VALUES = 1024
#: Tables of a row a node or a value are broadcast up to this length; of longer ones Spark chooses the join.
SMALL = 4096
#: Copies of one text are one unit of the tree up to this part of a shard; more of them are dealt into units of that size.
UNIT = 1 / 128
#: After so many levels the rows are written with their places so far, so that the plan doesn't grow with the tree.
LEVELS = 4


def _small(df: DataFrame, kept: Scratch, name: str, rows: int | None = None) -> DataFrame:
    """A written table, marked for a broadcast if it is short (rows: its length at most)."""
    df = kept.save(df, name)
    return F.broadcast(df) if (df.count() if rows is None else rows) <= SMALL else df


def _ranked(rows: DataFrame, column: str, kept: Scratch) -> DataFrame:
    """Add `d_<column>`: the rank of a string among the distinct values, scaled to 24 bits; null counts as empty and sorts first.

    Past VALUES distinct values the rank is that among VALUES of them, so that neighbours can share a coordinate.
    """
    values = rows.select(F.coalesce(column, F.lit("")).alias("__value")).distinct()
    known = values.orderBy(F.xxhash64("__value"), "__value").limit(VALUES).agg(F.collect_list("__value").alias("__known"))
    rank = F.size(F.filter("__known", lambda x: x <= F.col("__value")))
    ranked = values.crossJoin(F.broadcast(known)).select("__value", F.floor(rank * F.lit((1 << 24) - 1) / F.size("__known")).cast("long").alias(f"d_{column}"))
    ranked = _small(ranked, kept, "shard-values")
    return rows.withColumn("__value", F.coalesce(column, F.lit(""))).join(ranked, "__value").drop("__value")


def metadata_positions(rows: DataFrame, kept: Scratch) -> DataFrame:
    """Add the tree's dimensions, each a 24-bit coordinate: d_size (logarithmic), d_lang and d_source (ranks)."""
    size = F.least(F.lit((1 << 24) - 1), F.floor(F.log2(F.col("size") + F.lit(1.0)) * F.lit(1 << 18))).cast("long")
    return _ranked(_ranked(rows, "lang", kept), "source", kept).withColumn("d_size", size)


def kd_shards(rows: DataFrame, dims: list[str], weight: str, tie: str, kept: Scratch, shards: int | None = None, target_bytes: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Add `shard` to rows by a k-d tree over the 24-bit coordinates in `dims`.

    A node with k > 1 leaves is split along the dimension in which its rows spread widest, as a part of that
    dimension's whole range, at the weighted quantile floor(k/2)/k, which is the weighted median where k is even. Ties in a
    coordinate, such as those of a hot source, are ordered by `tie` (a 24-bit hash), so that a cut
    can fall inside one value; rows equal in coordinates and tie stay together. A node is named by its first shard. Each level takes five aggregations over
    all nodes at once: the spreads, and four histograms (each within the buckets in which the cuts fall). What they give, a row a node, is joined
    with the rows; it is broadcast for up to SMALL nodes.
    Give either `shards` or `target_bytes`; the latter makes ceil(total / target) leaves.
    Returns the rows with `shard` and the cuts of each level (__from, leaves, dim, cut). An empty table has no rows in them.
    """
    if shards is None:
        total = rows.agg(F.sum(weight)).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    spans = rows.agg(*[(F.max(d) - F.min(d)).alias(d) for d in dims]).first()
    whole = {d: max(1, spans[d] or 0) for d in dims}
    now = rows.withColumns({"__from": F.lit(0).cast("long"), "__leaves": F.lit(shards).cast("long")})
    most, level, cuts = shards, 0, []
    position = F.array(*[F.shiftleft(F.col(d), 24).bitwiseOR(F.col(tie)) for d in dims])
    half = F.floor(F.col("__leaves") / 2)
    while most > 1:
        nodes = min(shards, 1 << level)
        live = now.filter("__leaves > 1")
        spread = live.groupBy("__from", "__leaves").agg(F.sum(weight).alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in dims])
        widest = F.array_max(F.array(*[F.struct((F.col(d) / whole[d]).alias("part"), F.lit(-i).alias("i")) for i, d in enumerate(dims)]))
        table = spread.select(F.col("__from").alias("__f"), F.col("__leaves").alias("__l"), (-widest["i"]).cast("int").alias("dim"), (F.col("w") * half / F.col("__leaves")).alias("goal"), F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("base"))
        sent = lambda x, nodes=nodes: F.broadcast(x) if nodes <= SMALL else x
        shift = SPAN_BITS
        while shift:
            shift -= HALF
            at = live.withColumn("__p", position).join(sent(table), F.col("__from") == F.col("__f")).withColumn("__at", F.get("__p", F.col("dim")))
            at = at.filter(F.shiftright("__at", shift + HALF) == F.shiftright("base", shift + HALF))
            hist = at.groupBy("__f", "__l", "dim", "goal", "below", F.shiftright("__at", shift).alias("b")).agg(F.sum(weight).alias("n"))
            upto = F.sum("n").over(Window.partitionBy("__f").orderBy("b"))  # 2**HALF buckets a node at most
            hist = hist.withColumn("upto", F.col("below") + upto)
            # the first bucket that reaches beyond the goal, or the last one
            best = F.struct(F.when(F.col("upto") > F.col("goal"), 0).otherwise(1).alias("o"), F.when(F.col("upto") > F.col("goal"), F.col("b")).otherwise(-F.col("b")).alias("k"), "b", (F.col("upto") - F.col("n")).alias("below"))
            table = hist.groupBy("__f", "__l", "dim", "goal").agg(F.min(best).alias("x")).select("__f", "__l", "dim", "goal", F.col("x.below").alias("below"), F.shiftleft(F.col("x.b"), shift).alias("base"))
        table = _small(table, kept, "shard-nodes", nodes)  # all five steps in one go: each reads the one before once
        cut = table.select("__f", F.col("dim").alias("__dim"), F.col("base").alias("__cut"))
        cuts.append(table.select(F.col("__f").alias("from"), F.col("__l").alias("leaves"), "dim", F.col("base").alias("cut")))
        split = now.withColumn("__p", position).join(cut, F.col("__from") == F.col("__f"), "left")
        high = F.coalesce(F.get("__p", F.col("__dim")) >= F.col("__cut"), F.lit(False))
        one = F.col("__leaves") <= 1
        split = split.withColumns({"__from": F.when(one | ~high, F.col("__from")).otherwise(F.col("__from") + half), "__leaves": F.when(one, F.col("__leaves")).when(high, F.col("__leaves") - half).otherwise(half)})
        now = split.select(*rows.columns, "__from", "__leaves")
        most, level = most - most // 2, level + 1
        if level % LEVELS == 0 and most > 1:
            now = kept.save(now, "shard-placed")
    return now.withColumn("shard", F.col("__from").cast("int")).drop("__from", "__leaves"), cuts


def number_slots(rows: DataFrame, shard: str, order: list[str], shards: int) -> DataFrame:
    """Add `slot`, gapless from 0 in each shard, without gathering a shard in one task.

    Rows are numbered within shard and block (a hash of the order columns), on top of the counts of
    the blocks before; that table has at most shards * BLOCKS rows and is broadcast up to 2**17.
    """
    blocks = rows.withColumn("__block", F.pmod(F.xxhash64(*order), F.lit(BLOCKS)).cast("int"))
    counts = blocks.groupBy(shard, "__block").count()
    before = Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "__block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(shard, "__block").orderBy(*order)
    joined = blocks.withColumn("__n", F.row_number().over(within)).join(F.broadcast(starts) if shards * BLOCKS <= 1 << 17 else starts, [shard, "__block"])
    return joined.withColumn("slot", F.col("__start") + F.col("__n").cast("long") - 1).drop("__block", "__n", "__start")


def shard_documents(docs: DataFrame, shards: int | None = 16, target_bytes: int | None = None) -> DataFrame:
    """Shard a table with doc_id, text, lang and source under the law `bytes`: sizes near equal.

    size is the text's UTF-8 bytes (null: none) plus 1; text_crc32 that of the bytes (null: of none). Equal texts go to one
    shard together, under the least of their languages and sources, unless they fill more than UNIT of a shard: then they are dealt into units of
    that size by doc_id. Null texts and empty ones are equal texts.
    Repeated rows are rows like any other; null lang, source or doc_id sort first. An empty table
    gives an empty result. Other columns of docs are ignored.
    """
    kept = Scratch()
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    text = F.coalesce("text", F.lit(""))
    slim = docs.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("same"), "lang", "source")
    slim = kept.save(slim, "shard-rows")
    total = slim.agg(F.sum("size")).first()[0] or 0
    unit = max(1, int((target_bytes or total / shards) * UNIT))
    # copies: their least language and source, and into how many units they are dealt
    groups = slim.groupBy("same", "size").agg(F.count(F.lit(1)).alias("n"), F.min("lang").alias("g_lang"), F.min("source").alias("g_source")).filter("n > 1")
    groups = kept.save(groups.select(F.col("same").alias("g_same"), F.col("size").alias("g_size"), "g_lang", "g_source", F.ceil(F.col("n") * F.col("size") / unit).alias("units")), "shard-copies")
    rows = slim.join(groups, (F.col("same") == F.col("g_same")) & (F.col("size") == F.col("g_size")), "left")
    copy = F.col("units").isNotNull()
    rows = rows.withColumns({"lang": F.when(copy, F.col("g_lang")).otherwise(F.col("lang")), "source": F.when(copy, F.col("g_source")).otherwise(F.col("source"))})
    deal = F.when(F.col("units") > 1, F.pmod(F.xxhash64("doc_id"), F.col("units"))).otherwise(0)
    rows = rows.select("doc_id", "size", "text_crc32", "lang", "source", F.shiftrightunsigned(F.xxhash64("same", deal), 40).alias("tie"))
    dims = ["d_size", "d_lang", "d_source"]
    rows = kept.save(metadata_positions(kept.save(rows, "shard-units"), kept).select("doc_id", "size", "text_crc32", *dims, "tie"), "shard-positions")
    out, _ = kd_shards(rows, dims, "size", "tie", kept, shards, target_bytes)
    out = kept.result(out.select("doc_id", "size", "text_crc32", "shard"), "shard-shards")
    out = number_slots(out, "shard", ["doc_id", "text_crc32", "size"], shards or 1 << 20)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op1_kd_shards(spark, sf_dir):
    """All documents in shards 0 to 15 under the law `bytes`: doc_id, size, text_crc32, law, shard, slot, grown_shard (null)."""
    return shard_documents(read(spark, sf_dir, "documents"), shards=16)
