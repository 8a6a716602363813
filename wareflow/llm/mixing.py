"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, Scratch, bounded, read
from .words import mix as spread

#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (5, 2, 1)
#: The mix has this many times the words of the corpus; a source gives this many times its own at most.
SHARE, CAP = 1.5, 2.0
#: Rows that one task rounds one after the other, and residuals that one node of the tree combines.
BLOCK, FAN = 1_000, 256
#: Equal rows that are given back by one array.
CHUNK = 10_000

ROUNDED = "source string, key long, doc_id long, size long, frac double, extra int"


def numbered(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Add `rank` (from 0) to a table with a row a source: by code point, null last. No task holds all of them."""
    order = [F.col("source").isNull(), F.col("source")]
    kept = sources.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    kept = scratch.save(kept, "mix-sources")
    counts = kept.groupBy("__part").count()  # a row a partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("__part").alias("__p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return kept.withColumn("__n", place).join(F.broadcast(counts), F.col("__part") == F.col("__p")).withColumn("rank", F.col("__before") + F.col("__n") - 1).drop("__part", "__p", "__n", "__before")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, scratch: Scratch | None = None) -> DataFrame:
    """Add `target`, the words to take from each source, to a table with source and source_size (a row a source).

    Shares go by weight; a source whose share is over cap times its size stops there, and the rest is shared anew among the
    others until none is over. A round takes one aggregate; the driver gets one row a round, however many sources there are.
    A source without words gets 0.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    scratch = scratch or Scratch()
    t = scratch.save(numbered(sources, scratch).withColumn("weight", w), "mix-weights")
    size = F.col("source_size").cast("double")
    total = share * (t.agg(F.sum(size)).first()[0] or 0.0)
    left, heavy = total, t.agg(F.sum("weight")).first()[0] or 1.0
    while True:
        over = (F.lit(left) * F.col("weight") / F.lit(heavy)) > cap * size
        r = t.agg(F.sum(F.when(over, cap * size)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        now = (total - (r["full"] or 0.0), r["weight"] or 1.0)
        if now == (left, heavy):
            return t.select("source", "source_size", F.when(over, cap * size).otherwise(F.lit(left) * F.col("weight") / F.lit(heavy)).alias("target"))
        left, heavy = now


def pivot(pdf: pd.DataFrame, level: int = 0) -> pd.DataFrame:
    """Round the fractions of one block: pairs trade mass until one of them is 0 or 1.

    Mass moves in words (fraction times size), so the words that the block takes stay the same up to
    one residual row, and each row's fraction is kept in expectation. Large rows trade first, so that the
    residual tends to be a small one. A trade's random number comes from the key of the row that enters it and the level of the tree, so that no
    two trades share one. At most one row comes back with a fraction other than 0 or 1.
    """
    pdf = pdf.sort_values(["size", "key", "doc_id"], ascending=False, kind="stable").reset_index(drop=True)
    p, s = pdf["frac"].to_numpy(float).copy(), pdf["size"].to_numpy(float)
    with np.errstate(over="ignore"):
        u = spread(pdf["key"].to_numpy(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1))
    u = (u >> np.uint64(11)).astype(float) / float(1 << 53)
    held = -1
    for i in range(len(p)):
        if not 0 < p[i] < 1:
            continue
        if held < 0:
            held = i
            continue
        j, mi, mj = held, p[i] * s[i], p[held] * s[held]
        up = min(s[i] - mi, mj)  # words that i can win from the held row
        down = min(mi, s[j] - mj)  # words that it can lose to it
        moved = up if u[i] * (up + down) < down else -down
        mi, mj = mi + moved, mj - moved
        eps = 1e-9
        p[i] = 0.0 if mi <= eps else 1.0 if mi >= s[i] - eps else mi / s[i]
        p[j] = 0.0 if mj <= eps else 1.0 if mj >= s[j] - eps else mj / s[j]
        held = i if 0 < p[i] < 1 else j if 0 < p[j] < 1 else -1
    pdf["frac"], pdf["extra"] = p, np.where(p == 1.0, 1, 0)
    return pdf[["source", "key", "doc_id", "size", "frac", "extra"]]


def _deal(level: int):
    return lambda pdf: pivot(pdf, level).assign(block=pdf["block"].iloc[0])


def mix(docs: DataFrame, sizes, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 0, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Copies of each row so that each source gives near its target of words.

    docs needs doc_id and source; sizes is the column with a row's words. Returns doc_id, source,
    size, source_size, target, copies and taken = copies * size. A source's fraction of its words is
    target / source_size = whole copies + a fractional probability; the fractions are rounded within
    blocks (a hash of the row's key, about `block` rows each), and the blocks' residual rows meet in
    groups of `fan` until a source has one, which goes to the nearer whole number. A source's taken
    words miss its target by half the size of that one row at most. A null source is a source of its own, the last.
    Rows of size 0, such as those with null or empty texts, are taken 0 words, with the whole copies
    of their source. Rows equal in id, source and size (repeated rows, null ids) are counted first: n of them with fraction f are n * f whole
    copies and one fraction, so that however many there are, they are one row of one block. Reruns agree for the same rows.
    """
    bounded(docs.sparkSession)
    kept = Scratch()
    rows = docs.select("doc_id", "source", sizes.cast("long").alias("size")).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = kept.save(rows.withColumn("key", F.xxhash64("doc_id", "source", "size", F.lit(seed))), "mix-rows")
    per = kept.save(rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("size") * F.col("n")).alias("source_size")), "mix-sizes")
    goal = targets(per.select("source", "source_size"), weights, share, cap, kept).select(F.col("source").alias("__t"), "target")
    share_of = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    plan = per.join(goal, F.col("source").eqNullSafe(F.col("__t"))).select(F.col("source").alias("__s"), "source_size", "target", share_of.alias("per_row"), F.ceil(F.col("rows") / block).alias("blocks"))
    plan = kept.save(plan, "mix-plan")
    most = plan.agg(F.max("blocks"), F.count(F.lit(1))).first()
    rows = rows.join(F.broadcast(plan) if most[1] < 10_000 else plan, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    whole = F.floor(F.col("per_row") + F.lit(1e-12))
    frac = F.when(F.col("size") == 0, 0.0).otherwise(F.greatest(F.col("per_row") - whole, F.lit(0.0)))
    rows = rows.withColumns({"whole": whole.cast("long"), "of_all": F.when(frac < 1e-12, 0.0).otherwise(frac) * F.col("n")})
    rows = rows.withColumns({"sure": F.floor(F.col("of_all") + F.lit(1e-9)).cast("long"), "frac": F.greatest(F.col("of_all") - F.floor(F.col("of_all") + F.lit(1e-9)), F.lit(0.0))})
    rows = kept.save(rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks"))).drop("of_all", "blocks", "per_row"), "mix-shares")
    fractional, done, level, most = rows.filter("frac > 0").select("source", "key", "doc_id", "size", "frac", "block"), [], 0, most[0] or 1
    while True:
        out = kept.save(fractional.groupBy("source", "block").applyInPandas(_deal(level), ROUNDED + ", block long"), f"mix-level{level}")
        done.append(out.filter("frac in (0, 1)"))
        rest = out.filter("frac > 0 and frac < 1")
        if most <= 1:
            # one row a source at most: the nearer whole number
            done.append(rest.withColumn("extra", (F.col("frac") >= 0.5).cast("int")))
            break
        most, level = -(-most // fan), level + 1
        fractional = rest.withColumn("block", F.floor(F.col("block") / fan))
    extra = done[0]
    for d in done[1:]:
        extra = extra.unionByName(d)
    e = extra.filter("extra = 1").select(F.col("key").alias("ek"), F.col("doc_id").alias("ed"), F.col("source").alias("eo"), F.col("size").alias("es"))
    same = (F.col("key") == F.col("ek")) & F.col("doc_id").eqNullSafe(F.col("ed")) & F.col("source").eqNullSafe(F.col("eo")) & (F.col("size") == F.col("es"))
    out = rows.join(e, same, "left").withColumn("more", F.col("sure") + F.when(F.col("ek").isNotNull(), 1).otherwise(0))
    # n equal rows: `more` of them get one copy more than the others
    chunk = lambda n: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / CHUNK)), lambda i: F.least(F.lit(CHUNK), n - i * CHUNK))
    part = lambda n, copies: F.when(n > 0, F.transform(chunk(n), lambda k: F.struct(k.cast("int").alias("k"), copies.cast("int").alias("copies")))).otherwise(F.expr("array()"))
    out = out.withColumn("__part", F.explode(F.concat(part(F.col("more"), F.col("whole") + 1), part(F.col("n") - F.col("more"), F.col("whole")))))
    out = out.withColumn("__one", F.explode(F.sequence(F.lit(1), F.col("__part.k")))).withColumn("copies", F.col("__part.copies"))
    return kept.result(out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")), "mix-copies")


def word_count(text):
    """How many words a text has: the places where a word begins (null: 0)."""
    t = F.translate(F.coalesce(text, F.lit("")), SPACES, "      ")
    gaps = F.concat(F.lit(" "), t)
    return F.regexp_count(gaps, F.lit(r"\x20[^\x20]")).cast("long")


def op10_mixing(spark, sf_dir):
    """The mix of all documents: doc_id, size, source_size (long), target (double), taken (long); a row a row of documents."""
    found = mix(read(spark, sf_dir, "documents"), word_count(F.col("text")))
    return found.select("doc_id", "size", "source_size", "target", "taken")
