"""Near-duplicate vectors by NN-descent on neighbour lists, with a recall audit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bounded, read
from .components import components

#: Length of a neighbour list at first and at most (a saturated list doubles), and sorted orders (each by its own random code) for the first lists.
NEIGHBOURS, LONGEST, ORDERS, REACH = 10, 20, 10, 4
#: First vectors a label that the audit compares with all (eight times as many in each further step), the vectors
#: with links that it must have seen before it trusts a label, and vectors in a block of the exact scan.
AUDIT, LINKED, BLOCK = 256, 300, 1024
#: Labels whose sizes are broadcast at most.
LABELS = 20_000


def clean(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """The rows that can link, folded by equal vector and label: key, g (label and length), vec, n, least."""
    v = F.col("vec")
    x = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label"))
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    good = x.filter(F.col("label").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda e: e != 0))
    g = F.xxhash64(F.col("label").cast("string"), F.size("vec"))
    good = good.select("id", "vec", g.alias("g"), F.xxhash64("vec", g).alias("key"))
    return good


def _matrix(column) -> np.ndarray:
    """A column of lists of one length as a matrix of unit rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    m = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _by_length(column):
    """Row numbers by list length: vectors of one group have one length, a batch may hold several."""
    n = np.diff(np.asarray(column.offsets))
    return [(k, np.flatnonzero(n == k)) for k in np.unique(n)]


def first_lists(classes: DataFrame, seed: int, orders: int = ORDERS, reach: int = REACH) -> DataFrame:
    """Pairs that stand within `reach` places in one of several orders by random hyperplane codes."""

    def code(batches):
        for b in batches:
            for k, rows in _by_length(b.column("vec")):
                planes = np.random.default_rng([seed, int(k)]).standard_normal((int(k), orders, 20))
                at = pa.array(rows)
                unit = _matrix(b.column("vec").take(at))
                bits = np.einsum("nk,kob->nob", unit, planes) > 0
                codes = (bits * (1 << np.arange(20)[::-1])).sum(axis=2)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel())) for x in (unit, codes)]
                yield pa.RecordBatch.from_arrays([b.column("key").take(at), b.column("g").take(at), *lists], names=["key", "g", "vec", "codes"])

    coded = classes.select("key", "g", "vec").mapInArrow(code, "key long, g long, vec array<double>, codes array<long>")
    dealt = coded.select("key", "g", "vec", F.posexplode("codes").alias("o", "code")).repartition("g", "o", F.shiftright("code", 14)).sortWithinPartitions("g", "o", "code", "key")

    def near(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            t = t.combine_chunks()
            g, o, key = (t.column(c).to_numpy() for c in ("g", "o", "key"))
            vec = t.column("vec").combine_chunks()
            new = 0 if held is None else held.num_rows
            a, c, s = [], [], []
            lengths = np.diff(np.asarray(vec.offsets))
            flat, begin = vec.values.to_numpy(zero_copy_only=False), np.asarray(vec.offsets)
            for d in range(1, reach + 1):
                j = np.arange(max(new, d), t.num_rows)
                j = j[(g[j] == g[j - d]) & (o[j] == o[j - d]) & (key[j] != key[j - d])]
                for k in np.unique(lengths[j]):
                    i = j[lengths[j] == k]
                    x, y = flat[begin[i][:, None] + np.arange(k)], flat[begin[i - d][:, None] + np.arange(k)]
                    sim = (x * y).sum(axis=1)
                    a.append(key[i])
                    c.append(key[i - d])
                    s.append(sim)
            held = t.slice(max(0, t.num_rows - reach))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in (a, c, s)], names=["a", "b", "sim"])

    return dealt.mapInArrow(near, "a long, b long, sim double")


def _lists(edges: DataFrame, sizes: DataFrame | None) -> DataFrame:
    """For each vertex its k best neighbours, both ways of each edge counted; k is NEIGHBOURS, or more where `sizes` (a, k) has it."""
    both = edges.select("a", "b", "sim").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim")).dropDuplicates(["a", "b"])
    w = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    ranked = both.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= LONGEST)
    ranked = ranked.withColumn("k", F.lit(NEIGHBOURS)) if sizes is None else ranked.join(sizes, "a", "left").fillna(NEIGHBOURS, ["k"])
    return ranked.filter(F.col("r") <= F.col("k")).select("a", "b", "sim", "k")


def descend(lists: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Neighbours of a common neighbour are compared with each other: at most 2k meet at one vertex.

    A pair goes on if it is a link or better than the last entry of one of the two lists. Links between two vertices whose lists are full
    of links at LONGEST needn't: both are compared with all of their label later.
    """
    longest = LONGEST
    size = lists.groupBy("a").agg(F.max("k").alias("k"), F.when(F.count(F.lit(1)) >= F.max("k"), F.min("sim")).otherwise(-2.0).alias("last"))
    back = Window.partitionBy("b").orderBy(F.desc("sim"), "a")
    reverse = lists.withColumn("r", F.row_number().over(back)).filter(F.col("r") <= LONGEST).join(size.select(F.col("a").alias("b"), F.col("k").alias("kb")), "b").filter(F.col("r") <= F.col("kb")).select(F.col("b").alias("hub"), F.col("a").alias("key"))
    at = lists.select(F.col("a").alias("hub"), F.col("b").alias("key")).unionByName(reverse).distinct()
    met = at.join(classes.select("key", "vec").join(size.select(F.col("a").alias("key"), "last", ((F.col("k") >= longest) & (F.col("last") >= threshold)).alias("done")), "key"), "key")
    met = met.groupBy("hub").agg(F.collect_list("key").alias("keys"), F.collect_list("vec").alias("vecs"), F.collect_list("last").alias("lasts"), F.collect_list("done").alias("dones"))

    def compare(batches):
        for b in batches:
            a, c, s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
            keys, vecs, lasts, dones = (b.column(c) for c in ("keys", "vecs", "lasts", "dones"))
            for r in range(b.num_rows):
                key, m, low = keys[r].values.to_numpy(), _matrix(vecs[r].values), lasts[r].values.to_numpy()
                sim, done = m @ m.T, dones[r].values.to_numpy(zero_copy_only=False)
                i, j = np.nonzero(np.triu(((sim >= threshold) & ~(done[:, None] & done[None, :])) | (sim > np.minimum(low[:, None], low[None, :])), 1))
                a.append(key[i])
                c.append(key[j])
                s.append(sim[i, j])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in (a, c, s)], names=["a", "b", "sim"])

    return met.select("keys", "vecs", "lasts", "dones").mapInArrow(compare, "a long, b long, sim double")


def saturated(lists: DataFrame, threshold: float) -> DataFrame:
    """The vertices (a, k) whose lists are full of links: what they lack can be links as well."""
    return lists.filter(F.col("sim") >= threshold).groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k")).filter("n >= k").select("a", "k")


def _roots(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least row of its connected part, for each row and column of a bipartite table without empty lines."""
    n = len(hit)
    low = np.arange(n)
    while True:
        high = np.where(hit, low[:, None], n).min(axis=0)
        later = np.where(hit, high[None, :], n).min(axis=1)
        if (later == low).all():
            return low, high
        low = later


def _scan(asked: DataFrame, members: DataFrame, threshold: float, kept: Scratch) -> DataFrame:
    """The vectors `asked` (key, c) compared with all members (key, c, n, vec) of their c, blocks against blocks.

    Rows (key, links, pairs, back, root), to be summed by key: links and pairs of an asked vector with members (with
    and without their copies), links of a member with asked vectors; key and root are connected.
    """
    blocks = kept.save(asked.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("ni")).join(members.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nj")), "c"), "neardup-blocks")
    m = members.select("key", "c", "n", "vec").join(F.broadcast(blocks) if blocks.count() <= LABELS else blocks, "c")
    dealt = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    low = m.join(asked.select("key"), "key", "left_semi").withColumn("i", dealt("ni")).withColumn("j", every("nj"))
    high = m.withColumn("j", dealt("nj")).withColumn("i", every("ni"))
    cells = low.withColumn("low", F.lit(True)).unionByName(high.withColumn("low", F.lit(False))).select("c", "i", "j", "low", "key", "n", "vec")

    def count(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        key, n, first = t.column("key").to_numpy(), t.column("n").to_numpy(), t.column("low").to_numpy()
        m = _matrix(t.column("vec").combine_chunks())
        low, high = np.flatnonzero(first), np.flatnonzero(~first)
        hit = (m[low] @ m[high].T >= threshold) & (key[low][:, None] != key[high][None, :])
        x, y = hit.any(axis=1), hit.any(axis=0)
        low, high, hit = low[x], high[y], hit[x][:, y]
        if not len(low):
            return pa.table({z: np.zeros(0, np.int64) for z in ("key", "links", "pairs", "back", "root")})
        r, q = _roots(hit)
        none = np.zeros(len(high), np.int64)
        return pa.table({
            "key": np.concatenate([key[low], key[high]]),
            "links": np.concatenate([hit @ n[high], none]),
            "pairs": np.concatenate([hit.sum(axis=1), none]),
            "back": np.concatenate([np.zeros(len(low), np.int64), hit.T @ n[low]]),
            "root": key[low][np.concatenate([r, q])],
        })

    # all three columns deal the cells, else those of a hot label would meet in one task
    return cells.repartition("c", "i", "j").groupBy("c", "i", "j").applyInArrow(count, "key long, links long, pairs long, back long, root long")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


class Audit:
    """Vectors compared with all of their label; what they show of the links found so far.

    `asked` (key, g) are the vectors, `scans` the rows of _scan() for them. A label's recall is the mean, over its asked
    vectors that have links and no full list, of the part of their links that was found.
    """

    def __init__(self, classes: DataFrame, threshold: float, kept: Scratch):
        self.classes, self.threshold, self.kept = classes, threshold, kept
        self.members = classes.withColumn("c", F.col("g"))
        self.sizes = kept.save(classes.groupBy("g").agg(F.count(F.lit(1)).alias("size")), "neardup-labels")
        self.asked = classes.select("key", "g").limit(0)
        self.scans = classes.select("key", *(F.lit(0).cast("long").alias(c) for c in ("links", "pairs", "back", "root"))).limit(0)
        self.step = -1

    def scan(self, keys: DataFrame) -> None:
        """Compare the vectors of keys (key, g) that weren't asked before with all of their label."""
        new = self.kept.save(keys.join(self.asked.select("key"), "key", "left_anti").select("key", "g"), "neardup-asked")
        rows = self.kept.save(_scan(new.withColumnRenamed("g", "c"), self.members, self.threshold, self.kept), "neardup-scan")
        self.asked, self.scans = self.asked.unionByName(new), self.scans.unionByName(rows)

    def labels(self, found: DataFrame, full: DataFrame) -> DataFrame:
        """One row a label: g, size, asked (how many), linked (asked ones with links and no full list) and recall."""
        truth = self.scans.groupBy("key").agg(F.sum("pairs").alias("pairs"))
        degree = _both(found).groupBy(F.col("a").alias("key")).agg(F.count(F.lit(1)).alias("degree"))
        x = self.asked.join(truth, "key", "left").join(degree, "key", "left").join(full.select("key", F.lit(True).alias("full")), "key", "left")
        counts = F.col("full").isNull() & (F.col("pairs") > 0)
        share = F.least(F.coalesce("degree", F.lit(0)) / F.when(counts, F.col("pairs")), F.lit(1.0))
        x = x.groupBy("g").agg(F.count(F.lit(1)).alias("asked"), F.count(F.when(counts, 1)).alias("linked"), F.avg(F.when(counts, share)).alias("recall"))
        return self.kept.save(self.sizes.join(x, "g", "left").fillna(0, ["asked", "linked"]).fillna(1.0, ["recall"]), "neardup-recall")

    def short(self, found: DataFrame, full: DataFrame, recall: float) -> DataFrame:
        """The labels (g) whose links found fall short; a label asked as a whole can't.

        More vectors are asked until each label has shown LINKED vectors with links or was asked as a whole.
        """
        while True:
            now = self.labels(found, full)
            few = now.filter((F.col("asked") < F.col("size")) & (F.col("linked") < LINKED)).select("g", "size")
            if few.isEmpty():
                return now.filter((F.col("asked") < F.col("size")) & (F.col("recall") < recall)).select("g")
            self.step += 1
            part = F.pmod(F.xxhash64("key", F.lit("audit")), F.lit(1 << 40)) / (1 << 40)
            self.scan(self.classes.join(few, "g").filter(part * F.col("size") < AUDIT * 8.0**self.step).select("key", "g"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", recall: float = 0.99, rounds: int = 4) -> DataFrame:
    """One row a vector: id_col, n_links, component_id and kept, for links of cosine >= threshold.

    Only vectors of one label and length are compared. Null or zero vectors, those with null or
    non-finite components and those with a null label link with nothing (0 links, their own
    component). Equal vectors of a label are folded and count each other as links. Rows that repeat an
    id stand each for itself. Other columns are ignored.

    Lists of the NEIGHBOURS best start from several random orders and are refined by NN-descent until
    a round adds next to nothing. A list that is then full of links is saturated: what it lacks can lie in any group of the label. It gets twice the
    length, is filled from all links found so far and from new orders of the saturated vectors alone (in which other groups are near), and the descent goes on,
    until its last entry is no link. Only where LONGEST isn't enough is a
    vector compared with all of its label, block by block. An audit compares vectors of each label with all of it until enough of them
    have links; labels below the wanted recall get new orders, and after the last round they are compared as
    a whole. So a recall below the wanted one is never returned.
    """
    bounded(vectors.sparkSession)
    kept = Scratch()
    good = kept.save(clean(vectors, id_col, vec_col, label_col), "neardup-rows")
    classes = good.groupBy("key", "g").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    classes = kept.save(classes, "neardup-classes")
    check = Audit(classes, threshold, kept)
    links_of = lambda x: x.filter(F.col("sim") >= threshold).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim")
    active, lists, found, full, sizes = classes, None, None, None, None
    for r in range(rounds):
        new = first_lists(active, 11 + r)
        start = new if lists is None else new.unionByName(lists.join(active.select(F.col("key").alias("a")), "a", "left_semi").select("a", "b", "sim"))
        lists = kept.save(_lists(start, sizes), "neardup-lists")
        found = kept.save((links_of(lists) if found is None else found.unionByName(links_of(lists))).dropDuplicates(["a", "b"]), "neardup-found")
        size, steps = lists.agg(F.sum("sim")).first()[0] or 0.0, 0
        while True:
            pairs = kept.save(descend(lists, active, threshold), "neardup-pairs")
            more = kept.save(found.unionByName(links_of(pairs)).dropDuplicates(["a", "b"]), "neardup-found")
            longer = kept.save(_lists(lists.select("a", "b", "sim").unionByName(pairs), sizes), "neardup-lists")
            kept.drop(pairs, found, lists)
            found, lists = more, longer
            later, steps = lists.agg(F.sum("sim")).first()[0] or 0.0, steps + 1
            if later > size * 1.002 and steps % 4:
                size = later
                continue
            now = kept.save(saturated(lists, threshold), "neardup-full")
            grow = now.filter(F.col("k") < LONGEST).select("a", F.least(2 * F.col("k"), F.lit(LONGEST)).cast("int").alias("k"))
            if grow.isEmpty():
                break
            sizes = kept.save(grow if sizes is None else sizes.unionByName(grow).groupBy("a").agg(F.max("k").alias("k")), "neardup-sizes")
            seeds = first_lists(active.join(grow.select(F.col("a").alias("key")), "key", "left_semi"), 1000 * (r + 1) + steps)
            longer = kept.save(_lists(lists.select("a", "b", "sim").unionByName(found).unionByName(seeds), sizes), "neardup-lists")
            kept.drop(lists)
            lists, size = longer, longer.agg(F.sum("sim")).first()[0] or 0.0
        now = now.select(F.col("a").alias("key"))
        full = kept.save(now if full is None else full.unionByName(now).distinct(), "neardup-full")
        short = check.short(found, full, recall)
        if short.isEmpty():
            break
        active = kept.save(classes.join(short, "g", "left_semi"), "neardup-short")
    else:
        check.scan(active.select("key", "g"))
    check.scan(classes.join(full, "key", "left_semi").select("key", "g"))
    scans, scanned = check.scans, check.asked.select("key")
    edges = found.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(scans.select(F.col("key").alias("u"), F.col("root").alias("v")))
    comp = components(edges, kept)
    # links of a scanned vector are its scan's; another one has those of the scans that met it, and those found with the others
    exact = scans.groupBy("key").agg(F.sum("links").alias("links"), F.sum("back").alias("back"))
    rest = _both(found).join(scanned.select(F.col("key").alias("b")), "b", "left_anti")
    counted = rest.join(classes.select(F.col("key").alias("b"), "n"), "b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("found"))
    per = classes.select("key", "n", "least").join(scanned.withColumn("scanned", F.lit(True)), "key", "left").join(counted, "key", "left").join(exact, "key", "left").join(comp.select(F.col("id").alias("key"), F.col("component_id").alias("c")), "key", "left")
    zero = F.lit(0)
    links = F.when(F.col("scanned"), F.coalesce("links", zero)).otherwise(F.coalesce("found", zero) + F.coalesce("back", zero))
    per = kept.save(per.select("key", "least", F.coalesce("c", "key").alias("c"), (links + F.col("n") - 1).alias("n_links")), "neardup-classes-linked")
    least = per.groupBy("c").agg(F.min("least").alias("component_id"))
    per = per.join(least, "c").select("key", "n_links", "component_id")
    linked = good.select("id", "key").join(per, "key").select(F.col("id").alias(id_col), "n_links", "component_id")
    x = vectors.select(F.col(id_col).cast("long").alias(id_col), F.col(vec_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label"))
    usable = F.col("label").isNotNull() & F.col("vec").isNotNull() & F.coalesce(F.forall("vec", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))), F.lit(False)) & F.coalesce(F.exists("vec", lambda e: e != 0), F.lit(False))
    alone = x.filter(~usable).select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    out = linked.unionByName(alone)
    return kept.result(out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))), "neardup-links")


def op4_near_duplicates(spark, sf_dir):
    """Links of all embeddings of one label at a cosine of 0.93 or more: vec_id, n_links, component_id (long), kept; a row a vector."""
    return near_duplicates(read(spark, sf_dir, "embeddings"))
