"""N-gram Jaccard join: universe partition, pigeonhole over segments, one-deletion neighbourhoods."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Marks, Scratch, bounded, read
from .components import components
from .words import _GOLD, mix, parts, span, sums, word_hashes

#: Segments beyond the pigeonhole's number, as a part of it: they stand in for segments left out.
SLACK = 0.5
#: Signatures of a set, the least ones, by which a pair that met before is told.
FIRST = 16
#: Parts of the universe in which a set's members are counted: what two sets can have in common, before their members are fetched.
PARTS = 32
#: Classes that a task remembers, so that it signs copies once.
SEEN = 200_000


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-word shingles of each text as hashes, sorted; where each text's begin; a key of its words.

    Words are lower-cased (A-Z) runs of non-white characters. A shorter text is one shingle, a text without words none.
    """
    h, first = word_hashes(column, True)
    count = np.diff(first)
    k = np.minimum(n, count)
    sets = np.where(count > 0, count - k + 1, 0)
    begin = np.concatenate([[0], np.cumsum(sets)])
    owner = np.repeat(np.arange(len(count)), sets)
    at = np.arange(begin[-1]) - begin[owner] + first[owner]
    own = k[owner]
    s = own.astype(np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            s = np.where(i < own, mix(s * _GOLD + h[np.minimum(at + i, len(h) - 1)]), s)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        s[a:b].sort()
    fresh = np.ones(len(s), dtype=bool)
    fresh[1:] = s[1:] != s[:-1]
    fresh[begin[:-1][sets > 0]] = True
    total = sums(mix(h))
    return s[fresh], np.concatenate([[0], np.cumsum(fresh)])[begin], span(total, first[:-1], first[1:]).view(np.int64)


class Bands:
    """Size bands and, for each, how many segments the universe is cut into.

    Sets of sizes a <= b with a Jaccard similarity of t or more have b <= a / t and differ in
    (1 - t) / (1 + t) * (a + b) members at most. Band k holds the sizes in [edge(k), edge(k + 1)),
    edges growing by 1 / t, so that a pair's sizes lie in one band or in two neighbouring ones. A set
    takes part in the group of its own band and in that of the band above.
    """

    def __init__(self, percent: int, slack: float = SLACK):
        self.percent, self.slack, self.edges = percent, slack, [1]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, -(-self.edges[-1] * 100 // percent)))
        self.first = np.array(self.edges)
        self.differences = np.array([self.differ(g) for g in range(len(self.edges) - 1)])

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.first, size, side="right")) - 1

    def differ(self, group: int) -> int:
        """The most members in which two linked sets of a group differ."""
        top = self.edges[group + 1] - 1
        return (100 - self.percent) * 2 * top // (100 + self.percent)


def signatures(members: np.ndarray, group: int, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """The index entries of one set in one group, and how many of them the cost may leave out (-1: none).

    The universe is cut into (1 + slack) * (H + 1) segments by a hash; H is the most members in which
    linked sets differ. A segment's signature is the sum of its members' hashes. Two allocations share out
    H. By the first, segments are compared as they are (allowance 0): linked sets have all but H of
    either's signatures in common, so the H + 1 that cost least, in one order for all sets,
    hold a common one. Empty segments match the most for nothing and are left out from the start
    (allowance -1), on both sides alike, and it takes but one set with H + 1 left to find a pair. Sets with
    fewer also enter the second allocation: H // 2 + 1 segments, each with allowance 1, of which one
    differs in one member at most. There a segment enters with all members and with each one deleted.
    """
    h = bands.differ(group)
    with np.errstate(over="ignore"):
        spun = mix(members + np.uint64(group + 1))
        if h == 0:
            return mix(np.array([spun.sum(dtype=np.uint64)], dtype=np.uint64) + np.uint64(group * 8 + 1)), np.full(1, -1, np.int32)
        m = math.ceil((1 + bands.slack) * (h + 1))
        seg = (members % np.uint64(m)).astype(np.int64)
        count = np.bincount(seg, minlength=m)
        order = np.argsort(seg, kind="stable")
        full = np.add.reduceat(np.append(spun[order], np.uint64(0)), np.minimum(np.cumsum(count) - count, len(seg)))
        good = np.flatnonzero(count)
        out = mix(mix(full[good] + good.astype(np.uint64)) + np.uint64(group * 8 + 2))
        if len(good) >= h + 1:
            return out, np.full(len(out), len(out) - h - 1, np.int32)
        m = h // 2 + 1
        seg = (mix(members) % np.uint64(m)).astype(np.int64)
        full = np.zeros(m, dtype=np.uint64)
        np.add.at(full, seg, spun)
        whole = mix(mix(full + np.arange(m, dtype=np.uint64)) + np.uint64(group * 8 + 3))
        less = mix(mix(full[seg] - spun + seg.astype(np.uint64)) + np.uint64(group * 8 + 3))
        out = np.concatenate([out, whole, less])
        return out, np.full(len(out), -1, np.int32)


def sign_sets(members: np.ndarray, begin: np.ndarray, group: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """signatures() of many sets at once, each in its group: the entries, the set of each, and what each may leave out."""
    size = np.diff(begin)
    h = bands.differences[group]
    m = np.ceil((1 + bands.slack) * (h + 1)).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(m)])
    owner = np.repeat(np.arange(len(size)), size)
    with np.errstate(over="ignore"):
        spun = mix(members + (group + 1).astype(np.uint64)[owner])
        seg = base[owner] + (members % m.astype(np.uint64)[owner]).astype(np.int64)
        full = np.zeros(base[-1], dtype=np.uint64)
        np.add.at(full, seg, spun)
        good = np.flatnonzero(np.bincount(seg, minlength=base[-1]))
        of = np.searchsorted(base, good, side="right") - 1
        held = np.bincount(of, minlength=len(size))
        plain = (h > 0) & (held >= h + 1)
        keep = plain[of]
        good, of = good[keep], of[keep]
        out = mix(mix(full[good] + (good - base[of]).astype(np.uint64)) + (group[of] * 8 + 2).astype(np.uint64))
    room = (held - h - 1)[of]
    more = [signatures(members[begin[i] : begin[i + 1]], int(group[i]), bands) for i in np.flatnonzero(~plain)]
    rest = [np.full(len(x), i) for i, (x, _) in zip(np.flatnonzero(~plain), more, strict=True)]
    return np.concatenate([out, *[x for x, _ in more]]), np.concatenate([of, *rest]), np.concatenate([room, *[r for _, r in more]])


def jaccard_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", slack: float = SLACK) -> DataFrame:
    """Link rows whose sets of n-word shingles have a Jaccard similarity of percent / 100 or more.

    Returns id_col, n_shingles (the set's size) and component_id (the least id that links reach), one
    row for each row of docs. Null and empty texts, and those without words, have an empty set and
    link with nothing; texts of fewer than n words have one shingle, the whole. Ids are integers;
    rows that repeat an id stand each for itself. Other columns are ignored.

    Copies (equal word sequences) are one class. Signatures that two or more classes share, the cheapest
    of each set, make candidates. Those of a signature are compared with
    one hub, the class among them that shares most signatures; what then still lies in different components
    is compared pair by pair, if the members that no other candidate has, and the counts of members by parts of the universe, leave room for a link, so that
    no link between components is lost and copies of one text cost a row for each, not for each pair. Similarities are exact counts over
    64-bit shingle hashes. Texts are hashed anew where they are needed and never shuffled. A
    smaller slack writes fewer signatures and leaves more pairs to compare; the result is the same.
    """
    bounded(docs.sparkSession)
    bands, send, kept = Bands(percent, slack), docs.sparkSession.sparkContext.broadcast, Scratch()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def index(batches):
        for b in parts(batches):
            _, begin, key = shingle_sets(b.column("text"), n)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(begin)), pa.array(key)], names=["id", "n_shingles", "key"])

    rows = kept.save(texts.mapInArrow(index, "id long, n_shingles long, key long"), "jaccard-rows")
    classes = kept.save(rows.filter("n_shingles > 0").groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "jaccard-classes")

    def sign(batches):
        seen = set()
        for b in parts(batches):
            members, begin, key = shingle_sets(b.column("text"), n)
            size = np.diff(begin)
            fresh = []
            for i in np.flatnonzero(size):
                if (k := int(key[i])) not in seen:  # copies that other tasks sign meet in the sort by signature
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.add(k)
                    fresh.append(i)
            if not fresh:
                continue
            fresh = np.array(fresh)
            members = np.concatenate([members[begin[i] : begin[i + 1]] for i in fresh])
            begin, group = np.concatenate([[0], np.cumsum(size[fresh])]), np.searchsorted(bands.first, size[fresh], side="right") - 1
            for guest in (0, 1):
                found, of, room = sign_sets(members, begin, group + guest, bands)
                info = ((group + guest)[of] * 2 + guest << 32) + room + 1
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(key[fresh][of]), pa.array(info)], names=["sig", "key", "info"])

    signed = texts.select("text").mapInArrow(sign, "sig long, key long, info long")
    same = Window.partitionBy("sig").orderBy("key")
    near = signed.withColumns({"before": F.lag("key").over(same), "after": F.lead("key").over(same)})
    shared = near.filter((F.col("before") != F.col("key")) | (F.col("after") != F.col("key"))).select("sig", "key", "info").distinct()
    plain = {"band": "cast(shiftright(info, 33) as int)", "guest": "(shiftright(info, 32) & 1) = 1", "room": "cast(info & 4294967295L as int) - 1"}
    met = kept.save(shared.select("sig", "key", *[F.expr(e).alias(c) for c, e in plain.items()]), "jaccard-met")
    # the costs: how many classes share a signature; the costliest `room` of each set are left out
    cost = met.groupBy("sig").agg(F.count(F.lit(1)).alias("k"))
    own = Window.partitionBy("key", "band")
    ranked = met.join(cost, "sig").withColumns({"rank": F.row_number().over(own.orderBy("k", "sig")), "n": F.count(F.lit(1)).over(own)})
    # an end of `n - room` of the cheapest stays: those that no other class has come first and are not here
    left = ranked.filter((F.col("room") < 0) | (F.col("rank") <= F.col("n") - F.col("room"))).select("sig", "key", "band", "guest")
    shared = kept.save(left.join(left.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("sig"), "sig"), "jaccard-shared")
    kept.drop(met)

    sizes = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("k"))
    weight = shared.join(sizes, "sig").groupBy("key").agg(F.sum("k").alias("weight"))
    hubs = shared.join(weight, "key").groupBy("sig").agg(F.max(F.struct("weight", "key"))["key"].alias("hub"))
    stars = shared.join(hubs, "sig").filter("key <> hub").select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()
    stars = kept.save(stars, "jaccard-stars")

    wanted = send(Marks(shared.select("key").distinct()))

    def sets(batches):
        for b in parts(batches):
            members, begin, key = shingle_sets(b.column("text"), n)
            hit = wanted.value.hit(key) & (np.diff(begin) > 0)
            lists = pa.LargeListArray.from_arrays(pa.array(begin), pa.array(members.view(np.int64)))
            part = np.repeat(np.arange(len(key)), np.diff(begin)) * PARTS + (members >> np.uint64(40)).astype(np.int64) % PARTS
            counts = pa.array(np.bincount(part, minlength=len(key) * PARTS).astype(np.int32))
            counts = pa.ListArray.from_arrays(pa.array(np.arange(len(key) + 1, dtype=np.int32) * PARTS), counts)
            yield pa.RecordBatch.from_arrays([pa.array(key), lists.cast(pa.list_(pa.int64())), counts], names=["key", "members", "parts"]).filter(pa.array(hit))

    members = texts.select("text").mapInArrow(sets, "key long, members array<long>, parts array<int>")
    members = kept.save(members.join(shared.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]), "jaccard-members")

    def linked(pairs: DataFrame) -> DataFrame:
        x = members.select(F.col("key").alias("a"), F.col("members").alias("ma"))
        y = members.select(F.col("key").alias("b"), F.col("members").alias("mb"))
        both = F.size(F.array_intersect("ma", "mb"))
        return pairs.join(x, "a").join(y, "b").filter(100 * both >= percent * (F.size("ma") + F.size("mb") - both)).select(F.col("a").alias("u"), F.col("b").alias("v"))

    edges = kept.save(linked(stars), "jaccard-edges")
    first = components(edges, kept)
    placed = shared.join(first, shared["key"] == first["id"], "left").select("sig", "key", "band", "guest", F.coalesce("component_id", "key").alias("c"))
    mixed = placed.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("sig")
    rest = placed.join(mixed, "sig")
    # members that no other candidate has are in no intersection, and in every union
    lone = members.select("key", F.explode("members").alias("m")).groupBy("m").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("k")).filter("k = 1").groupBy("key").agg(F.count(F.lit(1)).alias("lone"))
    sizes = members.select("key", F.size("members").alias("n"), "parts").join(lone, "key", "left").select("key", "n", F.coalesce("lone", F.lit(0)).alias("lone"), "parts")
    rest = kept.save(rest.join(sizes, "key").filter(f"100 * (n - lone) >= {percent} * n"), "jaccard-rest")
    least = Window.partitionBy("key", "band").orderBy("sig")  # what a set keeps in a group
    firsts = rest.select("key", "band", "sig").withColumn("r", F.row_number().over(least)).filter(F.col("r") <= FIRST).groupBy("key", "band").agg(F.collect_list("sig").alias("firsts"))
    rest = rest.join(kept.save(firsts, "jaccard-firsts"), ["key", "band"])
    x, y = (rest.select("sig", *[F.col(c).alias(f"{c}_{i}") for c in ("key", "c", "guest", "n", "lone", "firsts", "parts")]) for i in "ab")
    top = "least(n_a - lone_a, n_b - lone_b)"
    # two guests meet in their own group; a pair isn't made again where both have a common signature among their first ones
    fit = f"key_a < key_b and c_a <> c_b and not (guest_a and guest_b) and 100 * {top} >= {percent} * greatest(n_a + lone_b, n_b + lone_a) and 100 * {top} >= {percent} * (n_a + n_b - {top}) and not exists(array_intersect(firsts_a, firsts_b), s -> s < sig)"
    # by parts of the universe no more members can be in both than the smaller set has there
    most = "aggregate(zip_with(parts_a, parts_b, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    fit += f" and (100 + {percent}) * {most} >= {percent} * (n_a + n_b)"
    pairs = x.join(y, "sig").filter(fit).select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    late = kept.save(linked(pairs), "jaccard-late")
    kept.drop(shared, stars, members)

    ends = components(edges.unionByName(late), kept).select(F.col("id").alias("key"), F.col("component_id").alias("c"))
    least = classes.join(ends, "key").groupBy("c").agg(F.min("least").alias("component_id"))
    found = classes.join(ends.join(least, "c").select("key", "component_id"), "key", "left").select("key", F.coalesce("component_id", "least").alias("component_id"))
    out = rows.join(found, "key", "left").select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    return kept.result(out, "jaccard-groups")


def op6_jaccard_join(spark, sf_dir):
    """Links of all documents by 4-word shingles at a Jaccard similarity of 0.85 or more: doc_id, n_shingles, component_id (long); a row a row of documents."""
    return jaccard_groups(read(spark, sf_dir, "documents").select("doc_id", "text"), n=4, percent=85)
