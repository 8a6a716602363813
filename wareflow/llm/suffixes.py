"""Repeated passages by sparse suffix arrays: suffixes at minimisers, sorted, compared with their neighbours, extended."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Marks, Scratch, bounded, read
from .words import mix, parts, span, sums, text_keys, word_hashes

#: Words in a passage at least, and in the head of a suffix by which suffixes are sorted first.
LENGTH, HEAD = 50, 16
_C = np.uint64(0xD6E8FEB86659FD93)


def window_least(values: np.ndarray, size: int) -> np.ndarray:
    """Where the least of each `size` neighbouring values stands (the first of equal ones), by doubling."""
    at, n, best = np.arange(len(values)), 1, values
    while n < size:
        step = min(n, size - n)
        low = best[step:] < best[: len(best) - step]
        at = np.where(low, at[step:], at[: len(at) - step])
        best = values[at]
        n += step
    return at


class Kept:
    """The suffixes kept of the texts of a column: at the minimisers of their passages.

    Of each passage of `length` words the head (`head` words) with the least hash is kept. The same passage, wherever it
    stands, thus keeps a suffix at the same place in it. The passages that keep one suffix start next to each
    other. Arrays by suffix: row, head, first and last (words, from the text's begin on) of its passages, and whole: a hash of all the words that the
    suffix's passages hold, from `first` on the left to the last passage's end, and of where the suffix stands in them.
    """

    def __init__(self, column: pa.Array, length: int, head: int):
        h, begin = word_hashes(column, False)
        self.length, self.begin, self.total = length, begin, sums(h)
        if len(h) < length:
            self.row = self.first = self.last = np.zeros(0, np.int64)
            self.head = self.whole = np.zeros(0, np.int64)
            return
        heads = span(self.total, np.arange(len(h) - head + 1), np.arange(len(h) - head + 1) + head)
        least = window_least(heads, length - head + 1)  # of the passage that starts at each word
        count = np.maximum(np.diff(begin) - length + 1, 0)
        start = np.concatenate([[0], np.cumsum(count)])
        row = np.repeat(np.arange(len(count)), count)
        a = np.arange(start[-1]) - start[row] + begin[row]  # first words of all passages
        at = least[a]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        i = np.flatnonzero(new)
        self.row, at = row[i], at[i]
        first, last = a[i], a[np.append(i[1:], len(a)) - 1] if len(i) else a
        self.head = heads[at].view(np.int64)
        with np.errstate(over="ignore"):
            self.whole = mix(span(self.total, first, last + length) + (at - first).astype(np.uint64) * _C).view(np.int64)
        self.first, self.last = first - begin[self.row], last - begin[self.row]

    def passages(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Suffix, row, first word and hash of all passages of some suffixes."""
        first, n = self.first[which], (self.last - self.first + 1)[which]
        a = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        suffix = np.repeat(which, n)
        row = self.row[suffix]
        at = a + self.begin[row]
        return suffix, row, a, span(self.total, at, at + self.length).view(np.int64)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


#: What compare() says of a suffix: all suffixes with its head have the same words around them; they differ; the run of its head reaches
#: the partition's end, so that the neighbouring partitions decide.
ALIKE, DIFFER, OPEN = 0, 1, 2
_SORTED = "kind int, part int, head long, whole long, id long, text_key long, a long, b long, is_first boolean"


def compare(batches):
    """Neighbours of one sorted partition of suffixes: runs of equal heads, and whether all their suffixes have equal extensions.

    Only the rows of a run that has not ended are held. Suffixes whose head no neighbour has are left out, and so is all but one of
    equal rows.
    """
    part, held, opened = TaskContext.get().partitionId(), None, True
    names = ["head", "whole", "id", "text_key", "a", "b"]

    def told(t: pa.Table, at_start: bool, at_end: bool):
        """All rows of complete runs (but for the first and the last, which may be open)."""
        t = t.combine_chunks()
        head, whole, key, a = (_column(t, c) for c in ("head", "whole", "text_key", "a"))
        none, number = t.column("id").is_null().to_numpy(), t.column("id").fill_null(0).to_numpy()
        again = np.zeros(len(head), dtype=bool)
        again[1:] = (head[1:] == head[:-1]) & (key[1:] == key[:-1]) & (a[1:] == a[:-1]) & (number[1:] == number[:-1]) & (none[1:] == none[:-1])
        t, head, whole = t.filter(pa.array(~again)), head[~again], whole[~again]
        new = np.ones(len(head), dtype=bool)
        new[1:] = head[1:] != head[:-1]
        run = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        n = np.diff(np.append(begin, len(head)))
        turn = np.zeros(len(head), dtype=bool)
        turn[1:] = whole[1:] != whole[:-1]
        kind = np.where(np.bincount(run[turn & ~new], minlength=len(n)) > 0, DIFFER, ALIKE)
        kept = n > 1
        for at, there in ((0, at_start), (-1, at_end)):
            if there and len(n):
                kind[at], kept[at] = OPEN, True
        keep = kept[run]
        out = t.filter(pa.array(keep))
        r = run[keep]
        return pa.RecordBatch.from_arrays(
            [pa.array(kind[r].astype(np.int32)), pa.array(np.full(len(r), part, np.int32)), *[out.column(c).combine_chunks() for c in names], pa.array(new[keep])],
            names=["kind", "part", *names, "is_first"],
        )

    for b in batches:
        t = pa.Table.from_batches([b.select(names)])
        held = t if held is None else pa.concat_tables([held, t])
        last = held.column("head").slice(held.num_rows - 1, 1).to_pylist()[0] if held.num_rows else None
        head = _column(held, "head")
        cut = int(np.searchsorted(head, last)) if len(head) else 0
        if cut:
            yield told(held.slice(0, cut), opened, False)
            held, opened = held.slice(cut), False
    if held is not None and held.num_rows:
        yield told(held, opened, True)


def repeated_spans(docs: DataFrame, length: int = LENGTH, head: int = HEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The maximal spans of words that lie in a passage of `length` words found twice or more in the table.

    Returns id_col, text_key (a hash of the text, which tells rows that repeat an id apart), is_first,
    start_word, end_word (exclusive) and n_words. A passage's first occurrence is the one with the
    least (id, text_key, start); spans of first occurrences and of later ones are given apart. Words
    are runs of characters other than ASCII white space, compared as they are. Rows equal in id and
    text are one document. Null ids stay null (and come first); null and short texts have no spans. Other columns are ignored.

    The suffixes kept at minimisers (see Kept) are sorted by their heads, then by the words that extend them to the left and right: by
    ranges of head, extension and place, so that however often a head occurs, its suffixes are dealt over many tasks. In
    the sorted order neighbours with one head are compared. Where a whole run is extended alike, all passages of its suffixes are repeats, in
    one row each. Where extensions differ, at the borders of a match, they are extended word by word: their passages meet one by one by 64-bit hash. Any
    repeated passage has a kept suffix whose head is repeated, so none is missed. Runs over the end of a range are settled by two rows a
    partition, which the driver sees. All shuffles count before they join.
    """
    bounded(docs.sparkSession)
    send, kept = docs.sparkSession.sparkContext.broadcast, Scratch()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def keep(batches):
        for b in parts(batches):
            k = Kept(b.column("text"), length, head)
            if len(k.row):
                at, keys = pa.array(k.row), text_keys(b.column("text"))
                yield pa.RecordBatch.from_arrays([*map(pa.array, (k.head, k.whole)), b.column("id").take(at), *map(pa.array, (keys[k.row], k.first, k.last))], names=["head", "whole", "id", "text_key", "a", "b"])

    suffixes = kept.save(texts.mapInArrow(keep, "head long, whole long, id long, text_key long, a long, b long"), "suffix-kept")
    place = ["head", "whole", "id", "text_key", "a"]
    ranges = kept.save(suffixes.repartitionByRange(*place).sortWithinPartitions(*place).mapInArrow(compare, _SORTED), "suffix-sorted")
    kept.drop(suffixes)
    # runs over the ends of partitions: which partition has the first row, and whether all parts have one extension
    ends = ranges.filter(f"kind = {OPEN}").groupBy("head").agg(F.min("part").alias("part"), F.count(F.lit(1)).alias("n"), (F.min("whole") == F.max("whole")).alias("same"))
    edges = send({r["head"]: (ALIKE if r["same"] else DIFFER, r["part"]) for r in ends.filter("n > 1").collect()})  # two rows a partition at most

    def settle(batches):
        known = edges.value
        for b in batches:
            kind, first = b.column("kind").to_numpy().copy(), b.column("is_first").to_numpy(zero_copy_only=False).copy()
            at = np.flatnonzero(kind == OPEN)
            if len(at):
                heads, of = np.unique(b.column("head").to_numpy()[at], return_inverse=True)
                said = np.array([known.get(h, (OPEN, -1)) for h in heads.tolist()])[of]
                kind[at], first[at] = said[:, 0], first[at] & (b.column("part").to_numpy()[at] == said[:, 1])
            b = b.set_column(b.schema.get_field_index("kind"), "kind", pa.array(kind)).set_column(b.schema.get_field_index("is_first"), "is_first", pa.array(first))
            yield b.filter(pa.array(kind != OPEN))  # what is open still is no repeat

    settled = kept.save(ranges.mapInArrow(settle, ranges.schema), "suffix-settled")
    kept.drop(ranges)
    alike = settled.filter(f"kind = {ALIKE}").select("id", "text_key", "a", "b", "is_first")
    border = settled.filter(f"kind = {DIFFER}").select("head", "text_key")
    borders = kept.save(border.select("head").distinct(), "suffix-borders")
    heads, keys = send(Marks(borders, "head")), send(Marks(border.select("text_key").distinct(), "text_key"))

    def extend(batches):
        for b in parts(batches):
            at = np.flatnonzero(keys.value.hit(text_keys(b.column("text"))))
            if len(at):
                b = b.take(pa.array(at))
                k = Kept(b.column("text"), length, head)
                which = np.flatnonzero(heads.value.hit(k.head))
                suffix, row, a, passage = k.passages(which)
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(row)), *map(pa.array, (text_keys(b.column("text"))[row], a, k.head[suffix], passage))], names=["id", "text_key", "a", "head", "passage"])

    passages = kept.save(texts.mapInArrow(extend, "id long, text_key long, a long, head long, passage long"), "suffix-passages")
    again = passages.groupBy("passage").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    often = send(Marks(again, "passage"))

    def meet(batches):
        for b in batches:
            yield b.filter(pa.array(often.value.hit(b.column("passage").to_numpy())))

    # the bitmaps let some heads too many through, with a part of their texts only: those go
    found = kept.save(passages.mapInArrow(meet, passages.schema).join(borders, "head", "left_semi"), "suffix-often")
    kept.drop(passages)
    one = F.struct("id", "text_key", "a")
    met = kept.save(found.groupBy("passage").agg(F.min(one).alias("first"), F.max(one).alias("last")).filter("first <> last").select("passage", "first"), "suffix-met")
    met = found.join(met, "passage").select("id", "text_key", "a", F.col("a").alias("b"), (one == F.col("first")).alias("is_first"))
    hits = alike.unionByName(met).distinct()
    by = Window.partitionBy("id", "text_key", "is_first").orderBy("a", "b")
    reach = F.max("b").over(by.rowsBetween(Window.unboundedPreceding, -1)) + length
    hits = hits.withColumn("fresh", F.when(F.col("a") <= reach, 0).otherwise(1))
    spans = hits.withColumn("span", F.sum("fresh").over(by.rowsBetween(Window.unboundedPreceding, 0))).groupBy("id", "text_key", "is_first", "span").agg(F.min("a").alias("start_word"), (F.max("b") + length).alias("end_word"))
    return kept.result(spans.select(F.col("id").alias(id_col), "text_key", "is_first", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words")), "suffix-spans")


def cut_repeats(docs: DataFrame, length: int = LENGTH, head: int = HEAD) -> DataFrame:
    """docs without the later occurrences of repeated passages; n_chars follows if there is one.

    The first occurrence of a passage stays. A text from which nothing is left goes. Only the rows
    that a bitmap marks are joined with their spans; the others are not shuffled.
    """
    later = repeated_spans(docs, length, head).filter("not is_first")
    cuts = later.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("__cuts"))  # a text's own spans
    bits = docs.sparkSession.sparkContext.broadcast(Marks(later.select(F.col("text_key").alias("key")).distinct()))
    schema, names = docs.schema, docs.columns

    def part(marked: bool):
        def run(batches):
            for b in parts(batches):
                keys = text_keys(b.column("text"))
                yield (b.append_column("__key", pa.array(keys)) if marked else b).filter(pa.array(bits.value.hit(keys) == marked))

        return run

    def cut(batches):
        word = re.compile(WORD)
        for b in parts(batches):
            texts, live = [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column("__cuts").to_pylist(), strict=True):
                if spans:
                    at = [m.start() for m in word.finditer(text)] + [len(text)]
                    left, last = [], 0
                    for s in spans:
                        left.append(text[last : max(last, at[s["start_word"]])])
                        last = max(last, at[s["end_word"]])
                    text = "".join([*left, text[last:]])
                    live.append(bool(word.search(text)))
                else:
                    live.append(True)
                texts.append(text)
            yield b.drop_columns(["__cuts"]).set_column(b.schema.get_field_index("text"), "text", pa.array(texts, pa.string())).filter(pa.array(live))

    from pyspark.sql.types import LongType, StructType

    touched = docs.mapInArrow(part(True), StructType([*schema.fields]).add("__key", LongType()))
    c = cuts.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text_key"), "__cuts")
    joined = touched.join(c, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__text_key")), "left").select(*names, "__cuts")
    done = joined.mapInArrow(cut, schema)
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.char_length("text").cast(schema["n_chars"].dataType))
    return docs.mapInArrow(part(False), schema).unionByName(done.select(*names))


def op9_suffix_dedup(spark, sf_dir):
    """Repeated passages of 50 words or more in documents: one row a maximal span, first occurrences and later ones apart.

    Columns: doc_id (null ids stay null), text_key, is_first, start_word, end_word, n_words (long). Documents without repeats have no row.
    """
    return repeated_spans(read(spark, sf_dir, "documents").select("doc_id", "text"))
