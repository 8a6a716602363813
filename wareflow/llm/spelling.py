"""Spelling variants: a bidirectional FM-index over the delimited vocabulary, searched from either half with one error."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded, read, tasks_for
from .words import parts

#: Code points and occurrences of a word at least, and how many times as frequent a word's form is.
LETTERS, OFTEN, RATIO = 7, 2, 10
#: A run of letters that may give a word, once A to Z are small.
RUN = re.compile(f"[a-zÀ-ÿ]{{{LETTERS},}}")
#: One occurrence in so many is damaged.
DAMAGE = 31
#: Code points at either end by which words are dealt to indexes; a half of a word has as many at least.
EDGE = LETTERS // 2
#: Words of an index, about, and those that are looked up together.
BLOCK, TOGETHER = 1 << 16, 1 << 13
#: Words that a task counts before it passes them on.
HELD = 1 << 17


def occurrences(docs: DataFrame) -> DataFrame:
    """(word, n) of the runs of letters in whole texts, A to Z made small, with the rule's damage; counted in parts by the tasks."""

    def count(batches):
        held: Counter = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        for b in batches:
            for part in parts([b]):
                for who, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    if not text.is_valid:
                        continue
                    begun = zlib.crc32(f"{who or ''}:".encode())
                    for run, n in Counter(RUN.findall(text.as_buffer().to_pybytes().lower().decode())).items():
                        h = zlib.crc32(run.encode(), begun)
                        if h % DAMAGE == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                        if len(run) >= LETTERS:
                            held[run] += n
                    if len(held) >= HELD:
                        yield out()
                        held.clear()
        if held:
            yield out()

    bounded(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(count, "word string, n long")


class _Bwt:
    """A Burrows-Wheeler transform as a wavelet matrix: suffix-rank intervals move by one symbol for many patterns at once."""

    def __init__(self, text: np.ndarray, sigma: int):
        self.order = _suffixes(text, sigma)
        now = text[self.order - 1]  # what stands before each suffix; before the first stands the end mark
        first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (now >> level & 1).astype(bool)
            self.ones.append(np.concatenate([np.zeros(1, np.int32), np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            now = np.concatenate([now[~bit], now[bit]])
        symbols, begins = np.unique(now, return_index=True)
        self.shift = np.zeros(1 << self.bits, np.int64)
        self.shift[symbols] = first[symbols] - begins

    def step(self, lo: np.ndarray, size: np.ndarray, symbol: np.ndarray):
        """Intervals with a symbol put before: where they begin, how long they are, and how many smaller symbols stood there."""
        hi, less = lo + size, np.zeros(len(lo), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            less += np.where(bit, (hi - b) - (lo - a), 0)
            lo, hi = np.where(bit, zeros + a, lo - a), np.where(bit, zeros + b, hi - b)
        return lo + self.shift[symbol], hi - lo, less

    def children(self, lo: np.ndarray, size: np.ndarray):
        """All symbols that stand before the suffixes of each interval: (interval, symbol, begin, size, smaller symbols)."""
        who, hi, symbol, less = np.arange(len(lo)), lo + size, np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            a, b = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            none = (hi - b) - (lo - a)
            left, right = none > 0, b > a
            who = np.concatenate([who[left], who[right]])
            symbol, less = np.concatenate([symbol[left] << 1, symbol[right] << 1 | 1]), np.concatenate([less[left], (less + none)[right]])
            lo, hi = np.concatenate([(lo - a)[left], (zeros + a)[right]]), np.concatenate([(hi - b)[left], (zeros + b)[right]])
        return who, symbol, lo + self.shift[symbol], hi - lo, less


def _suffixes(text: np.ndarray, sigma: int) -> np.ndarray:
    """Order of the suffixes by prefix doubling, from as many symbols as a number holds; the text's last symbol is its least and stands once."""
    n, bits = len(text), max(1, int(sigma - 1).bit_length())
    width = 62 // bits
    rank, padded = np.zeros(n, np.int64), np.concatenate([text, np.zeros(width, text.dtype)])
    for i in range(width):
        rank = rank << bits | padded[i : i + n]
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate([[0], rank[order][1:] != rank[order][:-1]]))
        if new[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = new[width:] + 1
        rank, width = new * (n + 1) + after, 2 * width


END, MARK = 0, 1  # the end of the text, and what stands around each word


class Index:
    """Both directions of `#word#word#…#`, the words all different. A pattern has two intervals of one size, among the suffixes of the text and of
    its reverse; a symbol put at its left moves the first by LF and the second by the smaller symbols, one at its right the other way round."""

    def __init__(self, words: list[str]):
        self.words = words
        points = np.frombuffer("".join(f"#{w}" for w in words).encode("utf-32-le") + "#\0".encode("utf-32-le"), np.uint32)
        self.letters = np.unique(points[points > ord("#")])
        text = np.where(points > ord("#"), np.searchsorted(self.letters, points) + 2, np.where(points == 0, END, MARK)).astype(np.int64)
        self.sigma, self.n = len(self.letters) + 2, len(text)
        length = np.fromiter(map(len, words), np.int64, len(words))
        self.ways = [_Bwt(text, self.sigma), _Bwt(np.concatenate([text[-2::-1], [END]]), self.sigma)]
        # the suffixes that begin with a mark come after the end's; the last mark's own is the first of them
        begin = [np.cumsum(np.concatenate([[0], length[:-1] + 1])), np.cumsum(np.concatenate([[0], length[:0:-1] + 1]))]
        self.word_at = []
        for way, back in ((0, False), (1, True)):
            k = np.searchsorted(begin[way], self.ways[way].order[2 : len(words) + 2])
            self.word_at.append(len(words) - 1 - k if back else k)
        self.rank = np.empty(len(words), np.int64)  # in code-point order
        self.rank[self.word_at[0]] = np.arange(len(words))

    def coded(self, words: list[str]) -> np.ndarray:
        """Words of one length as rows of symbols; a letter that the index doesn't have is one past its symbols."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        at = np.searchsorted(self.letters, points)
        known = self.letters[np.minimum(at, len(self.letters) - 1)] == points
        return np.where(known, at + 2, self.sigma).astype(np.int64)

    def near(self, codes: np.ndarray, exact: int, side: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words that are one edit from a query, the edit beyond the half that is matched exactly.

        codes: queries of one length. Side 0 matches the first `exact` symbols, from the middle to the left and the mark, then goes right with one
        error; side 1 is its mirror. The error stands where query and word first differ, so that each pair is found once.
        """
        first, other = self.ways[side], self.ways[1 - side]
        q = codes if side == 0 else codes[:, ::-1]
        k, m = q.shape
        q = np.concatenate([q, np.full((k, 1), MARK)], axis=1)
        who = np.arange(k)
        x, y, size = np.zeros(k, np.int64), np.zeros(k, np.int64), np.full(k, self.n, np.int64)

        def moved(way, a, b, size, who, symbol, *more):
            """The patterns that still occur with a symbol more; a is the interval of the side that grows."""
            ok = symbol < self.sigma
            a, b, size, who, symbol, more = a[ok], b[ok], size[ok], who[ok], symbol[ok], [z[ok] for z in more]
            a, new, less = way.step(a, size, symbol)
            b = b + less
            ok = new > 0
            return a[ok], b[ok], new[ok], who[ok], *[z[ok] for z in more]

        for j in (*range(exact - 1, -1, -1), m):
            x, y, size, who = moved(first, x, y, size, who, q[who, j])
        none = np.zeros(0, np.int64)
        late = (none, none, none, none)  # y, x, size, query of what has its error behind it
        for j in range(exact, m + 1):
            c, symbol, cy, csize, less = other.children(y, size)
            fresh = (symbol > MARK) & (symbol != q[who[c], j])
            wrong = (cy[fresh], x[c[fresh]] + less[fresh], csize[fresh], who[c[fresh]])
            late = tuple(np.concatenate(z) for z in zip(late, wrong, strict=True))  # a symbol more in the word
            ly, lx, lsize, lwho = late
            late = moved(other, ly, lx, lsize, lwho, q[lwho, j])
            if j == m:
                break
            gone = q[who, j] != q[who, j + 1]
            missing = (y[gone], x[gone], size[gone], who[gone])  # a symbol less in the word
            late = tuple(np.concatenate(z) for z in zip(late, wrong, missing, strict=True))  # `wrong` again: another symbol
            y, x, size, who = moved(other, y, x, size, who, q[who, j])
        return late[3], self.word_at[side][late[1] - 2]


def _lookups(index: Index, counts: np.ndarray, queries: list[tuple[str, int]], side: int):
    """For each query how many words are near it by this side's half, and the most frequent of them."""
    by_length: dict[int, list[int]] = {}
    for i, (word, _) in enumerate(queries):
        by_length.setdefault(len(word), []).append(i)
    near, best = np.zeros(len(queries), np.int64), np.full(len(queries), -1, np.int64)
    for m, all_at in by_length.items():
        half = m // 2
        for i in range(0, len(all_at), TOGETHER):
            at = all_at[i : i + TOGETHER]
            q, w = index.near(index.coded([queries[j][0] for j in at]), m - half if side else half, side)
            q = np.asarray(at, np.int64)[q]
            if side:  # those that have the first half too are the other side's
                keep = np.fromiter((index.words[b][:half] != queries[a][0][:half] for a, b in zip(q, w, strict=True)), bool, len(q))
                q, w = q[keep], w[keep]
            near += np.bincount(q, minlength=len(queries))
            order = np.lexsort((index.rank[w], -counts[w], q))
            q, w = q[order], w[order]
            head = np.concatenate([np.ones(min(1, len(q)), bool), q[1:] != q[:-1]])
            best[q[head]] = w[head]
    return near, best


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): how many words are one edit from each word, and the most frequent of them (ties: the least).

    Words one edit apart have a half in common, and so their first or their last EDGE code points: each word is dealt by both, and an index holds the
    words of some such ends. An end with more than BLOCK words has its words dealt to several indexes, and its queries asked of each. The keys are
    at most two for each three letters, so the table of such ends is bounded. vocabulary: word, n; words are different.
    """
    ends = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.left("word", F.lit(EDGE)).alias("edge")), F.struct(F.lit(1).alias("side"), F.right("word", F.lit(EDGE)).alias("edge"))))
    rows = vocabulary.select("word", "n", ends.alias("e")).select("word", "n", "e.side", "e.edge")
    hot = rows.groupBy("side", "edge").count().filter(F.col("count") > BLOCK).select("side", "edge", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(F.broadcast(hot), ["side", "edge"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("here", F.col("block") == F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    dealt = rows.repartition(tasks_for(vocabulary.sparkSession), "side", "edge", "block").sortWithinPartitions("side", "edge", "block", F.desc("here"))

    def search(batches):
        held: list[tuple[str, int]] = []  # words of the index to be
        asked: list[tuple[str, int]] = []
        index, counts, now = None, None, None

        def answer():
            nonlocal index, counts
            if held and index is None:
                index, counts = Index([w for w, _ in held]), np.asarray([n for _, n in held], np.int64)
            near, best = _lookups(index, counts, asked, now[0]) if index else (np.zeros(len(asked), np.int64), np.full(len(asked), -1))
            form, form_n = [held[b][0] if b >= 0 else None for b in best], [held[b][1] if b >= 0 else None for b in best]
            out = [pa.array([w for w, _ in asked], pa.string()), pa.array([n for _, n in asked], pa.int64()), pa.array(near), pa.array(form, pa.string()), pa.array(form_n, pa.int64())]
            asked.clear()
            return pa.RecordBatch.from_arrays(out, names=["word", "n", "n_near", "form", "form_n"])

        for b in batches:
            for side, edge, block, blocks, here, word, n in zip(*(b.column(c).to_pylist() for c in ("side", "edge", "block", "blocks", "here", "word", "n")), strict=True):
                key = (side, edge, block, blocks)
                if key != now:
                    alone = now and (side != now[0] or max(blocks, now[3]) > 1)  # blocks of one end, and the two sides, have indexes of their own
                    if alone or len(held) >= BLOCK:
                        if asked:
                            yield answer()
                        held, index = [], None
                    now = key
                if here:
                    held.append((word, n))
                elif len(asked) >= BLOCK:  # all words of this block are held
                    yield answer()
                asked.append((word, n))
        if asked:
            yield answer()

    found = dealt.select("side", "edge", "block", "blocks", "here", "word", "n").mapInArrow(search, "word string, n long, n_near long, form string, form_n long")
    first = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form")))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("f")).select("word", "n", "n_near", F.col("f.form").alias("form"), (-F.col("f.less")).alias("form_n"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): the last form of each word that has one. forms: word, form. A form is RATIO times as frequent, so that no chain has more
    than 19 steps, and each round doubles the steps that are taken."""
    now = scratch.save(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while now.filter("moved").head(1):
        after = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = scratch.save(now.drop("moved").join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        scratch.drop(now)
        now = new
    return now.drop("moved")


def variants(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of the documents."""
    vocabulary = scratch.save(occurrences(docs).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN), "spelling-words")
    near = neighbours(vocabulary)
    enough = F.col("form_n") >= RATIO * F.col("n")
    found = scratch.save(near.select("word", F.when(enough, F.col("form")).alias("form"), "n", "n_near", F.when(enough, F.col("form_n")).alias("form_n")), "spelling-near")
    last = roots(found.filter("form is not null"), scratch)
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir):
    """All words of documents with their near words and forms: word, form, root, n, n_near, form_n; a row a word.

    A null text has no words, a null doc_id is empty in the rule's key, a row that is there twice counts twice; without words there are no rows.
    """
    scratch = Scratch()
    return scratch.result(variants(read(spark, sf_dir, "documents"), scratch), "spelling-result")
