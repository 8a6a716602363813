"""BPE encoding by a tokenization automaton compiled from the merges, and decoding by its arc labels."""

from __future__ import annotations

import gc
import json
import unicodedata
import zlib
from array import array
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from .common import bounded, read
from .words import parts

#: Unicode White_Space, written out because Python's own class also holds U+001C to U+001F.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Runs of non-white characters that a worker keeps encoded, and their characters; the cache starts anew beyond either.
CACHE, CACHE_CHARS = 300_000, 4_000_000
#: Pre-split words that a worker keeps encoded, whatever runs they came in, twice at most (the last and those before), and the longest of them.
WORDS, WORD_CHARS = 150_000, 64
#: Ends of words whose labels a worker keeps, and the longest of them.
RESTS, REST_CHARS = 50_000, 10


class Automaton:
    """The deterministic automaton over token labels that accepts correct BPE tokenizations only.

    It starts with one state in which every base symbol loops. The merges are taken in order; the
    gadget of merge t, (u, v) -> w, acts wherever an arc u leads to a state with an arc v: that state
    is copied without v, all arcs u go to the copy, and an arc w is added beside each arc u, to where
    v led. All arcs of one label thus lead to one state at any time, so a state is named by the
    label that leads to it. While compiling, it is stored as what its gadgets took away (`without[u]`: v -> t) and as
    the state that it was copied from when its label came to be (that of v, as of time t). An arc x
    leaves a state if no label on x's left spine had been taken away by the time that it was needed.

    The compiled table has a row a state: the ranges of labels that no arc of it bears, over labels numbered so that those
    with a common left spine stand together (`place`). A gadget that took v away at time t closes v and the labels that
    begin with v and came to be at t or later; these are one range, as a label's followers are numbered latest first. Rows lie
    one after the other in `starts` and `ends`, a row's limits are in `row`; transitions are looked up there alone.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.ids = vocab
        n = max(vocab.values()) + 1
        left, right, born = [-1] * n, [-1] * n, [-1] * n
        without: dict[int, dict[int, int]] = {}

        def arc(state: int, label: int) -> bool:
            """Whether the arc `label` leaves the state that the arcs `state` lead to, by the gadgets so far."""
            by = n + (1 << 40)
            while state >= 0:
                gone = without.get(state)
                if gone:
                    x, need = label, by
                    while x >= 0:
                        t = gone.get(x)
                        if t is not None and t < by and t <= need:
                            return False
                        need, x = born[x], left[x]
                by, state = min(by, born[state]), right[state]
            return True

        for t, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if born[w] >= 0 or not arc(u, v):
                continue  # no path u v is left, so the gadget changes nothing
            left[w], right[w], born[w] = u, v, t
            without.setdefault(u, {})[v] = t
        self._compile(n, left, right, born, without)
        self.longest = max((len(x) - 4 * x.endswith("</w>") for x in vocab), default=1)
        self.heads: dict[str, tuple[int, dict]] = {}  # a tree of the inner labels by characters: a label's id, or -1, and what follows
        self.whole: dict[str, int] = {}  # the labels that end a word
        self.rests: dict[str, tuple[tuple[int, int], ...]] = {}
        for x, i in vocab.items():
            inner = not x.endswith("</w>")
            if born[i] < 0 and len(x) - 4 * (not inner) != 1:
                continue
            if not inner:
                self.whole[x[:-4]] = i
                continue
            below = self.heads
            for c in x[:-1]:
                below = below.setdefault(c, (-1, {}))[1]
            below[x[-1]] = (i, below.get(x[-1], (-1, {}))[1])

    def _compile(self, n: int, left: list[int], right: list[int], born: list[int], without: dict) -> None:
        below: list[list[int]] = [[] for _ in range(n)]
        for x in sorted(range(n), key=lambda x: -born[x]):
            if left[x] >= 0:
                below[left[x]].append(x)  # latest first
        place, end, at = [0] * n, [0] * n, 0
        for root in range(n):
            todo = [(root, False)] if left[root] < 0 else []
            while todo:
                x, done = todo.pop()
                if done:
                    end[x] = at
                else:
                    place[x], at = at, at + 1
                    todo.append((x, True))
                    todo += [(c, False) for c in reversed(below[x])]
        own = {}
        for u, gone in without.items():
            rows = []
            for v, t in gone.items():
                last = place[v] + 1
                for c in below[v]:
                    if born[c] < t:
                        break
                    last = end[c]
                rows.append((t, place[v], last))
            own[u] = np.array(rows, dtype=np.int32)
        closed, none = {}, np.zeros((0, 3), np.int32)
        rows: list[np.ndarray] = [none[:, 1:]] * n
        for x in sorted(range(n), key=lambda x: born[x]):  # a state is a copy of one that came before
            from_ = closed.get(right[x], none)
            closed[x] = np.concatenate([own.get(x, none), from_[from_[:, 0] < born[x]]])
            r = closed[x][np.argsort(closed[x][:, 1], kind="stable"), 1:]
            if len(r):  # overlapping ranges become one
                reach = np.maximum.accumulate(r[:, 1])
                first = np.flatnonzero(np.concatenate([[True], r[1:, 0] > reach[:-1]]))
                rows[x] = np.stack([r[first, 0], reach[np.append(first[1:], len(r)) - 1]], axis=1)
        table = np.concatenate(rows) if n else none[:, 1:]
        as_array = lambda x: array("i", np.ascontiguousarray(x, dtype=np.int32).tobytes())
        self.place, self.starts, self.ends = as_array(place), as_array(table[:, 0]), as_array(table[:, 1])
        self.row = as_array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]))

    def arc(self, state: int, label: int) -> bool:
        """Whether the arc `label` leaves the state that the arcs `state` lead to: one look into the state's row."""
        at, low = self.place[label], self.row[state]
        k = bisect_right(self.starts, at, low, self.row[state + 1])
        return k == low or self.ends[k - 1] <= at

    def _arcs(self, rest: str) -> tuple[tuple[int, int], ...]:
        """All labels that the rest of a word begins with, and their lengths; the longest is the first."""
        out, below, n = [], self.heads, len(rest)
        for j, c in enumerate(rest[: min(n - 1, self.longest)], 1):  # the last character has a label that ends the word
            if c not in below:
                break
            x, below = below[c]
            if x >= 0:
                out.append((x, j))
        if n <= self.longest:
            x = self.whole.get(rest)
            if x is not None:
                out.append((x, n))
        found = tuple(out[::-1])
        if n <= REST_CHARS:
            if len(self.rests) >= RESTS:
                self.rests.clear()
            self.rests[rest] = found
        return found

    def encode(self, word: str) -> list[int]:
        """The labels on the one accepting path that spells word (byte-level symbols, the last with </w>).

        A prefix has one path at most, so a place from which the end can't be reached is never
        entered again, and the search is linear in the word's length. The transitions are those of arc(), looked up in place.
        """
        if word in self.whole:
            return [self.whole[word]]  # any label may be the first
        place, starts, ends, row, rests = self.place, self.starts, self.ends, self.row, self.rests
        n, i, far = len(word), 0, self.longest + 1  # no label reaches beyond
        arcs = iter(self._arcs(word[:far]))
        low = high = 0  # the row of the state: of the first, empty
        out, held, dead = [], [], set()
        while True:
            for x, size in arcs:
                j = i + size
                if dead and j in dead:
                    continue
                at = place[x]
                k = bisect_right(starts, at, low, high)
                if k == low or ends[k - 1] <= at:
                    out.append(x)
                    if j == n:
                        return out
                    held.append((low, high, i, arcs))
                    low, high, i, rest = row[x], row[x + 1], j, word[j : j + far]
                    arcs = iter(rests[rest] if rest in rests else self._arcs(rest))
                    break
            else:
                dead.add(i)
                low, high, i, arcs = held.pop()
                out.pop()


@lru_cache(maxsize=1)
def _bytes_to_symbols() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for U+0100 onwards."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class _Numbers(dict):
    """Numbers of runs; that of a new run is made when it is asked for."""

    def __init__(self, new):
        self.new = new

    def __missing__(self, run: str) -> int:
        n = self[run] = self.new(run)
        return n


class Tokenizer:
    """Normalisation, pre-tokenization and the automaton of one tokenizer file (its text)."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        model = spec["model"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges)
        self.labels = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels |= {i: t for t, i in self.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern.replace(r"\s", WHITE))
        self.white = regex.compile(f"[{WHITE}]+")
        self.odd = regex.compile("[\x1c-\x1f]")  # Python splits at these, the pattern doesn't
        self.table = {b: s for b, s in enumerate(_bytes_to_symbols())}
        self.known: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}
        self.fresh()

    def fresh(self) -> None:
        self.held = 0
        self.number = _Numbers(self._new)
        self.flat, self.begin = array("i"), array("q", [0])

    def normal(self, text: str) -> str:
        text = self.white.sub(" ", unicodedata.normalize("NFC", text))
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def _new(self, run: str) -> int:
        """Keep the ids of a run of non-white characters: no pre-split word reaches beyond one."""
        known, flat = self.known, self.flat
        for word in self.pieces(run):
            flat.extend(known[word] if word in known else self._word(word))
        self.held += len(run)
        self.begin.append(len(flat))
        return len(self.begin) - 2

    def _word(self, word: str) -> tuple[int, ...]:
        """The ids of a pre-split word, which are kept for the other runs that it is in."""
        if word[0] == "\0" and word[1:] in self.special:
            return (self.special[word[1:]],)
        ids = self.before.get(word)
        if ids is None:
            plain = word.isascii() and word.isprintable()  # each character is its own symbol
            ids = tuple(self.automaton.encode(word if plain else word.encode("utf-8").decode("latin-1").translate(self.table)))
        if len(word) <= WORD_CHARS:
            self.known[word] = ids
        return ids

    def pieces(self, run: str) -> list[str]:
        """The pre-split words of a run; a special token is marked by a NUL before it."""
        if self.at_special is None or "<|" not in run:
            if not run.isascii():
                return self.words.findall(self.normal(run))
            return [run.lower()] if run.isalpha() else self.words.findall(run.lower())
        out: list[str] = []
        for i, part in enumerate(self.at_special.split(run)):
            out += [f"\0{part}"] if i % 2 else self.words.findall(self.normal(part))
        return out

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and all ids of a list of texts."""
        if len(self.number) > CACHE or self.held > CACHE_CHARS:
            self.fresh()
        if len(self.known) > WORDS:
            self.known, self.before = {}, self.known
        number, seen, counts = self.number.__getitem__, array("q"), [0]
        for text in texts:
            runs = self.white.split(text or "") if self.odd.search(text or "") else (text or "").split()
            seen.extend(map(number, runs))
            counts.append(len(seen))
        at, begin = np.frombuffer(seen, dtype=np.int64) if seen else np.zeros(0, np.int64), np.frombuffer(self.begin, dtype=np.int64).copy()
        flat = np.frombuffer(self.flat, dtype=np.int32).copy() if self.flat else np.zeros(0, np.int32)
        n = begin[at + 1] - begin[at]
        total = np.concatenate([[0], np.cumsum(n)])
        return total[np.array(counts)], flat[np.repeat(begin[at] - total[:-1], n) + np.arange(total[-1])]

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the arcs, joined by a space."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])


@lru_cache(maxsize=1)
def compiled(packed: bytes) -> Tokenizer:
    """The tokenizer of a compressed file, compiled once in each worker, whose garbage collector then leaves the table alone."""
    made = Tokenizer(zlib.decompress(packed))
    gc.collect()
    gc.freeze()
    return made


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add `ids`, the whole text's token ids, and `decoded`, the text of those ids read back.

    keep names the columns to carry (doc_id if none are given). A null text counts as empty and has
    no ids and an empty decoded text. Each row stands for itself: no shuffle, rows of any order. The file is
    read on the driver and broadcast (compressed, under a megabyte); each worker compiles its table once, of a size that depends on the vocabulary alone.
    """
    bounded(docs.sparkSession)
    keep = keep or ["doc_id"]
    fields = docs.select(*keep).schema
    with open(path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(zlib.compress(f.read()))

    def run(batches):
        t = compiled(sent.value)
        for b in parts(batches, "__text"):
            offsets, ids = t.encode_batch(b.column("__text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            every = ids.tolist()
            decoded = pa.array([t.decode(every[i:j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], lists, decoded], names=[*keep, "ids", "decoded"])

    out = StructType([*fields.fields]).add("ids", ArrayType(IntegerType())).add("decoded", StringType())
    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, out)


def digests(encoded: DataFrame, keep: list[str]) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(*keep, F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_bpe(spark, sf_dir):
    """Token ids of every whole text of documents as digests: doc_id, n_tokens (long), ids_sha256, decoded_sha256; a row a row.

    Null and empty texts have no tokens and the digests of the empty string.
    """
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")), ["doc_id"])
