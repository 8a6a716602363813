"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, read
from .words import parts

#: Labelled rows, and bytes of their texts, that the network is fitted on at most; scoring covers all rows.
SAMPLE, SAMPLE_BYTES = 5000, 32 << 20
#: Words in a window, and from one window to the next; every word lies in two windows but at the ends.
WINDOW, STRIDE = 32, 16
WORDS, GRAMS, TABLE, DIM, HIDDEN, ATTEND = 1 << 20, 1 << 18, 1 << 15, 4, 8, 8
CACHE = 200_000
_INNER = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Inputs:
    """Numbers for the tokens of texts: word input (hash) and character input (4-byte windows)."""

    def __init__(self):
        self.fresh()

    def fresh(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.word, self.text = [0], ["\n"]

    def tokens(self, text: str | None) -> list[int]:
        number, out = self.number, []
        for t in (text or "").split():
            n = number.get(t)
            if n is None:
                w = _INNER.sub("", t.lower())
                n = number[t] = len(self.word)
                self.word.append(xxhash.xxh3_64_intdigest(w.encode("utf-8")) if w else 0)
                self.text.append(w)
            out.append(n)
        return out

    def grams(self, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the 4-byte windows of the words numbered from `first` on, and where each word's begin."""
        parts = [f"\n\n{w}\n\n".encode("utf-8") for w in self.text[first:]]
        raw = np.frombuffer(b"".join(parts) + b"\0\0\0", dtype=np.uint8).astype(np.uint64)
        v = raw[:-3] | raw[1:-2] << np.uint64(8) | raw[2:-1] << np.uint64(16) | raw[3:] << np.uint64(24)
        with np.errstate(over="ignore"):
            b = (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 18)
        lengths = np.array([len(p) for p in parts])
        return b.astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)


def windows_of(tokens: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows of the texts (0: padding) and the text that each is from; one at least for each text."""
    counts = np.array([max(1, -(-max(0, len(t) - WINDOW) // STRIDE) + 1) for t in tokens], dtype=np.int64)
    room = (counts - 1) * STRIDE + WINDOW
    begin = np.concatenate([[0], np.cumsum(room)]).astype(np.int64)
    flat = np.zeros(begin[-1], dtype=np.int32)
    for t, b in zip(tokens, begin[:-1].tolist(), strict=True):
        flat[b : b + len(t)] = t
    owner = np.repeat(np.arange(len(tokens)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begin[owner] + within * STRIDE
    return flat[at[:, None] + np.arange(WINDOW)[None, :]], owner


class Network:
    """Word and character log-odds, learned word vectors, a forward and a backward GRU, attention."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d, h = DIM + 3, HIDDEN
        self.word_odds, self.gram_odds = np.zeros(WORDS, np.float32), np.zeros(GRAMS, np.float32)
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"E": f(TABLE, DIM) * np.float32(0.1), "Wa": f(2 * h, ATTEND), "ba": np.zeros(ATTEND, np.float32), "v": f(ATTEND), "w": f(2 * h), "b": np.zeros(1, np.float32)}
        for k in "fb":
            self.p |= {f"W{k}": f(d, 3 * h), f"U{k}": f(h, 3 * h), f"c{k}": np.zeros(3 * h, np.float32)}

    # inputs
    def features(self, inputs: Inputs, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Fixed inputs of the words from `first` on, and the rows of the learned word vectors."""
        word = np.array(inputs.word[first:], dtype=np.uint64)
        b, starts = inputs.grams(first)
        odds = self.gram_odds[b]
        n = np.diff(np.append(starts, len(odds)))
        fixed = np.stack([self.word_odds[(word % np.uint64(WORDS)).astype(np.int64)], np.maximum.reduceat(odds, starts), np.add.reduceat(odds, starts) / n], axis=1).astype(np.float32)
        return fixed, ((word >> np.uint64(24)) % np.uint64(TABLE)).astype(np.int64)

    # one direction
    def _run(self, gx: np.ndarray, k: str, keep: bool):
        """gx: time, windows, 3H. The states after each step, and what going back needs."""
        h, u = np.zeros((gx.shape[1], HIDDEN), np.float32), self.p[f"U{k}"]
        out, cache, steps = np.empty((gx.shape[0], gx.shape[1], HIDDEN), np.float32), [], range(gx.shape[0])
        for t in steps if k == "f" else reversed(steps):
            hu = h @ u
            zr = _sigmoid(gx[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r, c = zr[:, :HIDDEN], zr[:, HIDDEN:], hu[:, 2 * HIDDEN :]
            n = np.tanh(gx[t, :, 2 * HIDDEN :] + r * c)
            if keep:
                cache.append((t, h, z, r, c, n))
            h = n + z * (h - n)
            out[t] = h
        return out, cache

    def logits(self, gf: np.ndarray, gb: np.ndarray, pad: np.ndarray, keep: bool = False):
        """gf, gb: projected inputs (time, windows, 3H); pad: (time, windows)."""
        hf, cf = self._run(gf, "f", keep)
        hb, cb = self._run(gb, "b", keep)
        h = np.concatenate([hf, hb], axis=2)
        a = np.tanh(h @ self.p["Wa"] + self.p["ba"])
        e = a @ self.p["v"] - np.float32(30) * pad
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        s = (e[:, :, None] * h).sum(axis=0)
        out = s @ self.p["w"] + self.p["b"][0]
        return out, (h, a, e, s, cf, cb) if keep else None

    def _back(self, dh: np.ndarray, cache, k: str, g: dict, x: np.ndarray) -> np.ndarray:
        u, w = self.p[f"U{k}"], self.p[f"W{k}"]
        carry, dx = np.zeros_like(dh[0]), np.zeros(x.shape, np.float32)
        for t, h, z, r, c, n in reversed(cache):
            d = dh[t] + carry
            dn, dz, carry = d * (1 - z) * (1 - n * n), d * (h - n) * z * (1 - z), d * z
            dr = dn * c * r * (1 - r)
            dg, du = np.concatenate([dz, dr, dn], axis=1), np.concatenate([dz, dr, dn * r], axis=1)
            carry = carry + du @ u.T
            g[f"U{k}"] += h.T @ du
            g[f"W{k}"] += x[t].T @ dg
            g[f"c{k}"] += dg.sum(axis=0)
            dx[t] = dg @ w.T
        return dx

    def step(self, win: np.ndarray, y: np.ndarray, weight: np.ndarray, fixed: np.ndarray, row: np.ndarray, state: dict, rate: float) -> None:
        """One Adam step on windows (rows of token numbers) with targets y."""
        ids = win.T
        x = np.concatenate([fixed[ids], self.p["E"][row[ids]]], axis=2)
        pad = (ids == 0).astype(np.float32)
        pad[0] = 0
        gf, gb = x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]
        out, (h, a, e, s, cf, cb) = self.logits(gf, gb, pad, True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d = ((_sigmoid(out) - y) * weight / len(y)).astype(np.float32)
        g["b"][0], g["w"] = d.sum(), s.T @ d
        ds = d[:, None] * self.p["w"][None, :]
        de = (h * ds[None]).sum(axis=2)
        de = e * (de - (e * de).sum(axis=0))
        da = de[:, :, None] * self.p["v"] * (1 - a * a)
        g["v"] = (a * de[:, :, None]).sum(axis=(0, 1))
        g["Wa"], g["ba"] = np.einsum("tmi,tmj->ij", h, da), da.sum(axis=(0, 1))
        dh = e[:, :, None] * ds[None] + da @ self.p["Wa"].T
        dx = self._back(dh[:, :, :HIDDEN], cf, "f", g, x) + self._back(dh[:, :, HIDDEN:], cb, "b", g, x)
        np.add.at(g["E"], row[ids].ravel(), dx[:, :, 3:].reshape(-1, DIM))
        state["t"] = n = state.get("t", 0) + 1
        for k, v in g.items():
            m = state[f"m{k}"] = 0.9 * state.get(f"m{k}", 0) + 0.1 * v
            q = state[f"q{k}"] = 0.999 * state.get(f"q{k}", 0) + 0.001 * v * v
            self.p[k] -= (rate * (m / (1 - 0.9**n)) / (np.sqrt(q / (1 - 0.999**n)) + 1e-8)).astype(np.float32)

    def fit(self, texts: list[str], labels: np.ndarray, steps: int = 200, seed: int = 7) -> None:
        """Log-odds of words and character windows by text, then the network on windows.

        A toxic text says only that some window is toxic: its windows of highest score stand for
        it, by log-odds at first, then by the network. Clean texts give their highest windows and others.
        There are three rounds over the windows, or more until there were `steps` steps.
        """
        r, inputs = np.random.default_rng(seed), Inputs()
        tokens = [inputs.tokens(t) for t in texts]
        word = (np.array(inputs.word, dtype=np.uint64) % np.uint64(WORDS)).astype(np.int64)
        b, starts = inputs.grams(0)
        ends = np.append(starts[1:], len(b))
        seen = {1: (np.zeros(WORDS), np.zeros(GRAMS)), 0: (np.zeros(WORDS), np.zeros(GRAMS))}
        for t, y in zip(tokens, labels.tolist(), strict=True):
            u = np.unique(np.array(t, dtype=np.int64))
            if len(u):
                seen[y][0][np.unique(word[u])] += 1
                seen[y][1][np.unique(np.concatenate([b[starts[i] : ends[i]] for i in u]))] += 1
        pos, neg = max(1, int((labels == 1).sum())), max(1, int((labels == 0).sum()))
        for i, name in enumerate(("word_odds", "gram_odds")):
            odds = np.log((seen[1][i] + 0.5) / (pos + 1)) - np.log((seen[0][i] + 0.5) / (neg + 1))
            sure = np.minimum(1, (seen[1][i] + seen[0][i]) / 8)  # what few texts hold says little
            setattr(self, name, np.clip(odds * sure / 4, -1.5, 1.5).astype(np.float32))
        win, owner = windows_of(tokens)
        fixed, row = self.features(inputs)
        y = labels[owner].astype(np.float32)
        score, state = fixed[win, :2].max(axis=(1, 2)), {}
        epoch = done = 0
        while epoch < 3 or (done < steps and epoch < 25):
            best = np.lexsort((-score, owner))
            rank = np.empty(len(win), dtype=np.int64)
            rank[best] = np.arange(len(win)) - np.searchsorted(owner[best], owner[best])
            pick = np.flatnonzero(((y == 1) & (rank < 1)) | ((y == 0) & ((rank < 2) | (r.random(len(win)) < 0.02))))
            pick = pick[r.permutation(len(pick))]
            balance = np.float32(max(1.0, (y[pick] == 0).sum() / max(1, (y[pick] == 1).sum()) / 2))
            batch = min(384, max(32, len(pick) // 24))
            for k in range(0, len(pick), batch):
                i = pick[k : k + batch]
                done += 1
                self.step(win[i], y[i], np.where(y[i] == 1, balance, np.float32(1)), fixed, row, state, 0.01 if epoch < 2 or done < steps * 0.7 else 0.003)
            score = np.concatenate([self.windows(win[k : k + 4096], fixed, row) for k in range(0, len(win), 4096)])
            epoch += 1

    def windows(self, win: np.ndarray, fixed: np.ndarray, row: np.ndarray) -> np.ndarray:
        x = np.concatenate([fixed, self.p["E"][row]], axis=1)
        return self.score(win, x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"])

    def score(self, win: np.ndarray, gf: np.ndarray, gb: np.ndarray) -> np.ndarray:
        ids = np.ascontiguousarray(win.T)
        pad = (ids == 0).astype(np.float32)
        pad[0] = 0
        return self.logits(gf[ids], gb[ids], pad)[0]


class Scorer:
    """Scores of whole texts: the highest of all overlapping windows. Words are projected once a worker."""

    def __init__(self, net: Network):
        self.net, self.inputs = net, Inputs()
        self.gf = self.gb = np.zeros((0, 3 * HIDDEN), np.float32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if len(self.inputs.word) > CACHE:
            self.inputs.fresh()
            self.gf = self.gb = np.zeros((0, 3 * HIDDEN), np.float32)
        net, tokens = self.net, [self.inputs.tokens(t) for t in texts]
        if len(self.inputs.word) > len(self.gf):
            fixed, row = net.features(self.inputs, len(self.gf))
            x = np.concatenate([fixed, net.p["E"][row]], axis=1)
            self.gf = np.concatenate([self.gf, x @ net.p["Wf"] + net.p["cf"]])
            self.gb = np.concatenate([self.gb, x @ net.p["Wb"] + net.p["cb"]])
        win, owner = windows_of(tokens)
        out = np.concatenate([net.score(win[k : k + 2048], self.gf, self.gb) for k in range(0, len(win), 2048)])
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, out)
        return _sigmoid(best)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Network:
    """Fit on `sample` labelled rows and `most_bytes` of text at most, those of the least id hashes, without any held-out row.

    An id counts once: with its least text if it repeats in docs, and not at all if its labels differ. Labels other than 0 and 1 and null
    ids don't count; a text that doesn't fit in the bytes left is passed over. With no row of one class the network stays as
    it began. The sample's texts go to the driver, where the small network is fitted.
    """
    rows = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("__most")).filter("toxic = __most").drop("__most")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = text.withColumn("size", F.octet_length("text")).filter(F.col("size") <= most_bytes)
    got = text.join(F.broadcast(rows), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "size")).alias("x")).select("doc_id", "toxic", "x.*")
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # over ids and sizes of `sample` rows at most, without their texts
    chosen = got.select("doc_id", "size").withColumn("upto", upto).filter(F.col("upto") <= most_bytes).select("doc_id")
    got = got.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "text", "toxic").toPandas()
    got = got.sort_values(["doc_id"], kind="stable")
    net, y = Network(), got["toxic"].to_numpy(np.int64)
    if len(set(y.tolist())) == 2:
        net.fit(got["text"].tolist(), y)
    return net


def score_documents(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and score of every row: the highest of all windows of the whole text.

    A null, empty or wordless text has one window of padding and its score. Rows stand for
    themselves, in any order; no shuffle.
    """
    bounded(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        s = Scorer(sent.value)
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s.scores(b.column("text").to_pylist()), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def op8_toxicity(spark, sf_dir):
    """Toxicity of every document: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5); a row a row of documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
