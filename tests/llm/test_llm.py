"""The training-data operators on hand-made rows, against brute force, exact round trips and held-out rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wareflow.llm import bpe, chat, html, jaccard, mixing, neardup, quality, sharding, suffixes, toxicity
from wareflow.llm.components import components

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def find_roots(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.fixture(scope="module")
def docs(spark):
    """Plain, null, empty and odd texts, copies, a null language and source, columns with clashing names."""
    texts = [prose(i, 60 + i) for i in range(40)]
    base = prose(99, 400).split()
    for i in range(6):
        changed = list(base)
        changed[50 * i] = "odd"
        texts.append(" ".join(changed))
    shared = prose(7, 60)
    texts += [f"{prose(200 + i, 40)} {shared} {prose(300 + i, 40)}" for i in range(4)]
    texts += [None, "", " \t\n ", "one", "one", "Two words", prose(1, 61), prose(5000, 5000), "a\n\na\nb\n" * 30]
    rows = [(i, t, None if i % 11 == 0 else "en", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).withColumns({"key": F.lit("x"), "sig": F.lit(1), "size": F.lit(2), "id": F.lit(3), "__node": F.lit(4)})


def empty(spark):
    return spark.createDataFrame([], DOC)


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    got = {x.id: x.component_id for x in components(spark.createDataFrame(links, "u long, v long")).collect()}
    ids = {i for p in links if p[0] != p[1] for i in p}
    assert got == find_roots(ids, links) and not components(spark.createDataFrame([], "u long, v long")).count()


def test_sharding(spark, docs):
    got = sharding.shard_documents(docs, shards=4).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    by = defaultdict(list)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        by[r.shard].append(r)
    assert set(by) <= set(range(4)) and all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    assert sharding.shard_documents(empty(spark), shards=4).count() == 0


def test_sharding_is_even_with_a_hot_source(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "repeat('x', cast(20 + id % 50 as int)) as text", "'en' as lang", "if(id % 3 = 0, 'hot', concat('s', id % 5)) as source")
    sizes = [r.b for r in sharding.shard_documents(rows, shards=16).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.02 * sum(sizes) / 16
    parts = sharding.shard_documents(rows, shards=None, target_bytes=20_000).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert max(r.b for r in parts) <= 21_000


def test_sharding_splits_on_source_and_language(spark):
    rows = spark.range(1600).selectExpr("id as doc_id", "lpad(id, 40, 'x') as text", "if(id % 16 < 8, 'de', 'en') as lang", "concat('src', id % 16) as source")
    for column in ("lang", "source"):
        one = rows.withColumn("lang" if column == "source" else "source", F.lit(None).cast("string"))
        got = sharding.shard_documents(one, shards=2 if column == "lang" else 4).join(one, "doc_id").groupBy(column).agg(F.count_distinct("shard").alias("n")).collect()
        assert len(got) == (2 if column == "lang" else 16) and all(r.n == 1 for r in got)


def test_sharding_cuts_metadata_and_keeps_copies_together(spark):
    """Language, source and size are all cut where they spread; copies are in one shard, and a hot copy is dealt evenly."""
    rows = spark.range(4000).selectExpr("id as doc_id", "repeat(concat('w', id div 2, ' '), cast(1 + (id div 2) % 97 as int)) as text", "if(id % 4 < 2, 'de', 'en') as lang", "concat('src', id % 8 div 2) as source")
    kept = sharding.Scratch()
    slim = rows.select("doc_id", F.octet_length("text").cast("long").alias("size"), "lang", "source", F.shiftrightunsigned(F.xxhash64("text"), 40).alias("tie"))
    dims = ["d_size", "d_lang", "d_source"]
    placed, cuts = sharding.kd_shards(sharding.metadata_positions(slim, kept), dims, "size", "tie", kept, shards=32)
    assert {r.dim for c in cuts for r in c.collect()} == {0, 1, 2}
    sizes = [r.b for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 32 and max(sizes) < 1.05 * sum(sizes) / 32  # a pair of copies is up to 0.03 of a shard
    got = sharding.shard_documents(rows, 8).groupBy("text_crc32", "size").agg(F.count_distinct("shard").alias("n"))
    assert got.filter("n > 1").count() == 0
    hot = rows.withColumn("text", F.when(F.col("doc_id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("another "), "doc_id")))
    sizes = [r.b for r in sharding.shard_documents(hot, 16).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.05 * sum(sizes) / 16


def test_sharding_odd_rows(spark):
    """Null ids, repeated rows and null columns; the tree's plan doesn't grow with the leaves."""
    rows = spark.createDataFrame([(None, "a", None, None, 1), (None, "a", None, None, 1), (3, None, "en", "s", 0), (3, None, "en", "s", 0), (4, "", None, "s", 0)], DOC)
    got = sharding.shard_documents(rows, 4).collect()
    assert len(got) == 5 and all(sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got))) for k in range(4))
    many = spark.range(2000).selectExpr("id as doc_id", "lpad(id, 40, 'x') as text", "'en' as lang", "'s' as source")
    parts = sharding.shard_documents(many, None, target_bytes=164).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(parts) > 450 and max(r.b for r in parts) <= 4 * 41 * 2


def brute_quality(text):
    w = [x.decode() for x in (text or "").encode().split()]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if x.encode().split():
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again)


def test_quality(spark, docs):
    got = {r.doc_id: r for r in quality.judge(docs, ["doc_id", "lang", "source"]).collect()}
    for r in docs.collect():
        g, want = got[r.doc_id], brute_quality(r.text)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (g.base_failed and g.kept)
    assert quality.judge(empty(spark), ["doc_id", "lang", "source"]).count() == 0


def test_quality_on_real_texts(spark):
    rows = spark.read.parquet(f"{DIR}/documents.parquet")
    got = {r.doc_id: r for r in quality.judge(rows, ["doc_id", "lang", "source"]).collect()}
    for r in rows.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == brute_quality(r.text)


def test_masks_are_prefix_sums():
    turns = [{"ids": [1, 2, 3, 4], "loss_from": 0, "loss_to": 0}, {"ids": [5, 6, 7], "loss_from": 1, "loss_to": 3}, {"ids": [8, 9], "loss_from": 1, "loss_to": 1}]
    ids, mask = chat.spliced(turns)
    assert ids.tolist() == list(range(1, 10)) and mask.tolist() == [0, 0, 0, 0, 0, 1, 1, 0, 0]
    assert [len(x) for x in chat.spliced([])] == [0, 0]


def test_very_long_turns(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "<|im_end|> word" * 60_000
    turns = spark.createDataFrame([(1, 0, "assistant", text), (1, 1, "user", text)], "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.assemble(chat.encode_turns(turns, path)), path).first()
    assert r.texts == [text, text] and r.loss_texts == [text]


def test_chat_round_trip(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\|", "<|<|", "", None, "é\n🙂 <|endoftext|>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(odd)] + [(2, 0, None, "hi"), (2, 0, None, "hi"), (3, None, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    formatted = chat.assemble(chat.encode_turns(turns, path))
    got = {r.conv_id: r for r in chat.read_back(formatted, path).collect()}
    assert got[1].texts == [t or "" for t in odd] and got[1].loss_texts == [t or "" for i, t in enumerate(odd) if i % 2 and t]
    assert got[2].texts == ["hi", "hi"] and got[3].loss_texts == ["x"]
    assert got[1].formatted.count(chat.START) == len(odd)
    assert chat.assemble(chat.encode_turns(turns.limit(0), path)).count() == 0


def test_vectors(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((300, 16))
    for i in range(60):
        x[240 + i] = x[i % 20] + 0.05 * r.standard_normal(16)
    rows = [(i, v.tolist(), int(i % 3 if i < 240 else i % 20 % 3)) for i, v in enumerate(x)]
    rows += [(300, x[0].tolist(), 0), (301, None, 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0), (304, x[0].tolist(), None), (305, x[0].tolist()[:8], 0), (306, [None] * 16, 0), (307, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"key": F.lit(1), "g": F.lit(1)})
    got = {r.vec_id: r for r in neardup.near_duplicates(df).collect()}
    assert sorted(got) == list(range(308))
    vec = np.array([v for _, v, _ in rows[:301]], dtype=np.float32).astype(float)
    label = np.array([y for *_, y in rows[:301]])
    unit = vec / np.linalg.norm(vec, axis=1)[:, None]
    hit = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(hit, False)
    root = find_roots(range(301), [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(hit)), strict=True)])
    for i in range(301):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (hit[i].sum(), root[i], root[i] == i)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(301, 308))
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_dense_vectors_are_counted_exactly(spark):
    r = np.random.default_rng(6)
    base = r.standard_normal(16)
    rows = [(i, (base + 0.1 * r.standard_normal(16)).tolist(), 0) for i in range(80)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    v = np.array([x for _, x, _ in rows], dtype=np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    assert {r.vec_id: r.n_links for r in got} == {i: int(n) - 1 for i, n in enumerate((v @ v.T >= 0.93).sum(1))}


def linked_vectors(spark, v):
    """near_duplicates() of the rows of v under one label, and what brute force gives: id to (n_links, component_id)."""
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(df).collect()}
    u = v / np.linalg.norm(v, axis=1)[:, None]
    hit = np.triu(u @ u.T >= 0.93, 1)
    root = find_roots(range(len(v)), [(int(a), int(b)) for a, b in zip(*np.nonzero(hit), strict=True)])
    degree = hit.sum(axis=0) + hit.sum(axis=1)
    return got, {i: (int(degree[i]), root[i]) for i in range(len(v))}


def test_isolated_pairs_are_found_in_a_large_label(spark):
    r = np.random.default_rng(3)
    v = r.standard_normal((12000, 64))
    v[:400] = v[400:800] + 0.38 * r.standard_normal((400, 64))
    got, wanted = linked_vectors(spark, v)
    assert sum(n for n, _ in wanted.values()) > 300
    assert got == wanted


@pytest.mark.parametrize("size", [30, 90])
def test_tight_groups_joined_by_few_links(spark, monkeypatch, size):
    """Links between groups whose lists are full of their own members, without help of the audit."""
    monkeypatch.setattr(neardup, "AUDIT", 1)
    monkeypatch.setattr(neardup, "LINKED", 0, raising=False)
    r = np.random.default_rng(8)
    groups = []
    for _ in range(6):
        a, b = np.linalg.qr(r.standard_normal((64, 2)))[0].T
        for turn in (0, 0.4):
            x = np.cos(turn) * a + np.sin(turn) * b + 0.018 * r.standard_normal((size, 64))
            groups.append(x)
    v = np.concatenate([*groups, r.standard_normal((1000, 64))])
    got, wanted = linked_vectors(spark, v)
    u = v / np.linalg.norm(v, axis=1)[:, None]
    cross = [int((u[i : i + size] @ u[i + size : i + 2 * size].T >= 0.93).sum()) for i in range(0, 12 * size, 2 * size)]
    assert 0 < max(cross) < size
    assert got == wanted


def test_bpe_equals_the_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = ["<|endoftext|> Hi<|startoftext|>x", "ΑΣ İstanbul naïve \x1c\x1d12", "aaaa aaaaaaaaa ooo", "日本語 ﬁ ½ '  don't", "ab" * 500]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(odd, 1000)), "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in bpe.encode_documents(rows, path).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    d = bpe.digests(bpe.encode_documents(rows.filter("text is null"), path), ["doc_id"]).first()
    assert d.n_tokens == 0 and d.ids_sha256 == d.decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_bpe_encodes_a_word_once(monkeypatch):
    """A word that many runs hold is taken through the automaton once, also when the runs are forgotten, and words are kept up to a bound."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, calls = Tokenizer.from_file(path), []
    with open(path, "rb") as f:
        t = bpe.Tokenizer(f.read())
    encode = t.automaton.encode
    monkeypatch.setattr(t.automaton, "encode", lambda w: calls.append(w) or encode(w))

    def same(texts):
        offsets, ids = t.encode_batch(texts)
        assert [ids[i:j].tolist() for i, j in zip(offsets[:-1], offsets[1:], strict=True)] == [library.encode(x or "", add_special_tokens=False).ids for x in texts]

    monkeypatch.setattr(bpe, "CACHE", 2)
    for _ in range(3):
        same(["thenti, (thenti) \"Thenti\" thenti-eawh", None, "eawh!"])
    assert sorted(w for w in calls if w.isalpha()) == ["eawh", "thenti"]
    monkeypatch.setattr(bpe, "WORDS", 5)
    monkeypatch.setattr(bpe, "RESTS", 3)
    for k in range(40):
        same([" ".join(f"{'nter' * (i % 3)}st{chr(97 + i % 26)}nt{'ñé' * (i % 2)}" for i in range(k, k + 9)) + " \x7f\x01a ﬁ"])
    assert len(t.known) < 40 and len(t.before) < 40 and len(t.automaton.rests) <= 3


def shingle_set(text, n):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    return frozenset(" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard(spark, docs, n, percent):
    rows = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: shingle_set(t, n) for i, t in rows.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = find_roots(sets, links)
    got = {r.doc_id: r for r in jaccard.jaccard_groups(docs, n, percent).collect()}
    assert {i: (got[i].n_shingles, got[i].component_id) for i in sets} == {i: (len(sets[i]), root[i]) for i in sets}


def test_vectorised_signatures_are_those_of_single_sets():
    import pyarrow as pa

    texts = [prose(i, n) for i, n in enumerate([0, 1, 2, 3, 5, 9, 30, 70, 200, 900])] + [None, "a\u00a0b C", "A B c"]
    members, begin, key = jaccard.shingle_sets(pa.array(texts), 3)
    for i, t in enumerate(texts):
        assert begin[i + 1] - begin[i] == len(shingle_set(t, 3))
    assert key[11] != key[12] and len(set(key.tolist())) == len(texts) - 1  # the texts without words are alike
    bands, size = jaccard.Bands(85), np.diff(begin)
    full = np.flatnonzero(size)
    joined, starts = np.concatenate([members[begin[i] : begin[i + 1]] for i in full]), np.concatenate([[0], np.cumsum(size[full])])
    group = np.array([bands.of(int(size[i])) for i in full])
    found, of, room = jaccard.sign_sets(joined, starts, group, bands)
    for j, i in enumerate(full):
        one, left = jaccard.signatures(members[begin[i] : begin[i + 1]], int(group[j]), bands)
        assert sorted(found[of == j].tolist()) == sorted(one.tolist()) and set(room[of == j].tolist()) == set(left.tolist())


def test_word_hashes_do_not_depend_on_the_batch():
    import pyarrow as pa
    from wareflow.llm import words

    texts = ["Foo bar", "bar\tfoo", None, "", " x", "x", "é" * 9 + "\u3000z", "giant" * 300_000, "a"]
    h, at = words.word_hashes(pa.array(texts), True)
    for i, t in enumerate(texts):
        one, _ = words.word_hashes(pa.array([t], pa.string()), True)
        assert one.tolist() == h[at[i] : at[i + 1]].tolist() and len(one) == len((t or "").encode().split())
    assert len(set(h.tolist())) == 6
    plain, _ = words.word_hashes(pa.array(["Foo foo"]), False)
    assert plain[0] != plain[1] == h[0]
    assert [b.num_rows for b in words.parts([pa.RecordBatch.from_pydict({"text": ["a" * 400_000, "b", "c" * 600_000, None]})])] == [2, 1, 1]


def thue_morse(n, a, b):
    return [(a, b)[bin(i).count("1") & 1] for i in range(n)]


def test_regular_sequences_have_hashes_of_their_own(spark):
    """Words, and texts of words, in the order of Thue and Morse and in its reverse: sums modulo 2**64 alone meet, whatever the base."""
    import pyarrow as pa

    from wareflow.llm import words

    one, other = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    assert len(set(words.word_hashes(pa.array(["".join(one) + " " + "".join(other)]), True)[0].tolist())) == 2
    texts = ["".join(one), "".join(other), " ".join(x * 7 for x in one), " ".join(x * 7 for x in other)]
    _, _, key = jaccard.shingle_sets(pa.array(texts), 4)
    assert len(set(key.tolist())) == 4
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(df, n=1000, percent=85).collect()}
    assert got == {i: i for i in range(4)}


def test_jaccard_near_the_threshold(spark):
    """Sets of many sizes whose similarity lies just at, above or below the threshold."""
    r, rows = random.Random(4), []
    for size in [*range(5, 60, 3), 80, 120, 200, 333]:
        a = [f"x{size}_{i}" for i in range(size)]
        for k in range(4):
            b = list(a)
            for i in r.sample(range(size), min(size, max(0, round(size * 0.02) + k))):
                b[i] = f"y{size}_{k}_{i}"
            rows.append(" ".join(b))
        rows.append(" ".join(a[: round(size * 0.86)]))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = {i: shingle_set(t, 1) for i, t in enumerate(rows)}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    got = {x.doc_id: x.component_id for x in jaccard.jaccard_groups(df, 1, 85).collect()}
    assert got == find_roots(sets, links)
    assert jaccard.jaccard_groups(df.limit(0)).count() == 0


def test_signature_allocations_find_all_links():
    """Any two sets within the threshold have a common entry, in each group that both are in."""
    r, bands = np.random.default_rng(1), jaccard.Bands(85)
    for size in list(range(1, 40)) + [60, 100, 250]:
        for _ in range(20):
            a = np.unique(r.integers(0, 1 << 63, size).astype(np.uint64))
            for cut in range(0, size):
                b = np.unique(np.concatenate([a[cut // 2 :], r.integers(0, 1 << 63, cut - cut // 2).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both < 85 * (len(a) + len(b) - both):
                    break
                x, y = ({s for g in (bands.of(len(z)), bands.of(len(z)) + 1) for s in jaccard.signatures(z, g, bands)[0].tolist()} for z in (a, b))
                assert x & y


def test_large_and_repeated_vectors(spark):
    """Squares that would overflow, and rows that repeat an id."""
    rows = [(0, [1e200, 2e200], 1), (1, [1e200, 2.1e200], 1), (2, [1e-200, -2e-200], 1), (2, [1e-200, -2e-200], 1), (None, [1e200, 2e200], 1)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()), key=repr)
    assert got == sorted([(0, 2, 0, True), (1, 2, 0, False), (2, 1, 2, True), (2, 1, 2, True), (None, 2, 0, False)], key=repr)


@pytest.mark.parametrize("size", [25, 60])
def test_saturated_lists_grow(spark, monkeypatch, size):
    """Two groups larger than a list, joined by few links, are found by longer lists alone: nothing is compared with a whole label."""
    monkeypatch.setattr(neardup, "AUDIT", 0)
    monkeypatch.setattr(neardup, "LONGEST", 80)
    monkeypatch.setattr(neardup, "LINKED", 0)
    asked = []
    scan = neardup.Audit.scan
    monkeypatch.setattr(neardup.Audit, "scan", lambda self, keys: (asked.append(keys.count()), scan(self, keys)))
    r = np.random.default_rng(12)
    a, b = np.linalg.qr(r.standard_normal((64, 2)))[0].T
    groups = [np.cos(turn) * a + np.sin(turn) * b + 0.018 * r.standard_normal((size, 64)) for turn in (0, 0.4)]
    v = np.concatenate([*groups, r.standard_normal((300, 64))])
    got, wanted = linked_vectors(spark, v)
    assert got == wanted and sum(asked) == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">x</a></ul></nav>
<div class="cookie-notice">We use</div><article><h1>Head &amp; more</h1><p><b>First  line<br>second<p>Third &lt;tag&gt; &copy;</p><aside>no</aside><div class="comments"><p>hey</p></div>
<form>f</form><ul><li>a<li>b</ul></article><footer>foot</footer>"""


def test_html(spark):
    url = "http://h.example/1"
    rows = [(1, url, PAGE), (2, url, None), (3, url, ""), (4, None, "<p>plain <i>text</i></p> tail &am"), (5, url, "<article><p>cut &amp; <p>la"), (6, url, "<article><p>x</p><foo"), (7, url, "<nav><article><p>in</p></article>"), (8, url, "<!-- no")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("h"), "key": F.lit(1)})
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert got[1] == "Head & more\n\nFirst line second\n\nThird <tag> ©\n\na\n\nb"
    assert got == got | {2: "", 3: "", 4: "plain text\n\ntail &am", 5: "cut &\n\nla", 6: "x", 7: "in", 8: ""}
    assert html.extract(df.limit(0)).count() == 0


def test_site_template(spark):
    """A box that recurs in a host's pages goes; copies count once; a common paragraph in an article stays."""
    box = "<div><p>Join our club</p></div>"
    rows = [(i, "http://a.example/", f"<body>{box}<div><p>{prose(i, 9)}</p></div></body>") for i in range(12)]
    rows += [(100 + i, "http://b.example/", f"<body>{box}<div><p>same</p></div></body>") for i in range(12)]
    rows += [(200 + i, "http://c.example/", f"<article><p>{prose(i, 9)}</p><p>common</p>{box}</article>") for i in range(12)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == prose(0, 9) and got[100] == "Join our club\n\nsame" and got[200] == f"{prose(0, 9)}\n\ncommon"


TEXT = "<p>One two three.</p><p>Four five six.</p>"
KEPT = "One two three.\n\nFour five six."


@pytest.mark.parametrize(
    "page,text",
    [
        (f'<div class="content with-sidebar">{TEXT}</div>', KEPT),
        (f'<div class="container no-sidebar">{TEXT}</div>', KEPT),
        (f'<article class="post has-comments">{TEXT}</article>', KEPT),
        (f'<article>{TEXT}<section class="menu"><p>Soup 3</p><p>Fish 9</p></section></article>', f"{KEPT}\n\nSoup 3\n\nFish 9"),
        (f'<article><div class="main-menu"><ul><li><a href=x>Home</a><li><a href=y>About</a></ul></div>{TEXT}</article>', KEPT),
        ("<p data-x=Tom's>First text isn't here</p><p>x</p>", "First text isn't here\n\nx"),
        ('<p title="a hidden gem" data-y="a>b">shown</p>', "shown"),
        ('<p>Read <span class="share">share me</span>the news</p>', "Read the news"),
        ('<p>Read <span class="ad">buy <span>now</span> or never</span>the news</p>', "Read the news"),
        ('<p>Read <span class="ad">the news</p><p>on</p>', "Read the news\n\non"),
        (f'<article><h1>T</h1>{TEXT}<div class="comments"><article class="comment"><p>{"hey " * 50}</p></article></div></article>', f"T\n\n{KEPT}"),
        (f'<div class="comments"><article class="comment"><p>c</p></article></div><article>{TEXT}</article>', KEPT),
        (f'<div class="page sidebar-right"><h1>T</h1>{TEXT}</div><div class="sidebar"><p>a</p></div>', f"T\n\n{KEPT}"),
        (f'<form id="aspnet"><h1>T</h1>{TEXT}</form>', f"T\n\n{KEPT}"),
        (f"<form><input><p>Sign</p></form>{TEXT}", KEPT),
        (f"<article><header><div><h1>Title</h1></div><p>by me</p></header>{TEXT}</article>", f"Title\n\n{KEPT}"),
        (f'<div class="cookie-consent"><p>We use cookies.</p></div>{TEXT}<div hidden><p>no</p></div><div role="navigation">n</div>', KEPT),
    ],
)
def test_names_are_hints(page, text):
    blocks, nodes = html.parse(page)
    assert html.main_text(blocks, nodes, set()) == text


def test_long_pages_take_linear_time():
    import time

    for page in ("<ul><li>x", "<div>x", "<p>a <span class=ad>x", "<p class=\"x", "<script>"):
        began = time.time()
        html.parse(page * 12_000)
        assert time.time() - began < 4


def test_templates_by_count(spark):
    """A box that rotates, a small site's box, copies of a page, and the way for more template subtrees than are broadcast."""
    rows = [(i, "http://big.example/x", f"<article><p>{prose(i, 9)}</p><div><b>variant {i % 5}</b></div></article>") for i in range(600)]
    rows += [(1000 + i, "http://small.example/x", f"<article><p>{prose(i, 8)}</p><div>club</div></article>") for i in range(4)]
    rows += [(2000 + i, "http://copy.example/x", "<article><p>one</p><div>own</div></article>") for i in range(40)]
    rows += [(3000, "http://big.example/y", None), (3001, None, "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert all(got[i] == prose(i, 9) for i in range(600)) and all(got[1000 + i] == prose(i, 8) for i in range(4))
    assert got[2000] == "one\n\nown" and got[3000] == "" and got[3001] == "x"
    assert {r.page_id: r.text for r in html.extract(df, exact=0).collect()} == got
    # brute force: in how many pages of a host each box is
    seen = defaultdict(set)
    for i, url, page in rows:
        blocks, nodes = html.parse(page)
        html.hash_subtrees(url.split("/")[2] if url else "", nodes)
        for n in html.candidates(blocks):
            seen[n.key].add(nodes[0].key)
    kept = html.Scratch()
    slim = df.select(html.host_of(F.col("url")).alias("host"), "html")
    keys = {r.key % (1 << 64) for r in html.template_keys(slim, kept).collect()}
    assert keys == {k for k, p in seen.items() if len(p) >= 100 or (3 <= len(p) < 10)}


def test_toxicity_learns(spark):
    r = random.Random(2)
    bad = ["idiot", "scum", "loweiabc", "loweixyz", "loweiqq"]
    rows = []
    for i in range(700):
        w, y = prose(i, 30 + i % 90).split(), int(i % 5 == 0)
        if y:
            w[r.randrange(len(w))] = r.choice(bad)
        rows.append((i, " ".join(w), y))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    net = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), 500)
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, "fine LoweiNEW here")], "doc_id long, text string")
    got = {x.doc_id: x.score for x in toxicity.score_documents(df.select("doc_id", "text").unionByName(odd), net).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((got[i] >= 0.5) == bool(rows[i][2]) for i in held)
    assert right >= 0.9 * len(held) and got[1000] == got[1001] < 0.5 and got[1002] > got[1000]


def test_the_toxicity_sample_is_bounded(spark, monkeypatch):
    """Repeated ids count once, ids with two labels not at all, and the texts' bytes have a limit."""
    seen = {}
    monkeypatch.setattr(toxicity.Network, "fit", lambda self, texts, labels: seen.update(texts=texts, labels=labels.tolist()))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, "x" * (10 + i % 3), "q") for i in ids for _ in range(3)] + [(None, "n", "q"), (ids[0], None, "q")], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[1], 1 - ids[1] % 2), (None, 1), (ids[2], 7)], "doc_id long, toxic int")
    toxicity.fit(docs.drop("toxic"), labels)
    assert len(seen["texts"]) == len(ids) - 1 and set(seen["labels"]) == {0, 1}
    toxicity.fit(docs.drop("toxic"), labels, most_bytes=300)
    assert 200 < sum(map(len, seen["texts"])) <= 300
    toxicity.fit(docs.drop("toxic"), labels, sample=7)
    assert len(seen["texts"]) == 7
    net = toxicity.Network()
    assert toxicity.score_documents(docs.limit(0), net).count() == 0 and toxicity.fit(docs.drop("toxic"), labels.limit(0)) is not None
    assert toxicity.score_documents(docs.withColumn("score", F.lit("s")), net).count() == docs.count()


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 200):
        win, owner = toxicity.windows_of([list(range(1, n + 1))])
        assert set(win.ravel().tolist()) - {0} == set(range(1, n + 1)) and set(owner.tolist()) == {0}


def test_gradients():
    """The backward pass against differences."""
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(1)
    fixed, row = r.standard_normal((9, 3)), np.arange(9)
    win, y = r.integers(0, 9, (4, 6)), np.array([1, 0, 1, 0.0])

    def loss():
        x = np.concatenate([fixed[win.T], net.p["E"][row[win.T]]], axis=2)
        pad = (win.T == 0).astype(float)
        pad[0] = 0
        z, _ = net.logits(x @ net.p["Wf"] + net.p["cf"], x @ net.p["Wb"] + net.p["cb"], pad)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    before = {k: v.copy() for k, v in net.p.items()}
    state = {}
    net.step(win, y, np.ones(4), fixed, row, state, 0.0)
    for k in ("Wf", "Ub", "cf", "Wa", "v", "w", "E"):
        at = (1,) * before[k].ndim
        net.p[k][at] += 1e-3
        up = loss()
        net.p[k][at] -= 2e-3
        down = loss()
        net.p[k][at] += 1e-3
        assert abs(state[f"m{k}"][at] * 10 - (up - down) / 2e-3) < 2e-3


def repeated_words(rows, n=50):
    seen = defaultdict(set)
    words = {i: [x.decode() for x in (t or "").encode().split()] for i, t in rows.items()}
    for i, w in words.items():
        for s in range(len(w) - n + 1):
            seen[tuple(w[s : s + n])].add((i, s))
    out = defaultdict(set)
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                out[i].update(range(s, s + n))
    return dict(out)


@pytest.mark.parametrize("length,head", [(50, 16), (20, 6)])
def test_repeated_passages(spark, docs, length, head):
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = defaultdict(set)
    for r in suffixes.repeated_spans(docs, length, head).collect():
        got[r.doc_id].update(range(r.start_word, r.end_word))
    assert dict(got) == repeated_words(rows, length)


def test_passages_with_odd_rows(spark):
    """Null ids stay null beside a real -1, equal rows are one document, and runs over many partitions are one."""
    a, b = prose(11, 55), prose(12, 120)
    rows = [(None, a), (-1, a), (5, b), (5, b), (6, "x " + b)] + [(100 + i, f"left{i} " * 9 + a + f" right{i}" * 9) for i in range(60)] + [(1000 + i, b) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = suffixes.repeated_spans(df).collect()
    assert Counter((r.doc_id, r.is_first) for r in got if r.doc_id in (None, -1)) == {(None, True): 1, (-1, False): 1}
    firsts = [r for r in got if r.is_first]
    assert {(r.doc_id, r.n_words) for r in firsts} == {(None, 55), (5, 120)}
    assert sum(r.n_words == 120 for r in got) == 302 and sum(r.n_words == 55 for r in got) == 62
    assert suffixes.cut_repeats(df.selectExpr("doc_id", "text", "'en' as lang", "cast(length(text) as long) as n_chars")).filter("doc_id is null").count() == 1


def test_suffixes_are_kept_alike(spark):
    """Vectorised suffixes against a plain loop over passages."""
    import pyarrow as pa

    r = random.Random(9)
    texts = [" ".join(r.choice("abc") + str(r.randrange(9)) for _ in range(r.randrange(0, 160))) for _ in range(30)] + [None, "", "x " * 70]
    k = suffixes.Kept(pa.array(texts), 20, 6)
    got = [(int(a), int(b), int(c)) for a, b, c in zip(k.row, k.first, k.last, strict=True)]
    wanted = []
    for row, t in enumerate(texts):
        w = (t or "").split()
        h, _ = suffixes.word_hashes(pa.array([t]), False)
        total, last = suffixes.sums(h), None
        for i in range(len(w) - 19):
            heads = [int(suffixes.span(total, np.array([i + j]), np.array([i + j + 6]))[0]) for j in range(15)]
            at = i + heads.index(min(heads))
            if at == last:
                wanted[-1] = (row, wanted[-1][1], i)
            else:
                wanted.append((row, i, i))
            last = at
    assert got == wanted


def test_passages_are_cut_once(spark, docs):
    left = {r.doc_id: r for r in suffixes.cut_repeats(docs.select("doc_id", "text", "lang", "source", "n_chars")).collect()}
    assert all(r.n_chars == len(r.text) for i, r in left.items() if r.text and i < 50)
    shared = prose(7, 60)
    assert sum(shared in (r.text or "") for r in left.values()) == 1
    assert left[5].text == docs.filter("doc_id = 5").first().text and left[50].text is None
    assert suffixes.cut_repeats(empty(spark)).count() == 0


def brute_targets(sizes):
    """Shares by weight, those over twice the size refilled by the rest, a round at a time."""
    order = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight, left, open_, found = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        found |= {s: 2.0 * sizes[s] for s in over} if over else {s: left * weight[s] / total for s in open_}
        left -= sum(2.0 * sizes[s] for s in over)
        open_ = open_ - over if over else set()
    return found


def test_targets(spark):
    r = random.Random(5)
    many = {f"host{i}": r.randrange(1, 4000) for i in range(300)} | {None: 50, "é": 7, "": 9}
    for sizes in ({"a": 100, "b": 100, "c": 100, None: 100}, {"a": 0, "b": 10}, many, {}):
        t = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        assert {x.source: x.target for x in mixing.targets(t).collect()} == pytest.approx(brute_targets(sizes))


def test_rounding_keeps_fractions_in_expectation():
    import pandas as pd

    base = pd.DataFrame({"source": "a", "doc_id": range(9), "size": [50, 7, 30, 9, 12, 80, 3, 22, 41], "frac": [0.3] * 9})
    taken, words = np.zeros(9), []
    for k in range(4000):
        keys = [int(x) for x in np.random.default_rng(k).integers(-(1 << 62), 1 << 62, 9)]
        out = mixing.pivot(base.assign(key=keys)).sort_values("doc_id")
        p = out["frac"].to_numpy()
        assert ((p > 0) & (p < 1)).sum() <= 1
        words.append((p * out["size"]).sum())
        taken += p
    assert np.allclose(words, 0.3 * base["size"].sum()) and np.abs(taken / 4000 - 0.3).max() < 0.03


def test_mixing_repeated_rows(spark):
    """A row that is there many times is one row to the blocks; each of its copies comes back."""
    rows = spark.range(30_000).selectExpr("cast(if(id < 25000, null, id) as long) as doc_id", "if(id % 3 = 0, 'a', 'b') as source", "cast(if(id < 25000, 10, id % 90) as long) as n")
    got = mixing.mix(rows, F.col("n"), block=50, fan=3)
    by = {r.source: r for r in got.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("copies").alias("most")).collect()}
    assert {s: r.rows for s, r in by.items()} == {"a": 10_000, "b": 20_000}
    assert all(abs(r.taken - r.target) <= 45 and r.most <= 2 for r in by.values())


def test_mixing(spark, docs):
    size = F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), " +"))
    rows = [r for r in mixing.mix(docs, mixing.word_count(F.col("text")), block=5, fan=3).collect()]
    again = [r for r in mixing.mix(docs.repartition(7), mixing.word_count(F.col("text")), block=5, fan=3).collect()]
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr) and len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        by[r.source].append(r)
    for x in by.values():
        assert abs(sum(r.taken for r in x) - x[0].target) <= max(r.size for r in x) / 2 + 1e-6
        assert sum(r.size for r in x) == x[0].source_size
    assert mixing.mix(empty(spark), size).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    rows = spark.read.parquet(f"{DIR}/documents.parquet")
    done = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, done = done, corpus_pipeline.common.materialize(stage(spark, done, DIR), name)
        assert done.columns == rows.columns
        ids, had = {r.doc_id for r in done.collect()}, {r.doc_id for r in before.collect()}
        assert ids <= had
    final = corpus_pipeline.STAGES[-1][1](spark, done, DIR)
    assert final.count() == done.count() > 0
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, DIR).collect()) == sorted(r.doc_id for r in final.collect())


def test_pipeline_stages_on_odd_rows(spark, docs):
    """Clashing columns, null ids and repeated rows go through every stage but the last unharmed."""
    import corpus_pipeline

    odd = spark.createDataFrame([(None, prose(800, 80), "en", "s1", 1), (None, None, None, None, None), (7, prose(7, 67), "en", None, 1)], DOC)
    extra = {c: F.lit("x") for c in ("n_words", "kept", "cuts", "copies", "__n", "key", "ids", "component_id")}
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd).withColumns(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, DIR)
        assert out.columns == rows.columns and out.filter("doc_id is null and text is not null").count() >= (name != "mixing")
        assert stage(spark, rows.limit(0), DIR).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, rows, DIR).count() == rows.count()
