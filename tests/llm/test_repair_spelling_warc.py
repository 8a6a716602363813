"""Conversation repair, spelling variants and WARC archives against brute force, round trips and broken archives."""

import hashlib
import io
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from wareflow.llm import repair, spelling, warc
from wareflow.llm.common import Scratch
from wareflow.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
SCHEMAS = {
    "op11_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op12_spelling_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op13_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
}


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    found = QUERIES[name](spark, DIR)
    assert ", ".join(f"{c} {t}" for c, t in found.dtypes) == SCHEMAS[name]
    columns = sorted(found.columns)
    rows = sorted(map(tuple, found.select(columns).collect()), key=repr)
    wanted = sorted(con.execute(f"select {', '.join(columns)} from ({ORACLE_SQL[name]})").fetchall(), key=repr)
    assert len(rows) and rows == wanted


# --- op11


def brute_repair(codes):
    """All edits, with up to two inserts at any place."""
    n, best = len(codes) // 2, []

    def go(i, out, audit, cost):
        if best and cost > best[0][0]:
            return
        for ins in ("", "u", "a", "ua", "au"):
            o, a, c = out + ins, audit + "I" * len(ins), cost + 2 * len(ins)
            if i == n:
                if re.fullmatch("(s?(ua)+)?", o):
                    best[:] = [min([*best, (c, a)])]
            elif re.fullmatch("s?(ua)*u?", o):
                role, fault = codes[2 * i], codes[2 * i + 1]
                go(i + 1, o, a + "D", c + 3)
                late = int(fault == "t")
                for x, letter, paid in ((role, "K", late), ("u", "R", 2 + late), ("a", "R", 2 + late)):
                    if fault in "-t" and re.fullmatch("s?(ua)*u?", o + x):
                        go(i + 1, o + x, a + letter, c + paid)

    go(0, "", "", 0)
    return best[0]


@pytest.mark.parametrize("run", [2, 512])
def test_cheapest_edits(monkeypatch, run):
    monkeypatch.setattr(repair, "RUN", run)
    r = random.Random(run)
    for _ in range(600):
        codes = "".join(r.choice("suua-a") + r.choice("---tbd") for _ in range(r.randint(0, 5)))
        assert repair.cheapest(codes) == brute_repair(codes)


def test_runs_join_to_the_same_integer(monkeypatch):
    r = random.Random(5)
    codes = "".join(r.choice("suua-a") + r.choice("---tbd") for _ in range(3000))
    found = repair.cheapest(codes)
    monkeypatch.setattr(repair, "RUN", 4000)
    assert repair.cheapest(codes) == found


def brute_conversation(rows):
    """Faults, audit and repaired text of one conversation's rows (turn, role, text), by plain loops."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))
    codes, seen = "", set()
    for _, role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        fault = "b" if not said else "d" if (role, text) in seen else "-" if said[-1] in ".!?" else "t"
        seen.add((role, text))
        codes += (role[:1] if role[:1] in ("s", "u", "a") else "-") + fault
    cost, audit = brute_repair(codes)
    out, at = [], iter(rows)
    for letter in audit:
        turn = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if letter == "I":
            out.append((turn, ""))
            continue
        _, role, text = next(at)
        if letter != "D":
            out.append((role if letter == "K" else turn, text))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (gaps, codes[1::2].count("b"), codes[1::2].count("d"), codes[1::2].count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest())


def test_repair_of_odd_conversations(spark):
    r = random.Random(2)
    roles, texts = ["user", "assistant", "system", "", None, "tool", "unknown"], ["Yes.", "no", "", None, " \n", "Why? ", "é" * 70_000 + "!"]
    rows = [(c if c else None, r.choice([None, 0, 1, 2, 3, 9]), r.choice(roles), r.choice(texts), True) for c in range(60) for _ in range(r.randint(0, 4))]
    rows += [(77, 1, "user", "gone", False)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, alive boolean").withColumns({"pos": F.lit("x"), "code": F.lit(1), "head": F.lit(2)})
    scratch = Scratch()
    got = {x[0]: tuple(x)[1:] for x in repair.repair(df, scratch).collect()}
    scratch.drop(*scratch.tables)
    wanted = {c: brute_conversation([x[1:4] for x in rows if x[0] == c and x[4]]) for c in {x[0] for x in rows}}
    assert got == wanted and got[77] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_damage(spark):
    rows = [(c, t, "assistant", "A. B! C?") for c in range(20) for t in range(5)] + [(None, None, None, None)]
    got = Counter(tuple(x) for x in repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    wanted = Counter()
    for c, t, role, text in rows:
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if how == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(how, text), how != 0)
        wanted[row] += 2 if how == 3 else 1
    assert got == wanted


def test_long_conversation(spark):
    """5,000 turns of one conversation, in file order of no meaning, among short ones."""
    n = 5000
    df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn "), "id", F.lit(".")).alias("text"), F.lit(True).alias("alive"))
    scratch = Scratch()
    got = repair.repair(df.orderBy(F.rand(1)).unionByName(df.filter("turn < 2").withColumn("conv_id", F.lit(2))), scratch).collect()
    scratch.drop(*scratch.tables)
    row = {r.conv_id: r for r in got}[1]
    said = "\n".join(f"{'assistant' if i % 2 else 'user'}:turn {i}." for i in range(n))
    assert (row.cost, row.audit, row.repaired_sha256) == (0, "K" * n, hashlib.sha256(said.encode()).hexdigest())


# --- op12


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def some_words(seed, n, letters):
    r, out = random.Random(seed), set()
    while len(out) < n:
        w = "".join(r.choice(letters) for _ in range(r.randint(7, 10)))
        i, c = r.randrange(len(w)), r.choice(letters)
        out |= {w, *(x for x in (w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]) if len(x) >= 7)}
    return sorted(out, key=lambda w: zlib.crc32(w.encode()))


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnopqrstuvwxyzéàÿÀ×"])
def test_index_finds_each_near_word_once(letters):
    words = some_words(1, 250, letters)
    index, asked = spelling.Index(words), [(w, 1) for w in [*words, "zzzzzzzz", "abababaqq"]]
    n = [5 + zlib.crc32(w.encode()) % 3 for w in words]
    sides = [spelling._lookups(index, np.asarray(n), asked, side) for side in (0, 1)]
    for i, (w, _) in enumerate(asked):
        near = [j for j, x in enumerate(words) if one_edit(w, x)]
        assert sides[0][0][i] + sides[1][0][i] == len(near)
        best = [int(s[1][i]) for s in sides if s[1][i] >= 0]
        assert min(best, key=lambda j: (-n[j], words[j]), default=None) == min(near, key=lambda j: (-n[j], words[j]), default=None)


@pytest.mark.parametrize("seed", range(3))
def test_suffix_order(seed):
    r = np.random.default_rng(seed)
    text = np.concatenate([np.tile(r.integers(1, 4, 30), 5), [0]]).astype(np.int64)
    wanted = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert spelling._suffixes(text, 4).tolist() == wanted


def brute_variants(docs):
    n = Counter()
    for who, text in docs:
        low = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if who is None else who}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b and n[b] >= 10 * n[w] else None for w, b in best.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


@pytest.mark.parametrize("block", [1 << 16, 8])
def test_variants(spark, monkeypatch, block):
    """Chains of forms, mixed case, letters beyond ASCII, a long run, odd rows; with small blocks, ends that several indexes share."""
    base = some_words(3, 60, "abcdé")
    docs = [(i, " ".join(base[j] for j in range(len(base)) if i % (j % 7 + 1) == 0)) for i in range(30)]
    docs += [(100 + i, "Receive receive, RECEIVE recieve " * 20 + "abcdefgh " * 3) for i in range(12)]
    docs += [(400 + i, "zyxwvutabc " * 30 + "zyxwvutabd " * 3 + "zyxwvutabde " * (i < 2)) for i in range(10)]
    docs += [(200, "abcdefghx abcdefghx abcdefgxx " * 2 + "abcdefgxx"), (201, "abcdefgh " * 400), (202, "abcdefghx " * 25), (203, "q" * 3_000 + " " + "q" * 2_999), (203, "q" * 3_000 + " " + "q" * 2_999), (None, "Überfluß überfluß Überfluß"), (204, None), (205, ""), (206, "short a1b2 ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷")]
    monkeypatch.setattr(spelling, "BLOCK", block)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"word": F.lit("x"), "n": F.lit(1), "side": F.lit(2)})
    scratch = Scratch()
    got = [tuple(r) for r in spelling.variants(df, scratch).collect()]
    scratch.drop(*scratch.tables)
    assert len(got) == len(set(got)) and set(got) == brute_variants(docs)
    assert any(r[1] and r[2] not in (r[0], r[1]) for r in got)  # a chain of two forms
    assert spelling.variants(df.limit(0), scratch).count() == 0


# --- op13


@pytest.fixture
def pages(spark):
    r = random.Random(1)
    page = lambda i, n: f"<html><head><title>page {i}</title></head><body>" + " ".join(r.choice(["alpha", "beta", "gamma", "é", "<p>", "</p>", "delta"]) for _ in range(n)) + "</body></html>"
    rows = [(i, f"http://a.b/{i}", page(i, 900)) for i in range(40)]
    same = page("same", 500)
    rows += [(100 + i, f"http://a.b/same/{i}", same) for i in range(200)]
    rows += [(300, "http://a.b/x", "x" * 99), (301, None, "x" * 99), (302, "http://a.b/y z\r\nX: 1", "y" * 100), (299, "", "y" * 100), (303, "u", ""), (304, "u", None), (None, "u", "y" * 100), (305, "u", "z" * 3_000_000), (310, "u", "w" * 200), (310, "u", "w" * 200), (311, "u", "w" * 200)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "key": F.lit("x"), "first": F.lit(2)})


def brute_warc(rows):
    raw = [(i, (h or "").encode()) for i, _, h in rows]
    least = {}
    for i, h in raw:
        if i is not None and len(h) >= 100:
            least[h] = min(i, least.get(h, i))
    again = [len(h) >= 100 and h in least and least[h] != i for i, h in raw]
    return Counter((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if a else "response", least[h] if a else None) for (i, h), a in zip(raw, again, strict=True))


def test_archives_come_back(spark, pages, tmp_path):
    rows, df = pages
    scratch = Scratch()
    dictionary = warc.fit_dictionary(df)
    assert int.from_bytes(dictionary[:4], "little") == warc.DICTIONARY
    records = warc.records_of(df, scratch)
    archives = scratch.save(warc.write_archives(records, str(tmp_path / "a"), dictionary), "t")
    back = warc.read_archives(archives).collect()
    number = lambda x: None if x is None else int(x)
    assert Counter((number(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in back) == brute_warc(rows)
    html = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in back) and all((number(r.page_id), bytes(r.payload)) in html for r in back if r.payload is not None)
    assert {r.url for r in back if r.page_id in ("302", "301", "1")} == {"http://a.b/y%20z%0D%0AX:%201", None, "http://a.b/1"}
    kept = [r.path for r in archives.collect()]
    first = open(kept[0], "rb").read()
    assert int.from_bytes(first[:4], "little") == warc.DICTIONARY_FRAME and kept[0].endswith(".warc.zst")
    # one frame a record, each by itself
    offsets = sorted(r.offset for r in back if r.path == kept[0])
    tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert len(offsets) == archives.filter(F.col("path") == kept[0]).first().records and all(tool.decompressobj().decompress(first[a:]).startswith(b"WARC/1.1\r\n") for a in offsets)
    scratch.drop(*scratch.tables)


def archive(*records, dictionary=b"", lead=None):
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return (warc.leading_frame(dictionary) if lead is None else lead) + b"".join(map(coder.compress, records))


def scan(raw):
    return [warc.parse(content, str(at)) for at, content in warc.frames(io.BytesIO(raw))]


PAGE = b"<p>hello</p>" * 20
GOOD = warc.record(7, "http://x", PAGE, hashlib.sha256(PAGE).hexdigest(), len(PAGE), None, "2020-01-01T00:00:00Z")


def test_reader_takes_what_the_format_allows(monkeypatch):
    skip = (0x184D2A50).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc"
    for chunk in (1, 7, 1 << 20):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        for raw in (archive(GOOD, GOOD), archive(GOOD) + skip + archive(GOOD), skip + archive(GOOD, GOOD)):
            assert [p for _, p, _ in scan(raw)] == [PAGE, PAGE]
    assert scan(b"") == []
    samples = [f"{i} some text {i * 7919 % 1000} and more of it {i % 13}".encode() * 20 for i in range(400)]
    made = zstandard.train_dictionary(4096, samples).as_bytes()
    plain = warc.DICTIONARY_FRAME.to_bytes(4, "little") + len(made).to_bytes(4, "little") + made
    assert [p for _, p, _ in scan(archive(GOOD, dictionary=made))] == [p for _, p, _ in scan(archive(GOOD, dictionary=made, lead=plain))] == [PAGE]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: 3\r\n\r\na:b\r\n\r\n"
    assert scan(archive(info))[0][1:] == (b"a:b", 3)


def broken():
    digest = hashlib.sha256(PAGE).hexdigest()
    whole = archive(GOOD, GOOD)
    made = zstandard.train_dictionary(4096, [f"{i} some text {i * 7919 % 1000} and more of it {i % 13}".encode() * 20 for i in range(400)]).as_bytes()
    yield "cut short", whole[:-5]
    yield "begins no frame", whole + b"garbage"
    yield "after the last frame", whole + b"ab"
    yield "has no dictionary", archive(GOOD, lead=warc.DICTIONARY_FRAME.to_bytes(4, "little") + (5).to_bytes(4, "little") + b"plain")
    yield "skippable frame is cut short", warc.leading_frame(made)[:-1]
    yield "ictionary", archive(GOOD, dictionary=made, lead=b"")
    yield "no record begins", archive(b"HTTP" + GOOD)
    yield "before the frame's end", archive(GOOD + GOOD)
    yield "before the frame's end", archive(GOOD[:-1])
    yield "warc-date missing", archive(GOOD.replace(b"WARC-Date: 2020-01-01T00:00:00Z\r\n", b""))
    yield "no header line", archive(GOOD.replace(b"WARC-Date: ", b"WARC-Date "))
    yield "stands twice", archive(GOOD.replace(b"Page-ID: 7", b"Page-ID: 7\r\npage-id: 8"))
    yield "content-length is '-1'", archive(re.sub(rb"(?<=msgtype=response\r\nContent-Length: )\d+", b"-1", GOOD))
    yield "block's digest", archive(GOOD.replace(b"hello", b"hellO", 1))
    wrong = warc.record(7, "http://x", PAGE, digest, len(PAGE) + 1, None, "2020-01-01T00:00:00Z")
    yield f"{len(PAGE)} of {len(PAGE) + 1} bytes", archive(wrong)
    yield "payload's digest", archive(warc.record(7, "http://x", PAGE, "0" * 64, len(PAGE), None, "2020-01-01T00:00:00Z"))
    revisit = warc.record(8, "http://x", None, digest, len(PAGE), 7, "2020-01-01T00:00:00Z")
    yield "refers to nothing", archive(re.sub(rb"WARC-Refers-To: [^\r]+\r\n", b"", revisit))
    yield "header has no end", archive(b"WARC/1.1\r\n")


@pytest.mark.parametrize("what,raw", list(broken()), ids=lambda x: x[:24] if isinstance(x, str) else "")
def test_broken_archives(what, raw):
    with pytest.raises(warc.ArchiveError, match=re.escape(what)):
        scan(raw)


def test_no_pages(spark, pages, tmp_path):
    _, df = pages
    scratch = Scratch()
    none = df.limit(0)
    assert warc.fit_dictionary(none) == b""
    archives = scratch.save(warc.write_archives(warc.records_of(none, scratch), str(tmp_path / "none"), b""), "t")
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_scratch_goes(spark, name):
    """A query leaves the table behind its result, and no other."""
    import os

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    QUERIES[name](spark, DIR).count()
    left = [x.rpartition("-")[0] for x in set(os.listdir(folder)) - before]
    assert len(left) == 1 and left[0].endswith("-result")
