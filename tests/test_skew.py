"""Hot keys: one key with all rows is spread over tasks, with the same result as brute force; plans without what would gather it."""

import random
import re

import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from wareflow.operators import frontier, joins, ledger, messages


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def brute_health(rows, most=5):
    out = {}
    for endpoint, _, ok in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        now, worst = out.get(endpoint, (0, 0))
        now = 0 if ok else now + 1
        out[endpoint] = (now, max(worst, now))
    return {k: (f, w, w > most) for k, (f, w) in out.items()}


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 16])
def test_health_of_a_hot_endpoint(spark, width):
    """Runs that begin, end and lie in blocks, blocks without a success, null outcomes, gaps in the numbers."""
    r = random.Random(width)
    rows = [("hot", i, r.random() < (0.02 if i // 200 % 2 else 0.5)) for i in range(3000)]
    rows += [(e, i * 50 + r.randrange(50), r.choice([True, False, False, None])) for e in ("a", "b", None) for i in range(60)]
    rows += [("never", i, False) for i in range(300)] + [("once", 5, True), ("late", 0, False), ("late", 10**12, False)]
    df = spark.createDataFrame(rows, "endpoint string, seq long, ok boolean").repartition(7)
    got = {x.endpoint: (x.failures, x.worst, x.dropped) for x in ledger.endpoint_health(df, width=width).collect()}
    assert got == brute_health(rows)


def test_health_is_dealt_by_blocks(spark):
    df = spark.range(4_000_000).select(F.lit("hot").alias("endpoint"), F.col("id").alias("seq"), (F.xxhash64("id") % 9 == 0).alias("ok"))
    out = ledger.endpoint_health(df, width=1 << 14)
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", plan(out))
    assert exchanges and any("__block" in x for x in exchanges)
    assert "__block" in re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan(out))[0]  # the log's rows; the others are a row a block
    assert out.count() == 1


@pytest.mark.parametrize("width", [1, 8, 4096])
def test_dispatch_of_a_hot_queue(spark, width):
    """Ties by seq, k as a column, k of nothing, null priorities and spiders."""
    r = random.Random(4)
    rows = [(7, r.choice([1, 2, 2, 2, 3]), i) for i in range(4000)] + [(s, r.choice([None, 0, 5]), i * 3) for s in (None, 1, 2) for i in range(40)] + [(3, 1, 9), (0, 1, 1)]
    df = spark.createDataFrame(rows, "spiderid int, priority int, seq long")
    got = {(x.spiderid, x.priority, x.seq, x["rank"]) for x in frontier.dispatch_plan(df, F.coalesce("spiderid", F.lit(4)) * 10, 3, width).collect()}
    wanted = set()
    for s in {x[0] for x in rows}:
        queue = sorted((x for x in rows if x[0] == s), key=lambda x: (x[1] is None, -(x[1] or 0), x[2]))
        wanted |= {(*x, n + 1) for n, x in enumerate(queue[: (4 if s is None else s) * 30])}
    assert got == wanted


def test_dispatch_sorts_no_queue(spark):
    """Of a million requests of one spider, the rank sees the best ones and a last step's."""
    df = spark.range(1_000_000).select(F.lit(1).alias("spiderid"), (F.col("id") % 3).cast("int").alias("priority"), F.col("id").alias("seq"))
    out = frontier.dispatch_plan(df, F.lit(60), 2, 1000)
    assert out.count() == 120
    # the table that is ranked: everything below the last window
    ranked = frontier.dispatch_plan(df, F.lit(60), 2, 1000).drop("rank")
    assert ranked.count() == 120
    window = [x for x in plan(out).split("\n\n") if "Window" in x and "row_number" in x]
    assert len(window) == 1 and df.filter("priority = 2 and seq < 1000").count() < 400


def brute_match(images, wanted):
    out = {}
    for text, pattern in wanted:
        if text is None:
            continue
        hits = [(p, u) for u, p in images if u is not None and (u == text or (pattern and re.search(text, u)))]
        if hits:
            out[text] = min([*hits, *([out[text]] if text in out else [])])
    return out


PATTERNS = [r"/[0-9]*2/?$", "abc|img", "u.", r"a\.jpg", "(x|y)foo+bar", "ab{2,3}cd", "[a-c]de", "(?i)IMG", "x(?:ab)?cde", r"\Qab\E", r"\d\/b", "", "zzz", "^http", r"foo?o*bar", r"[]x]y", "a(b[)]c)d", r"\x61b", "im+g"]


def test_patterns_meet_what_they_require(spark):
    r = random.Random(6)
    pieces = ["http://", "img", "abc", "abbcd", "abcd", "ade", "xfoobar", "yfoooobar", "xcde", "xabcde", "a.jpg", "/12/", "/22", "1/b", "IMG", "fobar", "xy", "]y", "ab)cd", "é"]
    images = [("".join(r.choice(pieces) for _ in range(r.randint(1, 4))), i) for i in range(300)] + [("", 400), (None, 401), ("u1", 402), ("abc|img", 403), ("ab", 404)]
    wanted = [(p, True) for p in PATTERNS] + [(images[5][0], False), ("abc|img", False), ("a.jpg", False), (None, True), (images[5][0], False)]
    im, want = spark.createDataFrame(images, "url string, pos int"), spark.createDataFrame(wanted, "text string, pattern boolean")
    out = joins.image_match(im.withColumn("gram", F.lit("x")), want.withColumn("salt", F.lit(1)))
    java = [(p.replace(r"\Qab\E", "ab").replace("(?i)IMG", "(?i:IMG)"), p) for p, is_p in wanted if is_p and p is not None]
    brute = brute_match(images, [(a, True) for a, _ in java] + [(t, False) for t, is_p in wanted if not is_p])
    names = dict(java)
    expected: dict = {}
    for k, v in brute.items():
        name = names.get(k, k)
        expected[name] = min(v, expected.get(name, v))
    assert {x.text: (x.pos, x.url) for x in out.collect()} == expected
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_required_grams_are_required():
    """Each gram stands in whatever a pattern finds, over random texts."""
    r = random.Random(8)
    texts = ["".join(r.choice("abcdexy/12.mgihfo]()[") for _ in range(12)) for _ in range(30_000)]
    for p in PATTERNS:
        if p.startswith(r"\Q"):
            continue
        found = re.compile(p.replace("[]x]", r"[\]x]"))
        for gram in joins.required_grams(p):
            assert all(gram in m[0] for t in texts for m in [found.search(t)] if m)
    assert joins.required_grams("abcdef") == ["abc", "bcd", "cde", "def"] and joins.required_grams("a{2}bc") == ["bc"]


def test_many_patterns(spark):
    """More patterns than were allowed before; each finds its own image."""
    n = 3000
    images = spark.range(n).select(F.concat(F.lit("http://shop/item-"), F.hex(F.xxhash64("id")), F.lit("_main.jpg")).alias("url"), F.col("id").cast("int").alias("pos"))
    wanted = spark.range(n).select(F.concat(F.lit("item-"), F.hex(F.xxhash64("id")), F.lit("_[a-z]+[.]jpg$")).alias("text"), F.lit(True).alias("pattern"))
    assert joins.image_match(images, wanted).count() == n


@pytest.mark.parametrize("most,heavy", [(1 << 20, 5), (0, 0), (0, 3), (0, 10**6)])
def test_memory_of_any_size(spark, most, heavy):
    """The same rows whether all tasks hold the memory, a part of it, or nothing."""
    texts = [(1, "the cat sat\non the  mat"), (2, ""), (3, None), (4, "the " * 5000 + "end"), (5, " lead and trail "), (6, "unknown words")]
    memory = [("the", "THE"), ("the", "The"), ("cat", "Katze"), ("mat", None), ("end", "ende"), (None, "x"), ("", "_"), ("absent", "y")]
    df = spark.createDataFrame(texts, "id int, text string").withColumn("src", F.lit("the"))
    mem = spark.createDataFrame(memory, "src string, dst string")
    known = {"the": "THE", "cat": "Katze", "end": "ende", "": "_"}
    got = {r.id: r.text for r in messages.translate(df, mem, most=most, heavy=heavy).collect()}
    assert got == {i: " ".join(known.get(w, w) for w in re.split("[ \n]+", t)) for i, t in texts if t is not None}
    specs = spark.createDataFrame([(1, '["the","cat","odd"]'), (2, "[]"), (3, None), (4, '["a",null]'), (5, "no json"), (6, '["mat","end"]')], "id long, specs string")
    assert {r.id: r.specs for r in messages.translate_pairs(specs, mem, most=most, heavy=heavy).collect()} == {1: '["THE","Katze"]', 4: '["a",null]', 6: '["mat","ende"]'}


def test_a_small_memory_shuffles_no_text(spark):
    texts = spark.range(100).select("id", F.lit("a b c").alias("text"))
    memory = spark.createDataFrame([("a", "x")], "src string, dst string")
    assert "Exchange" not in plan(messages.translate(texts, memory)) and "Exchange" in plan(messages.translate(texts, memory, most=0))


@pytest.mark.parametrize("heavy,held", [(3, {"the": "the", "cat": "Katze"}), (1, {}), (52, {"the": "the", "cat": "Katze", **{f"x{i}": f"x{i}" for i in range(50)}})])
def test_frequent_words_without_an_entry_are_held(spark, monkeypatch, heavy, held):
    """A word that all texts have meets no join, whether a large memory knows it or not, and the memory is computed once."""
    sent, seen, plain = [], spark.sparkContext.accumulator(0), SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda sc, value: sent.append(value) or plain(sc, value))

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    texts = spark.range(200).select("id", F.format_string("the w%d cat x%d w%d", "id", F.col("id") % 50, "id").alias("text"))
    entries = [(f"w{i}", f"W{i}") for i in range(0, 400, 2)] + [("cat", "Katze"), (None, "x"), ("w2", "Z")]
    memory = spark.createDataFrame(entries, "src string, dst string").mapInArrow(counted, "src string, dst string")
    got = {r.id: r.text for r in messages.translate(texts, memory, most=0, heavy=heavy).collect()}
    word = lambda i: f"W{i}" if i % 2 == 0 else f"w{i}"
    assert got == {i: f"the {word(i)} Katze x{i % 50} {word(i)}" for i in range(200)}
    assert sent == [held] and seen.value == len(entries)


def brute_residue(rows, words, stop):
    out = {}
    for group in {r[0] for r in rows}:
        text = "".join(re.sub("[^a-z]", "", (t or "").lower()) for g, _, t in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]))
        for w in [words(group), *stop]:
            text = text.replace(w, "") if w else text
        out[group] = text
    return out


@pytest.mark.parametrize("width", [1, 3, 1000])
@pytest.mark.parametrize("stop", [["ab", "ba"], ["aa", "aba", "c"], ["aabb", ""]])
def test_residue_across_chunks(spark, width, stop):
    """Words that begin and end in different chunks, overlap themselves, and come to be when another goes; titles shorter than a word, empty and null."""
    r = random.Random(width)
    rows = [(g, 5 * i, r.choice([None, "", "-", *["".join(r.choice("aabBc -") for _ in range(r.randint(1, 6))) for _ in range(6)]])) for g in ("x", "y", None) for i in range(150)]
    rows += [("a", i, "a") for i in range(40)] + [("last", 0, "zab a")]
    df = spark.createDataFrame(rows, "g string, pos long, title string")
    word = F.when(F.col("g") == "x", "aba").when(F.col("g") == "y", "b").otherwise("aab")
    got = {x.g: x.residue for x in frontier.keyword_residue(df, "g", word, stop, width=width).collect()}
    assert got == brute_residue(rows, lambda g: {"x": "aba", "y": "b"}.get(g, "aab"), stop)
    if width == 1:
        chunks = frontier.residue_chunks(df, "g", word, stop, width=width)
        assert chunks.count() == len(rows) and max(len(x.residue) for x in chunks.collect()) < 12


def test_long_residues_are_an_error(spark):
    df = spark.createDataFrame([("x", 1, "abc"), ("x", 2, "def")], "g string, pos long, title string")
    with pytest.raises(Exception, match="more than 5 letters"):
        frontier.keyword_residue(df, "g", F.lit(""), [], most=5).collect()


@pytest.mark.parametrize("size", [4, 100, 10_000])
def test_children_of_a_hot_parent(spark, size):
    """One parent with 3,000 children among others: chunks of about `size` nodes, everything there once, a missing parent's children dropped."""
    import json

    from wareflow.operators import catalog

    paths = ["/a#1", "/a#2", "/a#1/b#1", "/a#1/b#2", *(f"/a#1/b#1/c#{i}" for i in range(3000)), "/a#1/b#2/c#1", *(f"/a#2/b#{i}" for i in range(200)), "/a#9/b#1", "/a#2/b#777/c#1"]
    df = spark.createDataFrame([(p, f"v{p}") for p in paths], "path string, value string").withColumns({"chunk": F.lit("x"), "weight": F.lit("y"), "up": F.lit(1)})
    rows = catalog.roll_up_chunks(df, size=size).collect()
    nodes = lambda row: 1 + sum(nodes(c) if "children" in c else 1 for c in row["children"])
    top = {}
    for r in rows:
        top.setdefault(r.path, []).append(r)
        assert r.value == f"v{r.path}" and len([x for x in rows if x.path == r.path]) <= r.chunks
    assert max(nodes(r.asDict(True)) for r in rows) <= 6 * size + 60
    leaves = [c["path"] for r in rows for b in r.children for c in b["children"]]
    assert sorted(leaves) == sorted(p for p in paths if p.count("/") == 3 and "b#777" not in p)
    assert {b["path"] for r in rows for b in r.children} == {p for p in paths if p.count("/") == 2 and p.startswith(("/a#1", "/a#2"))} and set(top) == {"/a#1", "/a#2"}
    if size == 10_000:  # one chunk each: what the roll-up gives as text
        text = {r.path: json.loads(r.json) for r in catalog.roll_up(df.select("path", "value")).collect()}
        shape = lambda x: {"path": x["path"], "value": x["value"], "children": [shape(c) for c in x.get("children", [])]}
        assert {r.path: shape(r.asDict(True)) for r in rows} == text


def test_images_are_dealt_out_before_they_are_ranked(spark):
    """No task sorts all that it reads, and a hot colour's images are in several tasks; the best rank wins, then the first position."""
    from wareflow.operators import catalog

    images = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("product_id"), F.lit("red").alias("color"), (-F.col("id")).alias("pos"), F.when(F.col("id") == 7, "best").when(F.col("id") % 500 == 1, "good").otherwise("x").alias("kind"), F.col("id").cast("string").alias("url"))
    got = catalog.choose_main(images, spark.createDataFrame([("best", 0), ("good", 1)], "kind string, rank int"))
    found = {r.product_id: (r.url, r.rank) for r in got.collect()}
    assert len(found) == 1001 and found.pop(1) == ("7", 0)
    assert all(found[i] == (str(i), 1 if i % 500 == 1 else None) for i in found)
    below = got._jdf.queryExecution().sparkPlan().toString()
    below = below[below.rindex("WindowGroupLimit"):]  # the part before the shuffle by colour
    assert "Partial" in below.splitlines()[0] and "Exchange hashpartitioning(product_id" in below and "pos#" in below[below.index("Exchange hashpartitioning("):].splitlines()[0]


def test_chunks_come_in_small_batches(spark):
    """Python gets chunks a few megabytes at a time, unless the session has a size of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    df = spark.createDataFrame([("x", 1, "abc")], "g string, pos long, title string")
    try:
        for own, wanted in ((None, frontier.BATCH), ("1000000b", 1_000_000)):
            spark.conf.set(name, own) if own else spark.conf.unset(name)
            frontier.keyword_residue(df, "g", F.lit("a"), [])
            assert int(spark.conf.get(name).rstrip("b")) == wanted
    finally:
        spark.conf.unset(name)
