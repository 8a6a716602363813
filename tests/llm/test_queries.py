"""The registered queries themselves: columns, types and rows, against the oracle's SQL or brute force on the smallest tables."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wareflow.llm import quality
from wareflow.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
SCHEMAS = {
    "op1_kd_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op3_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op4_near_duplicates": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op5_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op6_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op7_main_text": "page_id bigint, url string, text string, n_chars bigint",
    "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_suffix_dedup": "doc_id bigint, text_key bigint, is_first boolean, start_word bigint, end_word bigint, n_words bigint",
    "op10_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
}
TABLE = {"op3_chat_format": None, "op4_near_duplicates": "embeddings", "op7_main_text": "pages", "op9_suffix_dedup": None}


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


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "pages"):
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_query(spark, con, name):
    found = QUERIES[name](spark, DIR)
    assert ", ".join(f"{c} {t}" for c, t in found.dtypes) == SCHEMAS[name]
    rows = found.toPandas()
    table = TABLE.get(name, "documents")
    if table:
        assert len(rows) == con.execute(f"select count(*) from {table}").fetchone()[0]
    if name in ORACLE_SQL:
        wanted = con.execute(ORACLE_SQL[name]).df()
        assert sorted(wanted.columns) == sorted(rows.columns)
        by = sorted(rows.columns)
        assert sorted(map(tuple, rows[by].itertuples(index=False))) == sorted(map(tuple, wanted[by].itertuples(index=False)))


def test_op10_sizes_and_targets(spark, con):
    """What SQL can say of the mix: sizes, source sizes; targets by brute force; bounds of what is taken."""
    got = QUERIES["op10_mixing"](spark, DIR).toPandas()
    sizes = con.execute(r"select doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as n, source from documents").df()
    assert dict(zip(got.doc_id, got["size"], strict=True)) == dict(zip(sizes.doc_id, sizes.n, strict=True))
    per = sizes.groupby("source", dropna=False).n.sum()
    goal = brute_targets(per.to_dict())
    both = got.merge(sizes[["doc_id", "source"]], on="doc_id")
    for source, x in both.groupby("source"):
        assert set(x.source_size) == {per[source]} and x.target.iloc[0] == pytest.approx(goal[source])
        assert abs(x.taken.sum() - goal[source]) <= x["size"].max() / 2 + 1e-6
    assert (both.taken <= 2 * both["size"]).all()


def test_op1_shards_and_slots(spark):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    got = QUERIES["op1_kd_shards"](spark, DIR).toPandas()
    for r in got.itertuples():
        raw = (rows[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "bytes")
    for _, x in got.groupby("shard"):
        assert sorted(x.slot) == list(range(len(x)))


def brute_fence(values, unit, words, sign):
    v = np.sort(sign * np.asarray(values))
    q = [v[max(0, int(np.ceil(r * len(v) - 1e-9)) - 1)] for r in quality.RANKS]
    reach = lambda i: q[i] + quality.REACH * max(q[i] - q[0], unit / max(words, 1))
    for i in range(1, len(q) - 1):
        if q[i + 1] > reach(i):
            return sign * max(reach(i), q[i] + quality.PART * (q[i + 1] - q[i]))
    return sign * reach(len(q) - 1)


def test_thresholds_follow_the_source(spark):
    """One source writes symbols into all of its texts, the other hardly any: one cutoff would judge one of them wrongly."""
    r = np.random.default_rng(3)
    word = lambda n: " ".join(f"word{x}" for x in r.integers(0, 10**6, n).tolist())
    rows = []
    for i in range(5000):
        noisy = i % 2 == 0
        n = int(r.integers(0, 60)) if noisy else 0  # a noisy source's clean texts
        if i % 20 == 1:
            n = 40  # junk of the quiet source: less than many clean texts of the other have
        if i % 20 == 2:
            n = 900
        rows.append((i, word(100) + " #" * n, "en", "noisy" if noisy else "quiet"))
    rows.append((9999, None, None, None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x.doc_id: x for x in quality.judge(df, ["doc_id", "lang", "source"]).collect()}
    junk = {i for i, *_ in rows if i < 5000 and i % 20 in (1, 2)}
    assert {i for i, x in got.items() if not x.kept} == junk | {9999}
    clean, bad = max(got[i].symbol_ratio for i in got if got[i].kept and got[i].source == "noisy"), min(got[i].symbol_ratio for i in junk)
    assert clean > bad
    # the fences of exact quantiles, drawn to the language's and to those of all
    m = quality.ratios(quality.measured(df.filter("doc_id < 5000"), ["doc_id", "lang", "source"])).toPandas()
    found = {x.source: x for x in quality.thresholds(spark.createDataFrame(m), ["lang", "source"]).collect()}
    for source in ("noisy", "quiet"):
        own = m[m.source == source]
        for rule, (_, unit) in quality.RULES.items():
            one, all_ = (brute_fence(x[rule], unit, np.sort(x.n_words)[(len(x) - 1) // 2], 1) for x in (own, m))
            w, l = len(own) / (len(own) + quality.SHRINK), len(m) / (len(m) + quality.SHRINK)
            assert found[source][f"hi_{rule}"] == pytest.approx(one * w + (all_ * l + all_ * (1 - l)) * (1 - w), rel=0.1, abs=0.02)


def test_quality_odd_rows(spark):
    df = spark.createDataFrame([(1, "x " * 30_000, "en", "a"), (1, "x " * 30_000, "en", "a"), (None, "", None, "a"), (3, None, "en", None)], "doc_id long, text string, lang string, source string").withColumn("n", F.lit("x"))
    got = quality.judge(df, ["doc_id", "lang", "source"]).collect()
    assert len(got) == 4 and not any(x.kept for x in got) and {x.n_repeat_words for x in got} == {30_000, 0}


def test_pipeline_leaves_other_tables_alone(spark):
    """pipeline, a lazy query, pipeline: the query's tables are still there."""
    import corpus_pipeline

    corpus_pipeline.run(spark, DIR).count()
    lazy = QUERIES["op10_mixing"](spark, DIR)
    last = corpus_pipeline.run(spark, DIR)
    corpus_pipeline.run(spark, DIR).count()
    assert lazy.count() == 200 and last.count() > 0


@pytest.mark.parametrize("name,left", [("op2_quality", "quality-measures"), ("op6_jaccard_join", "jaccard-groups"), ("op10_mixing", "mix-copies"), ("pipeline", "pipeline-mixing")])
def test_scratch_tables_go(spark, name, left):
    """An operator leaves the table behind its result, and no other; the pipeline its last stage's."""
    import os

    import corpus_pipeline

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, DIR) if name == "pipeline" else QUERIES[name](spark, DIR)
    assert [x.rpartition("-")[0] for x in set(os.listdir(folder)) - before] == [left] and out.count() > 0
