"""Quality rules with thresholds from mergeable quantile sketches, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Scratch, materialize, read, words_of

#: The rules: measure, the sides on which a text fails, and what one count more adds to the measure of a text of one word.
RULES = {
    "symbol_ratio": ("high", 1),
    "dup_line_ratio": ("high", 5),
    "repeat_ratio": ("high", 3),
    "mean_word": ("both", 1),
}
#: Ranks at which a group's quantiles are read, from the median outwards.
RANKS = [0.5, 0.6, 0.7, 0.75, 0.8, *(round(0.81 + 0.01 * i, 2) for i in range(19))]
#: A quantile is beyond a break if it is further from the one before than this many times that one's distance from the median.
REACH = 4.0
#: In a break, the threshold stands this part of the way up.
PART = 0.25
#: A group's thresholds weigh n / (n + SHRINK) against those of its language, and these likewise against those of all texts.
SHRINK = 200
#: Parameter of the sketches: ranks are right to about 0.4 of a hundredth.
SKETCH = 800
#: Groups whose thresholds are broadcast at most; beyond that Spark chooses the join.
GROUPS = 20_000


def measures(text: Column) -> list[Column]:
    """Columns to add in two steps: arrays first, then counts (see measured())."""
    return [words_of(text).alias("__w"), F.coalesce(text, F.lit("")).alias("__t")]


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each whole text.

    Three-word windows are told apart by 64-bit hashes. A window's hash and its start share one
    long, so that equal windows meet in a sort of primitive longs: as many low bits hold the start
    as the text needs, and neighbours with the same high bits are compared by the whole hash.
    """
    t = docs.select(*keep, *measures(F.col("text")))
    t = t.withColumn("n_words", F.size("__w").cast("long"))
    windows = F.expr("if(n_words < 3, cast(array() as array<bigint>), transform(sequence(0, cast(n_words as int) - 3), i -> xxhash64(__w[i], __w[i+1], __w[i+2])))")
    lines = F.expr(r"filter(split(__t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')")
    t = t.select(
        *keep,
        "n_words",
        F.char_length(F.translate("__t", SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length("__t") - F.char_length(F.translate("__t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        windows.alias("__h"),
        lines.alias("__l"),
    )
    t = t.withColumn("n_dup_lines", (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"))
    t = t.withColumn("__b", F.ceil(F.log2(F.greatest(F.size("__h"), F.lit(2)).cast("double"))).cast("int")).withColumn("__m", F.expr("shiftleft(1L, __b) - 1"))
    distinct = F.size(F.array_distinct("__h")) == F.size("__h")
    packed = F.expr("sort_array(transform(__h, (x, i) -> (x & ~__m) | i))")
    t = t.withColumn("__s", F.when(distinct, F.expr("cast(array() as array<bigint>)")).otherwise(packed))
    same = "(__s[{a}] & ~__m) = (__s[{b}] & ~__m) and __h[cast(__s[{a}] & __m as int)] = __h[cast(__s[{b}] & __m as int)]"
    again = f"(i > 0 and {same.format(a='i', b='i-1')}) or (i < size(__s) - 1 and {same.format(a='i', b='i+1')})"
    t = t.withColumn("__p", F.expr(f"sort_array(transform(filter(__s, (x, i) -> {again}), x -> x & __m))"))
    covered = "aggregate(transform(__p, (x, i) -> if(i = size(__p) - 1, 3L, least(3L, __p[i+1] - x))), 0L, (a, x) -> a + x)"
    return t.withColumn("n_repeat_words", F.expr(covered)).select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def ratios(m: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return m.withColumns(
        {
            "symbol_ratio": F.col("n_symbols") / n,
            "dup_line_ratio": F.col("n_dup_lines") * 5 / n,
            "repeat_ratio": F.col("n_repeat_words") / n,
            "mean_word": F.col("word_chars") / n,
        }
    )


def _fence(sketch: Column, words: Column, unit: int, sign: int) -> Column:
    """The threshold on one side of a sketch: where its quantiles break, or beyond the outermost one.

    Going outwards from the median, each quantile q has a reach: REACH times its distance from the median, which counts as
    one more count in a text of median length at least. If the next quantile is beyond q's reach, the texts
    from there on are another population, and the threshold is between the two. Where no quantile is, the threshold
    is the reach of the outermost one.
    """
    ranks = RANKS if sign > 0 else [round(1 - r, 2) for r in RANKS]
    raw = F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(r)) for r in ranks]))
    q = F.transform(raw, lambda x: x * sign)
    least = F.lit(float(unit)) / F.greatest(words, F.lit(1.0))
    reach = lambda i: F.get(q, i) + REACH * F.greatest(F.get(q, i) - F.get(q, F.lit(0)), least)
    last = len(RANKS) - 1
    at = F.array_min(F.filter(F.sequence(F.lit(1), F.lit(last - 1)), lambda i: F.get(q, i + 1) > reach(i)))
    broken = F.greatest(reach(at), F.get(q, at) + PART * (F.get(q, at + 1) - F.get(q, at)))
    return F.coalesce(broken, reach(F.lit(last))) * sign


def _fences(sketches: DataFrame, keep: list[str], mark: str) -> DataFrame:
    """keep, n and `lo_<rule>`, `hi_<rule>` (with a mark before them) of each row of sketches."""
    some = lambda c: F.when(F.col("n") > 0, F.col(c))  # noqa: E731  the sketch of an empty table has no quantiles
    words = F.kll_sketch_get_quantile_double(some("words"), F.lit(0.5))
    found = []
    for r, (side, unit) in RULES.items():
        found.append((_fence(some(r), words, unit, -1) if side == "both" else F.lit(float("-inf"))).alias(f"{mark}lo_{r}"))
        found.append(_fence(some(r), words, unit, 1).alias(f"{mark}hi_{r}"))
    return sketches.select(*keep, F.col("n").alias(f"{mark}n"), *found)


def thresholds(m: DataFrame, by: list[str], scratch: Scratch | None = None) -> DataFrame:
    """A row a group with the fences of each rule: `lo_<rule>` and `hi_<rule>`. by: language, then source.

    One KLL sketch a rule and group, built partially on the map side and merged, so that a hot group
    costs no more than any other. Sketches of groups are merged again for their language and for all texts, and a group's
    thresholds are drawn to those of its language and these to those of all, the more the fewer texts there are, so that no verdict
    flips at a certain count. Sketches compact at random: ranks are right to about 0.004, and a rerun
    can move a threshold by as much.
    """
    rules = [*RULES, "words"]
    sketches = m.withColumn("words", F.col("n_words").cast("double")).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(r, F.lit(SKETCH)).alias(r) for r in rules])
    sketches = (scratch or Scratch()).save(sketches, "quality-sketches")
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(r, F.lit(SKETCH)).alias(r) for r in rules]]
    lang = _fences(sketches.groupBy(F.col(by[0]).alias("__of")).agg(*merged), ["__of"], "l_")
    whole = _fences(sketches.agg(*merged), [], "a_")
    t = _fences(sketches, by, "g_").join(lang, F.col(by[0]).eqNullSafe(F.col("__of"))).crossJoin(F.broadcast(whole))  # one row
    weight = lambda n: F.col(n) / (F.col(n) + F.lit(float(SHRINK)))
    drawn = lambda n, own, other: F.col(own) * weight(n) + other * (1 - weight(n))
    ends = [f"{e}_{r}" for r, (side, _) in RULES.items() for e in (("lo", "hi") if side == "both" else ("hi",))]
    t = t.select(*by, F.col("g_n").alias("n"), *[drawn("g_n", f"g_{e}", drawn("l_n", f"l_{e}", F.col(f"a_{e}"))).alias(e) for e in ends])
    return t.withColumns({f"lo_{r}": F.lit(float("-inf")) for r, (side, _) in RULES.items() if side == "high"})


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The measures of each document with base_failed and kept.

    keep names columns of docs to carry, lang and source among them. kept is false if the base rule
    fails, or else a measure is beyond its group's fences. Groups are (lang, source); a null is a
    group of its own. A null or empty text has no words and fails. Repeated rows are judged alike.
    The table of fences has a row a (lang, source): it is broadcast up to GROUPS rows, else Spark chooses the join of its table, which then stays
    beside that of the measures.
    A text's three-word windows are one array of longs while it is measured: 8 bytes a word of the longest text.
    """
    scratch = Scratch()
    m = materialize(ratios(measured(docs, keep)), "quality-measures")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    m = m.withColumn("base_failed", failed).withColumns({"__lang": F.col("lang"), "__source": F.col("source")})
    fences = scratch.save(thresholds(m.filter(~F.col("base_failed")), ["__lang", "__source"], scratch).withColumnsRenamed({"__lang": "__fl", "__source": "__fs"}), "quality-fences")
    if fences.count() <= GROUPS:
        few = docs.sparkSession.createDataFrame(fences.toArrow(), fences.schema)
        scratch.drop(*scratch.tables)
        fences = F.broadcast(few)
    out = m.join(fences, F.col("__lang").eqNullSafe(F.col("__fl")) & F.col("__source").eqNullSafe(F.col("__fs")), "left")
    good = F.lit(True)
    for r in RULES:
        good = good & F.coalesce(F.col(r).between(F.col(f"lo_{r}"), F.col(f"hi_{r}")), F.lit(True))
    out = out.withColumn("kept", ~F.col("base_failed") & good)
    return out.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *RULES)


def op2_quality(spark, sf_dir):
    """Measures, base rule and verdict of every document: doc_id, five counts (long), base_failed and kept (boolean).

    Null and empty texts have counts of 0 and fail. Repeated rows and ids are judged each for itself.
    """
    found = judge(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), ["doc_id", "lang", "source"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
