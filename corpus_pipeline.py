"""The corpus pipeline: quality rules, near duplicates, repeated passages, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.llm import bpe, common, jaccard, mixing, quality, suffixes


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the adaptive thresholds reject go."""
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "text", "lang", "source")  # other columns may have any name
    return quality.judge(rows, ["__row", "lang", "source"]).filter("kept").select("__row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the least id stays; rows without an id stay."""
    groups = jaccard.jaccard_groups(docs, n=5, percent=80)
    return common.without(docs, groups.filter("doc_id <> component_id").select("doc_id").distinct())


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of passages of 50 words or more are cut out of the texts."""
    return suffixes.cut_repeats(docs)


#: Sources whose rows all have the same number of copies are broadcast up to this number.
EVEN = 10_000


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is there as many times as the mix takes it, 0 to 2 times.

    Rows that repeat an id get the most copies of any of them. Sources of which all rows have the same number of copies, such as those at their cap, need no
    join by id: only the rows of the other sources are shuffled.
    """
    mixed = mixing.mix(docs, mixing.word_count(F.col("text")))
    per = mixed.groupBy(F.col("source").alias("__s")).agg(F.min("copies").alias("__least"), F.max("copies").alias("__all")).filter("__least = __all").drop("__least")
    per = F.broadcast(per.orderBy(F.xxhash64("__s"), "__s").limit(EVEN))  # rows of a source that isn't in it are joined by id
    of = lambda source: F.col(source).eqNullSafe(F.col("__s"))
    dealt = docs.withColumn("__source", F.col("source")).join(per, of("__source"), "left")
    even = dealt.filter("__all > 0").select(*docs.columns, F.col("__all").alias("__copies"))
    rest = mixed.join(per, of("source"), "left").filter("__all is null and copies > 0")
    rest = rest.groupBy(F.col("doc_id").alias("__id")).agg(F.max("copies").alias("__copies"))
    odd = dealt.filter("__all is null").select(*docs.columns).join(rest, F.col("doc_id").eqNullSafe(F.col("__id"))).select(*docs.columns, "__copies")
    taken = even.unionByName(odd)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__mix_n")).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text that was taken, with digests of the ids and of what they decode to."""
    import public_tokenizers

    keep = ["doc_id", "lang", "source"]
    encoded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep=keep)
    return bpe.digests(encoded, keep)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", passage_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: SQL expresses neither the sketches nor the rounding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again.

    A stage's table goes when the next one's is written, and what the operators left behind their results when their stage's is. The last table stays, as
    the result reads it.
    """
    docs, before = common.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with common.recorded() as made:
            docs = common.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        for table in made:
            if table is not docs:
                common.drop(table)
        if before is not None:
            common.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
