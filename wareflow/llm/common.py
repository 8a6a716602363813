"""What several training-data operators share: tables, scratch tables, bitmaps, white space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters that are none of the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: The same six characters, for translate().
SPACES = " \t\n\x0b\x0c\r"
#: Bits of a bitmap at least and at most (128 kB to 16 MB), whatever the input.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27


#: Bytes of rows that Spark sends to a Python worker at once: a task then needs little memory outside the heap.
BATCH = 2 << 20


def bounded(spark: SparkSession) -> None:
    """Let Arrow batches of this session be of BATCH bytes, unless it has a size of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name).rstrip("b") == str(64 << 20):  # Spark's default
        spark.conf.set(name, BATCH)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set and all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoints-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df as Parquet in the shared folder and read it again, which cuts its lineage.

    A lost executor then costs no more than the tasks that were running. The path is kept as
    `.written`, so that drop() can delete the table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")  # what was shuffled for this table goes when it is written, not when the driver next collects its garbage
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written = path
    for made in _RECORDED:
        made.append(out)
    return out


#: Spark's setting for shuffle files that go at the end of an execution.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Lists that get every table which is written while they are here: see recorded().
_RECORDED: list[list[DataFrame]] = []


@contextmanager
def recorded():
    """The tables that are written within, in a list, so that the caller can drop those that operators have left behind their results."""
    made: list[DataFrame] = []
    _RECORDED.append(made)
    try:
        yield made
    finally:
        _RECORDED.pop()


def drop(df: DataFrame) -> None:
    """Delete the files behind a materialize()d table that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(df.written)
    path.getFileSystem(conf).delete(path, True)


class Scratch:
    """The tables that one run of an operator writes to the shared folder, and deletes again.

    They belong to this run alone. result() writes what the run gives and deletes all the others, so that
    one table stays, behind the DataFrame that the caller gets; other runs' tables are never touched.
    """

    def __init__(self):
        self.tables: list[DataFrame] = []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(materialize(df, name))
        return self.tables[-1]

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step of this run reads."""
        for t in tables:
            drop(t)
            self.tables = [x for x in self.tables if x is not t]

    def result(self, df: DataFrame, name: str) -> DataFrame:
        out = materialize(df, name)
        self.drop(*self.tables)
        return out


class Marks:
    """A set of 64-bit keys as a bitmap of bounded size: it lets all keys pass, and some others."""

    def __init__(self, keys: DataFrame, column: str = "key"):
        n = keys.count()
        self.size = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * n).bit_length()))
        bit = F.pmod(column, F.lit(self.size)) + 1  # the built-in bitmaps count from 1
        rows = keys.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect()
        self.bits = np.zeros(self.size // 8, dtype=np.uint8)
        for r in rows:
            self.bits[(r["n"] - 1) * 4096 : r["n"] * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)

    def hit(self, keys: np.ndarray) -> np.ndarray:
        at = keys.astype(np.int64, copy=False) % self.size
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1) == 1


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs but for the rows whose id is in `ids` (one column, id_col); rows without an id stay.

    Rows that a bitmap of the ids doesn't mark pass as they are; only the marked ones are shuffled and joined with the ids.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    bounded(docs.sparkSession)
    marks = docs.sparkSession.sparkContext.broadcast(Marks(ids, id_col))

    def part(marked: bool):
        def run(batches):
            for b in batches:
                key = b.column(id_col).cast(pa.int64())
                hit = marks.value.hit(pc.fill_null(key, 0).to_numpy(zero_copy_only=False)) & ~key.is_null().to_numpy(zero_copy_only=False)
                yield b.filter(pa.array(hit == marked))

        return run

    rest = docs.mapInArrow(part(True), docs.schema).join(ids, id_col, "left_anti").select(*docs.columns)
    return docs.mapInArrow(part(False), docs.schema).unionByName(rest)


def words_of(text) -> "F.Column":
    """All words of a whole text; null gives an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def tasks_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
