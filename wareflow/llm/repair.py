"""Conversation structure repair: the cheapest edits that give alternating turns, by one integer minimum over a DAG."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, Scratch, bounded, read

#: Digits of the audit letters, in ASCII order; 0 pads the end of a row's digits.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {v: k for k, v in DIGIT.items()}
BITS = 3
#: What a repaired conversation goes through: nothing yet, after s, after u, after a. It may end at the first and the last.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1


def _edges(role: str, fault: str) -> list[list[tuple[int, int, int, int]]]:
    """From each state: (next state, cost, first digit, second digit) of all ways to pass a row of this role and fault.

    At most one insert stands before a row: two in a row can be left out, and the alternation still holds; where that leaves a lone s,
    deleting it costs 3 instead of the two inserts' 4.
    """
    out = []
    for state in range(4):
        ways = []
        before = [(state, 0, ())] + [(STEP[state, x], INSERT, ("I",)) for x in "ua" if (state, x) in STEP]
        for at, paid, letters in before:
            after = [(at, DELETE, "D")]
            if fault in "-t":
                late = TRUNCATED if fault == "t" else 0
                after += [(STEP[at, role], KEEP + late, "K")] if (at, role) in STEP else []
                after += [(STEP[at, x], REROLE + late, "R") for x in "ua" if (at, x) in STEP]
            for to, cost, letter in after:
                first, second = [*(DIGIT[x] for x in (*letters, letter)), 0][:2]
                ways.append((to, paid + cost, first, second))
        out.append(ways)
    return out


EDGES = {role + fault: _edges(role, fault) for role in "sua-" for fault in "-tbd"}


#: Rows that are passed one by one; longer conversations are runs of so many rows, joined two by two.
RUN = 512


def _passed(codes: str) -> tuple[int, dict[tuple[int, int], int]]:
    """Bits of the low digits of a run of rows, and the least weight from each state before it to each state after it."""
    width = BITS * len(codes)
    least: dict[tuple[int, int], int] = {}
    for begin in range(4):
        best: list[int | None] = [0 if state == begin else None for state in range(4)]
        for i in range(0, len(codes), 2):
            one, two = width - BITS * (i + 1), width - BITS * (i + 2)
            new: list[int | None] = [None] * 4
            for state, ways in enumerate(EDGES[codes[i : i + 2]]):
                if (so_far := best[state]) is None:
                    continue
                for to, cost, first, second in ways:
                    total = so_far + (cost << width) + (first << one) + (second << two)
                    if new[to] is None or total < new[to]:
                        new[to] = total
            best = new
        least |= {(begin, end): x for end, x in enumerate(best) if x is not None}
    return width, least


def _joined(left: tuple, right: tuple) -> tuple[int, dict[tuple[int, int], int]]:
    """Two runs as one: the left one's digits stand before the right one's, the costs add up above both."""
    (a, before), (b, after) = left, right
    low, least = (1 << b) - 1, {}
    for (begin, mid), x in before.items():
        for to in range(4):
            if (y := after.get((mid, to))) is not None:
                total = (x << b) + (y >> b << a + b) + (y & low)
                if (begin, to) not in least or total < least[begin, to]:
                    least[begin, to] = total
    return a + b, least


def cheapest(codes: str) -> tuple[int, str]:
    """Cost and audit of the cheapest edits, the ASCII-least of them; codes: two letters a row, its role (s, u, a, -) and fault (-, b, d, t).

    A node of the DAG is (rows passed, state). The weight of a path is one integer: its high digits are the cost, then come two digits a row
    and one for the end. A row's letters are I? and one of D, K, R, and no such word begins another, so that digits aligned by row and padded
    with zeros at the end compare as the audits do. Weights only add up, and the least integer has everything in it.
    """
    runs = [_passed(codes[i : i + 2 * RUN]) for i in range(0, len(codes), 2 * RUN)] or [_passed("")]
    while len(runs) > 1:
        runs = [_joined(*runs[i : i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    width, least = runs[0]
    ends = [x << BITS for (begin, end), x in least.items() if begin == 0 and end in ENDS]
    high = width + BITS
    ends += [(x << BITS) + (INSERT << high) + DIGIT["I"] for (begin, end), x in least.items() if (begin, end) == (0, 2)]  # an inserted a may end it
    total = min(ends)
    digits = f"{total & ((1 << high) - 1):0{high // BITS}o}"  # a digit has three bits
    return total >> high, "".join(LETTER[int(d)] for d in digits if d != "0")


def numbered(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, alive) with `pos` from 1 in each conversation's order and `fault`, `fresh_turn`, `illegal`.

    The order is by turn (nulls first), then role and text; rows that aren't alive are numbered apart.
    """
    whose = ("conv_id", "alive")
    order = Window.partitionBy(*whose).orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    seen = Window.partitionBy(*whose, "role", "text").orderBy("pos")
    said = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    rows = rows.repartition("conv_id").withColumns({
        "pos": F.row_number().over(order),
        "fresh_turn": F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(order)),
        "illegal": F.lag("role").over(order).isNotNull() & ~F.concat(F.substring(F.lag("role").over(order), 1, 1), initial).isin("su", "ua", "au"),
    })
    fault = F.when(said == "", "b").when(F.row_number().over(seen) > 1, "d").when(~F.right(said, F.lit(1)).isin(".", "!", "?"), "t").otherwise("-")
    return rows.withColumn("fault", fault).withColumn("code", F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("-"), "fault"))


def repair(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Faults, cost, audit and digest of each conversation repaired.

    rows: conv_id, turn, role, text and `alive`; a row that isn't alive only says that the conversation exists. Returns conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Two characters a row are gathered to decide a conversation; its texts are not. They follow their conversation's audit in order through a
    task, which hashes them one by one. Null texts and roles are one space, null conv_ids are one conversation. The digest is of one sequence of
    texts, so the texts of one conversation are read by one task, in constant memory.
    """
    none = F.lit(" ")
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text"), "alive")
    flat = scratch.save(numbered(rows), "repair-rows")
    bounded(flat.sparkSession)
    n = lambda what: F.coalesce(F.sum(F.when(F.col("alive") & what, 1)), F.lit(0)).cast("long")
    turn = F.when(F.col("alive"), F.col("turn"))
    codes = F.sort_array(F.collect_list(F.when(F.col("alive"), F.struct("pos", "code"))))
    found = flat.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - n(F.col("fresh_turn")), F.lit(0)).cast("long").alias("gaps"),
        *[n(F.col("fault") == k).alias(name) for k, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
        n(F.col("illegal")).alias("illegal"),
        F.array_join(F.transform(codes, lambda x: x["code"]), "").alias("codes"),
    )

    def decide(batches):
        for b in batches:
            both = [cheapest(x) for x in b.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([c for c, _ in both], pa.int64()), pa.array([a for _, a in both], pa.string())], names=[*b.schema.names[:-1], "cost", "audit"])

    key = f"conv_id {flat.schema['conv_id'].dataType.simpleString()}"
    head = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    schema = f"{key}, " + ", ".join(f"{c} long" for c in head[:-1]) + ", audit string"
    decided = found.mapInArrow(decide, schema).select("conv_id", F.lit(0).alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), F.struct(*head).alias("head"))
    follow = flat.filter("alive").select("conv_id", "pos", "role", "text").withColumn("head", F.lit(None).cast(decided.schema["head"].dataType))
    both = decided.unionByName(follow).repartition("conv_id").sortWithinPartitions("conv_id", "pos")

    def digest(batches):
        now = None  # the conversation that is open: its id, head, digest
        for b in batches:
            out = []
            for who, pos, role, text, known in zip(*(b.column(c).to_pylist() for c in ("conv_id", "pos", "role", "text", "head")), strict=True):
                if pos == 0:
                    out += [now.row()] if now else []
                    now = _Repaired(who, known)
                else:
                    now.take(role, text)
            if out:
                yield _batch(out, kind)
        if now:
            yield _batch([now.row()], kind)

    kind = pa.schema([b for b in _arrow(flat)] + [(c, pa.int64()) for c in head[:-1]] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    return both.mapInArrow(digest, f"{schema}, repaired_sha256 string")


def _arrow(flat: DataFrame) -> list:
    from pyspark.sql.pandas.types import to_arrow_type

    return [("conv_id", to_arrow_type(flat.schema["conv_id"].dataType))]


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)


class _Repaired:
    """A conversation that is being hashed along its audit. Where a turn stands says its role: s first if it was kept, then u and a in turn."""

    def __init__(self, who, head: dict):
        self.who, self.head, self.audit = who, head, head["audit"]
        self.at, self.n, self.next, self.sha = 0, 0, "user", hashlib.sha256()

    def put(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.n else ''}{role}:{text}".encode())
        self.n += 1
        if not (self.n == 1 and role[:1] == "s"):
            self.next = "assistant" if self.next == "user" else "user"

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.put(self.next, "")
            self.at += 1

    def take(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self.put(role if letter == "K" else self.next, text)

    def row(self) -> tuple:
        self.inserts()
        return (self.who, *self.head.values(), self.sha.hexdigest())


def damaged(conversations: DataFrame) -> DataFrame:
    """Each row as crc32(`conv_id:turn`) % 20 says: dropped (not alive), emptied, without its end marks, repeated, or the user's."""
    none = F.lit(" ")
    x = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), none).alias("role"), F.coalesce(F.col("text").cast("string"), none).alias("text"))
    x = x.withColumn("how", F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), none), F.lit(":"), F.coalesce(F.col("turn").cast("string"), none))) % 20)
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    x = x.withColumns({"text": text, "role": F.when(F.col("how") == 4, "user").otherwise(F.col("role")), "alive": F.col("how") != 0})
    return x.withColumn("again", F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("how", "again")


def op11_conversation_repair(spark, sf_dir):
    """All conversations damaged by the rule and repaired: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256; a row a conversation.

    Nulls are one space, in the rule's key too; a null conv_id is one conversation; rows of one turn go by role and text; an empty table gives no rows.
    """
    scratch = Scratch()
    return scratch.result(repair(damaged(read(spark, sf_dir, "conversations")), scratch), "repair-result")
