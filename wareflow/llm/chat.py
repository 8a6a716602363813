"""Chat formatting by token-level assembly: segments, reserved ids, masks by prefix sums."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, read
from .words import parts

START, END = "<|im_start|>", "<|im_end|>"
#: A text may hold what looks like a control string: '<', backslashes, '|'. One backslash more marks it.
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


@lru_cache(maxsize=2)
def codec(path: str):
    """The tokenizer of a file, and the two ids after its vocabulary that mark a turn."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # a text's "<|endoftext|>" is text
    n = t.get_vocab_size()
    return t, n, n + 1


def encode_turns(turns: DataFrame, path: str) -> DataFrame:
    """Each turn as token ids: start id, role and newline, escaped text, end id, newline.

    The segments are encoded by themselves, so that no token spans a border; the mask's limits are
    prefix sums of the segments' lengths. Columns: conv_id, turn, role, text, ids, loss_from, loss_to
    (the text's span if the role is assistant, else empty). Null texts and roles are empty.
    """

    def encode(batches):
        t, start, end = codec(path)
        for b in parts(batches):
            roles = [x or "" for x in b.column("role").to_pylist()]
            texts = [x or "" for x in b.column("text").to_pylist()]
            heads = [e.ids for e in t.encode_batch([f"{escape(r)}\n" for r in roles], add_special_tokens=False)]
            bodies = [e.ids for e in t.encode_batch([escape(x) for x in texts], add_special_tokens=False)]
            newline = t.encode("\n", add_special_tokens=False).ids
            ids, spans = [], []
            for role, head, body in zip(roles, heads, bodies, strict=True):
                limits = np.cumsum([1, len(head), len(body), 1, len(newline)])
                ids.append([start, *head, *body, end, *newline])
                spans.append((int(limits[1]), int(limits[2])) if role == "assistant" else (0, 0))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), pa.array(roles), pa.array(texts), pa.array(ids, pa.list_(pa.int32())), pa.array([x for x, _ in spans], pa.int32()), pa.array([x for _, x in spans], pa.int32())],
                names=["conv_id", "turn", "role", "text", "ids", "loss_from", "loss_to"],
            )

    bounded(turns.sparkSession)
    slim = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return slim.mapInArrow(encode, "conv_id long, turn long, role string, text string, ids array<int>, loss_from int, loss_to int")


def spliced(turns: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of turns in order. Each turn's limits are shifted by the prefix sum of the lengths before it; the mask is the
    prefix sum of a step up where a text under the loss begins and a step down where it ends."""
    parts_ = [np.asarray(t["ids"], dtype=np.int32) for t in turns]
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(p) for p in parts_], dtype=np.int64)])
    step = np.zeros(before[-1] + 1, dtype=np.int8)
    np.add.at(step, before[:-1] + np.array([t["loss_from"] for t in turns], np.int64), 1)
    np.add.at(step, before[:-1] + np.array([t["loss_to"] for t in turns], np.int64), -1)
    return np.concatenate([*parts_, np.zeros(0, np.int32)]), np.cumsum(step, dtype=np.int8)[:-1]


def assemble(encoded: DataFrame) -> DataFrame:
    """One row a conversation: `ids` of all turns in order and `mask`, 1 where a token counts for the loss.

    Equal turns are ordered by role, then text; a null turn comes first. A conversation is one output row by
    nature; only ids are gathered, after encoding. Null conv_ids are one conversation.
    """
    turn = F.struct("turn", "role", "text", "ids", "loss_from", "loss_to")
    g = encoded.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))

    def splice(batches):
        for b in batches:
            both = [spliced(t) for t in b.column("t").to_pylist()]
            lists = [pa.array([x.tolist() for x in column], pa.list_(kind)) for column, kind in zip(zip(*both, strict=True), (pa.int32(), pa.int8()), strict=True)] if both else [pa.array([], pa.list_(pa.int32())), pa.array([], pa.list_(pa.int8()))]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), *lists], names=["conv_id", "ids", "mask"])

    slim = F.transform("t", lambda x: F.struct(x["ids"].alias("ids"), x["loss_from"].alias("loss_from"), x["loss_to"].alias("loss_to")))
    return g.select("conv_id", slim.alias("t")).mapInArrow(splice, "conv_id long, ids array<int>, mask array<tinyint>")


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """From ids and mask alone: the formatted text, the turns' roles and texts, and the texts under the mask."""

    def decode(batches):
        t, start, end = codec(path)
        for b in batches:
            out = []
            for ids, mask in zip(b.column("ids").to_pylist(), b.column("mask").to_pylist(), strict=True):
                a, m = np.asarray(ids, dtype=np.int64), np.asarray(mask, dtype=np.int8)
                begins, ends = np.flatnonzero(a == start), np.flatnonzero(a == end)
                bodies = [a[i + 1 : j].tolist() for i, j in zip(begins, ends, strict=True)]
                tails = [a[j + 1 : k].tolist() for j, k in zip(ends, [*begins[1:], len(a)], strict=True)]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], m, [0]])))
                spans = [a[i:j].tolist() for i, j in zip(edges[::2], edges[1::2], strict=True)]
                said = t.decode_batch(bodies + tails + spans, skip_special_tokens=False)
                texts, n = said[: len(bodies)], len(bodies)
                parts = [x.partition("\n") for x in texts]
                out.append(
                    {
                        "formatted": "".join(f"{START}{x}{END}{y}" for x, y in zip(texts, said[n : 2 * n], strict=True)),
                        "roles": [unescape(x[0]) for x in parts],
                        "texts": [unescape(x[2]) for x in parts],
                        "loss_texts": [unescape(x) for x in said[2 * n :]],
                    }
                )
            kind = pa.struct([("formatted", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("loss_texts", pa.list_(pa.string()))])
            yield pa.RecordBatch.from_struct_array(pa.StructArray.from_arrays([b.column("conv_id"), *pa.array(out, kind).flatten()], names=["conv_id", "formatted", "roles", "texts", "loss_texts"]))

    return formatted.select("conv_id", "ids", "mask").mapInArrow(decode, "conv_id long, formatted string, roles array<string>, texts array<string>, loss_texts array<string>")


def op3_chat_format(spark, sf_dir):
    """All conversations and conversation -1, formatted and read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; a row a conversation."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = f"{END}{START}assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(assemble(encode_turns(turns, path)), path)
    said = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda x: F.concat(x["roles"], F.lit("\n"), x["texts"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("roles").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
