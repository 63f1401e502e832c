"""Chat formatting by columnar byte assembly.

A conversation becomes ``### role: text</turn>\\n`` per turn.  Backslashes are
doubled and the control strings ``##`` and ``</`` are broken by a backslash, so
neither a header nor a turn end can occur inside a text, and ``\\\\x -> x`` undoes
the escape.

Rows are shuffled by conversation, sorted by turn, and assembled batch by batch:
segment lengths, cumulative offsets and scatter indices are numpy arrays, and
headers, contents and ends are copied into one preallocated Arrow buffer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.common import runs, table

OPEN, MID, END = b"### ", b": ", b"</turn>\n"
LOSS_ROLE = "assistant"
FORMAT_SCHEMA = "conv_id long, n_turns long, formatted string, mask array<struct<start:long,length:long>>"
BATCH_BYTES = 32 << 20


def escape(a: pa.Array, header: bool = False) -> pa.Array:
    a = pc.replace_substring(a, "\\", "\\\\")
    a = pc.replace_substring(a, "##", "#\\#")
    a = pc.replace_substring(a, "</", "<\\/")
    return pc.replace_substring(a, ":", "\\:") if header else a


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", r"\1", s, flags=re.S)


def _bytes(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string array without nulls."""
    a = a.cast(pa.large_string())
    _, off, data = a.buffers()
    offsets = np.frombuffer(off, np.int64)[a.offset:a.offset + len(a) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def assemble(roles: pa.Array, texts: pa.Array, first: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Formatted conversations, and per turn the code-point start (inside its
    conversation) and length of the escaped text.  ``first``: first row of each
    conversation."""
    n = len(texts)
    roles, texts = escape(roles, header=True), escape(texts)
    (rd, ro), (td, to) = _bytes(roles), _bytes(texts)
    rl, tl = np.diff(ro), np.diff(to)
    # segment lengths: open, role, mid, text, end
    fixed = [np.full(n, len(x), np.int64) for x in (OPEN, MID, END)]
    lengths = np.stack([fixed[0], rl, fixed[1], tl, fixed[2]], axis=1)
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(n, 5)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    for column, constant in ((0, OPEN), (2, MID), (4, END)):
        at = starts[:, column, None] + np.arange(len(constant))
        out[at] = np.frombuffer(constant, np.uint8)
    for column, data, offsets, size in ((1, rd, ro, rl), (3, td, to, tl)):
        total = int(size.sum())
        # scatter index of each byte: its place in the segment plus the segment's start
        inside = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(starts[:, column], size) + inside] = data[int(offsets[0]):int(offsets[0]) + total]
    bounds = np.append(starts[first, 0], len(out)).astype(np.int64)
    formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(out))
    rc = pc.utf8_length(roles).to_numpy(zero_copy_only=False).astype(np.int64)
    tc = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    turn = len(OPEN) + rc + len(MID) + tc + len(END)
    before = np.cumsum(turn) - turn
    conv = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    return formatted, before - before[first][conv] + len(OPEN) + rc + len(MID), tc


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def build(tables: list[pa.Table]) -> pa.RecordBatch:
        sizes = np.array([t.num_rows for t in tables])
        first = np.cumsum(sizes) - sizes
        t = pa.concat_tables(tables).combine_chunks()
        roles, texts = (t.column(c).combine_chunks() for c in ("role", "text"))
        formatted, start, length = assemble(roles, texts, first)
        loss = pc.equal(roles, LOSS_ROLE).to_numpy(zero_copy_only=False).astype(bool)
        conv = np.repeat(np.arange(len(tables)), sizes)[loss]
        offsets = np.searchsorted(conv, np.arange(len(tables) + 1)).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(start[loss]), pa.array(length[loss])], ["start", "length"])
        has = t.column("known").combine_chunks().take(pa.array(first))
        ids = pc.if_else(has, t.column("conv_id").combine_chunks().take(pa.array(first)), None)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), formatted.cast(pa.string()),
             pa.ListArray.from_arrays(pa.array(offsets), spans)],
            names=["conv_id", "n_turns", "formatted", "mask"])

    held, size = [], 0
    for run in runs(batches, ["lost", "conv_id"]):
        held.append(run)
        size += run.nbytes
        if size >= BATCH_BYTES or len(held) >= 5000:
            yield build(held)
            held, size = [], 0
    if held:
        yield build(held)


def format_chats(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, mask) per conversation of (conv_id, turn,
    role, text); the mask holds the code-point spans of the assistant's texts.

    Null texts and roles count as empty; rows without a conv_id form one
    conversation with a null id; equal turns are ordered by role, then text, and
    repeated rows are kept; null turns come first.  Other columns are ignored.
    An empty table gives no rows.  A conversation is one value, so its own size
    bounds what a task holds.
    """
    r = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"),
                    F.col("conv_id").isNull().cast("int").alias("lost"),
                    F.col("conv_id").isNotNull().alias("known"), F.col("turn"),
                    F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    r = r.repartition("conv_id", "lost").sortWithinPartitions("lost", "conv_id", "turn", "role", "text")
    return r.mapInArrow(_format, FORMAT_SCHEMA)


TURN = re.compile(r"### ((?:\\.|[^\\:])*): (.*?)</turn>\n", re.S)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"turns": [], "loss": []}
        for formatted, mask in zip(batch.column(2), batch.column(3)):
            text = formatted.as_py()
            turns, at = [], 0
            while at < len(text):
                m = TURN.match(text, at)
                if not m:
                    raise ValueError(f"not a turn at {at}")
                turns.append({"role": unescape(m[1]), "text": unescape(m[2])})
                at = m.end()
            out["turns"].append(turns)
            out["loss"].append([unescape(text[s["start"]:s["start"] + s["length"]]) for s in mask.as_py()])
        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pc.utf8_length(batch.column(2)).cast(pa.int64()),
             pa.array(out["turns"], pa.list_(turn)), pa.array(out["loss"], pa.list_(pa.string()))],
            names=["conv_id", "n_turns", "formatted_chars", "turns", "loss"])


def read_chats(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations back into turns and the texts under the mask."""
    return formatted.select("conv_id", "n_turns", "formatted", "mask").mapInArrow(
        _read, "conv_id long, n_turns long, formatted_chars long, "
               "turns array<struct<role:string,text:string>>, loss array<string>")


PROBE = "\\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
                                  "conv_id long, turn long, role string, text string")
    read = read_chats(format_chats(rows.unionByName(probe)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
