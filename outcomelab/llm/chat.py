"""Chat formatting in budgeted windows.

The turns of a conversation are numbered and cut into blocks of ``BLOCK_TURNS``; a
block also gets the last ``HISTORY_TURNS`` of the block before and the system turn, so
blocks are formatted independently and a conversation of any length is spread over many
tasks.  Inside a block, prefix sums of turn tokens choose turn-aligned windows: the
system turn, as much of the preceding turns as the history allows, then as many new
turns as fit the budget (one at least).  Every turn is new in exactly one window; the
loss mask covers the texts of new assistant turns only, so repeated targets are masked.

Format of a turn: ``<|begin|>role\\ntext<|end|>\\n``.  Control strings inside texts and
roles are broken up reversibly: a backslash is doubled, and ``\\~`` is put after the
first character of a control string (``\\n`` stands for a line break in a role).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import held

BUDGET, HISTORY = 512, 128
BLOCK_TURNS = 256
#: Tokens of a turn's markers and role.
TURN_COST = 4
BEGIN, END = "<|begin|>", "<|end|>\n"

#: Control strings of common chat templates; all that open with "<|" are covered by it.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_BACK = {"\\": "\\", "~": "", "n": "\n"}


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\~" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of one formatted window, as they were before formatting."""
    turns = []
    for part in formatted.split(BEGIN)[1:]:
        role, _, text = part[:-len(END)].partition("\n")
        turns.append((unescape(role), unescape(text)))
    return turns


def count_tokens(text: Column) -> Column:
    """Words and single marks: a count that needs no vocabulary."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"))


def numbered(turns: DataFrame) -> DataFrame:
    """Adds ``pos``, the place of each row in its conversation, from 0.

    Two levels: rows are counted by ranges of turn numbers, then numbered inside a range.
    """
    rows = turns.withColumn("range", F.floor(F.col("turn") / BLOCK_TURNS))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("range").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    before = rows.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("conv_id").alias("c"), F.col("range").alias("r"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "range").orderBy(
        F.col("turn").asc_nulls_last(), "role", "text")
    return (rows.withColumn("place", F.row_number().over(inside) - 1)
            .join(before, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("range").eqNullSafe(F.col("r")))
            .withColumn("pos", F.col("before") + F.col("place")).drop("range", "place", "c", "r", "before"))


WINDOWS = ("conv_id long, block long, window int, first_turn long, n_new int, n_repeated int, tokens int, "
           "text string, loss array<struct<start:int,end:int>>")
LOSS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _windows(block: list[dict], budget: int, history: int) -> list[dict]:
    """Formats one block; rows carry ``kind`` (0 system, 1 history, 2 new), in order."""
    system = [r for r in block if r["kind"] == 0]
    turns = [r for r in block if r["kind"] > 0]
    old = sum(r["kind"] == 1 for r in turns)
    sums = np.array([0, *accumulate(r["tokens"] for r in turns)])
    fixed = sum(r["tokens"] for r in system)
    out, start = [], old
    while start < len(turns):
        # The system turn is new itself where it opens the conversation.
        head = system if turns[start]["pos"] > 0 else []
        back = max(int(np.searchsorted(sums, sums[start] - history)), 0)
        # History makes room for the first new turn, oldest turns first.
        while back < start and (fixed if head else 0) + int(sums[start + 1] - sums[back]) > budget:
            back += 1
        room = budget - (fixed if head else 0) - int(sums[start] - sums[back])
        end = max(start + 1, int(np.searchsorted(sums, sums[start] + room, "right")) - 1)
        if head:    # it must not be repeated twice
            while back < start and turns[back]["pos"] == 0:
                back += 1
        parts, loss, at = [], [], 0
        repeated = [*head, *turns[back:start]]
        for k, r in enumerate([*repeated, *turns[start:end]]):
            opening = f"{BEGIN}{escape(r['role']).replace(chr(10), chr(92) + 'n')}\n"
            body = escape(r["text"])
            if k >= len(repeated) and r["role"] == "assistant":
                loss.append({"start": at + len(opening), "end": at + len(opening) + len(body)})
            parts += [opening, body, END]
            at += len(opening) + len(body) + len(END)
        out.append({"first_turn": turns[start]["pos"], "n_new": end - start, "n_repeated": len(repeated),
                    "tokens": sum(r["tokens"] for r in repeated) + int(sums[end] - sums[start]),
                    "text": "".join(parts), "loss": loss})
        start = end
    return out


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of a sorted partition, key by key, across batches."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if rows and key != now:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows


def _format(budget: int, history: int):
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("window", pa.int32()),
                        ("first_turn", pa.int64()), ("n_new", pa.int32()), ("n_repeated", pa.int32()),
                        ("tokens", pa.int32()), ("text", pa.string()), ("loss", LOSS_TYPE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for (conv, block), rows in _groups(batches, ["conv_id", "block"]):
            for k, w in enumerate(_windows(rows, budget, history)):
                out.append({"conv_id": conv, "block": block, "window": k, **w})
                size += len(w["text"])
            if size > 1 << 22:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                   tokens: Column | None = None) -> DataFrame:
    """Windows ``conv_id, block, window, first_turn, n_new, n_repeated, tokens, text, loss``.

    Rows go by ``turn`` (missing ones last), equal turns by role and text, repeated rows
    are turns of their own.  Null texts and roles are empty; a null ``conv_id`` is a
    conversation like any other.  The system turn is the first row if its role says so.
    History is what fits in ``history`` tokens, less what the first new turn needs.  A
    window exceeds ``budget`` only if its system turn and one new turn do.
    ``tokens`` counts a row's tokens from ``text``.  Other columns are not looked at.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    cost = (count_tokens(F.col("text")) if tokens is None else tokens) + TURN_COST
    # Written: new turns, histories and system turns are all drawn from it.
    # A turn costs TURN_COST at least, so the history of a block's first turn lies in the block before.
    reach = max(0, history) // TURN_COST
    size = max(BLOCK_TURNS, reach)
    rows = held(numbered(turns.withColumn("tokens", cost.cast("int"))).withColumn(
        "block", F.floor(F.col("pos") / size)), "turns")
    fields = ["conv_id", "block", "kind", "pos", "role", "text", "tokens"]
    new = rows.withColumn("kind", F.lit(2)).select(fields)
    # A block without turns of its own makes no window, so a last block may send its tail on.
    tail = rows.where(F.col("pos") % size >= size - reach).withColumns(
        {"kind": F.lit(1), "block": F.col("block") + 1}).select(fields)
    opening = rows.where("pos = 0 AND role = 'system'").drop("block")
    blocks = rows.groupBy("conv_id").agg(F.max("block").alias("last"))
    blocks = blocks.withColumnRenamed("conv_id", "c")
    system = opening.join(blocks, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))).withColumn("kind", F.lit(0))
    every = new.unionByName(tail).unionByName(system.select(fields))
    return (every.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "pos")
            .mapInArrow(_format(budget, history), WINDOWS))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now, state = None, None
    done: list[list] = []

    def close():
        conv, n, turns, chars, loss, total = state
        done.append([conv, n, turns.hexdigest(), chars, loss.hexdigest(), total])

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], names)

    for rows in batches:
        for r in rows.to_pylist():
            if state is None or r["conv_id"] != now:
                if state:
                    close()
                now, state = r["conv_id"], [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            turns = read_turns(r["text"])[r["n_repeated"]:]
            state[1] += len(turns)
            for role, text in turns:
                state[2].update(f"{role}\n{text}\n".encode())
            for s in r["loss"]:
                text = unescape(r["text"][s["start"]:s["end"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(r["text"])
        if len(done) > 10_000:
            yield batch()
            done = []
    if state:
        close()
    yield batch()


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: counts and digests of turns and loss texts.

    A digest runs over a conversation in order, so its windows meet in one task, which
    streams through them.
    """
    return (windows.select("conv_id", "block", "window", "n_repeated", "text", "loss")
            .repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
            .mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long"))
