"""Repair of conversation structure: cheapest edits to a legal order of roles, by a tensor DP.

A legal conversation is empty, or an optional system turn followed by one or more pairs of a user
and an assistant turn; roles count by their first character. Turns are rows; a state says what the
output ends with (nothing, system, user, assistant), so an edit is a move between four states:

    D  delete the row                                      4
    I  insert an empty user or assistant turn before it    3
    K  keep the row                                        0, and 3 if its text is truncated
    R  give it the role user or assistant                  3, and 3 if its text is truncated

From each state one role can be inserted or given, so a letter a row is the whole edit. Rows
that are blank or repeat an earlier row of the conversation must be deleted. Of equally cheap
edits the one whose letters come first in ASCII is taken.

Spark deals rows by conversation and sorts them; a task reads whole conversations in bulk,
buckets them by length (powers of two), lays each bucket out with time as the first axis and ends
aligned, and updates the four costs of all its conversations turn by turn from the end. The
stored costs to go then steer all edits forward at once, turn by turn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after the one role that may be inserted or given in each state.
_FORCED = np.array([USER, USER, ASSISTANT, USER])
_NEVER = 1 << 29
_LETTERS = np.frombuffer(b"\0DIKR", dtype=np.uint8)
_D, _I, _K, _R = 1, 2, 3, 4
#: Turns that are worked on together, if no conversation is longer.
CHUNK = 1 << 16
SPACE = " \t\n\x0b\x0c\r"
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired array<struct<role:string,text:string>>"


def _next(code: np.ndarray) -> np.ndarray:
    """State after a row of role ``code`` is kept, for every state before it; -1 where it may not be."""
    to = np.full((4, *code.shape), -1, dtype=np.int8)
    to[START] = np.where(code == SYSTEM, SYSTEM, np.where(code == USER, USER, -1))
    to[SYSTEM] = np.where(code == USER, USER, -1)
    to[USER] = np.where(code == ASSISTANT, ASSISTANT, -1)
    to[ASSISTANT] = np.where(code == USER, USER, -1)
    return to


def _with_inserts(base: np.ndarray) -> np.ndarray:
    """Costs to go where turns may be inserted first; ``base`` (4, n) has those without."""
    base[USER] = np.minimum(base[USER], INSERT + base[ASSISTANT])
    for state in (START, SYSTEM, ASSISTANT):
        base[state] = np.minimum(base[state], INSERT + base[USER])
    return base


def _options(after: np.ndarray, code: np.ndarray, bad: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs to go by deleting, keeping and giving a role to one turn of n conversations, each (4, n)."""
    to = _next(code)
    kept = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0).astype(np.int64), 0) + KEEP + extra, _NEVER)
    given = after[_FORCED] + REROLE + extra
    return DELETE + after, np.where(bad, _NEVER, kept), np.where(bad, _NEVER, given)


def edits(code: np.ndarray, bad: np.ndarray, truncated: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cheapest edits of n conversations laid out as (turns, n), their ends aligned.

    Gives the costs (n), the letters as (turns + 1, 3, n) with inserts before a row's own letter,
    and the state after each letter.
    """
    turns, n = code.shape
    first = turns - lengths
    extra = np.where(truncated, TRUNCATED, 0).astype(np.int32)
    costs = np.empty((turns + 1, 4, n), dtype=np.int32)
    costs[turns] = _with_inserts(np.array([0, _NEVER, _NEVER, 0], dtype=np.int32)[:, None].repeat(n, 1))
    for t in range(turns - 1, -1, -1):
        base = np.minimum.reduce(_options(costs[t + 1], code[t], bad[t], extra[t]))
        costs[t] = np.where(t >= first, _with_inserts(base), costs[t + 1])
    letters = np.zeros((turns + 1, 3, n), dtype=np.uint8)
    states = np.zeros((turns + 1, 3, n), dtype=np.int8)
    state, each = np.zeros(n, dtype=np.int64), np.arange(n)
    for t in range(turns + 1):
        live = t >= first
        if t < turns:
            deleted, kept, _ = _options(costs[t + 1], code[t], bad[t], extra[t])
            to = _next(code[t])
        for slot in range(3):
            togo = costs[t, state, each]
            insert = live & (togo == INSERT + costs[t, _FORCED[state], each])
            if t < turns:
                insert &= togo != deleted[state, each]
                own = live & ~insert
                drop = own & (togo == deleted[state, each])
                keep = own & ~drop & (togo == kept[state, each])
                letters[t, slot] = np.select([insert, drop, keep, own], [_I, _D, _K, _R], 0)
                after = np.select([keep, drop | ~live], [to[state, each], state], _FORCED[state])
                live = live & insert
            else:
                letters[t, slot] = np.where(insert, _I, 0)
                after = np.where(insert, _FORCED[state], state)
                live = insert
            state = after.astype(np.int64)
            states[t, slot] = state
    return costs[first, START, each].astype(np.int64), letters, states


def _conversations(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.Table]:
    """Sorted rows as tables of whole conversations, of about ``chunk`` rows or one conversation."""
    held, rows, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = batch.column(0).slice(batch.num_rows - 1, 1)
        if rows >= chunk and not (batch.column(0).slice(0, 1).equals(last) and ends.equals(last)):
            keys = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            same = int(np.argmax(keys != keys[0])) if (keys != keys[0]).any() else len(keys)
            if not batch.column(0).slice(0, 1).equals(last):
                same = 0
            yield pa.Table.from_batches([*held, batch.slice(0, same)])
            held, rows, batch = [], 0, batch.slice(same)
        held.append(batch)
        rows += batch.num_rows
        last = ends
    if held:
        yield pa.Table.from_batches(held)


def _repair(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """One row a conversation of a table of whole ones (key, turn, role, text, present, code, blank, truncated)."""
    table = table.combine_chunks()
    key = table.column(0).combine_chunks()
    key = key.chunk(0) if isinstance(key, pa.ChunkedArray) else key
    ids = key.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    heads = np.flatnonzero(np.diff(ids, prepend=-1))
    conv = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(ids))))
    present = table.column("present").to_numpy().astype(bool)
    names = key.take(pa.array(heads))
    conv, table = conv[present], table.filter(pa.array(present))
    n = len(heads)
    length = np.bincount(conv, minlength=n)
    begin = np.cumsum(length) - length
    code, blank = (table.column(c).to_numpy() for c in ("code", "blank"))
    role, text = table.column("role").combine_chunks(), table.column("text").combine_chunks()
    seen = pd.DataFrame({"c": conv, "r": role.to_pandas(), "t": text.to_pandas()}).duplicated().to_numpy()
    blank = blank.astype(bool)
    duplicate = seen & ~blank
    truncated = table.column("truncated").to_numpy().astype(bool) & ~blank & ~duplicate
    same = conv[1:] == conv[:-1]
    a, b = code[:-1], code[1:]
    legal = ((a == SYSTEM) & (b == USER)) | ((a == USER) & (b == ASSISTANT)) | ((a == ASSISTANT) & (b == USER))
    count = lambda which: np.bincount(which, minlength=n)
    turn = table.column("turn")
    dated = turn.is_valid().to_numpy().astype(bool)
    turns = pd.Series(turn.fill_null(0).to_numpy()[dated]).groupby(conv[dated])
    gaps = np.zeros(n, dtype=np.int64)
    found = (turns.max() - turns.min() + 1 - turns.nunique()).astype(np.int64)
    gaps[found.index.to_numpy()] = found.to_numpy()
    totals = [gaps, count(conv[blank]), count(conv[duplicate]), count(conv[truncated]), count(conv[1:][same & ~legal])]
    bucket = np.ceil(np.log2(np.maximum(length, 1))).astype(int)
    for size in np.unique(bucket):
        some = np.flatnonzero(bucket == size)
        shape = (int(length[some].max()), len(some))
        rows = np.arange(shape[0])[:, None] - (shape[0] - length[some]) + begin[some]
        inside = np.arange(shape[0])[:, None] >= shape[0] - length[some]
        at = np.where(inside, rows, 0)
        laid = [np.where(inside, x[at], 0) if len(x) else np.zeros(shape, dtype=x.dtype) for x in (code, blank | duplicate, truncated)]
        cost, letters, states = edits(laid[0], laid[1].astype(bool), laid[2].astype(bool), length[some])
        flat = letters.reshape(-1, len(some)).T
        which, slot = np.nonzero(flat)
        op = flat[which, slot]
        ends = np.append(0, np.cumsum(np.bincount(which, minlength=len(some)))).astype(np.int32)
        audit = pa.StringArray.from_buffers(len(some), pa.py_buffer(ends), pa.py_buffer(_LETTERS[op].tobytes()))
        stays = op != _D
        which, slot, op = which[stays], slot[stays], op[stays]
        forced = np.array(["", "", "user", "assistant"], dtype=object)[states.reshape(-1, len(some)).T[which, slot]]
        source = rows[np.minimum(slot // 3, shape[0] - 1), which] if shape[0] else np.zeros(len(op), dtype=np.int64)
        taken = pa.array(np.where(op == _I, 0, source), mask=op == _I)
        new_text = text.take(taken).fill_null("")
        new_role = pa.array(np.where(op == _K, role.take(taken).to_numpy(zero_copy_only=False), forced), pa.string())
        ends = np.append(0, np.cumsum(np.bincount(which, minlength=len(some)))).astype(np.int32)
        repaired = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([new_role, new_text], ["role", "text"]))
        columns = [names.take(pa.array(some)), *(pa.array(x[some].astype(np.int64)) for x in totals), pa.array(cost), audit, repaired]
        yield pa.record_batch(columns, names=["key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"])


def repaired(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present_col: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row a conversation: its faults, the cost and letters of its cheapest edits, and its turns after them.

    Columns: ``conv_col``, gaps (turn numbers that are missing between the least and the
    greatest), blank, duplicate, truncated (rows by their first fault: no character but white
    space; role and text of an earlier row; last character but white space none of ``.!?``),
    illegal (neighbours whose roles may not follow each other), cost, audit (letters in order) and
    repaired (role and text of each turn).

    Defined cases: a null role or text is one space, so blank. Rows come by turn, nulls first; rows
    of one turn by role and text. A null id is an id like any other. A row for which ``present_col``
    is not true only names its conversation; one of such rows alone, has no faults, no edits and no
    turns. Other columns, whatever their names, are not read. An empty table gives an empty one.
    One conversation is worked on in one task, which holds its rows and 16 bytes a turn of costs:
    each edit depends on all turns before and after it. Texts may be of any length.
    """
    text = F.coalesce(F.col(text_col), F.lit(" "))
    role = F.coalesce(F.col(role_col), F.lit(" "))
    present = F.coalesce(F.col(present_col), F.lit(False)) if present_col else F.lit(True)
    initial = F.substring(role, 1, 1)
    end = F.rtrim(text, F.lit(SPACE))
    rows = turns.select(
        F.col(conv_col).alias("key"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), present.alias("present"),
        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0).cast("byte").alias("code"),
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    dealt = rows.repartition("key").sortWithinPartitions("key", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _conversations(batches, chunk):
            yield from _repair(table)

    return dealt.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, {RESULT}").withColumnRenamed("key", conv_col)
