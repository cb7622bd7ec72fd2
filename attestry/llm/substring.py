"""Removal of word passages that an earlier document already has.

A window is ``length`` consecutive words of one document. A word goes when a window that
covers it has the word sequence of a window of a document with a smaller id; windows are
judged on the input.

Level-wise doubling, from a quarter of the length: a window is looked at on a level only if
a part of half its size was found in two documents on the level before.

1. Level one takes of all quarter-length windows only anchors: the least hash among those
   that begin in some full window. Equal full windows have equal anchors, so none is lost,
   and about one word in twenty leads to a row.
2. Anchors found in two documents are extended to twice their length, to either side.
3. Survivors are extended to the full length: of each document, the windows whose anchor
   survived. Those that a document with a smaller id has are cut out.

Rows of a level are grouped within a task before they are shuffled. Of a passage that many
documents of a task hold, only the places of the least of them meet those of other tasks; the
others are known to be repeats and are spread by a salt, so a passage that a third of all
documents hold is not gathered in one task.

Defined cases: a null text has no words; a null id removes and loses nothing; documents
that share an id do not count as earlier than each other, each is judged by its own words;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attestry.llm import words as W
from attestry.llm.spark import cut, few_ids, hinted

#: Rows that a task gathers before it groups them and hands them on.
GATHER = 300_000
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def levels(length: int) -> tuple[int, int]:
    """Window sizes of the first two levels; the third is ``length``."""
    base = -(-length // 4)
    return base, 2 * base


def _sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """pick over values[i:i + width] for each i, in log2(width) passes; none where fewer than ``width`` are left."""
    if len(values) < width:
        return values[:0]
    have = 1
    while 2 * have <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def _grams(words: W.Words, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes, and the hash of the ``base`` words from each word; 0 where they run over the row."""
    h = words.hashes()
    grams = np.zeros(len(h), np.uint64)
    at = words.windows(base)
    grams[at] = W.sequence_hash(h, at, at + base) | np.uint64(1)
    return h, grams


def _least(words: W.Words, grams: np.ndarray, length: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of full windows, and the least gram of each."""
    starts = words.windows(length)
    least = _sliding(grams, length - base + 1, np.minimum)
    return starts, least[starts]


def _anchors(words: W.Words, length: int) -> tuple[np.ndarray, ...]:
    base, twice = levels(length)
    h, grams = _grams(words, base)
    starts, least = _least(words, grams, length, base)
    if not len(starts):
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.uint64))
    span = length - base + 1
    window = np.zeros(len(grams), np.uint64)
    window[starts] = least
    padded = np.concatenate((np.zeros(span - 1, np.uint64), window))
    at = np.flatnonzero((grams == _sliding(padded, span, np.maximum)) & (grams > 0))
    first, last = words.first[words.row[at]], words.first[words.row[at] + 1]
    right, left = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for out, begin in ((right, at), (left, at + base - twice)):
        ok = (begin >= first) & (begin + twice <= last)
        out[ok] = W.sequence_hash(h, begin[ok], begin[ok] + twice) | np.uint64(1)
    return at, grams[at], right, left


def _grouped(keys: list[np.ndarray], doc: np.ndarray, fields: list[np.ndarray]) -> list[pa.Array]:
    """Keys, salt, least and greatest document, and the packed fields of the rows of each key.

    A key has one row with what its least document holds (salt 0, so all such rows of a key
    meet). What its other documents hold is in a row of its own, which needs to meet no other:
    that a smaller document has the key is known. Its salt spreads it, so no key that many
    documents share is gathered in one task.
    """
    order = np.lexsort((doc, *keys[::-1]))
    keys, doc = [k[order] for k in keys], doc[order]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    group = np.cumsum(new) - 1
    lo = doc[np.flatnonzero(new)]
    hi = doc[np.append(np.flatnonzero(new)[1:], len(order)) - 1]
    other = doc > lo[group]
    new[1:] |= other[1:] != other[:-1]
    first = np.flatnonzero(new)
    place = W.mix(keys[0].view(np.uint64) ^ W.mix(doc.view(np.uint64) ^ W.mix(fields[1][order].view(np.uint64))))
    salt = np.where(other[first], (place[first] >> np.uint64(40)).astype(np.int64) + 1, 0)
    packed = np.stack([f[order].view(np.int64) for f in fields], 1).tobytes()
    size = 8 * len(fields)
    payload = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(np.append(first, len(order)) * size), pa.py_buffer(packed)])
    lo, hi = lo[group[first]], hi[group[first]]
    return [*(pa.array(k[first].view(np.int64)) for k in keys), pa.array(salt), pa.array(lo), pa.array(hi), payload.cast(pa.binary())]


def _unpacked(column: pa.Array, fields: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, fields)


def _gathered(parts: Iterator[tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Groups what ``parts`` yields, GATHER rows at a time."""
    held, count = [], 0

    def flush() -> pa.RecordBatch:
        keys, docs, fields = zip(*held, strict=True)
        join = lambda x: [np.concatenate(c) for c in zip(*x, strict=True)]
        return pa.record_batch(_grouped(join(keys), np.concatenate(docs), join(fields)), names=names)

    for part in parts:
        held.append(part)
        count += len(part[1])
        if count >= GATHER:
            yield flush()
            held, count = [], 0
    if count:
        yield flush()


def _level_one(length: int):
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, _, words in W.blocks(batch.column(2)):
                pos, gram, right, left = _anchors(words, length)
                row = words.row[pos]
                yield [gram], ids[at + row], [ids[at + row], _place(tags[at + row], pos - words.first[row]), right, left]

    return lambda batches: _gathered(rows(batches), ["h", "salt", "lo", "hi", "rows"])


def _place(tag: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return (tag.astype(np.int64) << 32) | pos.astype(np.int64)


def _level_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            m = _unpacked(batch.column(0), 4)
            key = np.concatenate((m[:, 2], m[:, 3])).view(np.uint64)
            doc, place = np.tile(m[:, 0], 2), np.tile(m[:, 1], 2)
            keep = key != 0
            yield [key[keep]], doc[keep], [doc[keep], place[keep]]

    return _gathered(rows(), ["h", "salt", "lo", "hi", "rows"])


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        m = np.unique(_unpacked(batch.column(0), 2), axis=0)
        yield pa.record_batch([pa.array(m[:, 0]), pa.array((m[:, 1] >> 32).astype(np.int32)), pa.array((m[:, 1] & 0xFFFFFFFF).astype(np.int32))], names=["id", "tag", "pos"])


def _level_three(length: int):
    base, _ = levels(length)

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            positions = batch.column(3)
            for at, to, words in W.blocks(batch.column(2)):
                part = positions.slice(at, to - at)
                row = np.repeat(np.arange(to - at), pa.compute.list_value_length(part).to_numpy())
                alive = words.first[row] + part.flatten().to_numpy()
                h, grams = _grams(words, base)
                starts, least = _least(words, grams, length, base)
                living = np.full(len(grams), _MAX)
                living[alive] = grams[alive]
                begin = starts[_least(words, living, length, base)[1] == least]
                row = words.row[begin]
                a, b = (W.sequence_hash(h, begin, begin + length, lane) for lane in (0, 1))
                doc = ids[at + row]
                yield [a, b >> np.uint64(32)], doc, [doc, _place(tags[at + row], begin - words.first[row])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(rows(batches), ["h", "g", "salt", "lo", "hi", "rows"]):
            yield batch.set_column(1, "g", batch.column(1).cast(pa.int64()))

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of windows that a document with a smaller id has."""
    for batch in batches:
        column = batch.column(1)
        m = _unpacked(column, 2)
        least = np.repeat(batch.column(0).to_numpy(), pa.compute.binary_length(column).to_numpy() // 16)
        m = m[m[:, 0] > least]
        yield pa.record_batch([pa.array(m[:, 0]), pa.array((m[:, 1] >> 32).astype(np.int32)), pa.array((m[:, 1] & 0xFFFFFFFF).astype(np.int32))], names=["id", "tag", "pos"])


def _kept(length: int, as_is: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                n_words, n_removed, kept = [], [], []
                part = batch.slice(at, 256)
                for text, cut_at in zip(part.column(1), part.column(2), strict=True):
                    whole = (text.as_py() or "").encode()
                    words = whole.split()
                    n_words.append(len(words))
                    if cut_at.is_valid and len(cut_at):
                        edge = np.zeros(len(words) + 1, np.int32)
                        begin = cut_at.values.to_numpy()
                        np.add.at(edge, begin, 1)
                        np.add.at(edge, begin + length, -1)
                        keep = np.cumsum(edge[:-1]) == 0
                        words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(whole if as_is and not n_removed[-1] else b" ".join(words))
                columns = [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), part.column(3)]
                yield pa.record_batch(columns, names=["id", "n_words", "n_removed", "kept_text", "rest"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """``id_col``, n_words, n_removed, kept_text (kept words joined by one space) of every row."""
    out = _removed(docs, id_col, text_col, length, F.lit(None).cast("boolean"), as_is=False).drop("rest")
    return out.withColumnRenamed("id", id_col)


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the kept words, joined by one space, where some were removed.

    Rows that lose all their words go; a row that loses none is returned as it is, with its
    white space. Other columns are carried along; ``chars_col`` is counted anew where it
    exists and words were removed.
    """
    others = [c for c in docs.columns if c != text_col]
    found = _removed(docs, id_col, text_col, length, F.struct(*(F.col(f"`{c}`") for c in others)), as_is=True)
    changed = F.col("n_removed") > 0
    out = {c: F.col(f"rest.`{c}`") for c in others}
    if chars_col in out:
        out[chars_col] = F.when(changed, F.char_length("kept_text")).otherwise(out[chars_col]).cast(docs.schema[chars_col].dataType)
    out[text_col] = F.col("kept_text")
    return found.where("n_removed = 0 or n_removed < n_words").select(*(out[c].alias(c) for c in docs.columns))


def _removed(docs: DataFrame, id_col: str, text_col: str, length: int, rest: Column, as_is: bool) -> DataFrame:
    if length < 4:
        raise ValueError("length must be 4 words at least")
    id_, text = F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    twice = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").limit(1).count()
    tag = F.hash("text").bitwiseAND(0x7FFFFFFF) if twice else F.lit(0)  # tells apart rows that share an id
    texts = docs.select(id_, text, rest.alias("rest")).withColumn("tag", tag.cast("int"))
    named = texts.where("id is not null")

    def repeated(level: DataFrame, *keys: str) -> DataFrame:
        # the order makes what a task reads, and so how it groups, the same if it is run again
        w = Window.partitionBy(*keys, "salt").orderBy("lo", "hi", "rows").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return level.withColumns({"least": F.min("lo").over(w), "most": F.max("hi").over(w)}).where("least < most")

    level = "h long, salt long, lo long, hi long, rows binary"
    one = named.select("id", "tag", "text").mapInArrow(_level_one(length), level)
    two = repeated(one, "h").select("rows").mapInArrow(_level_two, level)
    alive = repeated(two, "h").select("rows").mapInArrow(_survivors, "id long, tag int, pos int")
    alive = cut(alive.groupBy("id", "tag").agg(F.collect_set("pos").alias("positions")))
    ids = alive.select("id").distinct()
    few = few_ids(ids)
    touched = named.join(hinted(ids, few), "id", "left_semi") if few else named
    three = touched.join(alive, ["id", "tag"]).select("id", "tag", "text", "positions")
    three = three.mapInArrow(_level_three(length), "h long, g long, salt long, lo long, hi long, rows binary")
    gone = repeated(three, "h", "g").select("least", "rows").mapInArrow(_repeated, "id long, tag int, pos int")
    gone = gone.groupBy("id", "tag").agg(F.collect_list("pos").alias("starts"))
    held = touched.join(gone, ["id", "tag"], "left").select("id", "text", "starts", "rest")
    others = texts.where("id is null")
    if few:
        others = texts.join(hinted(ids, few), "id", "left_anti")
    held = held.union(others.select("id", "text", F.lit(None).cast("array<int>"), "rest"))
    kind = texts.schema["rest"].dataType.simpleString()
    return held.mapInArrow(_kept(length, as_is), f"id long, n_words long, n_removed long, kept_text string, rest {kind}")
