"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. Documents longer than the longest are cut into
pieces of that length and a rest; pieces are packed in decreasing length, each into the bin
with the least free space that holds it. Where none does, bins of the permitted length with
the least cost per piece are opened. At the end every bin shrinks to the least permitted
length that holds its contents.

Pieces of one length are interchangeable, so the plan is made from how many there are of
each length: a table of at most ``max(sizes)`` rows, whatever the input. It gives runs of
ranks within a length to runs of bins. Ranks are counted in parallel: within a length by
salted groups of about ``RANKED`` pieces (more where that gives over ``GROUPS`` groups), whose offsets are the sums of the groups before, so
a length that a third of all documents share is not one task's work.

Ties: of bins with equal free space the one opened last is filled first; of permitted lengths
with equal cost the shorter is opened; pieces of one length are placed by salt, then key, then
piece, and rows that are equal in all of these take each other's places.

Defined cases: a null or empty text counts as its closing token alone; a text of any length is
cut into pieces; equal rows are packed each for itself; a null id is packed like any other;
rows equal in id, piece and length are counted by one task, as a stream; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attestry.llm import words as W

SIZES = (512, 1024, 2048, 4096)
#: Tokens that a sequence costs beyond its length, and the length at which attention doubles its cost.
OVERHEAD, DOUBLES_AT = 16, 16_384
#: Pieces of one length that are ranked together, and the most groups of them.
RANKED, GROUPS = 1000, 100_000


def cost(size: int) -> float:
    return OVERHEAD + size * (1 + size / DOUBLES_AT)


def plan(counts: dict[int, int], sizes: tuple[int, ...] = SIZES) -> tuple[np.ndarray, np.ndarray]:
    """Runs and bins for ``counts`` pieces of each length.

    runs: length, first rank, pieces a bin, first bin, offset in the bin, by length and rank.
    bins: first bin, how many, capacity, used, by first bin.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    open_: dict[int, list[list[int]]] = {}  # free space: [first bin, how many, capacity]
    free: list[int] = []
    done: list[tuple[int, int, int, int]] = []
    next_bin = 0

    def keep(first: int, many: int, size: int, space: int) -> None:
        if many:
            if space not in open_:
                open_[space] = []
                insort(free, space)
            open_[space].append([first, many, size])

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(free, length)
            if at < len(free):
                space = free[at]
                first, many, size = open_[space].pop()
                if not open_[space]:
                    del open_[space]
                    del free[at]
            else:
                fitting = [s for s in sizes if s >= length]
                size = min(fitting, key=lambda s: (cost(s) / min(s // length, left), s))
                many = max(1, left // (size // length))  # what is left over chooses anew
                first, space = next_bin, size
                next_bin += many
            each = space // length
            full = min(many, left // each)
            if full:
                runs.append((length, rank, each, first, size - space))
                keep(first, full, size, space - each * length)
                rank, left = rank + full * each, left - full * each
            if left and full < many:  # fewer than fill a bin
                runs.append((length, rank, left, first + full, size - space))
                keep(first + full, 1, size, space - left * length)
                full, rank, left = full + 1, rank + left, 0
            keep(first + full, many - full, size, space)
    for space, groups in open_.items():
        for first, many, size in groups:
            used = size - space
            done.append((first, many, min(s for s in sizes if s >= used), used))
    return np.array(sorted(runs), np.int64).reshape(-1, 5), np.array(sorted(done), np.int64).reshape(-1, 4)


def word_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and n_tokens: the words of the text and one closing token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, words in W.blocks(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(at, to - at), pa.array(words.count + 1, pa.int64())], names=["key", "n_tokens"])

    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"key {kind}, n_tokens long").withColumnRenamed("key", id_col)


def packed(lengths: DataFrame, id_col: str = "doc_id", sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """One row a piece: ``id_col``, piece, piece_start, piece_tokens, bin_id, bin_size, bin_used, bin_offset."""
    sizes = tuple(sorted(sizes))
    most = sizes[-1]
    rows = lengths.select(F.col(id_col).alias("key"), F.col("n_tokens").cast("long").alias("n")).where("n > 0")
    rows = rows.select("key", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most))).alias("piece"))
    rows = rows.withColumn("tokens", F.least(F.lit(most), F.col("n") - F.col("piece") * most))
    counts = rows.groupBy("tokens").count().toPandas()  # max(sizes) rows at most
    totals = counts.set_index("tokens")["count"]
    salts = np.ones(most + 1, np.int64)
    salts[counts["tokens"].to_numpy(np.int64)] = 1 + counts["count"].to_numpy(np.int64) // max(RANKED, int(counts["count"].sum()) // GROUPS)
    first_salt = np.concatenate(([0], np.cumsum(salts)))  # of each length, in a list of all groups
    offset = np.zeros(first_salt[-1], np.int64)
    if (many := np.flatnonzero(salts > 1)).size:
        several = lengths.sparkSession.createDataFrame(list(zip(many.tolist(), salts[many].tolist(), strict=True)), "tokens long, salts long")
        rows = rows.join(F.broadcast(several), "tokens", "left")  # max(sizes) rows at most
        rows = rows.select("key", "piece", "tokens", F.coalesce(F.pmod(F.xxhash64("key", "piece", "n"), "salts"), F.lit(0)).cast("long").alias("salt"))
        groups = rows.where(F.col("tokens").isin(many.tolist())).groupBy("tokens", "salt").count().toPandas()  # GROUPS and one for each length at most
        groups = groups.sort_values(["tokens", "salt"])
        before = groups["count"].groupby(groups["tokens"]).cumsum() - groups["count"]
        offset[first_salt[groups["tokens"].to_numpy(np.int64)] + groups["salt"].to_numpy(np.int64)] = before
    else:
        rows = rows.select("key", "piece", "tokens", F.lit(0).cast("long").alias("salt"))
    runs, bins = plan({int(k): int(v) for k, v in totals.items()}, sizes)
    own = Window.partitionBy("tokens", "salt").orderBy("key", "piece")
    ranked = rows.withColumn("rank", F.row_number().over(own) - 1).select("key", "piece", "tokens", "salt", "rank")
    first_run = np.searchsorted(runs[:, 0], np.arange(most + 2))
    span = int(totals.max() if len(totals) else 0) + 1
    place = runs[:, 0].astype(object) * span + runs[:, 1]  # length and rank as one number
    place = np.array(place, np.int64) if most * span < 2**62 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, piece, tokens, salt, rank = batch.columns
            tokens, rank = tokens.to_numpy(), rank.to_numpy() + offset[first_salt[tokens.to_numpy()] + salt.to_numpy()]
            if place is not None:
                at = np.searchsorted(place, tokens * span + rank, "right") - 1
            else:
                at = np.array([first_run[t] + np.searchsorted(runs[first_run[t] : first_run[t + 1], 1], r, "right") - 1 for t, r in zip(tokens, rank, strict=True)], np.int64)
            inside = rank - runs[at, 1]
            bin_id = runs[at, 3] + inside // runs[at, 2]
            group = np.searchsorted(bins[:, 0], bin_id, "right") - 1
            where = runs[at, 4] + inside % runs[at, 2] * tokens
            columns = [key, piece, pa.array(piece.to_numpy() * most), pa.array(tokens), pa.array(bin_id), pa.array(bins[group, 2]), pa.array(bins[group, 3]), pa.array(where)]
            yield pa.record_batch(columns, names=["key", "piece", "piece_start", "piece_tokens", "bin_id", "bin_size", "bin_used", "bin_offset"])

    kind = dict(lengths.dtypes)[id_col]
    schema = f"key {kind}, piece long, piece_start long, piece_tokens long, bin_id long, bin_size long, bin_used long, bin_offset long"
    return ranked.mapInArrow(run, schema).withColumnRenamed("key", id_col)
