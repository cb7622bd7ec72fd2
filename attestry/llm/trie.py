"""Prefix trie of conversations by partition refinement.

All conversations start in one class, the root. Turn by turn, each active class is split by the
next turn of its members, which makes a node of the trie for each part. A class of one distinct
sequence is retired and its tail emitted as a unary chain. At the end the totals of subtrees are
folded back, from the deepest turn to the root.

Equal conversations are one weighted member from the start, so that a group of copies is a
single row. A class with many turns left is split by Spark: one grouping of (class, next turn)
and a join of the parts' names to the members, where members of a hot part are dealt over tasks.
Classes with at most LOCAL turns left are dealt whole and refined within a task, all turns of one
class in one go. There are as many rounds as turns that a class with more than LOCAL turns left
shares; each is written to the shared folder.

A turn counts by a digest of 128 bits of its role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.spark import few_ids, hinted, split_join, stored

#: Turns left in a class that one task refines.
LOCAL = 512
#: Copies of a conversation whose ids are put in order together; more are dealt by range.
COPIES = 1000
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation: conv_id, keys (digests of its turns in order) and sizes (bytes of their texts).

    Turns come by number, nulls first, those of one number by digest. A null role or text is
    empty. Rows without an id belong to no conversation. A conversation is one row of about
    40 bytes a turn, however long its texts are.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).cast("long").alias("turn"), key.alias("key"), F.octet_length(text).alias("size")).alias("turn")
    )
    found = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return found.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.size").alias("sizes"))


def _joined_ids(ids) -> F.Column:
    return F.sha2(F.array_join(F.transform(F.sort_array(ids), lambda i: i.cast("string")), ","), 256)


def _many_copies(rows: DataFrame) -> DataFrame:
    """whole and ends of conversations with many copies: ids sorted by range, joined in blocks, the blocks hashed in order.

    What one task reads of one conversation is a few long texts; it holds one of them at a time.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                to = at
                while to < len(ids) and to - at < 100 * COPIES and whole[to] == whole[at]:
                    to += 1
                yield pa.record_batch([pa.array([whole[at]]), pa.array([ids[at]]), pa.array([",".join(map(str, ids[at:to]))])], names=["whole", "at", "text"])
                at = to

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for batch in batches:
            for whole, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if whole != last:
                    if last is not None:
                        yield pa.record_batch([pa.array([last]), pa.array([digest.hexdigest()])], names=["whole", "ends"])
                    last, digest = whole, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
        if last is not None:
            yield pa.record_batch([pa.array([last]), pa.array([digest.hexdigest()])], names=["whole", "ends"])

    ordered = rows.select("whole", "conv_id").repartitionByRange("whole", "conv_id").sortWithinPartitions("whole", "conv_id")
    texts = ordered.mapInArrow(blocks, "whole binary, at long, text string")
    return texts.repartition("whole").sortWithinPartitions("whole", "at").mapInArrow(digests, "whole binary, ends string")


def _distinct(convs: DataFrame) -> DataFrame:
    """Distinct sequences: conv_id (least), weight, ends (digest of all ids), keys, sizes."""
    whole = F.unhex(F.md5(F.array_join(F.transform("keys", F.hex), ",")))
    rows = stored(convs.select("conv_id", "keys", "sizes", whole.alias("whole")))
    group = [F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.any_value("keys").alias("keys"), F.any_value("sizes").alias("sizes")]
    hot = stored(rows.groupBy("whole").count().where(F.col("count") > COPIES).select("whole"))
    columns = ("conv_id", "weight", "ends", "keys", "sizes")
    if not hot.limit(1).count():
        return stored(rows.groupBy("whole").agg(*group, _joined_ids(F.collect_list("conv_id")).alias("ends")).select(*columns))
    hot = hinted(hot, few_ids(hot))
    cold = rows.join(hot, "whole", "left_anti").groupBy("whole").agg(*group, _joined_ids(F.collect_list("conv_id")).alias("ends"))
    many = rows.join(hot, "whole", "left_semi")
    heads = many.groupBy("whole").agg(*group).join(_many_copies(many), "whole")
    return stored(cold.select(*columns).union(heads.select(*columns)))


def _chain(conv: int, depth: int, parent: int | None, weight: int, sizes: np.ndarray, ends: str) -> tuple[list[tuple], int]:
    """Nodes of a lone sequence from ``depth`` to its end, whose last texts have ``sizes``, and what they save."""
    saved = np.cumsum(((weight - 1) * sizes.astype(np.int64))[::-1])[::-1].tolist()
    last = len(saved) - 1
    rows = [(conv, depth + k, conv if k else parent, weight, int(k < last), 1, s, ends if k == last else NOTHING) for k, s in enumerate(saved)]
    return rows, saved[0]


def _refined(top: int, depth: int, parent: int | None, members: list[tuple]) -> list[tuple]:
    """All nodes of one class, its own first. Members, by id: conv_id, weight, ends, keys, sizes.

    Sizes have a leading zero, so that sizes[d] belongs to the last turn of a node at depth d.
    """
    if len(members) == 1:
        conv, weight, ends, _, sizes = members[0]
        return _chain(conv, depth, parent, weight, sizes[depth:], ends)[0]
    made: list[list] = []  # inner nodes, a parent before its children
    tails: list[tuple] = []
    active = [(members, parent, -1)]
    while active:
        split = []
        for part, above, up in active:
            conv, weight, ends, keys, sizes = part[0]
            if len(part) == 1:
                rows, saved = _chain(conv, depth, above, weight, sizes[depth:], ends)
                tails += rows
                made[up][4] += 1
                made[up][5] += 1
                made[up][6] += saved
                continue
            n = sum(m[1] for m in part)
            ended = [m[2] for m in part if len(m[3]) == depth]
            made.append([conv, depth, above, n, 0, 0, (n - 1) * int(sizes[depth]), ended[0] if ended else NOTHING, up])
            parts: dict[bytes, list] = {}
            for m in part:
                if len(m[3]) > depth:
                    parts.setdefault(m[3][depth], []).append(m)
            at = len(made) - 1
            split += [(p, conv, at) for p in parts.values()]
        active, depth = split, depth + 1
    for node in reversed(made):  # fold back
        node[5] = node[5] or 1
        if node[8] >= 0:
            above = made[node[8]]
            above[4] += 1
            above[5] += node[5]
            above[6] += node[6]
    return [tuple(n[:8]) for n in made] + tails


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of classes, each whole and by id (node, depth, parent, conv_id, weight, ends, keys, sizes), to nodes."""
    out: list[tuple] = []
    held: list[tuple] = []
    head = None
    kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_()]
    names = [c.split()[0] for c in NODE.split(", ")] + ["top"]

    def close() -> None:
        if head is not None:
            rows = _refined(*head, held)
            out.extend((*r, k == 0) for k, r in enumerate(rows))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:7]]
        lists = batch.column(7)
        values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        for i, row in enumerate(zip(*columns, strict=True)):
            if row[:3] != head:
                close()
                head, held = row[:3], []
            held.append((*row[3:], np.concatenate([[0], values[offsets[i] : offsets[i + 1]]])))
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
    close()
    if out:
        yield batch_of(out)


def nodes(convs: DataFrame, local: int = LOCAL) -> DataFrame:
    """Every node of the prefix trie of ``convs`` (conv_id, unique; keys; sizes, as of ``sequences``).

    conv_id (least member) and depth name a node; parent_conv_id (null at the root), n_convs
    (members), n_children, n_leaves (childless nodes of its subtree, itself included),
    saved_tokens ((members - 1) times the bytes of the last text, summed over its subtree) and
    ends_sha256 (of the ids, in order and joined by commas, of members that end here).

    Defined cases: a conversation without turns is a member of the root and ends there; equal
    conversations end at one node; an empty table gives no node, not even a root. Other columns,
    whatever their names, are not read. A result of many rounds is written step by step, so a
    lost executor repeats one step.
    """
    members = _distinct(convs)
    spark = members.sparkSession
    size = F.size("keys")
    total = members.agg(F.min("conv_id").alias("node"), F.sum("weight").alias("n"), F.count("*").alias("members"), F.sum(size).alias("turns"), F.max(F.when(size == 0, F.col("ends"))).alias("ends")).first()
    if not total.members:
        return spark.createDataFrame([], NODE)
    live = members.withColumns({"node": F.lit(total.node), "depth": F.lit(0).cast("long"), "parent": F.lit(None).cast("long")})
    state = ("node", "depth", "parent", "conv_id", "weight", "ends", "keys", "sizes")
    if total.members == 1 or total.turns <= local:
        levels, done = [], [live.select(*state)]
        live = None
    else:
        root = [(total.node, 0, None, total.n, 0, total.ends)]
        levels, done = [spark.createDataFrame(root, "conv_id long, depth long, parent_conv_id long, n_convs long, bytes long, ends string")], []
        live = live.select(*state)
    while live is not None:  # split every class once more
        depth = len(levels)
        going = live.where(size >= depth).select(F.col("node").alias("class"), F.col("keys")[depth - 1].alias("turn"), "conv_id", "weight", "ends", "keys", "sizes")
        parts = stored(
            going.groupBy("class", "turn").agg(
                F.min("conv_id").alias("node"), F.sum("weight").alias("n_convs"), F.count("*").alias("count"), F.sum(size - depth).alias("turns"),
                F.max(F.col("sizes")[depth - 1]).cast("long").alias("bytes"), F.max(F.when(size == depth, F.col("ends"))).alias("ends"),
            )
        ).withColumn("big", (F.col("count") > 1) & (F.col("turns") > local))
        named = split_join(going, parts.select("class", "turn", "node", "big"), ["class", "turn"], counts=parts.select("class", "turn", "count"))
        named = stored(named.select("big", "node", F.lit(depth).cast("long").alias("depth"), F.col("class").alias("parent"), "conv_id", "weight", "ends", "keys", "sizes"))
        done.append(named.where(~F.col("big")).select(*state))
        big = parts.where("big")
        live = None
        if big.limit(1).count():
            levels.append(big.select(F.col("node").alias("conv_id"), F.lit(depth).cast("long").alias("depth"), F.col("class").alias("parent_conv_id"), "n_convs", "bytes", "ends"))
            live = named.where("big").select(*state)
    rows = done[0]
    for d in done[1:]:
        rows = rows.union(d)
    found = rows.repartition("node", "depth").sortWithinPartitions("node", "depth", "conv_id").mapInArrow(_refine, f"{NODE}, top boolean")
    if not levels:
        return found.drop("top")
    found = stored(found)
    folded: list[DataFrame] = []
    below = None
    for depth in range(len(levels) - 1, -1, -1):  # fold back
        kids = found.where(F.col("top") & (F.col("depth") == depth + 1))
        kids = kids.drop("top") if below is None else kids.drop("top").unionByName(below)
        sums = kids.groupBy(F.col("parent_conv_id").alias("conv_id")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        below = levels[depth].join(sums, "conv_id", "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("bytes") + F.coalesce("below", F.lit(0))).alias("saved_tokens"), F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
        )
        below = stored(below)
        folded.append(below)
    for d in folded:
        found = found.unionByName(d, allowMissingColumns=True)
    return found.drop("top")
