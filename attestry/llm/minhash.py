"""Near-duplicate components by HyperMinHash, banding and exact verification.

A text's set is its distinct ``width``-word shingles after lower-casing A-Z (the whole
sequence as one shingle when it has fewer words).  Two texts are linked when
``100 * |A & B| >= percent * |A | B|``; a component is what links connect.

1. Each set is sketched: one register per bucket, every bucket with a permutation of its
   own, so short texts leave no bucket empty.  A register holds the leading-zero count of
   the bucket's minimum and ten mantissa bits, 16 bits in all.
2. Texts with equal sets form one class, a node of its own; the text of its smallest id
   stands for it. Classes of one id are linked with each other.
3. Registers are banded.  In a band's bucket of at most ``SMALL`` classes all pairs are
   candidates; in a larger one each class is paired with the smallest.
4. Candidates whose sizes or whose collision-corrected Jaccard estimate rule a link out go;
   the rest are confirmed on the full sets of the whole texts.
5. Larger buckets that still hold several components are finished exactly: shingles that no
   other class of those buckets has bound every overlap from above, which removes classes
   that can have no link; the class with the fewest such shingles becomes the second centre.
   Which of the centre's shingles two classes share, as bit sets, bounds the overlap of any
   pair across components; the pairs that this leaves are confirmed one by one. Bounds are
   compared in blocks of classes of a bucket, each a key of its own, so a bucket is the work
   of as many tasks as it has pairs of blocks.

Joins whose key may be hot (buckets, centres, roots, sets of exact copies) split such keys.

With 28 bands of 4 registers a link at Jaccard 0.8 misses all bands with probability 4e-7.

Defined cases: a null or empty text has no shingles and is linked with nothing; a null id
is kept and gets a null component; rows with shingles that repeat an id share its
component, whatever their texts, and each text keeps links of its own; a component is named by
its least id, so ties do not matter; texts of any length are taken whole; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm import words as W
from attestry.llm.spark import few_ids, hinted, hot_keys, map_batches, packed, split_join, stored

BANDS, ROWS = 28, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
#: Shingles of one side of a block in which sets are compared, in the mean.
BLOCK_SHINGLES = 500_000
#: Classes of a bucket up to which all its pairs are candidates.
SMALL = 12
#: Classes of one side of a block in which those of a large bucket are compared.
BLOCK_CLASSES = 1000
#: Nodes of a graph up to which labels are broadcast in the rounds of ``components``.
FEW_NODES = 50_000
#: Five standard errors of a Jaccard estimate at 0.8 from REGISTERS registers.
MARGIN = 5 * (0.8 * 0.2 / REGISTERS) ** 0.5

_rng = np.random.Generator(np.random.PCG64(77))
_XOR = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(words: W.Words, width: int) -> Iterator[np.ndarray]:
    """Each row's distinct shingle hashes, sorted."""
    h = words.hashes(lower=True)
    at = words.windows(width)
    grams = W.sequence_hash(h, at, at + width)
    edges = np.searchsorted(words.row[at], np.arange(len(words.count) + 1))
    whole = W.sequence_hash(h, words.first[:-1], words.first[1:])
    for r, n in enumerate(words.count):
        if n >= width:
            part = np.sort(grams[edges[r] : edges[r + 1]])
            yield part[np.concatenate(([True], part[1:] != part[:-1]))]
        else:
            yield whole[r : r + 1] if n else grams[:0]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers of each set, one row a set; a row of an empty set means nothing."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    values = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
    edges = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
    least = np.empty((len(full), REGISTERS), np.uint32)
    for j in range(REGISTERS):
        v = values ^ _XOR[j]
        v *= _ODD[j]
        v ^= v >> np.uint32(16)
        v *= np.uint32(0x7FEB352D)
        least[:, j] = np.minimum.reduceat(v, edges)
    # a float32's exponent counts the leading zeros, its upper mantissa bits are the mantissa
    bits = np.maximum(least, 1).astype(np.float32).view(np.uint32) >> np.uint32(23 - MANTISSA)
    out[full] = (bits - np.uint32(127 << MANTISSA)).astype(np.uint16)
    return out


def chance_collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that unequal minima of sets of n and m shingles give one register."""
    total = n + m
    lower = np.exp2(-np.arange(1, 33))[:, None]
    inside = np.exp(-total * lower) - np.exp(-2 * total * lower)
    return (n * m * lower / 2**MANTISSA * inside / total).sum(0)


def _sketch(width: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, texts = batch.column(0), batch.column(1)
        for at, to, words in W.blocks(texts):
            sets = list(shingle_sets(words, width))
            sums = np.zeros((len(sets), 2), np.uint64)
            for i, s in enumerate(sets):
                sums[i] = W.mix(s).sum(), W.mix(s ^ np.uint64(0xABCDEF1234567)).sum()
            reg = registers(sets)
            yield pa.record_batch(
                [
                    ids.slice(at, to - at),
                    batch.column(2).slice(at, to - at),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sums[:, 0].view(np.int64)),
                    pa.array(sums[:, 1].view(np.int64)),
                    pa.array([r.tobytes() for r in reg], pa.binary()),
                ],
                names=["id", "tag", "n", "set_a", "set_b", "sketch"],
            )

    return run


def _bands(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    node, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    reg = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(len(node), BANDS, ROWS)
    key = np.zeros((len(node), BANDS), np.uint64)
    for j in range(ROWS):
        key |= reg[:, :, j].astype(np.uint64) << np.uint64(16 * j)
    key = W.mix(key ^ W.mix(np.arange(1, BANDS + 1, dtype=np.uint64)))
    yield pa.record_batch(
        [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(node, BANDS)), pa.array(np.repeat(n, BANDS))],
        names=["key", "node", "n"],
    )


def _likely(percent: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        n, m = batch.column(2).to_numpy().astype(float), batch.column(3).to_numpy().astype(float)
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
        chance = chance_collision(n, m)
        jaccard = ((a == b).mean(1) - chance) / (1 - chance)
        keep = pa.array(jaccard >= percent / 100 - MARGIN)
        yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


def _as_set(width: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, to, words in W.blocks(batch.column(1)):
            sets = [s.tobytes() for s in shingle_sets(words, width)]
            yield pa.record_batch([batch.column(0).slice(at, to - at), pa.array(sets, pa.binary())], names=["node", "members"])

    return run


def _compare(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """Overlap of each pair; ``bits`` marks which of a's members, in order, b has too."""
    held = dict(zip(sets["node"].to_pylist(), (np.frombuffer(x, np.uint64) for x in sets["members"].to_pylist()), strict=True))
    a, b = pairs["a"].to_pylist(), pairs["b"].to_pylist()
    both, bits = [], []
    for i, j in zip(a, b, strict=True):
        x, y = held[i], held[j]
        there = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
        both.append(int(there.sum()))
        packed = np.packbits(np.pad(there, (0, -len(x) % 64)), bitorder="little").view(np.int64)
        bits.append(packed.tolist())
    sizes = [pa.array([len(held[i]) for i in side], pa.int64()) for side in (a, b)]
    return pa.table([pairs["a"], pairs["b"], *sizes, pa.array(both, pa.int64()), pa.array(bits, pa.list_(pa.int64()))], names=["a", "b", "na", "nb", "both", "bits"])


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _held(some: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """node and text of each of ``some`` nodes."""
    wanted = nodes.select("node", "id", "tag").join(hinted(some, few_ids(some)), "node", "left_semi")
    held = texts.join(hinted(wanted, few_ids(wanted)), ["id", "tag"])
    return held.groupBy("id", "tag", "node").agg(F.first("text").alias("text")).select("node", "text")  # a repeated row counts once


def _overlaps(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """a, b, na, nb, both, bits of each pair, from the full sets of the whole texts.

    Each text's set is made once. Sets meet in blocks: a pair goes to the block of its two
    nodes' hashes, a set to the blocks in which it has a pair, so a group holds the sets of two
    hash classes of about BLOCK_SHINGLES shingles each.
    """
    pairs = packed(pairs)
    some = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = packed(map_batches(_held(some, nodes, texts), _as_set(width), "node long, members binary"))
    total = sets.agg(F.sum(F.octet_length("members"))).first()[0] or 0
    parts = 1 + total // (8 * BLOCK_SHINGLES)
    cell = [F.pmod(F.xxhash64(c), F.lit(parts)).alias(f"cell_{c}") for c in ("a", "b")]
    placed = pairs.select("a", "b", *cell)
    needs = placed.select(F.explode(F.array("a", "b")).alias("node"), F.col("cell_a").alias("at_a"), F.col("cell_b").alias("at_b"))
    needs = needs.distinct().join(sets, "node")
    both = placed.groupBy("cell_a", "cell_b").cogroup(needs.groupBy("at_a", "at_b"))
    return both.applyInArrow(_compare, "a long, b long, na long, nb long, both long, bits array<long>")


def _linked(overlaps: DataFrame, percent: int) -> DataFrame:
    near = overlaps.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both")))
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked ones of candidate pairs: estimate first, then the full sets."""
    pairs = packed(pairs)
    sketch = nodes.select("node", "n", "sketch")
    both = split_join(pairs, sketch.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), ["a"])
    other = sketch.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = split_join(both, other, ["b"], counts=pairs.groupBy("b").count()).select("a", "b", "na", "nb", "sa", "sb")
    likely = map_batches(both, _likely(percent), "a long, b long")
    return packed(_linked(_overlaps(likely, nodes, texts, width), percent))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``; the root is the least node it reaches.

    Each round takes the least label among a node and its neighbours and then the label of
    that label, so paths shorten by more than half; rounds end when no label changes.
    """
    pairs = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = stored(pairs.groupBy("a").agg(F.min("b").alias("l")).select(F.col("a").alias("node"), F.least("a", "l").alias("root")))
    few = few_ids(labels, FEW_NODES)
    hot = None if few else hot_keys(packed(pairs.groupBy("b").count()), ["b"])
    while True:
        step = stored(_near_labels(pairs, labels) if few else _far_labels(pairs, labels, hot))
        changed = step.where("new < root").limit(1).count()
        labels = step.select("node", F.col("new").alias("root"))
        if not changed:
            return labels


def _near_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """A round of few nodes (node, root, new), in as many tasks as there are cores."""
    known = F.broadcast(labels)
    near = pairs.join(known.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
    step = near.join(known, near.a == known.node).select("node", "root", F.least("root", "near").alias("new"))
    jump = F.broadcast(labels.where("root < node").select(F.col("node").alias("new"), F.col("root").alias("far")))
    step = step.join(jump, "new", "left").select("node", "root", F.least("new", "far").alias("new"))
    return step.coalesce(pairs.sparkSession.sparkContext.defaultParallelism)


def _far_labels(pairs: DataFrame, labels: DataFrame, hot: DataFrame | None) -> DataFrame:
    """A round of any number of nodes (node, root, new)."""
    near = split_join(pairs, labels.select(F.col("node").alias("b"), "root"), ["b"], hot=hot).groupBy("a").agg(F.min("root").alias("near"))
    step = packed(labels.join(near, labels.node == near.a).select("node", "root", F.least("root", "near").alias("new")))
    # labels of labels; only of those that change, which are few in all but huge graphs
    jump = labels.where("root < node").select(F.col("node").alias("new"), F.col("root").alias("far"))
    far = packed(step.select("new").distinct().join(jump, "new"))
    step = step.join(F.broadcast(far), "new", "left") if few_ids(far) else split_join(step, far, ["new"], "left")
    return step.select("node", "root", F.least("new", "far").alias("new"))


def _shingles(width: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, to, words in W.blocks(batch.column(1)):
            sets = list(shingle_sets(words, width))
            node = np.repeat(batch.column(0).slice(at, to - at).to_numpy(), [len(s) for s in sets])
            yield pa.record_batch([pa.array(np.concatenate(sets).view(np.int64)), pa.array(node)], names=["shingle", "node"])

    return run


def _finish(members: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, links: DataFrame, width: int, percent: int) -> DataFrame:
    """``labels`` with links that the stars of the larger buckets may have left out, without loss."""
    large = members.where(F.col("size") > SMALL).select("key", "node", "n")

    def unresolved(rows: DataFrame, labels: DataFrame) -> DataFrame:
        rows = packed(rows.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")))
        several = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least")).where("lo < hi")
        return split_join(rows, packed(several.select("key", "least")), ["key"])

    open_ = packed(unresolved(large, labels))
    if not open_.limit(1).count():
        return labels
    grams = map_batches(_held(open_.select("node").distinct(), nodes, texts), _shingles(width), "shingle long, node long")
    # of a class's shingles, those that another class of these buckets has too
    alone = grams.groupBy("shingle").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
    alone = packed(alone.groupBy("node").agg(F.count("*").alias("alone")))
    bound = open_.join(alone, "node", "left").withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0)))
    # a link needs (100 + p) * overlap >= p * (n + m), the overlap is at most ``shared``, m at least ``least``
    fits = (100 + percent) * F.col("shared") >= percent * (F.col("n") + F.col("least"))
    bound = packed(bound.where(fits & (100 * F.col("shared") >= percent * F.col("n"))).select("key", "node", "n", "root", "shared"))
    centre = bound.groupBy("key").agg(F.max(F.struct(F.col("shared") / F.col("n"), -F.col("node"), F.col("n").alias("m"))).alias("c"))
    centre = centre.select("key", (-F.col("c.col2")).alias("centre"), F.col("c.m").alias("m"))
    bound = packed(split_join(bound, centre, ["key"]))
    star = bound.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    star = packed(_overlaps(star, nodes, texts, width))
    links = links.union(_linked(star, percent))
    labels = components(links)
    rest = unresolved(bound.where("node != centre").drop("root", "least"), labels)
    rest = packed(rest.join(star.select(F.col("a").alias("centre"), F.col("b").alias("node"), "both", "bits"), ["centre", "node"]))
    rest = rest.withColumn("apart", F.col("shared") - F.col("both"))
    rest = split_join(rest, rest.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_CLASSES).cast("int").alias("blocks")), ["key"])
    rest = packed(rest.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")))
    # a block meets itself and each later one once
    left = rest.withColumn("lo", F.col("own")).withColumn("hi", F.explode(F.sequence("own", F.col("blocks") - 1)))
    other = rest.withColumn("hi", F.col("own")).withColumn("lo", F.explode(F.sequence(F.lit(0), "own")))
    other = other.select("key", "lo", "hi", *(F.col(c).alias(f"{c}_") for c in ("node", "n", "root", "bits", "apart")))
    inside = F.aggregate(F.zip_with("bits", "bits_", lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda x, y: x + y)
    overlap = (100 + percent) * (inside + F.least("apart", "apart_")) >= percent * (F.col("n") + F.col("n_"))
    once = (F.col("node") < F.col("node_")) | (F.col("lo") < F.col("hi"))
    across = once & (F.col("root") != F.col("root_")) & _sizes_fit(F.col("n"), F.col("n_"), percent)
    pairs = left.join(other, ["key", "lo", "hi"]).where(across & overlap)
    pairs = pairs.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()
    found = _links(pairs, nodes, texts, width, percent)
    return components(links.union(found)) if found.limit(1).count() else labels


def _ties(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the classes of each id that has several."""
    sets = rows.where("n > 0 and id is not null").select("id", "set_a", "set_b")
    pair = F.struct("set_a", "set_b")
    several = packed(sets.groupBy("id").agg(F.min(pair).alias("lo"), F.max(pair).alias("hi")).where("lo < hi").select("id", "lo"))
    found = split_join(sets, several, ["id"]).distinct().where(pair != F.col("lo"))
    node = classes.select("set_a", "set_b", "node")
    found = packed(found.join(node.withColumnRenamed("node", "b"), ["set_a", "set_b"]).select("lo.set_a", "lo.set_b", "b"))
    found = split_join(found, node.withColumnRenamed("node", "a"), ["set_a", "set_b"])
    return packed(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``id_col``, n_shingles, component_id, kept for every row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("tag", F.xxhash64("text"))  # tells apart rows that share an id
    rows = packed(map_batches(texts.select("id", "text", "tag"), _sketch(width), "id long, tag long, n long, set_a long, set_b long, sketch binary"))
    classes = rows.where("n > 0 and id is not null").groupBy("set_a", "set_b").agg(F.min(F.struct("id", "tag", "n", "sketch")).alias("c"))
    classes = packed(classes.select("set_a", "set_b", "c.*", F.monotonically_increasing_id().alias("node")))
    nodes = classes.select("node", "id", "tag", "n", "sketch")
    banded = map_batches(nodes.select("node", "n", "sketch"), _bands, "key long, node long, n long")
    buckets = banded.groupBy("key").agg(F.min(F.struct("node", F.col("n").alias("m"))).alias("c"), F.count("*").alias("size")).where("size > 1")
    buckets = packed(buckets.select("key", F.col("c.node").alias("pivot"), F.col("c.m").alias("m"), "size"))
    members = packed(split_join(banded, buckets, ["key"], counts=buckets.select("key", F.col("size").alias("count"))).select("key", "node", "n", "pivot", "m", "size"))
    star = members.where((F.col("size") > SMALL) & (F.col("node") > F.col("pivot")) & _sizes_fit(F.col("n"), F.col("m"), percent))
    small = members.where(F.col("size") <= SMALL).select("key", "node", "n")
    other = small.select("key", F.col("node").alias("node_"), F.col("n").alias("n_"))
    full = small.join(other, "key").where((F.col("node") < F.col("node_")) & _sizes_fit(F.col("n"), F.col("n_"), percent))
    pairs = star.select(F.col("pivot").alias("a"), F.col("node").alias("b")).union(full.select("node", "node_")).distinct()
    links = _links(pairs, nodes, texts, width, percent).union(_ties(rows, classes))
    labels = components(links)
    labels = _finish(members, labels, nodes, texts, links, width, percent)
    labels = packed(labels.join(classes.select("node", "id"), "node"))
    labels = split_join(labels, labels.groupBy("root").agg(F.min("id").alias("least")), ["root"]).select("node", "least")
    roots = classes.join(labels, "node", "left").select("set_a", "set_b", F.coalesce("least", "id").alias("root"))
    found = split_join(rows.drop("sketch", "tag"), roots, ["set_a", "set_b"], "left")
    root = F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("id"))
    root = F.when(F.col("id").isNotNull(), root)
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), root.alias("component_id"), F.coalesce(F.col("id") == root, F.lit(True)).alias("kept")
    )
