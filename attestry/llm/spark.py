"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Most ids that are broadcast (about 16 MB as a hash table); more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Rows of one key that one task joins before the key is split.
HOT = 1000
#: Rows of a ``packed`` table that a partition holds at least, where there are more partitions than cores.
PACKED_ROWS = 10_000


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def packed(df: DataFrame) -> DataFrame:
    """``cut`` for tables between many small steps: one of few rows is read in few partitions.

    A session may deal every shuffle to hundreds of partitions; steps on small tables would then
    be mostly empty tasks, each with files and records of its own. Rows are counted as they are
    written.
    """
    shared_folder(df.sparkSession)
    seen = Observation()
    held = df.observe(seen, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
    few = max(df.sparkSession.sparkContext.defaultParallelism, (seen.get["rows"] or 0) // PACKED_ROWS)
    return held.coalesce(few) if 2 * few <= held.rdd.getNumPartitions() else held


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    In loops this stands for ``cut``: a checkpoint keeps the estimated size of its plan, which
    joins of joins multiply from round to round; a table has the size of its files.
    """
    path = f"{shared_folder(df.sparkSession)}/attestry-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between steps: the one that the session names in spark.checkpoint.dir.

    Where it is unset a local one is made, which only a local session can use; any other
    session is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    have = spark.sparkContext.getCheckpointDir()
    if named or have:
        if not have:
            spark.sparkContext.setCheckpointDir(named)
        return (named or have).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="attestry-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def few_ids(ids: DataFrame, limit: int = BROADCAST_IDS) -> bool:
    """Whether ``ids`` has at most ``limit`` rows; looks at no more than that."""
    return ids.limit(limit + 1).count() <= limit


def hinted(ids: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(ids) if few else ids


def hot_keys(counts: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys that are to be split and into how many ``_parts``, of a table of ``keys`` and ``count``.

    A key is hot when it has more rows than HOT, or than 1 in BROADCAST_IDS of all, so that at
    most BROADCAST_IDS keys can be hot and their table may be broadcast. None if no key is.
    """
    most, rows = counts.agg(F.max("count"), F.sum("count")).first()
    limit = max(HOT, (rows or 0) // BROADCAST_IDS)
    if (most or 0) <= limit:
        return None
    return packed(counts.where(F.col("count") > limit).select(*keys, F.ceil(F.col("count") / limit).cast("int").alias("_parts")))


def split_join(many: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", counts: DataFrame | None = None, hot: DataFrame | None | bool = True) -> DataFrame:
    """``many`` joined to ``few``, which has a key once at most; a key with many rows is split.

    Rows of a hot key are dealt to several tasks by a hash of the row, and the key's row of
    ``few`` goes to each. ``many`` is read twice, so it should be a table or a checkpoint;
    ``counts`` (the keys and ``count``) or ``hot`` (from ``hot_keys``) spares the first time.
    ``how`` is inner or left.
    """
    if hot is True:
        hot = hot_keys(many.groupBy(*keys).count() if counts is None else counts, keys)
    if hot is None:
        return many.join(few, keys, how)
    hot = F.broadcast(hot)
    part = F.coalesce(F.pmod(F.xxhash64(*many.columns), F.col("_parts")), F.lit(0)).cast("int")
    dealt = many.join(hot, keys, "left").select(*many.columns, part.alias("_part"))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    copies = few.join(hot, keys, "left").select(*few.columns, every.alias("_part"))
    return dealt.join(copies, [*keys, "_part"], how).drop("_part")


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df`` through a function of one Arrow batch that yields Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from make(batch)

    return df.mapInArrow(run, schema)
