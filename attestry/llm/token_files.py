"""Token ids in Arrow stream files: equal-length sequences and masks with zero-copy random access.

A dataset is a folder of part files and a manifest. A part holds the ids of a range of documents
in order, one document after the other, each with its end id, cut into sequences of one length:
an Arrow IPC stream whose batches all have BATCH rows of

    ids   fixed_size_list<uint16 or uint32>[length]   the narrower type that holds the vocabulary
    mask  fixed_size_list<bool>[length]               whether a place holds an id or padding

The last sequence of a part is padded. As lists have a fixed size and batches a fixed number of
rows, every batch takes the same number of bytes, so batch k lies at ``first + k * stride`` and a
memory-mapped part gives any sequence without reading, decoding or copying another one. Beside
each part, a second stream has its documents (``id``, ``start`` in the part, ``n_tokens``). The
manifest, one row a part, says how many ids come before each part.

Commits: a task writes each file under a name of its own and returns the names; only those of
the attempts that Spark took enter the manifest, so lost executors and repeated attempts leave
files that nobody reads, never half a part.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm.spark import shared_folder

LENGTH = 2048
#: Sequences of a batch.
BATCH = 64
#: Ids after which a task starts another part.
PART_IDS = 1 << 28
#: Bytes of texts that are encoded together, and pieces that a task remembers.
GROUP = 1 << 22
MEMO = 1 << 20
_WHITE = re.compile(r"[\s\u180e]").search
#: Bytes after which a text may be cut, if they come before a space, and that may follow it.
_GRAPHIC = np.zeros(256, dtype=bool)
_GRAPHIC[0x21:0x7F] = True
_LEAD = np.zeros(256, dtype=bool)
_LEAD[0xC3:0xE0] = True  # of two-byte characters without white space
_LETTER, _STOP = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LETTER[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True
_STOP[[*b".,;:!?"]] = True
PART_SCHEMA = "part int, file int, path string, docs_path string, n_docs long, n_tokens long, n_sequences long"


def _pieces(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ends of pieces of texts that lie one after the other and end at ``ends``.

    The pattern of byte-level tokenizers has a boundary at each of these places, whatever stands
    around: before a single space or line end between two characters that are no white space,
    after such a line end, and before a stop that follows a letter.
    """
    fits = _GRAPHIC[data]
    lead = _LEAD[data]
    before = fits.copy()
    before[1:] |= lead[:-1]  # the second byte of a two-byte character
    follows = fits | lead
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 2:
        around = before[:-2] & follows[2:]
        line = around & (data[1:-1] == 0x0A)
        cut[1 : len(data) - 1] = (around & (data[1:-1] == 0x20)) | line | (_LETTER[data[:-2]] & _STOP[data[1:-1]])
        cut[2 : len(data)] |= line
    cut[ends[ends > 0]] = True
    cut[0] = False
    return np.flatnonzero(cut)


class Ids:
    """Ids of texts by the tokenizers library; a piece that a task has met is not encoded again."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this task its core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype = np.dtype("<u2" if max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0) < 1 << 16 else "<u4")
        pre, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder().values()
        plain = type(pre).__name__ == "ByteLevel" and pre.use_regex and not pre.add_prefix_space and self.tokenizer.normalizer is None
        self.cuts = plain and not any(t.lstrip or t.rstrip or t.single_word or re.search(r"[\s.,;:!?]", t.content) for t in added)
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line[0] if len(line) == 1 else None
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``end_id``, and how many each text has."""
        data, ends = _flat(texts)
        stops = _pieces(data, ends) if self.cuts else np.unique(ends[ends > 0])
        offsets = np.concatenate([[0], stops]).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        coded = [*self._known(pieces.dictionary.to_pylist()), np.array([end_id], dtype=self.dtype).tobytes()]
        sizes = np.array([len(c) for c in coded], dtype=np.int64) // self.dtype.itemsize
        flat, starts = np.frombuffer(b"".join(coded), dtype=self.dtype), np.cumsum(sizes) - sizes
        last = np.searchsorted(stops, ends, side="right")  # pieces up to each text's end
        which = np.insert(pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64), last, len(coded) - 1)
        lengths = sizes[which]
        to = np.cumsum(lengths)
        ids = flat[np.repeat(starts[which] - (to - lengths), lengths) + np.arange(to[-1] if len(to) else 0)]
        done = to[last + np.arange(len(last))]
        return ids, np.diff(done, prepend=0)

    def _known(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece; what has not been asked for lately is forgotten."""
        young, old = self.young, self.old
        fresh = []
        for p in pieces:
            if p not in young:
                if p in old:
                    young[p] = old[p]
                else:
                    fresh.append(p)
        young.update(zip(fresh, self._library([p.decode() for p in fresh]), strict=True))
        found = list(map(young.__getitem__, pieces))
        if len(young) > MEMO // 2:
            self.young, self.old = {}, young
        return found

    def _library(self, pieces: list[str]) -> list[bytes]:
        """Pieces without white space but a first space are encoded as lines of one text, others one by one."""
        joined = [self.cuts and self.line_end is not None and not _WHITE(p, 1) and (p[0] == " " and len(p) > 1 or not p[0].isspace()) for p in pieces]
        lines = [p for p, j in zip(pieces, joined, strict=True) if j]
        others = iter(self.tokenizer.encode_batch_fast([p for p, j in zip(pieces, joined, strict=True) if not j], add_special_tokens=False))
        among = iter(self._lines(lines))
        return [next(among) if j else np.array(next(others).ids, dtype=self.dtype).tobytes() for j in joined]

    def _lines(self, lines: list[str]) -> list[bytes]:
        if not lines:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(lines)], add_special_tokens=False)[0].ids, dtype=self.dtype)
        ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
        whole, at = ids.tobytes(), (ends * self.dtype.itemsize).tolist()
        return [whole[a:b] for a, b in zip([0, *(x + self.dtype.itemsize for x in at)], at, strict=False)]


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each ends; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[1:] - offsets[0]


_coders: dict[str, Ids] = {}


def _coder(content: str) -> Ids:
    """One encoder a Python process and tokenizer file."""
    key = f"{zlib.crc32(content.encode())}-{len(content)}"
    if key not in _coders:
        _coders[key] = Ids(content)
    return _coders[key]


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path; s3a and s3n are what Hadoop calls s3."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if re.match(r"file:/(?!/)", path):
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


class Writer:
    """One part: sequences and documents are written as they come, with one batch in memory."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int, key_type: pa.DataType):
        store, base = _open(folder)
        self.path, self.docs_path = f"{folder}/{name}.arrows", f"{folder}/{name}.docs.arrows"
        store.create_dir(base, recursive=True)
        self.files = [store.open_output_stream(f"{base}/{name}.arrows"), store.open_output_stream(f"{base}/{name}.docs.arrows")]
        self.length, self.dtype, self.kind = length, dtype, pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(self.kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("id", key_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sequences = pa.ipc.new_stream(self.files[0], self.schema)
        self.docs = pa.ipc.new_stream(self.files[1], self.docs_schema)
        self.held: list[np.ndarray] = []
        self.n_tokens = self.n_docs = self.n_sequences = 0

    def add(self, keys: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Documents with the ids of all and how many each has."""
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        self.docs.write_batch(pa.record_batch([keys, pa.array(starts), pa.array(sizes)], schema=self.docs_schema))
        self.n_docs += len(keys)
        self.n_tokens += len(ids)
        self.held.append(ids)
        if sum(map(len, self.held)) >= BATCH * self.length:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate([np.empty(0, self.dtype), *self.held])
        step = BATCH * self.length
        whole = len(flat) // step * step
        for at in range(0, whole, step):
            self._batch(flat[at : at + step], np.ones(step, dtype=bool))
        rest = flat[whole:]
        if last and len(rest):
            room = -len(rest) % self.length
            self._batch(np.pad(rest, (0, room)), np.arange(len(rest) + room) < len(rest))
            rest = rest[:0]
        self.held = [rest.copy()]

    def _batch(self, flat: np.ndarray, mask: np.ndarray) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x, t), self.length) for x, t in ((flat, self.kind), (mask, pa.bool_()))]
        self.sequences.write_batch(pa.record_batch(lists, schema=self.schema))
        self.n_sequences += len(flat) // self.length

    def close(self) -> None:
        self._flush(last=True)
        for x in (self.sequences, self.docs, *self.files):
            x.close()


def _source(path: str) -> pa.NativeFile:
    store, at = _open(path)
    return pa.memory_map(at) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(at)


class Sequences:
    """Random access to the sequences of a part: views of the mapped file, without a copy."""

    def __init__(self, path: str):
        self.source = _source(path)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.source))
        self.first = self.source.tell()
        self.length = self.schema.field("ids").type.list_size
        self._batches: dict[int, pa.RecordBatch] = {}
        self.stride = 0
        if self.first + 8 < self.source.size():  # more than the end mark
            self.batch(0)
            self.stride = self.source.tell() - self.first

    def batch(self, k: int) -> pa.RecordBatch:
        if k not in self._batches:
            self.source.seek(self.first + k * self.stride)
            self._batches = {k: pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)}
        return self._batches[k]

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``k``."""
        batch, row = self.batch(k // BATCH), k % BATCH
        if not 0 <= row < batch.num_rows:
            raise IndexError(k)
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids[row * self.length : (row + 1) * self.length], batch.column(1).flatten().slice(row * self.length, self.length)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the part on: a view within a batch, else put together."""
        step = BATCH * self.length
        found = []
        while n > 0:
            k, at = divmod(start, step)
            flat = self.batch(k).column(0).flatten().to_numpy(zero_copy_only=True)[at : at + n]
            if not len(flat):
                raise IndexError(start)
            found.append(flat)
            start, n = start + len(flat), n - len(flat)
        return found[0] if len(found) == 1 else np.concatenate([np.empty(0, "<u2"), *found])


def _groups(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in groups of about ``most`` bytes of text."""
    size = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def written(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, length: int = LENGTH, part_ids: int = PART_IDS, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes the ids of all texts in ascending order of ``id_col`` and gives the dataset's folder.

    ``folder`` must be one that driver and executors share, of a kind that pyarrow opens (file,
    hdfs, s3, gs); where it is not given, a new one in the shared folder is taken. ``end_id``
    follows every document; a task begins another part after ``part_ids`` ids. Documents are dealt by range, so each text is shuffled once, and a
    part's file is written by the task that encodes it; memory is a group of texts and a batch.

    Defined cases: a null text counts as empty, an empty one gives its end id alone. Rows without
    an id come first. Rows that share an id all stay, ordered by a hash of the text, then the
    text; those equal in both are told apart by nothing and go to one task. A very long text is
    encoded in one piece and crosses sequences. Other columns, whatever their names, are not
    read. An empty table gives a dataset without parts.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    folder = (folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}").rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        coder, part, out, rows = _coder(content.value), task.partitionId(), None, []

        def done() -> None:
            out.close()
            rows.append((part, len(rows), out.path, out.docs_path, out.n_docs, out.n_tokens, out.n_sequences))

        for batch in batches:
            for group in _groups(batch, min(GROUP, part_ids)):
                if out is None:
                    name = f"part-{part:06d}-{len(rows):04d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
                    out = Writer(f"{folder}/parts", name, coder.dtype, length, group.column(0).type)
                out.add(group.column(0), *coder.encode(group.column(1), end_id))
                if out.n_tokens >= part_ids:
                    done()
                    out = None
        if out is not None:
            done()
        columns = zip(*rows, strict=True) if rows else [()] * 7
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in PART_SCHEMA.split(", ")])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie, "text")
    parts = sorted(tuple(r) for r in ordered.mapInArrow(run, PART_SCHEMA).collect())  # one row a file
    starts = [0, *accumulate(p[5] for p in parts)]
    kind = dict(rows.dtypes)["id"]
    table = [(k, *p[2:], starts[k], kind) for k, p in enumerate(parts)]
    columns = "place long, path string, docs_path string, n_docs long, n_tokens long, n_sequences long, start long, id_type string"
    spark.createDataFrame(table, columns).coalesce(1).write.parquet(f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row a part, in order by ``place``; ``start`` says how many ids come before it."""
    return spark.read.parquet(f"{folder}/manifest")


def documents(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, start, n_tokens and ids (bytes of unsigned 32-bit integers, little end first) of every document, from the files."""
    parts = manifest(spark, folder).select("place", "path", "docs_path", "start", "id_type")
    found = parts.agg(F.count("*").alias("n"), F.first("id_type").alias("kind")).first()
    kind = found.kind or "long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                sequences = Sequences(part["path"])
                for docs in pa.ipc.open_stream(_source(part["docs_path"])):
                    places = list(zip(docs.column(1).to_pylist(), docs.column(2).to_pylist(), strict=True))
                    ids = [sequences.ids(at, n).astype("<u4").tobytes() for at, n in places]
                    starts = pa.array([part["start"] + at for at, _ in places], pa.int64())
                    yield pa.record_batch([docs.column(0), starts, docs.column(2), pa.array(ids, pa.binary())], names=["id", "start", "n_tokens", "ids"])

    each = spark.range(0, found.n, 1, max(1, found.n)).withColumnRenamed("id", "place")  # a task a file
    return each.join(F.broadcast(parts), "place").mapInArrow(run, f"id {kind}, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)
