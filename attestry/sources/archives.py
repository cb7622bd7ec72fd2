"""Archives: JSON registers in a zip, and spreadsheets.

Files come through Spark's ``binaryFile`` reader, so they may lie in any store; a zip member
can't be split, so a file is one row and many files are read in parallel. Records are yielded in
batches, so memory follows the file and not what it unpacks to.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attestry.functions.scalars import plain_header

#: Rows of one batch that an archive is unpacked to.
BATCH = 10_000


def _unpacked(spark: SparkSession, path: str, rows_of: Callable[[bytes], Iterator[tuple]], schema: str, types: list) -> DataFrame:
    """Rows that ``rows_of`` yields for each file under ``path``, with the file's name."""
    names = ["file", *(part.split()[0] for part in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(name: str, held: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([name] * len(held), pa.string()), *(pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True))]
            return pa.record_batch(columns, names=names)

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held: list[tuple] = []
                for row in rows_of(content.as_py()):
                    held.append(row)
                    if len(held) >= BATCH:
                        yield batch_of(name, held)
                        held = []
                if held:
                    yield batch_of(name, held)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, f"file string, {schema}")


def array_items(stream: io.TextIOBase, depth: int = 2, size: int = 1 << 16) -> Iterator[object]:
    """Items of the arrays at ``depth`` of a JSON text, read in pieces.

    Fractions are refused: registers hold texts and whole numbers only.
    """

    def refuse(number: str) -> object:
        raise ValueError(f"fraction in a register: {number}")

    decoder = json.JSONDecoder(parse_float=refuse, parse_constant=refuse)
    held, level, ended = "", 0, False
    while True:
        held = held.lstrip(" \t\r\n,")
        if level < depth and held[:1] == "[":
            level, held = level + 1, held[1:]
            continue
        if held[:1] == "]":
            level, held = level - 1, held[1:]
            if level == 0:
                return
            continue
        if level == depth or held[:1] not in ("[", ""):
            try:
                item, at = decoder.raw_decode(held)
                if at < len(held) or ended:
                    held = held[at:]
                    if level == depth:
                        yield item
                    continue
            except json.JSONDecodeError:
                if ended:
                    raise
        piece = stream.read(size)
        ended = not piece
        if ended and not held.strip():
            return
        held += piece


def _zip_rows(content: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        members = [n for n in z.namelist() if n.lower().endswith(".json")]
        if len(members) != 1:
            raise ValueError(f"{len(members)} JSON members in a zip, not one")
        with z.open(members[0]) as raw:
            for k, item in enumerate(array_items(io.TextIOWrapper(raw, "utf-8-sig"))):
                yield k, json.dumps(item, ensure_ascii=False, sort_keys=True)


def zip_records(spark: SparkSession, path: str, needs: tuple[str, ...] = ()) -> DataFrame:
    """file, ordinal and record (JSON text) of every item in the sections of the JSON member of each zip.

    ``needs`` keeps only records with one of these keys, which leaves editorial sections out.
    """
    found = _unpacked(spark, path, _zip_rows, "ordinal long, record string", [pa.int64(), pa.string()])
    if not needs:
        return found
    has = [F.try_variant_get("v", f"$['{key}']", "variant").isNotNull() for key in needs]
    kept = has[0]
    for other in has[1:]:
        kept = kept | other
    return found.withColumn("v", F.parse_json("record")).where(kept).drop("v")


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _text(element: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{_MAIN}t"))


def _each(stream: io.IOBase, tag: str) -> Iterator[ElementTree.Element]:
    """The elements of a tag, each let go of before the next."""
    for _, element in ElementTree.iterparse(stream):
        if element.tag == tag:
            yield element
            element.clear()


def _place(reference: str) -> int:
    """Column number, from 0, of a cell reference."""
    n = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _sheet_rows(content: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        members = set(z.namelist())
        strings = [_text(e) for e in _each(z.open("xl/sharedStrings.xml"), f"{_MAIN}si")] if "xl/sharedStrings.xml" in members else []
        target = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        read = {
            "s": lambda c, v: strings[int(v)] if v is not None else None,
            "inlineStr": lambda c, v: _text(c),
        }
        for number, sheet in enumerate(ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")):
            name = target[sheet.get(_LINK)]
            for row in _each(z.open(name if name in members else f"xl/{name}"), f"{_MAIN}row"):
                for cell in row.iter(f"{_MAIN}c"):
                    value = read.get(cell.get("t"), lambda c, v: v)(cell, cell.findtext(f"{_MAIN}v"))
                    if value is not None:
                        yield sheet.get("name"), number, int(row.get("r")), _place(cell.get("r")), value


def sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    """file, sheet, sheet_no, row_no, column_no and value of the filled cells of every sheet."""
    types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string()]
    return _unpacked(spark, path, _sheet_rows, "sheet string, sheet_no int, row_no long, column_no int, value string", types)


def with_header(cells: DataFrame, label: str) -> DataFrame:
    """Cells under the header of their sheet: the first row that has ``label``, accents aside.

    Gives file, sheet, row_no, header and value; sheets without the label give none.
    """
    text: Column = plain_header(F.col("value"))
    sheet = Window.partitionBy("file", "sheet")
    marked = cells.withColumn("top", F.min(F.when(text == label, F.col("row_no"))).over(sheet)).where("row_no >= top")
    heads = marked.where("row_no = top").select("file", "sheet", "column_no", text.alias("header"))
    return marked.where("row_no > top").join(heads, ["file", "sheet", "column_no"]).select("file", "sheet", "row_no", "header", "value")
