"""Ordered scans of lexical XML files, plain or compressed, as one row per record element.

Files are listed and read by Spark (`binaryFile`), so they may lie in any store that Spark reads; each is parsed by
streaming in one task. A row carries the resource's ordinal and the element's ordinal in the file: that order is part
of the data model (first arrival wins).
"""

from __future__ import annotations

import gzip
import io
import lzma
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MERGE_TAGS = ("Concept", "Lexeme", "Sense", "Gloss", "Example", "SenseRelation", "ConceptRelation")
SPAN = "struct<start:int,end:int,sense:string>"
SCHEMA = (
    f"resource_ord int, element_ord long, tag string, attrs map<string,string>, root map<string,string>, text string, spans array<{SPAN}>, "
    "children array<struct<path:string,ord:int,parent:int,attrs:map<string,string>,text:string>>"
)


def unpack(data: bytes) -> bytes:
    if data[:2] == b"\x1f\x8b":
        return gzip.decompress(data)
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.decompress(data)
    return data


def local_name(tag: str) -> str:
    return tag.rpartition("}")[2]


def mixed_content(elem) -> tuple[str, list[tuple[int, int, str]]]:
    """Plain text of an annotated sentence, and (start, end, sense) of each child that names a sense; code points."""
    text, spans = elem.text or "", []
    for child in elem:
        inner = child.text or ""
        if child.get("sense"):
            spans.append((len(text), len(text) + len(inner), child.get("sense")))
        text += inner + (child.tail or "")
    return text, spans


def records(data: bytes, tags: tuple[str, ...] = MERGE_TAGS):
    """Yield (ordinal, tag, attributes, root attributes, text, spans, children) of each record, in document order.

    children lists all descendants depth first: path of tags, ordinal, the ordinal of the parent (-1: the record).
    """
    wanted, root, n = set(tags), None, 0
    open_records = 0
    for event, elem in ElementTree.iterparse(io.BytesIO(unpack(data)), ("start", "end")):
        tag = local_name(elem.tag)
        if event == "start":
            if root is None:
                root, top = dict(elem.attrib), elem
            elif tag == "Lexicon":
                root = dict(elem.attrib)
            open_records += tag in wanted
            continue
        if tag not in wanted:
            continue
        open_records -= 1
        text, spans, children = None, [], []

        def walk(parent, path, up):
            nonlocal text, spans
            for child in parent:
                name = local_name(child.tag)
                if name == "AnnotatedSentence":
                    text, spans = mixed_content(child)
                    continue
                at = len(children)
                children.append((f"{path}{name}", at, up, {local_name(k): v for k, v in child.attrib.items()}, "".join(child.itertext()) or None))
                walk(child, f"{path}{name}/", at)

        walk(elem, "", -1)
        yield n, tag, {local_name(k): v for k, v in elem.attrib.items()}, root, text, spans, children
        n += 1
        if not open_records:
            elem.clear()
            if elem is not top and len(top) > 1000:
                del top[:-1]


def _rows(data: bytes, order: int, tags: tuple[str, ...]):
    for n, tag, attrs, root, text, spans, children in records(data, tags):
        yield (order, n, tag, attrs, root, text, [{"start": a, "end": b, "sense": s} for a, b, s in spans], [dict(zip(("path", "ord", "parent", "attrs", "text"), c)) for c in children])


def read(spark: SparkSession, paths: list[str], tags: tuple[str, ...] = MERGE_TAGS) -> DataFrame:
    """Records of the files, whose order in the list is their priority."""
    import json

    order = F.from_json(F.lit(json.dumps({p.rpartition("/")[2]: k for k, p in enumerate(paths)})), "map<string,int>")
    files = spark.read.format("binaryFile").load(list(paths)).select(F.element_at(order, F.element_at(F.split("path", "/"), -1)).alias("ord"), "content")

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for order, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = []
                for row in _rows(data.as_buffer().to_pybytes(), order, tags):
                    held.append(row)
                    if len(held) == 2000:
                        yield pa.RecordBatch.from_arrays([pa.array([list(r[i].items()) if i in (3, 4) else r[i] for r in held], schema.types[i]) if i < 7 else _children(held, schema.types[i]) for i in range(8)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([list(r[i].items()) if i in (3, 4) else r[i] for r in held], schema.types[i]) if i < 7 else _children(held, schema.types[i]) for i in range(8)], schema=schema)

    return files.repartition(max(1, len(paths)), "ord").mapInArrow(run, SCHEMA)


def _children(rows, kind):
    import pyarrow as pa

    return pa.array([[c | {"attrs": list(c["attrs"].items())} for c in r[7]] for r in rows], kind)


class LexicalXml(DataSource):
    """`spark.read.format("lexxml").option("paths", "a.xml,b.xml.gz").load()`: the same rows for files on shared disks."""

    @classmethod
    def name(cls) -> str:
        return "lexxml"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        given = options.get("paths") or options.get("path") or ""
        self.paths = [p for p in given.split(",") if p]
        self.tags = tuple(t for t in options.get("tags", "").split(",") if t) or MERGE_TAGS

    def partitions(self):
        return [InputPartition(k) for k in range(len(self.paths))]

    def read(self, partition):
        with open(self.paths[partition.value], "rb") as f:
            data = f.read()
        yield from _rows(data, partition.value, self.tags)
