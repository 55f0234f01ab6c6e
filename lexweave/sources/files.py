"""Other inputs: interlingual-index TSVs, JSON logs and maps, source lists, annotated-gloss corpora."""

from __future__ import annotations

import glob
import os
import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import collapse_space, origin_parts, pos_of_origin

INDEX_SCHEMA = "ili_id string, status string, superseded_by string, origin string, definition string"


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(path)


def index_table(definitions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Definitions (ili_id, definition) joined with the map (ili_id, origin_id) on the interlingual id."""
    joined = definitions.join(mapping, "ili_id")
    return joined.select("ili_id", F.lit("1").alias("status"), F.lit("").alias("superseded_by"), F.concat(F.lit("pwn-3.0:"), "origin_id").alias("origin"), "definition")


def index_concepts(index: DataFrame) -> DataFrame:
    """Concepts and glosses of the index; an empty definition or a strange origin is an error when it is read."""
    text = collapse_space(F.col("definition"))
    whole = F.when(F.coalesce(text, F.lit("")) != "", text).otherwise(F.raise_error(F.concat(F.lit("empty definition: "), F.col("ili_id"))).cast("string"))
    part = origin_parts(F.col("origin"))
    return index.select(
        F.concat(F.lit("cili."), "ili_id").alias("concept_id"), pos_of_origin(F.col("origin")).alias("pos"), F.col("status").cast("int").alias("status"),
        F.nullif(F.col("superseded_by"), F.lit("")).alias("superseded_by"), whole.alias("gloss"), part["version"].alias("version"), part["id"].alias("original_id"),
    )


def empty_definitions(index: DataFrame, most: int = 20) -> DataFrame:
    """The first ids without a definition, to report before the build stops."""
    return index.filter(F.trim(F.coalesce("definition", F.lit(""))) == "").select("ili_id").orderBy("ili_id").limit(most)


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def pictogram_map(spark: SparkSession, path: str) -> DataFrame:
    """(ili, position, lemma, ids) of a document {ili: {lemma: [id, ...]}}, lemmas in document order."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,array<bigint>>>").alias("m"))
    per = whole.select(F.explode("m").alias("ili", "lemmas"))
    return per.select("ili", F.posexplode(F.map_entries("lemmas")).alias("position", "e")).select("ili", "position", F.col("e.key").alias("lemma"), F.col("e.value").alias("ids"))


def sources_config(path: str) -> dict[str, list[str]]:
    """Language -> addresses, from a TOML file."""
    with open(path, "rb") as f:
        raw = tomllib.load(f)
    return {k: [v] if isinstance(v, str) else list(v) for k, v in raw.items() if isinstance(v, (str, list))}


def discover(root: str, first: str = "oewn") -> list[str]:
    """XML files in root or its folders, each base name once, sorted, those that start with first ahead."""
    found: dict[str, str] = {}
    for pattern in ("*.xml", "*.xml.gz", "*.xml.xz"):
        for path in sorted(glob.glob(f"{root}/**/{pattern}", recursive=True)):
            found.setdefault(os.path.basename(path).split(".xml")[0], path)
    return [p for _, p in sorted(found.items(), key=lambda x: (not x[0].startswith(first), x[0]))]


def merge_order(paths: list[str], first: tuple[str, ...] = ("cili", "oewn")) -> list[str]:
    """Priority order of a merge: index files, then the reference wordnet, then the rest by name."""
    rank = lambda p: next((k for k, f in enumerate(first) if os.path.basename(p).startswith(f)), len(first))
    return sorted(paths, key=lambda p: (rank(p), os.path.basename(p)))


def gloss_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(synset, ord, text, sense) of the tokens of annotated glosses: elements synset/gloss with wf and cf tokens."""
    whole = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):
        import io
        from xml.etree import ElementTree

        import pyarrow as pa

        from .xml import local_name, unpack

        for batch in batches:
            out = []
            for data in batch.column(0):
                for _, elem in ElementTree.iterparse(io.BytesIO(unpack(data.as_buffer().to_pybytes()))):
                    if local_name(elem.tag) != "synset":
                        continue
                    n = 0
                    for token in elem.iter():
                        if local_name(token.tag) not in ("wf", "cf"):
                            continue
                        ids = [x for x in token.iter() if local_name(x.tag) == "id"]
                        words = "".join(t for x in [token.text, *(y.tail for y in token)] if x for t in x).strip()
                        if words:
                            out.append((elem.get("id") or f"{elem.get('ofs')}-{elem.get('pos')}", n, words, ids[0].get("sk") if ids else None))
                            n += 1
                    elem.clear()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))], names=["synset", "ord", "text", "sense"])

    return whole.mapInArrow(run, "synset string, ord int, text string, sense string")


def align_tokens(text: str, tokens: list[str], at: int = 0) -> list[tuple[int, int]] | None:
    """Where each token lies in text from at on, one after the other; None if they do not fit in this order."""
    out = []
    for token in tokens:
        k = text.find(token, at)
        if k < 0 or text[at:k].strip(" \t\n\"'`()[],.;:-") != "":
            return None
        out.append((k, k + len(token)))
        at = k + len(token)
    return out


def align_sentences(text: str, sentences: list[list[tuple[str, str | None]]]) -> list[tuple[int, int, str]] | None:
    """Spans of the tokens that name a sense, for the first order of the sentences that fits the text; adjacent tokens of
    one sense make one span. A sentence is placed only where it fits, and a state that failed is not tried again."""
    failed: set[tuple[frozenset[int], int]] = set()

    def place(left: frozenset[int], at: int) -> list[tuple[int, list[tuple[int, int]]]] | None:
        if not left:
            return []
        if (left, at) in failed:
            return None
        for k in sorted(left):
            places = align_tokens(text, [t for t, _ in sentences[k]], at)
            if places is not None:
                rest = place(left - {k}, places[-1][1] if places else at)
                if rest is not None:
                    return [(k, places), *rest]
        failed.add((left, at))
        return None

    found = place(frozenset(range(len(sentences))), 0)
    if found is None:
        return None
    tokens = [t for k, _ in found for t in sentences[k]]
    spans: list[tuple[int, int, str]] = []
    for (a, b), (_, sense), before in zip([x for _, p in found for x in p], tokens, [None, *[s for _, s in tokens]]):
        if not sense:
            continue
        if spans and sense == before and spans[-1][2] == sense:
            spans[-1] = (spans[-1][0], b, sense)
        else:
            spans.append((a, b, sense))
    return spans


def gloss_errors(text: str, spans: list[tuple[int, int, str | None]], known: set[str] | None = None) -> list[str]:
    """What is wrong with an annotated gloss: order, overlap, bounds, empty spans, missing or unknown senses."""
    out, last = [], 0
    for k, (a, b, sense) in enumerate(spans):
        if not 0 <= a < b <= len(text):
            out.append(f"span {k} [{a}, {b}) is empty or outside the text")
        elif a < last:
            out.append(f"span {k} starts at {a}, before {last}")
        elif text[a:b] != text[a:b].strip():
            out.append(f"span {k} begins or ends with white space")
        if not sense:
            out.append(f"span {k} names no sense")
        elif known is not None and sense not in known:
            out.append(f"span {k} names the unknown sense {sense}")
        last = max(last, b)
    return out


def offset_to_key(offsets: DataFrame, mapping: DataFrame) -> DataFrame:
    """(synset, offset, pos) with the source id offset8-pos; mapping (name, offset, pos) names what has no number."""
    from ..functions.text import offset_id

    joined = offsets.join(mapping.withColumnRenamed("name", "synset"), "synset", "left")
    return joined.select("synset", offset_id(F.col("offset"), F.col("pos")).alias("source_id"))
