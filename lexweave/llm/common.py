"""Helpers shared by the training-data operators: table access, shared scratch tables, row conventions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch, shared_dir

__all__ = ["LAST", "SPACE", "Scratch", "add_columns", "doc_key", "fresh", "held_out", "join_counted", "shared_dir", "steps", "table", "without_lines", "word_count"]

#: Characters between words where a contract speaks of `[^\x20\x09-\x0D]+`.
SPACE = r"\x20\x09-\x0D"


#: Key of documents without an integer id; it sorts after all others.
LAST = (1 << 63) - 1


def doc_key(doc_id: str = "doc_id") -> Column:
    """doc_id as a number; LAST for null and for ids that are no integers, such rows are told apart by their text."""
    return F.coalesce(F.col(doc_id).try_cast("long"), F.lit(LAST))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of the documents that no model may learn from; null ids are never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: A key with more than one row in HOT_PART is hot, so there are fewer than HOT_PART hot keys.
HOT_PART = 1000


def join_counted(many: DataFrame, one: DataFrame, key: str, n: str) -> DataFrame:
    """Inner join on key of many rows a key with one row a key, whose column n is the key's number of rows in many.

    Rows of hot keys meet a broadcast list of under HOT_PART rows and are not shuffled, so none of them makes a large task.
    n is dropped. Both sides are read twice: give tables.
    """
    inner = f"_{key}_of_one"
    limit = many.count() // HOT_PART
    one = one.withColumnRenamed(key, inner)
    hot, rest = one.filter(F.col(n) > limit), one.filter(F.col(n) <= limit)
    met = many.join(F.broadcast(hot), F.col(key) == F.col(inner))
    others = many.join(F.broadcast(hot.select(inner)), F.col(key) == F.col(inner), "left_anti").join(rest, F.col(key) == F.col(inner))
    return met.unionByName(others).drop(inner, n)


def word_count(text: str | Column) -> Column:
    """Number of maximal runs without ASCII white space, evaluated in the JVM; 0 for null."""
    col = F.col(text) if isinstance(text, str) else text
    flat = F.trim(F.translate(col, "\t\n\x0b\x0c\r", "     "))
    return F.when(flat.isNull() | (flat == ""), F.lit(0)).otherwise(F.size(F.split(flat, " +"))).cast("long")


def without_lines(text: str, gone: str) -> Column:
    """The column text without the lines whose numbers (from 0, sorted, once each) the column gone lists.

    Linear in the lines: each number contributes the gap before it and itself to one flag a line.
    """
    before = lambda j: F.when(j == 0, -1).otherwise(F.get(gone, j - 1))
    flags = F.flatten(F.transform(gone, lambda x, j: F.concat(F.array_repeat(F.lit(False), x - before(j) - 1), F.array(F.lit(True)))))
    both = F.arrays_zip(F.split(text, "\n", -1).alias("s"), flags.alias("gone"))
    left = F.transform(F.filter(both, lambda z: ~F.coalesce(z["gone"], F.lit(False))), lambda z: z["s"])
    return F.array_join(left, "\n")


#: Rows and bytes of text that one step of an Arrow function holds as Python objects; a longer text makes a step of its own.
STEP_ROWS = 512
STEP_BYTES = 4 << 20


def steps(batches, *texts: str):
    """Arrow batches cut into smaller ones by rows and by the bytes of the named string columns.

    Spark cuts its batches by bytes as well (spark.sql.execution.arrow.maxBytesPerBatch), so a batch is never much larger
    than its longest row.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            yield batch
            continue
        sizes = np.zeros(batch.num_rows, np.int64)
        for c in texts:
            sizes += pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(c))), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = min(max(at + 1, int(np.searchsorted(ends, before + STEP_BYTES, "right"))), at + STEP_ROWS, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to the given ones that df does not have."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = f"_{n}"
        have.add(n.lower())
        out.append(n)
    return out


def add_columns(df: DataFrame, inputs: list[str], fields: str, fn) -> DataFrame:
    """df with columns computed in Arrow batches: fn takes the input columns as lists and returns one list per field.

    All other columns pass through untouched, nulls and integer width included. fields is DDL ("a long, b string");
    a name that df already has is not allowed (see fresh()).
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType(df.schema.fields + StructType.fromDDL(fields).fields)
    types = to_arrow_schema(StructType.fromDDL(fields)).types
    out_names = schema.names
    texts = [f.name for f in df.schema if f.name in inputs and f.dataType.simpleString() in ("string", "binary")]

    def run(batches):
        for batch in steps(batches, *texts):
            made = fn(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in inputs])
            arrays = [pa.array(v, type=t) for v, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=out_names)

    return df.mapInArrow(run, schema)
