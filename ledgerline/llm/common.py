"""Helpers shared by the operators: table access, scratch tables, batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_scratch, scratch_path

#: Character class of the ASCII white space that separates words.
WHITE = r"\x20\x09-\x0D"
WHITE_CHARS = " \t\n\v\f\r"
WORD = rf"[^{WHITE}]+"

#: Rows and bytes of one Arrow batch handed to Python: a batch of very long
#: texts must fit a Python worker beside its working arrays.
BATCH_ROWS = 1000
BATCH_BYTES = 16 * 2**20
#: Characters of a long text that are worked on at once.
PIECE_CHARS = 1 << 18
_SPACE = re.compile(r"\s")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_pieces(text: str, size: int = PIECE_CHARS, most: int | None = None) -> Iterator[str]:
    """``text`` in pieces of at least ``size`` characters but for the last, each
    cut before white space; with ``most``, a piece without any is cut there."""
    begin = 0
    while len(text) - begin > size:
        until = len(text) if most is None else min(len(text), begin + most)
        gap = _SPACE.search(text, begin + size, until)
        end = gap.start() if gap else until
        yield text[begin:end]
        begin = end
    if begin < len(text):
        yield text[begin:]


#: Scratch folders written in the open ``scratch_tables`` blocks, innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the scratch tables that operators write within the block when it
    ends, also by an error.  Results read these tables: write them out, or
    collect them, before.  Blocks may be nested; each removes its own."""
    held: list[str] = []
    _SCOPES.append(held)
    try:
        yield held
    finally:
        _SCOPES.pop()
        for path in held:
            drop_scratch(spark, path)


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, and a lost executor costs no recomputation of what is written."""
    path = scratch_path(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_file`` and ``_index``, which together name a row for as long
    as its file is not written anew.  What is not just a table of files is
    written first."""
    plan = docs._jdf.queryExecution().analyzed().toString().strip().splitlines()
    if len(plan) > 1 or not plan[0].startswith("Relation"):
        docs = staged(docs.sparkSession, docs, "rows")
    return docs.select("*", F.xxhash64("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_index"))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session where it has no bounds of its own."""
    for key, value, default in (
            ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS, "10000"),
            ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES, None)):
        now = spark.conf.get(key, None)
        if now is None or now == default or (default is None and int(now) > BATCH_BYTES):
            spark.conf.set(key, str(value))


def map_rows(df: DataFrame, cols: list[Column], schema: str,
             start: Callable[[], Callable[[list[list]], Iterable[list]]]) -> DataFrame:
    """Run ``start()`` once per task and its result on the columns of each batch.

    ``start`` builds what a task needs (tables, models) and returns a function
    from a list of column values to a list of output columns; rows stay in
    their partition and in order.
    """
    bounded_batches(df.sparkSession)
    out = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            if batch.num_rows:
                made = work([c.to_pylist() for c in batch.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(made, arrow)], schema=arrow)

    return df.select(*cols).mapInArrow(run, out)
