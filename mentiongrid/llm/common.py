"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A word is a longest run of characters that are neither blank, tab, line feed, VT, FF nor CR.
WORD = r"[^\x20\x09-\x0D]+"
#: The characters that end a word.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> list[Column]:
    """`doc_id` and a hash of the text: rows that agree in both are treated alike."""
    return [F.col("doc_id"), F.xxhash64(*columns).alias("text_hash")]


def annotate(
    df: DataFrame,
    keep: Sequence[str],
    inputs: Sequence[str],
    work: Callable[..., Iterable[tuple]],
    result: str,
) -> DataFrame:
    """One row per row of `df`: the columns `keep` in a struct `row`, and computed columns.

    `work(*columns)` gets the `inputs` of one Arrow batch as iterators of Python values
    and gives one tuple of `result` (a DDL string) per row. Kept columns travel as Arrow data
    and never become Python objects, whatever their names and types are.
    """
    more = [c for c in inputs if c not in keep]
    source = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in more], F.lit(0).alias("_")).alias("more"),
    )
    schema = StructType([source.schema["row"], *StructType.fromDDL(result).fields])
    kept, names = list(keep), [f.name for f in schema.fields]
    kinds = _arrow_types(result)

    def values(array: pa.Array, start: int, stop: int) -> Iterator:
        for i in range(start, stop):
            yield array[i].as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, rest = batch.column(0), batch.column(1)
            arrays = [row.field(c) if c in kept else rest.field(c) for c in inputs]
            # Small slices bound what the results of one batch occupy.
            for start in range(0, batch.num_rows, 2048):
                stop = min(start + 2048, batch.num_rows)
                columns = list(zip(*work(*(values(a, start, stop) for a in arrays)), strict=True))
                done = [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([row.slice(start, stop - start), *done], names)

    return source.mapInArrow(run, schema)


def _arrow_types(ddl: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in StructType.fromDDL(ddl).fields]
