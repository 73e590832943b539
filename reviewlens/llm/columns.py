"""Helpers shared by the operators: words, free column names, rows in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII lower case and nothing else, on UTF-8 bytes.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes over all columns: rows with equal values in every column share them."""
    values = [F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in df.columns]
    return F.xxhash64(*values), F.xxhash64(F.lit(7), *values)


def map_texts(
    df: DataFrame, keep: list[str], inputs: list[str], schema: str, make: Callable[[], Callable[..., list]]
) -> DataFrame:
    """``keep`` as it is, and the columns of ``schema`` computed from the ``inputs`` of each batch.

    ``make`` runs once in each task and returns a function from one list for each input to a
    list of columns, in the order of ``schema``.
    """
    kept = df.select(*(F.col(f"`{c}`") for c in keep))
    added = T.StructType.fromDDL(schema)
    out = T.StructType([*kept.schema, *added])
    names, kinds, n = out.names, [to_arrow_type(f.dataType) for f in added], len(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            columns = function(*(c.to_pylist() for c in batch.columns[n:]))
            arrays = [pa.array(x, t) for x, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *arrays], names=names)

    given = [F.col(f"`{c}`").alias(f"{free_name(df, 'llm_input')}{i}") for i, c in enumerate(inputs)]
    return df.select(*(F.col(f"`{c}`") for c in keep), *given).mapInArrow(run, out)
