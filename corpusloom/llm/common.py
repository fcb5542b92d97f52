"""Helpers shared by the operators: Arrow slices, documents' columns, tables in the shared folder."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from corpusloom.session import scratch_path

SLICE_BYTES = 5_000_000
TEXT = "text"


def kept(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written compactly to the shared folder and read back; cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], column: str = TEXT, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batches with about ``limit`` bytes of text each; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(low, high - low)


def strings(column: pa.Array) -> list[str]:
    """The texts of a column; null is the empty text."""
    return ["" if text is None else text for text in column.to_pylist()]


def text_key(text="text"):
    """128 bits that stand for a whole text; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")))


def mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def free_name(columns: Iterable[str], name: str) -> str:
    """The name, with as many marks after it as make it differ from all columns in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
