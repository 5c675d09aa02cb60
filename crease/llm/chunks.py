"""Arrow batches of texts, cut into pieces of bounded size for vectorised work."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: A piece ends with the text that brings it to so many bytes; a longer text is a piece alone.
CHUNK_BYTES = 1 << 21


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in pieces of about ``limit`` bytes of text."""
    for batch in batches:
        start, size = 0, 0
        for i, n in enumerate(pc.binary_length(batch[text]).to_pylist()):
            size += n or 0
            if size >= limit:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def map_chunks(df: DataFrame, work: Callable[[pa.RecordBatch], dict], carry: list[str],
               schema: str, text: str = "text") -> DataFrame:
    """Columns ``carry`` of each row, untouched, and those that ``work`` returns for a piece.

    ``schema`` names the new columns; one row comes out per row, in order."""
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carry).schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, text):
            found = work(piece)
            names = [*carry, *found]
            arrays = [piece[c] for c in carry]
            yield pa.RecordBatch.from_arrays(
                arrays + [a if isinstance(a, pa.Array) else pa.array(a) for a in found.values()], names)

    return df.mapInArrow(task, f"{out}, {schema}" if carry else schema)
