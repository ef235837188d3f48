"""Token ids of whole texts, as Arrow batches (used by packing, counting and the id files)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import library_codes, text_slices


def id_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def encoded_slices(batch: pa.RecordBatch, path: str, ids: bool = True) -> Iterator[tuple[pa.Array, np.ndarray | None, np.ndarray]]:
    """For consecutive rows of a batch of (id, text): their ids' column, all token ids, and the number of each row."""
    codes = library_codes(path)
    for piece in text_slices(batch.column(1)):
        tokens, counts = codes.slice_ids(piece, ids)
        yield batch.column(0).slice(piece.first, len(piece)), tokens, counts


def token_lengths(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", extra: int = 0) -> DataFrame:
    """One row per document: its id and ``n_tokens``, its encoded length plus ``extra``; a null text counts as empty."""

    def lengths(batches):
        for batch in batches:
            for keys, _, counts in encoded_slices(batch, path, ids=False):
                yield pa.RecordBatch.from_arrays([keys, pa.array(counts + extra)], ["id", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lengths, f"id {id_type(docs, id_col)}, n_tokens long")
