"""Token counts: Arrow batches balanced by bytes go through the tokenizer, and only lengths come back.

Null text counts as empty (0 tokens). Repeated rows give repeated results, an empty table gives none, and further columns
of the input are kept out of the result, so that they cannot clash with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .encoding import as_batch, encoder
from .textops import by_bytes, text_bytes

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, unit: str = "lead") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs(doc_id, text).

    vocabulary: a tokenizers .json file, readable on every worker; unit: see encoding. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            buf, at = text_bytes(batch.column(1))
            n = encoder(vocabulary, unit).counts(buf, at)
            yield as_batch({"doc_id": batch.column(0), "n_bytes": np.diff(at), "n_tokens": n, "over_limit": n > limit}, _OUT)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
