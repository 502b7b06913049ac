"""Token counts of whole texts by rank-synchronous BPE (see ``bpe``).

Null texts count as empty.  Every row of the input gives one row; repeated rows
repeat.  Special strings inside a text are one token each, as the tokenizers
library has it by default.  A very long text is one slice; an empty table gives
no rows; other columns, whatever they are called, are not read.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from florilege.llm.bpe import encoder
from florilege.llm.words import map_slices


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of each row.

    ``vocabulary`` is a byte-level BPE file of the tokenizers library, by a path
    that every worker has; ``pattern`` its pre-token pattern.
    """

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(1)
        n = encoder(vocabulary, pattern).count(texts.to_pylist())
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        return pa.RecordBatch.from_arrays(
            [part.column(0), size, pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"]
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(docs, [id_col, text_col], text_col, count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
