"""Token counts: batch encoding in Arrow functions that return lengths only.

A map over the table without a shuffle. Arrow batches are recut by bytes, so a slice holds
about the same amount of text whatever the rows' lengths; long texts are split at white
space, which no token crosses (see ``tokens``).

Null texts count as empty (0 bytes, 0 tokens); null ids, repeated ids and repeated rows give
a row each; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from playpulse.llm.common import id_and_text, ship_code, slices
from playpulse.llm.tokens import splits_safely, token_lengths

CONTEXT = 2048


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = CONTEXT, id_col: str = "doc_id", text_col: str = "text", by_word: bool | None = None
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``over_limit``: more than ``limit`` tokens.

    ``by_word`` (None: found out by trying): whether the tokenizer may be used word by word.
    """
    by_word = splits_safely(tokenizer) if by_word is None else by_word

    def counted(batches):
        for part in slices(batches, "text"):
            texts = part.column(1)
            n = token_lengths(texts, tokenizer, by_word)
            sizes = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), sizes, pa.array(n.astype(np.int64)), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    ship_code(docs.sparkSession)
    return id_and_text(docs, id_col, text_col).mapInArrow(
        counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
