"""Token counts of whole texts, by batches of even size.

A text is cut where no piece can reach across, long texts into parts, and parts are
encoded in batches of about as many bytes each. Only lengths leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import bounded, filled
from tripweave.llm.vocab import default_path, safe_parts, sentence_pieces

BATCH = 1 << 18  # bytes encoded at once
PART = 1 << 16  # characters after which a text is cut at the next safe place


def _even_batches(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[list[int], list[str]]]:
    rows, parts, size = [], [], 0
    for row, part in texts:
        rows.append(row)
        parts.append(part)
        size += len(part) if part.isascii() else len(part.encode())
        if size >= BATCH:
            yield rows, parts
            rows, parts, size = [], [], 0
    if parts:
        yield rows, parts


def token_counter(path: str):
    """An Arrow function from texts to numbers of tokens under the sentence-piece model at ``path``."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        model, cuttable = sentence_pieces(path)

        def parts() -> Iterator[tuple[int, str]]:
            for row, text in enumerate(texts):
                text = text.as_py() or ""
                if not cuttable or len(text) <= PART:
                    yield row, text
                    continue
                for nth, part in enumerate(safe_parts(text, PART)):
                    # The model writes a space before each text it is given, in place of the one cut at.
                    yield row, part[1:] if nth else part

        total = np.zeros(len(texts), np.int64)
        for rows, batch in _even_batches(parts()):
            lengths = [len(ids) for ids in model.encode(batch, num_threads=1)]
            np.add.at(total, rows, lengths)
        return pa.array(total)

    return count


def with_token_counts(docs: DataFrame, path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    Null texts count as empty: no bytes and no tokens. Other columns pass through and rows
    are never merged, so repeated rows give repeated results; an empty table gives an empty one.
    Columns of the three names are replaced.
    """
    counted = bounded(docs).withColumn("n_tokens", token_counter(path)(filled(text)))
    return counted.withColumns({"n_bytes": F.octet_length(filled(text)).cast("long"), "over_limit": F.col("n_tokens") > limit})


def op9_token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    counted = with_token_counts(docs.select("doc_id", "text"), path or default_path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")
