"""Token counts of whole texts: batch encoding inside Arrow functions that give back lengths only.

A text longer than ``SEGMENT`` characters is cut where no piece of the vocabulary holds both neighbours. A merge can
only give a piece of the vocabulary, so none ever crosses such a place and the counts of the parts add up to the count
of the whole. A part that doesn't begin its text is encoded behind a line feed: neither the prefix mark nor the line
feed can merge with it, and both are subtracted again. Encoder calls are filled by bytes, not by rows.

Nulls and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows are counted one by one; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.blocks import blocks

SEGMENT = 4096
CALL_BYTES = 256 << 10
LIMIT = 4096
MARK = "▁"


@functools.cache
def processor(path: str):
    """The encoder, and the neighbours that stand together in some piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    text = [p for i, p in enumerate(pieces) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    joined = {a + b for p in text for a, b in zip(p, p[1:])}
    if any("\n" in p for p in text) or len(model.encode("\n")) != 2:
        raise ValueError("the vocabulary joins line feeds to other text; texts can't be cut")
    return model, joined


def cut(text: str, joined: set[str], size: int = SEGMENT) -> Iterator[str]:
    """Parts of about ``size`` characters; all but the first begin with the line feed to be subtracted."""
    begin, lead = 0, ""
    while len(text) - begin > size:
        at = begin + size
        while at > begin and (text[at - 1] + text[at]).replace(" ", MARK) in joined:
            at -= 1
        if at == begin:  # a run that can't be cut: on to its end
            at = begin + size
            while at < len(text) and (text[at - 1] + text[at]).replace(" ", MARK) in joined:
                at += 1
        if at == len(text):
            break
        yield lead + text[begin:at]
        begin, lead = at, "\n"
    yield lead + text[begin:]


def counts(texts: list[str], path: str, segment: int = SEGMENT) -> list[int]:
    """Tokens of each text."""
    model, joined = processor(path)
    out, parts, owners, size = [0] * len(texts), [], [], 0

    def encode():
        for owner, part, ids in zip(owners, parts, model.encode(parts, num_threads=1)):
            out[owner] += len(ids)
        parts.clear()
        owners.clear()

    for owner, text in enumerate(texts):
        for k, part in enumerate(cut(text, joined, segment)):
            out[owner] -= 2 * (k > 0)
            parts.append(part)
            owners.append(owner)
            size += len(part)
            if size >= CALL_BYTES:
                encode()
                size = 0
    encode()
    return out


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, segment: int = SEGMENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row; ``model`` is the vocabulary's path on every machine."""

    def count(batches):
        for batch in batches:
            for part in blocks(batch):
                text = pc.fill_null(part.column(1), "")
                n = np.asarray(counts(text.to_pylist(), model, segment), np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pc.binary_length(text).cast(pa.int64()), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
