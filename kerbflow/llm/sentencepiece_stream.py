"""SentencePiece encoding and decoding by a streaming Viterbi (operator 6)."""

from __future__ import annotations

from array import array

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import SLICE, put, ready
from kerbflow.llm.pieces import SPACE, load_pieces
from kerbflow.llm.token_counts import MODEL


def encode_pieces(docs: DataFrame, model_path: str | None = None, text: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of each whole text.

    Null and empty texts give an empty list. Texts of any length are encoded in a window that is
    emptied whenever all surviving paths meet. A column named ``to`` is replaced; other columns and repeated rows stay.
    """
    ready(docs.sparkSession)
    path = model_path or public_tokenizers.path(MODEL)

    def run(texts: pa.Array) -> pa.Array:
        pieces = load_pieces(path)
        parts, ends = [], [0]
        for at in range(0, len(texts), SLICE):
            for value in texts.slice(at, SLICE).to_pylist():
                parts.append(pieces.encode_bytes(value or ""))
                ends.append(ends[-1] + len(parts[-1]) // 4)
        values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(parts))])
        return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values)

    return put(docs, to, F.arrow_udf(run, "array<int>").asNondeterministic()(F.col(f"`{text}`")))


def encode_checked(
    docs: DataFrame, model_path: str | None = None, text: str = "text", to: str = "ids", check: str = "round_trip"
) -> DataFrame:
    """As ``encode_pieces``, and whether the ids decode to the text (with a space for each marker U+2581).

    Each text is decoded where it was encoded, so neither its ids nor the decoded text travel a second time.
    """
    ready(docs.sparkSession)
    path = model_path or public_tokenizers.path(MODEL)

    def run(texts: pa.Array) -> pa.Array:
        pieces = load_pieces(path)
        parts, ends, whole = [], [0], []
        for at in range(0, len(texts), SLICE):
            for value in texts.slice(at, SLICE).to_pylist():
                value = value or ""
                parts.append(pieces.encode_bytes(value))
                ends.append(ends[-1] + len(parts[-1]) // 4)
                whole.append(pieces.decode(array("i", parts[-1])) == value.replace(SPACE, " "))
        values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(parts))])
        lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values)
        return pa.StructArray.from_arrays([lists, pa.array(whole, type=pa.bool_())], names=["ids", "whole"])

    both = F.arrow_udf(run, "ids array<int>, whole boolean").asNondeterministic()(F.col(f"`{text}`"))
    made = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), both.alias("made"))
    others = [F.col(f"doc.`{c}`") for c in docs.columns if c.lower() not in (to.lower(), check.lower())]
    return made.select(*others, F.col("made.ids").alias(to), F.col("made.whole").alias(check))


def decode_pieces(docs: DataFrame, model_path: str | None = None, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``docs`` with the text of each list of ids; null lists and null ids give nothing, an id outside the model fails.

    The marker U+2581 in a text comes back as a space, since both have one piece; all other texts come back whole.
    """
    ready(docs.sparkSession)
    path = model_path or public_tokenizers.path(MODEL)

    def run(lists: pa.Array) -> pa.Array:
        pieces = load_pieces(path)
        out = [pa.array([], type=pa.string())]
        for at in range(0, len(lists), SLICE):
            found = (value.values for value in lists.slice(at, SLICE))
            texts = [pieces.decode(ids.drop_null().to_numpy().tolist()) if ids is not None else "" for ids in found]
            out.append(pa.array(texts, type=pa.string()))
        return pa.concat_arrays(out)

    return put(docs, to, F.arrow_udf(run, "string").asNondeterministic()(F.col(f"`{ids}`")))
