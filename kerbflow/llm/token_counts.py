"""Token counts without tokens: Viterbi that carries the best score and the number of pieces (operator 1)."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import put, ready, text_column
from kerbflow.llm.pieces import load_pieces

MODEL = "piece_bpe_32k.model"


def count_tokens(docs: DataFrame, model_path: str | None = None, text: str = "text", to: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of unigram pieces of each whole text.

    The pieces and scores of the model are read as a unigram vocabulary, whatever it was made for; its path must
    exist on every node. Null and empty texts have 0 tokens. A text of any length is one pass with a window of the longest
    piece. A column named ``to`` in the input is replaced; other columns and repeated rows are kept as they are.
    """
    ready(docs.sparkSession)
    path = model_path or public_tokenizers.path(MODEL)

    def count(texts: list) -> list[int]:
        pieces = load_pieces(path)
        return [pieces.count(t) if t else 0 for t in texts]

    return put(docs, to, text_column(count, "long", pa.int64())(F.col(f"`{text}`")))
