"""Counts of tokens by a vocabulary: the library's model is read once in a worker."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(8)
def _encoder(path: str) -> Callable[[list[str]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts)]
    import tokenizers

    model = tokenizers.Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]


def token_counter(path: str) -> Callable[[Column], Column]:
    """A function that counts the tokens of a text column, without added ones; null for null. path: of a .model or .json file that every worker has."""

    def counts(texts: pd.Series) -> pd.Series:
        there = texts.dropna()
        found = pd.Series(_encoder(path)(there.tolist()), there.index, dtype="int64") if len(there) else pd.Series([], dtype="int64")
        return found.reindex(texts.index).astype("Int64")

    return F.pandas_udf(counts, "bigint")
