"""Embeddings of document texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.config import EngineConfig

Encoder = Callable[[list[str]], list[list[float]]]


def hashed_embedding(documents: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Unit-length hashed term counts: deterministic, lexical, no model needed.

    A word's bucket is the number in the first eight hex digits of its MD5 digest,
    modulo the vector size, so that any other system can compute the same vectors.
    """
    words = F.array_remove(F.split(F.lower("semantic_text"), r"\s+"), "")
    bucket = lambda word: F.pmod(
        F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint"), F.lit(cfg.vector_size)
    )
    numbered = documents.withColumn("_buckets", F.transform(words, bucket).cast("array<string>"))
    counts = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(cfg.vector_size)], "_buckets", "_counts"
    ).transform(numbered)
    unit = Normalizer(inputCol="_counts", outputCol="_unit").transform(counts)
    return unit.withColumn("embedding", vector_to_array("_unit", "float32")).drop(
        "_buckets", "_counts", "_unit"
    )


#: The model of this Python worker and the call it was loaded for.
_loaded: dict[str, Encoder] = {}


def loaded_once(token: str, load_encoder: Callable[[], Encoder]) -> Encoder:
    """The model, loaded when the worker first needs it; tasks that follow there share it."""
    if token not in _loaded:
        _loaded.clear()
        _loaded[token] = load_encoder()
    return _loaded[token]


def embed_documents(
    documents: DataFrame, cfg: EngineConfig, load_encoder: Callable[[], Encoder] | None = None
) -> DataFrame:
    """Add ``embedding``. ``load_encoder`` returns the model; it gets ``embed_batch`` texts at a time."""
    if load_encoder is None:
        return hashed_embedding(documents, cfg)
    token, size = uuid.uuid4().hex, cfg.embed_batch

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = loaded_once(token, load_encoder)
        for batch in batches:
            texts = batch.tolist()
            parts = (encoder(texts[i : i + size]) for i in range(0, len(texts), size))
            yield pd.Series([vector for part in parts for vector in part], dtype=object)

    return documents.withColumn("embedding", encode("semantic_text"))
