"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams per language on Spark; the log-probability matrix, whose size
is fixed by the number of buckets and languages, is broadcast; each task scores its texts in
numpy by adding the matrix rows of a text's n-grams.

Defined results: a null text, and a text without any letter, is `und` with score 0. Ties go
to the language that sorts first. Rows are never dropped, repeated rows are scored alike,
and input columns are kept. A training table without usable rows gives a model that answers
`und` for everything. A language held by few texts is learned from these few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.llm.common import giving_back, text_batches

UNKNOWN = "und"
SIZES = (1, 2, 3)
#: Code points that a task scores at once.
BATCH_CHARS = 1 << 18
#: Texts of a language that training takes at least, about, if there are as many.
LEAST_TEXTS = 50


@dataclass
class LanguageModel:
    languages: list[str] = field(default_factory=list)
    #: log P(bucket | language): one row per bucket
    matrix: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    #: log P(language)
    prior: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bits: int = 16


def gram_buckets(codes: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Bucket of the `size` code points from each place on."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    value = np.full(n, size, np.uint64)
    for k in range(size):
        value = (value ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return (value >> np.uint64(64 - bits)).astype(np.int64)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, a space before and after each, and the starts."""
    lowered = [f" {text.lower()} " for text in texts]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
    return np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), starts


def _text_groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= BATCH_CHARS or i == len(texts) - 1:
            yield start, [t or "" for t in texts[start : i + 1]]
            start, size = i + 1, 0


def train(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = 16,
          max_docs: int = 20_000, seed: int = 7, smoothing: float = 0.1) -> LanguageModel:
    """Fit on about `max_docs` distinct labelled texts, those whose hashes are lowest.

    The bound is part of the interface: it keeps the training cost the same at every size. Each
    language has an equal share of it, and `LEAST_TEXTS` at least, so that none is lost to a more
    frequent one; a language with fewer texts is learned from all of them. The part of the hash
    range that holds so many follows from the approximate number of distinct texts of the
    language, so that every task picks its own rows and copies weigh nothing. The prior is the
    language's part of all distinct texts. Counting runs in tasks; what reaches the driver is one
    row per language, and one per language and filled bucket, at most 2**bits times the languages.
    """
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(text), F.lit(seed)).alias("at")
    )
    texts_of = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.approx_count_distinct("at").alias("n")).collect()}
    if not texts_of:
        return LanguageModel(bits=bits)
    quota = max(max_docs / len(texts_of), LEAST_TEXTS)
    share = F.create_map(*(F.lit(x) for name, n in texts_of.items() for x in (name, min(1.0, quota / max(1, n)))))
    rows = labelled.where(F.col("at") / 2.0**64 + 0.5 <= F.element_at(share, F.col("lang")))
    rows = rows.dropDuplicates(["text", "lang"]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for start, texts in _text_groups(batch.column(0).to_pylist()):
                codes, starts = code_points(texts)
                mine = langs[start : start + len(texts)]
                text_of = np.repeat(np.arange(len(texts)), np.diff(starts))
                place = {name: i for i, name in enumerate(sorted(set(mine)))}
                lang_of = np.array([place[name] for name in mine])[text_of]
                for size in SIZES:
                    at = gram_buckets(codes, size, bits)
                    whole = text_of[: len(at)] == text_of[size - 1 : size - 1 + len(at)]
                    for name, i in place.items():
                        counts = np.bincount(at[whole & (lang_of[: len(at)] == i)], minlength=1 << bits)
                        sums[name] = sums.get(name, 0) + counts
        for name, total in sums.items():
            filled = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(filled), pa.string()),
                "bucket": pa.array(filled, pa.int32()),
                "n": pa.array(total[filled], pa.int64()),
            })

    counted = rows.mapInArrow(giving_back(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    ).toArrow().to_pydict()
    languages = sorted(set(counted["lang"]))
    if not languages:
        return LanguageModel(bits=bits)
    place = {name: i for i, name in enumerate(languages)}
    totals = np.zeros((1 << bits, len(languages)))
    for name, bucket, n in zip(counted["lang"], counted["bucket"], counted["n"], strict=True):
        totals[bucket, place[name]] += n
    known = np.array([max(1, texts_of[name]) for name in languages], float)
    smooth = totals + smoothing
    return LanguageModel(languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float32),
                         np.log(known / known.sum()), bits)


def score_texts(model: LanguageModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Best language's number and its posterior probability, for each text."""
    codes, starts = code_points(texts)
    sums = np.tile(model.prior, (len(texts), 1))
    for size in SIZES:
        at = gram_buckets(codes, size, model.bits)
        text_of = np.repeat(np.arange(len(texts)), np.diff(starts))
        same = text_of[: len(at)] == text_of[size - 1 : size - 1 + len(at)]
        filled = starts[:-1][np.diff(starts) >= size]
        owner = np.flatnonzero(np.diff(starts) >= size)
        for j in range(len(model.languages)):
            values = np.where(same, model.matrix[:, j][at], np.float32(0)).astype(np.float64)
            if len(filled):
                sums[owner, j] += np.add.reduceat(values, filled)
    best = sums.argmax(axis=1)
    shifted = np.exp(sums - sums.max(axis=1, keepdims=True))
    return best, (shifted / shifted.sum(axis=1, keepdims=True)).max(axis=1)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """`docs` with the predicted language and its probability, for every whole text."""
    predicted, score = names
    clash = {predicted.lower(), score.lower()} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already; give other names")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(predicted, T.StringType()), T.StructField(score, T.DoubleType())])

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, raw in text_batches(batch, text):
                langs: list[str] = []
                scores: list[float] = []
                for _, texts in _text_groups([t.decode() for t in raw]):
                    known = [bool(model.languages) and any(map(str.isalpha, t)) for t in texts]
                    if model.languages:
                        best, sure = score_texts(model, texts)
                    for i, ok in enumerate(known):
                        langs.append(model.languages[best[i]] if ok else UNKNOWN)
                        scores.append(float(sure[i]) if ok else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names, predicted, score],
                )

    return docs.mapInArrow(giving_back(tag), schema)


def held_out(doc_id: Column) -> Column:
    """Rows kept away from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))

