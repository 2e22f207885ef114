"""Token counts by section: whole texts are encoded once, tokens attributed by their place.

A section's own encoding would differ at its edges, so each text is encoded whole. A token's
bytes give its span in the text; spans are joined to sections by interval, in the task that
holds the text, on sorted bounds. Tokens that cross a boundary are allocated by rule:

* `first`: to the section that holds the character in which the token's first byte lies;
* `shared`: by the share of the token's bytes that each section holds.

Tokens, or shares, outside all sections form one row with a null section. The counts of a text
add up to its number of tokens if its sections do not overlap.

Without a sections column the sections are the lines, each with its line end. Defined results:
a null or empty text has one empty line and no tokens; an empty section has no tokens; repeated
rows are counted alike; a null list of sections gives the null section alone; sections are cut
at the ends of the text; of overlapping ones each gets its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracemill.llm.tokens import TokenEncoder, default_path

RULES = ("first", "shared")


def line_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines of a text, each with its line end."""
    ends = np.flatnonzero(raw == 10) + 1
    if not len(ends) or ends[-1] < len(raw):
        ends = np.append(ends, len(raw))
    return np.concatenate([[0], ends[:-1]]), ends


def attribute(ends: np.ndarray, starts: np.ndarray, low: np.ndarray, high: np.ndarray, lead: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Tokens of each section [low, high), and of none. Tokens are bytes [starts, ends);
    `lead` is the byte where the character of a token's first byte begins."""
    if rule == "first":
        counts = np.searchsorted(lead, high) - np.searchsorted(lead, low)
        counts = np.maximum(counts, 0).astype(float)
    else:
        size = (ends - starts).astype(float)
        until = np.concatenate([[0.0], np.cumsum(np.ones(len(ends)))])

        def tokens_before(at: np.ndarray) -> np.ndarray:
            k = np.searchsorted(ends, at)
            inner = np.minimum(k, len(ends) - 1)
            part = np.clip((at - starts[inner]) / size[inner], 0, 1) if len(ends) else np.zeros(len(at))
            return until[k] + np.where(k < len(ends), part, 0.0)

        counts = np.maximum(tokens_before(high) - tokens_before(low), 0)
    # What no section holds: the gaps of the sections' union.
    order = np.argsort(low, kind="stable")
    reach = np.maximum.accumulate(high[order]) if len(order) else high
    gap_low, gap_high = np.concatenate([[0], reach]), np.concatenate([low[order], [ends[-1] if len(ends) else 0]])
    gaps = gap_high > gap_low
    if not gaps.any():
        return counts, 0.0
    if rule == "first":
        outside = (np.searchsorted(lead, gap_high[gaps]) - np.searchsorted(lead, gap_low[gaps])).sum()
    else:
        outside = (tokens_before(gap_high[gaps]) - tokens_before(gap_low[gaps])).sum()
    return counts, float(outside)


def count_tokens(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sections: str | None = None,
                 rule: str = "first", tokenizer: str | None = None, added: bool = False) -> DataFrame:
    """(doc_id, section, start, end, n_tokens): the tokens of each section of each text.

    `sections` names a column of array<struct<start, end>> in characters; `section` is its
    place in the list and start and end are the span in characters. With `added`, added tokens
    in a text are what the library makes of them, not ordinary text.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    path = tokenizer or default_path()
    spans = F.col(sections) if sections else F.lit(None).cast("array<struct<start:int,end:int>>")
    rows = docs.select(
        F.col(doc_id), F.col(text).alias("text"), F.transform(spans, lambda s: F.array(s["start"].cast("long"), s["end"].cast("long"))).alias("spans")
    )
    schema = T.StructType([docs.schema[doc_id]]).add("section", T.IntegerType()).add("start", T.LongType()).add("end", T.LongType()).add("n_tokens", T.DoubleType())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenEncoder.load(path, added)
        for batch in batches:
            row, section, start, end, tokens = [], [], [], [], []
            lists = batch.column(2).to_pylist() if sections else [None] * len(batch)
            for i, (value, given) in enumerate(zip(batch.column(1).to_pylist(), lists, strict=True)):
                value = value or ""
                raw = np.frombuffer(value.encode(), np.uint8)
                ends = np.cumsum(encoder.sizes[np.frombuffer(encoder.encode(value), "<u4")])
                starts = np.concatenate([[0], ends])[: len(ends)]
                plain = len(raw) == len(value)
                begins = None if plain else np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
                lead = starts if plain else begins[np.searchsorted(begins, starts, side="right") - 1]
                if sections is None:
                    low, high = line_bounds(raw)
                else:
                    chars = np.clip(np.array([s for s in given or [] if s is not None and None not in s], np.int64).reshape(-1, 2), 0, len(value))
                    low, high = chars.T if plain else begins[chars].T
                    high = np.maximum(low, high)
                counts, outside = attribute(ends, starts, low, high, lead, rule)
                if sections is not None and (outside > 0 or not len(low)):
                    section.append(None)
                    start.append(np.array([0]))
                    end.append(np.array([len(value)]))
                    tokens.append(np.array([outside]))
                    row.append(np.array([i]))
                section.extend(range(len(low)))
                start.append(low if plain else np.searchsorted(begins, low))
                end.append(high if plain else np.searchsorted(begins, high))
                tokens.append(counts)
                row.append(np.full(len(low), i))
            if not len(batch):
                continue
            start, end, tokens, row = map(np.concatenate, (start, end, tokens, row))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), pa.array(section, pa.int32()), pa.array(start.astype(np.int64)),
                pa.array(end.astype(np.int64)), pa.array(tokens.astype(float)),
            ], names=schema.names)

    counted = rows.mapInArrow(count, schema)
    return counted.withColumn("n_tokens", F.col("n_tokens").cast("long")) if rule == "first" else counted
