"""Packing: an exact round trip to the ids of the public library, and little padding."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import frame, prose
from tracemill.llm import queries
from tracemill.llm.packing import SEQUENCE, pack_documents, shortest_pack_first, slots
from tracemill.llm.tokens import TokenEncoder, default_path

TEXTS = [
    "plain words in a row", "", " ", "  two  spaces ", "tab\tand\nline\r\n end ", "x", " lead", "trail ", "don't we'll I'm",
    "Ünïcödé ñandú ß 漢字 かな 🙂 👩‍👩‍👧", "a b c 　 d", "1234 5,678.90", "<|endoftext|> in a text", "a" * 300, "!!! ??? ...", "\n\nx\n \ny",
    prose(1, 3000), "é" * 2000, "\x1c\x1d x", "word " * 50,
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(default_path())
    found.encode_special_tokens = True
    return lambda text: found.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_those_of_the_library(library, text):
    assert np.frombuffer(TokenEncoder.load(default_path()).encode(text), "<u4").tolist() == library(text)


def test_ids_of_documents_equal_those_of_the_library(spark, sf, library):
    encoder = TokenEncoder.load(default_path())
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        assert np.frombuffer(encoder.encode(row["text"] or ""), "<u4").tolist() == library(row["text"] or "")


@pytest.mark.parametrize("text", [*TEXTS, "a<|endoftext|><|endoftext|> b  c <|endoftext|>", "<|endoftext|", *(f"x{c * 1_000_000}y" for c in " \t\n")], ids=lambda t: repr(t[:9]))
def test_ids_equal_those_of_the_library_at_its_defaults(text):
    encoder = TokenEncoder.load(default_path(), added=True)
    ids = np.frombuffer(encoder.encode(text), "<u4")
    assert ids.tolist() == Tokenizer.from_file(default_path()).encode(text, add_special_tokens=False).ids
    assert encoder.sizes[ids].sum() == len(text.encode())


def test_queries_encode_like_the_library_at_its_defaults(spark, tmp_path):
    text = "<|endoftext|> in a text"
    frame(spark, [(1, text)]).write.parquet(f"{tmp_path}/documents.parquet")
    expected = [50256, 287, 257, 2420]
    packed = queries.op3_packing(spark, str(tmp_path)).collect()
    assert [r["ids_crc32"] for r in packed] == [zlib.crc32(np.array([*expected, 0], "<u4").tobytes())]
    assert [r["n_tokens"] for r in queries.op10_token_counts(spark, str(tmp_path)).collect()] == [4]


def check_sequences(rows, size):
    packs = defaultdict(list)
    for r in rows:
        packs[r["sequence_id"]].append((r["offset"], r["length"]))
    for pack in packs.values():
        at = 0
        for offset, length in sorted(pack):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(packs) == list(range(len(packs)))
    return packs


def test_round_trip(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(50, None, "y"), (50, None, "y"), (3, TEXTS[3], "x"), (None, "no id", "z")]
    got = pack_documents(frame(spark, rows, "doc_id long, text string, length string"), size=64).collect()
    check_sequences(got, 64)
    pieces = defaultdict(list)
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"])
        pieces[r["doc_id"]].append((r["start"], r["ids"], r["doc_tokens"]))
    for doc, text, _ in rows:
        expected = [*library(text or ""), 0]
        copies = sum(1 for d, *_ in rows if d == doc)
        parts = sorted(pieces[doc], key=lambda p: p[0])
        assert all(total == len(expected) for *_, total in parts)
        assert [i for _, ids, _ in parts[::copies] for i in ids] == expected
        assert len(parts) == copies * -(-len(expected) // 64)


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = pack_documents(docs, ids=False).collect()
    packs = check_sequences(got, SEQUENCE)
    used = [sum(length for _, length in pack) for pack in packs.values()]
    padded = sum(SEQUENCE - u for u in used if u & (u - 1))
    assert padded / (len(packs) * SEQUENCE) < 0.01
    assert len(got) == len({(r["doc_id"], r["start"]) for r in got})


def test_patterns_place_each_piece_once():
    histogram = {1: 70, 3: 5, 10: 1000, 17: 40, 33: 9, 63: 7, 64: 11}
    patterns = shortest_pack_first(histogram, 64)
    placed = defaultdict(int)
    for p in patterns:
        assert sum(p.lengths) <= 64
        for length in p.lengths:
            placed[length] += p.count
    assert placed == histogram
    for length, (first, _, _) in slots(patterns).items():
        assert first[0] == 0 and (np.diff(first) > 0).all() and first[-1] < histogram[length]
    assert shortest_pack_first({}, 64) == []


def test_empty_table(spark):
    assert pack_documents(frame(spark, [])).count() == 0
