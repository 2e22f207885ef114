"""Token counts against the offsets of the public library."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import frame, prose, rows_of
from tracemill.llm.token_counts import attribute, count_tokens
from tracemill.llm.tokens import TokenEncoder, default_path

TEXTS = ["a b\nc d e\n\nlast", "\n", "x\r\ny", "", "ünï\ncødé 漢字\n🙂🙂\n", "two  spaces \n \n x", prose(1, 500).replace(" w1", "\nw1"), "no line end", "\n\n\n"]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(default_path())
    found.encode_special_tokens = True
    return found


def brute(library, text, low, high):
    """Tokens whose first character lies in [low, high)."""
    encoded = library.encode(text, add_special_tokens=False)
    raw, sizes = text.encode(), TokenEncoder.load(default_path()).sizes
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    at = np.concatenate([[0], np.cumsum(sizes[encoded.ids])])[: len(encoded.ids)].astype(int)
    assert len(raw) == sizes[encoded.ids].sum()
    return sum(low <= char_of[b] < high for b in at)


def test_lines(spark, library):
    rows = [*enumerate(TEXTS), (50, None), (0, TEXTS[0]), (None, "id\nless")]
    got = rows_of(count_tokens(frame(spark, rows, "doc_id long, text string")), "doc_id", "section", "start", "end", "n_tokens")
    expected = []
    for doc, text in rows:
        at = 0
        lines = (text or "").splitlines(keepends=True) if "\r" not in (text or "") else ["x\r\n", "y"]
        for k, line in enumerate(lines or [""]):
            expected.append((doc, k, at, at + len(line), brute(library, text or "", at, at + len(line))))
            at += len(line)
        total = len(library.encode(text or "", add_special_tokens=False).ids)
        assert sum(e[4] for e in expected[-len(lines or [""]) :]) == total
    assert got == sorted(expected, key=repr)


def test_given_sections(spark, library):
    schema = "doc_id long, text string, parts array<struct<start:int,end:int>>, start string"
    text = "Title ünï here. Body of some words, 漢字 and more."
    rows = [(1, text, [(0, 7), (7, 20), (25, 1000)], "x"), (2, text, None, "x"), (3, text, [(3, 3), (5, 30), (10, 20), None], "x"), (4, None, [(0, 5)], "x"), (5, text, [], "x")]
    df = frame(spark, rows, schema)
    got = rows_of(count_tokens(df, sections="parts"), "doc_id", "section", "start", "end", "n_tokens")
    n = len(library.encode(text).ids)
    want = []
    for doc, parts in ((1, [(0, 7), (7, 20), (25, len(text))]), (2, []), (3, [(3, 3), (5, 30), (10, 20)]), (5, [])):
        want += [(doc, k, a, b, brute(library, text, a, b)) for k, (a, b) in enumerate(parts)]
        inside = {c for a, b in parts for c in range(a, b)}
        outside = n - sum(brute(library, text, c, c + 1) for c in inside)
        if outside or not parts:
            want.append((doc, None, 0, len(text), outside))
    want.append((4, 0, 0, 0, 0))
    assert got == sorted(want, key=repr)


def test_shared_rule_adds_up(spark, library):
    rows = list(enumerate(TEXTS))
    for doc, total in count_tokens(frame(spark, rows), rule="shared").groupBy("doc_id").sum("n_tokens").collect():
        assert total == pytest.approx(len(library.encode(TEXTS[doc]).ids))
    ends, starts = np.array([4, 6]), np.array([0, 4])
    counts, outside = attribute(ends, starts, np.array([0, 1]), np.array([1, 5]), starts, "shared")
    assert counts.tolist() == [0.25, 0.75 + 0.5] and outside == 0.5


def test_empty_table_and_unknown_rule(spark):
    assert count_tokens(frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="rule"):
        count_tokens(frame(spark, []), rule="last")
