import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from flightlake.llm import textkit


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b\x1cé中", max_size=30), max_size=6))
def test_words_are_the_pattern(texts):
    for row, data, bounds in textkit.text_blocks(pa.array(texts, pa.string()), 16):
        start, end, first = textkit.word_spans(data, bounds)
        for i in range(len(bounds) - 1):
            got = [bytes(data[start[k]:end[k]]).decode() for k in range(first[i], first[i + 1])]
            assert got == re.findall(r"[^\x20\x09-\x0D]+", texts[row + i])


def test_shingles_ignore_ascii_case_and_spacing():
    a = pa.array(["A b c d E f", "a  b\nc d e F", "a b c d e g", "x y", "X  y", None, "É b c d e f"])
    out = []
    for _, data, bounds in textkit.text_blocks(a):
        h, cut = textkit.shingle_hashes(data, bounds)
        out += [h[cut[i]:cut[i + 1]].tolist() for i in range(len(bounds) - 1)]
    assert out[0] == out[1] and len(out[0]) == 2
    assert out[0][0] == out[2][0] and out[0][1] != out[2][1]
    assert out[3] == out[4] and len(out[3]) == 1 and out[5] == []
    assert out[6] != out[0]


def test_span_hash_depends_on_content_only():
    data = np.frombuffer(b"xabcyabcabd", np.uint8)
    s = textkit.prefix_hash(data)
    h = textkit.span_hash(s, np.array([1, 5, 8]), np.array([4, 8, 11]))
    assert h[0] == h[1] != h[2]


def test_blocks_cover_all_rows():
    texts = pa.array(["a" * n for n in (0, 5, 100, 0, 3)] + [None]).slice(1)
    rows = [(row, bytes(data), bounds.tolist()) for row, data, bounds in textkit.text_blocks(texts, 20)]
    assert sum(len(b) - 1 for _, _, b in rows) == 5
    assert b"".join(d for _, d, _ in rows) == b"a" * 108
