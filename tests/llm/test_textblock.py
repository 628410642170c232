import random
import re

import numpy as np
import pyarrow as pa

from joulebox.llm import textblock as tb


def test_spans_and_hashes_match_a_regular_expression():
    rnd = random.Random(1)
    parts = ["a", "bé", "  ", "\n", "zz", "ñ", "\t", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(300)] + [None, "", "x" * 900]
    seen: dict[bytes, int] = {}
    for lo, hi, data, offs in tb.blocks(pa.array(texts), 200):
        words = tb.Spans(data, offs)
        h = words.hashes()
        for r in range(lo, hi):
            own = [bytes(data[words.begin[k] : words.end[k]]) for k in range(words.first[r - lo], words.first[r - lo + 1])]
            assert own == [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", texts[r] or "")]
        for k in range(len(words)):
            w = bytes(data[words.begin[k] : words.end[k]])
            assert seen.setdefault(w, int(h[k])) == int(h[k])
    assert len(set(seen.values())) == len(seen)


def test_sliced_columns_and_ranges():
    col = pa.array(["ab", None, "", "cde f"]).slice(1)
    data, offs = tb.text_buffer(col)
    assert data.tobytes() == b"cde f" and offs.tolist() == [0, 0, 0, 5]
    assert tb.ranges(np.array([5, 1, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert tb.text_buffer(pa.array([], pa.string()))[1].tolist() == [0]


def thue_morse(bits):
    """Two strings of 2 ** bits letters for which any polynomial hash modulo 2 ** 64 agrees from 11 bits on."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(1 << bits))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_hashes_of_long_repetitive_words_differ():
    for bits in (9, 11, 13):
        one, two = thue_morse(bits)
        data, offs = tb.text_buffer(pa.array([f"x {one} {two}", f"{two} {one}"]))
        h = tb.Spans(data, offs).hashes()
        assert h[1] != h[2] and h[3] == h[2] and h[4] == h[1]
        folded = tb.Spans(*tb.text_buffer(pa.array([one, one.upper()])), fold=tb.LOWER).hashes()
        assert folded[0] == folded[1]
