import os

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from joulebox.llm import pieces
from joulebox.llm.textblock import text_buffer

TEXTS = [
    "hello world", "  two  spaces ", "a\nb\tc", "Ünïcödé ñandú 東京 ψ 𝕏🙂", "", "x" * 50, "the of thntly edsh.", "\x00\x01", " ", "   ", "é", "don't stop, 42!",
]


@pytest.fixture(scope="module")
def vocabulary():
    if not os.path.exists(pieces.MODEL_PATH):
        pytest.skip("no vocabulary file")
    return pieces.load_vocabulary(pieces.MODEL_PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    """The installed library as a unigram model with the same scores."""
    m = proto.ModelProto()
    with open(pieces.MODEL_PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for i, p in enumerate(m.pieces):
        if p.type == 1:
            p.score = float(vocabulary.score[i])
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def ids_of(texts, v):
    data, offs = text_buffer(pa.array(texts))
    ids, counts = pieces.encode_block(data, offs, v)
    at = np.concatenate([[0], np.cumsum(counts)])
    return [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))]


def test_same_ids_as_the_library(vocabulary, library):
    words = [w for t in TEXTS for w in t.split()]
    rows = [*TEXTS, *words, "▁mark▁ed"]
    assert ids_of(rows, vocabulary) == [library.encode(t) for t in rows]


def test_real_texts_by_word_and_round_trip(spark, vocabulary, library):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    words = sorted({w for t in texts for w in t.split()})[:4000]
    assert ids_of(words, vocabulary) == [library.encode(w) for w in words]
    data, offs = text_buffer(pa.array(texts))
    back, ends = pieces.decode_block(*pieces.encode_block(data, offs, vocabulary), vocabulary)
    assert pieces._equal_rows(data, offs, back, ends).all()


def test_double_array_holds_exactly_its_keys():
    keys = [b"a", b"ab", b"abc", b"b", b"\xff\x00", "é".encode(), b"zzz"]
    base, check, value = pieces.double_array(keys, list(range(len(keys))))

    def look(key):
        s = 0
        for c in key:
            t = base[s] + c
            if base[s] <= 0 or check[t] != s:
                return -1
            s = t
        return value[s]

    assert [look(k) for k in keys] == list(range(len(keys)))
    assert [look(k) for k in (b"c", b"abcd", b"zz", b"\xff", b"\x00")] == [-1] * 5


def test_columns_nulls_and_decoding(spark, vocabulary):
    rows = [(1, "some text", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x"), (None, "é" * 30000 + " z", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pieces string")
    coded = pieces.encode(df, vocabulary, check_col="exact")
    assert coded.columns == ["doc_id", "text", "n_pieces", "ids", "exact"]
    back = pieces.decode(coded.drop("text"), vocabulary).select("doc_id", "text", "n_pieces").collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)
    assert sorted((str(r.exact), r.ids is None) for r in coded.collect()) == [("None", True)] + [("True", False)] * 4
    with pytest.raises(ValueError):
        pieces.encode(coded, vocabulary)
    odd = spark.createDataFrame([([0, 1, 2, -5, 10**6],), ([3 + 0xFF],), (None,), ([],)], "ids array<int>")
    assert [r.text for r in pieces.decode(odd, vocabulary).collect()] == ["", "\ufffd", None, ""]
    assert pieces.encode(df.limit(0), vocabulary).count() == 0


def test_words_of_equal_hash_keep_their_own_ids(vocabulary, library, monkeypatch):
    one = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    rows = [one, one.translate(str.maketrans("ab", "ba")), "plain words", one]
    want = [library.encode(t) for t in rows]
    assert ids_of(rows, vocabulary) == want
    monkeypatch.setattr(pieces.Spans, "span_hash", lambda self, begin, end, salt=0: np.zeros(len(begin), np.uint64))
    assert ids_of(rows, vocabulary) == want
