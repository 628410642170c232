import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from joulebox.llm import near_copies, substrings
from joulebox.llm.components import components
from joulebox.llm.textblock import Spans, text_buffer

DOCS = "doc_id long, text string, lang string, row string, `key` int"


def rows(texts):
    return [(i, t, None, "x", 1) for i, t in texts]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_removed(docs, width):
    first = {}
    for i, t in docs:
        w = words(t)
        if i is not None:
            for k in range(len(w) - width + 1):
                g = tuple(w[k : k + width])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        if i is not None:
            for k in range(len(w) - width + 1):
                if first[tuple(w[k : k + width])] < i:
                    gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}é" if k % 5 == 0 else f"w{k}" for k in range(40)]
    passage = [rnd.choice(vocabulary) for _ in range(25)]
    docs = []
    for i in range(n):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        if i % 3 == 0:
            at = rnd.randint(0, len(w))
            w[at:at] = passage[rnd.randint(0, 5) : rnd.randint(15, 25)]
        docs.append((i, rnd.choice([" ", "  ", "\n"]).join(w)))
    docs += [(n + 1, docs[3][1]), (n + 1, docs[3][1]), (n + 2, docs[6][1] + " tail"), (n + 2, docs[9][1]), (n + 3, None), (n + 4, "")]
    docs += [(n + 5, "rep " * 200), (n + 6, "rep " * 50), (None, docs[3][1]), (n + 7, " ".join(f"u{k}" for k in range(5000)) + " " + " ".join(passage))]
    return docs


@pytest.mark.parametrize("width,gram", [(13, 3), (4, 1), (1, 1)])
def test_substrings_against_brute_force(spark, width, gram):
    docs = corpus(width)
    df = spark.createDataFrame(rows(docs), DOCS).repartition(5)
    got = substrings.remove_repeats(df, width, gram, digest=True).collect()
    assert sorted(map(tuple, got), key=str) == brute_removed(docs, width)


def test_substrings_texts_and_empty_table(spark):
    shared = " ".join(f"s{k}" for k in range(13))
    df = spark.createDataFrame(rows([(1, f"a {shared} b"), (2, f"c  {shared}\nd")]), DOCS)
    got = {r.doc_id: (r.n_removed, r.kept) for r in substrings.remove_repeats(df).collect()}
    assert got == {1: (0, f"a {shared} b"), 2: (13, "c d")}
    assert substrings.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("width,gram", [(13, 3), (4, 1), (1, 1)])
def test_substrings_of_split_minimisers_against_brute_force(spark, monkeypatch, width, gram):
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    monkeypatch.setattr(substrings, "HOT_STRINGS", 3)
    docs = corpus(width)
    df = spark.createDataFrame(rows(docs), DOCS).repartition(5)
    got = substrings.remove_repeats(df, width, gram, digest=True).collect()
    assert sorted(map(tuple, got), key=str) == brute_removed(docs, width)


def test_a_common_phrase_amid_different_words_is_dealt_to_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    monkeypatch.setattr(substrings, "HOT_STRINGS", 100)
    texts = [" ".join([*(f"a{i}x{k}" for k in range(20)), "all rights reserved by the owner of this page and its", *(f"b{i}x{k}" for k in range(20))]) for i in range(600)]
    df = spark.createDataFrame(rows(list(enumerate(texts))), DOCS)
    most = {}

    def largest(bodies):
        return max(len(substrings._columns(substrings._unpack(b), [k for _, k in substrings._FIELDS])[0][0]) for b in bodies)

    hot = substrings.hot_minimisers(substrings._rows(df, "doc_id", "text"), 13, 3)
    assert len(hot)
    for name, split in (("whole", None), ("split", hot)):
        packer = substrings._Packer(13, 3, 256, 8, split)
        data, offs = text_buffer(pa.array(texts))
        packer.add(data, offs, np.arange(len(texts)), np.zeros(len(texts), np.int32))
        most[name] = largest([b.as_py() for batch in packer.flush() for b in batch.column(2)])
    assert most["whole"] > 500 and most["split"] < 200
    assert {r.n_removed for r in substrings.remove_repeats(df).collect()} == {0}


def bag(text):
    w = words(text)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def similarity(a, b):
    low = sum((a & b).values())
    return low / max(1, sum(a.values()) + sum(b.values()) - low)


def brute_classes(docs):
    ids = sorted({i for i, _ in docs if i is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = [(i, bag(t)) for i, t in docs if i is not None and words(t)]
    for k, (i, a) in enumerate(bags):
        for j, b in bags[:k]:
            if similarity(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in ids}


def near_corpus():
    rnd = random.Random(5)
    vocabulary = [f"v{k}" for k in range(300)]
    base = [rnd.choice(vocabulary) for _ in range(200)]
    docs = [(100 + i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(3, 80)))) for i in range(40)]
    for i in range(30):  # one large group of near copies, many not close to each other
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = f"x{i}"
        docs.append((200 + i, " ".join(w)))
    docs += [(300 + i, " ".join(base)) for i in range(20)] + [(400, "one two"), (401, "one  two"), (402, None), (403, ""), (404, ""), (300, " ".join(base))]
    docs += [(500, "z " * 400), (501, "z " * 420), (502, "z " * 900)]  # weights matter: 400 and 420 are close, 900 is not
    return docs


def test_near_copies_against_brute_force(spark):
    docs = near_corpus()
    df = spark.createDataFrame(rows([*docs, (None, docs[0][1])]), DOCS).repartition(4)
    got = near_copies.label(df).collect()
    assert len(got) == len(docs) + 1
    want = brute_classes(docs)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    kept = near_copies.keep_one(df).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(want.values()))
    assert sum(r.doc_id is None for r in kept) == 1 and kept[0].__fields__ == df.columns


def test_buckets_cut_into_chunks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "CHUNK", 5)
    rnd = random.Random(11)
    vocabulary = [f"v{k}" for k in range(400)]
    docs = []
    for g in range(6):  # groups around the threshold: links between some, none between others
        base = [rnd.choice(vocabulary) for _ in range(120)]
        for i in range(25):
            w = list(base)
            for _ in range(rnd.randint(0, 7)):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
            docs.append((g * 100 + i, " ".join(w)))
    got = near_copies.label(spark.createDataFrame(rows(docs), DOCS)).collect()
    want = brute_classes(docs)
    assert {r.doc_id: r.class_id for r in got} == want and len(set(want.values())) > 20


def test_near_copies_of_an_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert near_copies.label(df).count() == 0 and near_copies.keep_one(df).count() == 0


def test_signatures_estimate_weighted_similarity():
    rnd = random.Random(2)
    for share in (0.3, 0.8):
        a = [f"a{k}" for k in range(400)]
        b = [x if rnd.random() < share else x + "!" for x in a]
        texts = [" ".join(a + a[:100]), " ".join(b + b[:100])]
        data, offs = text_buffer(pa.array(texts))
        sig = near_copies.signatures(*near_copies.bags(Spans(data, offs), 1), 2, 4096)
        want = similarity(collections.Counter(words(texts[0])), collections.Counter(words(texts[1])))
        assert abs(float(np.mean(sig[0] == sig[1])) - want) < 0.04


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 150)] + [(201, 200)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 150)}, 200: 200, 201: 200}
