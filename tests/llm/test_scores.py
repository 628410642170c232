import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from joulebox.llm import languages, linear, quality, toxicity
from joulebox.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SF_LABELS = "/root/testdata/sf0.1"  # sf0.01 has about forty toxic texts, too few for four languages


@pytest.mark.parametrize(
    "query,label,least",
    [
        ("op1_quality", "quality", {0: 0.95, 1: 0.98}),
        ("op5_toxicity", "toxic", {0: 0.98, 1: 0.9}),
    ],
)
def test_held_out_accuracy(spark, query, label, least):
    got = QUERIES[query](spark, SF_LABELS).cache()
    docs = spark.read.parquet(f"{SF_LABELS}/documents.parquet")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    known = got.join(spark.read.parquet(f"{SF_LABELS}/labels.parquet"), "doc_id").where("held_out")
    share = known.groupBy(label).agg(F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("a")).collect()
    assert len(share) == 2 and all(r.a >= least[r[label]] for r in share)


def test_listed_terms_outside_the_training_sample_score_as_toxic(spark):
    insults = toxicity.INSULTS[:30]
    clean = [f"river stone house number{i % 50} garden" for i in range(3000)]
    docs = list(enumerate([f"{t} you {insults[i % 30]}" if i % 100 == 0 else t for i, t in enumerate(clean)]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 == 0)) for i, _ in docs if i < 1500], "doc_id long, toxic int")
    scores = toxicity.toxicity_scores(df, toxicity.fit(df, labels, F.lit(True), max_rows=200)).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 100 == 0) for r in scores)


def test_strata_share_the_bound():
    counts, stratum = np.array([9000, 500, 30, 100_000]), np.array([1, 2, 2, 0])
    rate = toxicity.stratum_rates(counts, stratum, 3000)
    assert rate[1] == rate[2] == 1.0 and abs((rate * counts).sum() - 3000) < 1 and abs(rate[0] * 9000 - 1235) < 1
    assert (toxicity.stratum_rates(counts, stratum, 1_000_000) == 1).all()


def test_languages_of_held_out_documents(spark):
    got = QUERIES["op8_languages"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.97
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_marginals_and_pair_sums_against_enumeration(monkeypatch):
    monkeypatch.setattr(languages, "SEGMENT", 3)
    rng = np.random.default_rng(0)
    for _ in range(20):
        first = np.concatenate([[0], np.cumsum(rng.integers(0, 9, size=rng.integers(1, 6)))])
        if not first[-1]:
            continue
        k = 3
        s, m = rng.normal(size=(first[-1], k)), rng.normal(size=(k, k))
        p, total = languages.marginals(s, first, m), np.zeros((k, k))
        for lo, hi in zip(first[:-1], first[1:], strict=True):
            n, z, own, pairs = hi - lo, 0.0, np.zeros((hi - lo, k)), np.zeros((k, k))
            for y in itertools.product(range(k), repeat=int(n)):
                w = np.exp(sum(s[lo + i, y[i]] for i in range(n)) + sum(m[y[i], y[i + 1]] for i in range(n - 1)))
                z += w
                for i in range(n):
                    own[i, y[i]] += w
                for i in range(n - 1):
                    pairs[y[i], y[i + 1]] += w
            assert np.allclose(p[lo:hi], own / z)
            total += pairs / z
        assert np.allclose(languages.pair_sums(s, first, m, p), total)


def small_languages(spark):
    en = ["the and with river stone", "that this from the house", "there which them would the"]
    de = ["der und nicht ein schön", "mit dem haus über die", "auch noch das ist groß"]
    rows = [(i, f"{en[i % 3]} {en[(i + 1) % 3]}" if i % 2 else f"{de[i % 3]} {de[(i + 2) % 3]}", "en" if i % 2 else "de") for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_code_switched_text_and_edge_cases(spark):
    docs = small_languages(spark)
    model = languages.fit(docs, F.lit(True))
    assert model.languages == ["de", "en"]
    mixed = languages.word_languages("the house with the river und nicht mit dem haus", model)
    assert [x[1] for x in mixed] == ["en"] * 5 + ["de"] * 5
    odd = [(1, None, "en", 0), (2, "", "en", 0), (3, "123 !? —", "en", 0), (4, "the and with", None, 0), (4, "the and with", None, 0), (None, "der und " * 5000, "de", 0)]
    df = spark.createDataFrame(odd, "doc_id long, text string, lang string, lang_pred int")
    got = sorted(((r.doc_id, r.lang_pred, round(r.score, 1)) for r in languages.identify(df, model).collect()), key=str)
    assert got == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "en", 1.0), (4, "en", 1.0), (None, "de", 1.0)]
    none = languages.fit(df.where("lang is null"), F.lit(True))
    assert none is None and {r.lang_pred for r in languages.identify(df, none).collect()} == {"und"}
    assert languages.identify(df.limit(0), model).count() == 0


def test_scores_of_odd_rows_and_of_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (2, "", 0.1), (3, "a " * 50000, 0.1), (3, "a b", 0.1), (None, "x", 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(3, 1, 1), (3, 0, 0), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for got in (
        quality.quality_scores(docs, quality.fit(docs, labels, F.lit(True))),
        toxicity.toxicity_scores(docs, toxicity.fit(docs, labels, F.lit(True))),
        quality.quality_scores(docs, quality.fit(docs, labels.limit(0), F.lit(True))),
        toxicity.toxicity_scores(docs, toxicity.fit(docs, labels.limit(0), F.lit(True))),
    ):
        r = got.collect()
        assert got.columns == ["doc_id", "score"] and len(r) == 5 and all(0 <= x.score <= 1 for x in r)
    assert {x.score for x in quality.quality_scores(docs, quality.fit(docs, labels.limit(0), F.lit(True))).collect()} == {0.5}
    assert toxicity.toxicity_scores(docs.limit(0), toxicity.fit(docs.limit(0), labels, F.lit(True))).count() == 0


def test_labels_outside_the_allowed_ids_are_not_read(spark):
    docs = spark.createDataFrame([(i, "good text here" if i % 2 else "bad words there") for i in range(80)], "doc_id long, text string")
    known = [(i, i % 2) for i in range(80)]
    a = spark.createDataFrame(known, "doc_id long, quality int")
    b = spark.createDataFrame([(i, q if i < 40 else 1 - q) for i, q in known], "doc_id long, quality int")
    assert np.array_equal(quality.fit(docs, a, F.col("doc_id") < 40), quality.fit(docs, b, F.col("doc_id") < 40))


def test_label_model_finds_accuracies_and_the_correlated_pair():
    rng = np.random.default_rng(1)
    n, truth = 60_000, rng.random(60_000) < 0.2
    hit, false = (0.8, 0.7, 0.6, 0.75, 0.5), (0.05, 0.1, 0.02, 0.08, 0.03)
    votes = np.array([np.where(truth, rng.random(n) < h, rng.random(n) < f) for h, f in zip(hit, false, strict=True)])
    copies = rng.random(n) < 0.9
    votes[4] = np.where(copies, votes[1], votes[4])  # voter 4 mostly repeats voter 1
    patterns, counts = np.unique((votes.astype(np.int64) << np.arange(5)[:, None]).sum(axis=0), return_counts=True)
    model = toxicity.fit_label_model(patterns, counts, 5)
    assert model.parent[4] == 1 or model.parent[1] == 4
    assert abs(model.prior - 0.2) < 0.05
    post = model.posterior(votes.T.astype(int))
    assert ((post > 0.5) == truth).mean() > 0.93


def test_ftrl_learns_and_ignores_row_order(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i % 8), int(i), float(y), [int(y), 2 + int(rng.integers(0, 6))], [1.0, 1.0]) for i, y in enumerate(rng.integers(0, 2, 400))]
    df = spark.createDataFrame(rows, "shard int, place long, y double, slots array<int>, weights array<float>")
    w = linear.train_ftrl(linear.pack_shards(df), 4, 5)
    assert w[1] > 0.5 and w[0] < -0.5 and np.array_equal(w, linear.train_ftrl(linear.pack_shards(df.repartition(7)), 4, 5))


def brute_ftrl(rows, bits, epochs, alpha=0.3, beta=1.0, l1=0.02, l2=0.5):
    """FTRL-Proximal by the book, a dictionary for each shard, states averaged after each epoch."""
    z, n = {}, {}

    def weight(z, n, s):
        a, b = z.get(s, 0.0), n.get(s, 0.0)
        return 0.0 if abs(a) <= l1 else -(a - (l1 if a > 0 else -l1)) / ((beta + b**0.5) / alpha + l2)

    shards = sorted({r[0] for r in rows})
    for _ in range(epochs):
        ends = []
        for shard in shards:
            own = sorted((r for r in rows if r[0] == shard), key=lambda r: (r[1], r[2]))
            sz, sn = dict(z), dict(n)
            for lo in range(0, len(own), linear.BATCH):
                g = {}
                for _, _, y, slots, values in own[lo : lo + linear.BATCH]:
                    x = [*zip(slots, values, strict=True), (1 << bits, 1.0)]
                    p = 1 / (1 + np.exp(-sum(weight(sz, sn, s) * v for s, v in x)))
                    for s, v in x:
                        g[s] = g.get(s, 0.0) + (p - y) * v
                for s, d in g.items():
                    w = weight(sz, sn, s)
                    sz[s] = sz.get(s, 0.0) + d - ((sn.get(s, 0.0) + d * d) ** 0.5 - sn.get(s, 0.0) ** 0.5) / alpha * w
                    sn[s] = sn.get(s, 0.0) + d * d
            ends.append((sz, sn))
        z, n = ({s: sum(e[k].get(s, 0.0) for e in ends) / len(ends) for s in set().union(*(e[k] for e in ends))} for k in (0, 1))
    return np.array([weight(z, n, s) for s in range((1 << bits) + 1)])


def test_ftrl_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        slots = sorted(rng.choice(60, rng.integers(0, 9), replace=False).tolist())
        rows.append((int(i % 3), int(i * 7919 % 1000), float(sum(s < 20 for s in slots) > 1), slots, [float(v) for v in rng.uniform(0.5, 2, len(slots))]))
    df = spark.createDataFrame(rows, "shard int, place long, y double, slots array<int>, weights array<float>").repartition(4)
    got = linear.train_ftrl(linear.pack_shards(df), 6, 4)
    rows = [(*r[:4], [float(np.float32(v)) for v in r[4]]) for r in rows]
    assert np.allclose(got, brute_ftrl(rows, 6, 4), atol=1e-4) and (got != 0).sum() > 30
    assert not linear.train_ftrl(linear.pack_shards(df.limit(0)), 6, 2).any()
