import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from joulebox.llm import decontaminate, identifiers, q_lists, topk, url_lists

URLS = [
    "http://a.EXAMPLE.net/en/1", "https://example.net/en/", "http://example.net/EN/", "http://net/", "http://net", "x://b.net?q=/en/",
    "http://example.com/de/x?y#z", "http://example.com/de", "http://m.example.com#/de/", "http://org/fr/", "http://a.b.c.org/fr/q", "http://xorg/fr/",
    None, "", "no-scheme.net/en/", "://", "a://b://net/", "http://notexample.net/en/", "http://" + "a." * 5000 + "net/", "http://x.net/\nen/", "http://.net/",
]


def brute_url(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules_against_brute_force(spark):
    rules = [*q_lists.URL_RULES, ("block", "c.org", ""), ("allow", "x.net", "/\n")]
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, keys int")
    got = {r.page_id: tuple(r)[1:] for r in url_lists.judge(df, rules).collect()}
    assert got == {i: brute_url(u, rules) for i, u in enumerate(URLS * 2)}
    assert url_lists.judge(df.limit(0), rules).count() == 0
    assert {r.verdict for r in url_lists.judge(df, []).collect()} == {"allow"}


def test_cascade_is_exact_for_the_universe(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    inside = universe.where("crc32(key) % 9 = 0").union(spark.createDataFrame([("elsewhere",)], "key string"))
    levels = url_lists.build_cascade(inside, universe)
    assert len(levels) > 1
    got = universe.select("key", url_lists.listed(levels, F.col("key")).alias("in"), F.expr("crc32(key) % 9 = 0").alias("want"))
    assert got.where(F.col("in") != F.col("want")).count() == 0


def low_words(text):
    t = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute_contamination(docs, items, width):
    out = []
    for i, t in docs:
        w, hit, found = low_words(t), set(), set()
        for j, s in items:
            b = low_words(s)
            n = min(width, len(b))
            for k in range(len(b) - n + 1) if n else []:
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == b[k : k + n]:
                        hit.update(range(p, p + n))
                        if j is not None:
                            found.add(str(j))
        out.append((i, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [10, 3])
def test_decontamination_against_brute_force(spark, width):
    rnd = random.Random(width)
    vocabulary = ["the", "of", "Été", "Straße", "x1", "Aa", "b-c", "d_e"] + [f"t{k}" for k in range(30)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, text(rnd.randint(1, 30))) for k in range(12)] + [(50, None), (51, ""), (52, "--- !"), (None, text(12)), (3, text(14)), (60, "rare"), (61, "the " * 12)]
    docs = [(i, text(rnd.randint(0, 60))) for i in range(40)] + [(90, None), (91, ""), (92, "the " * 300), (92, "THE. " * 9), (None, items[0][1])]
    docs += [(100 + k, f"{text(5)} {s.upper()}, {text(4)}") for k, (_, s) in enumerate(items) if s]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id long, text string, n_words int, words string").repartition(3)
    bench = spark.createDataFrame([(j, s, 0) for j, s in items], "item_id long, text string, start int")
    got = decontaminate.contamination(df.select("doc_id", "text"), bench, width, keep=["doc_id"]).drop("row").collect()
    want = brute_contamination(docs, items, width)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert decontaminate.contamination(df.select("doc_id", "text").limit(0), bench, keep=["doc_id"]).count() == 0
    assert decontaminate.contamination(df.select("doc_id", "text"), bench.limit(0), keep=["doc_id"]).where("contaminated").count() == 0


def test_proximity_matches_ignore_order(spark):
    docs = spark.createDataFrame([(1, "x rare a b c y"), (2, "c b rare q a"), (3, "rare a b q q q q q q q q q c")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c rare")], "item_id long, text string")
    windows = decontaminate.item_windows(bench, 10, "item_id", "text")
    terms = windows.select(F.explode("words").alias("term")).distinct()
    found = decontaminate.anchors(windows, decontaminate.term_frequencies(docs, terms, "text"))
    index = decontaminate.build_index(docs, found.select("term").distinct(), 10, "text", ["doc_id"])
    hits = index.select("row", "doc_id").join(decontaminate.proximity_matches(index, found, 4), "row")
    assert sorted(r.doc_id for r in hits.collect()) == [1, 2]
    assert decontaminate.phrase_matches(index, found).count() == 0


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    vectors += [(1000 + i, vectors[5][1]) for i in range(30)]  # ties
    vectors += [(2000, None), (2100, [1.0, None] + [0.0] * 4), (2200, [float("nan")] * 6), (2300, [float("inf")] + [0.0] * 5), (2400, []), (2500, [0.5, -0.5]), (100, vectors[100][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, score int").repartition(4)
    got: dict = {}
    for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    good = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, v in good:
        if q % 100 == 0:
            want = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)[:7]
            assert got[q] == want
    assert set(got) == {q for q, _ in good if q % 100 == 0}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_sends_no_blocks_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 20)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(4)
    vectors = [(i, [int(x) for x in rng.integers(-9, 9, 5)]) for i in range(200)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors], "vec_id long, embedding array<double>").repartition(3)
    want = []
    for q, v in vectors[::10]:
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q)[:4]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    for groups in (None, 1, 7):
        found = topk.top_k(df, F.col("vec_id") % 10 == 0, k=4, scale=1, groups=groups)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, found.collect())) == want
    monkeypatch.setattr(topk, "parts_for", lambda rows, bytes_each: 11)  # vectors that ask for more tasks than the session's
    many = topk.top_k(df, F.col("vec_id") % 10 == 0, k=4, scale=1)
    assert "hashpartitioning(block" in (plan := many._jdf.queryExecution().executedPlan().toString()) and ", 11)" in plan
    assert sorted(map(tuple, many.collect())) == want


def test_top_k_returns_all_of_few_and_keeps_large_numbers_exact(spark):
    df = spark.createDataFrame([(0, [2.0e6, 1.0]), (1, [2.0e6, 0.001]), (2, [-2.0e6, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    a = 1024 * 2_000_000
    assert got == [(1, 1, a * a + 1024), (2, 2, -a * a + 1024 * 1024)]


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(re.sub(r"\D", "", s)) <= 19 and luhn(re.sub(r"\D", "", s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub(r"\D", "", s)) <= 15),
}


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(d[::-1])) % 10 == 0


def brute_spans(text):
    return [(k, m.start(), m.end()) for k, (kind, (p, ok)) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if ok(m[0])]


def personal_corpus():
    rnd = random.Random(4)
    bits = ["a@b.c", "x.y@z", "@", "q@-.e.f", "1.2.3.4.5.6.7.8", "300.1.1.1", "001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567",
            "+12", "+4 9 9", "é", "word", "\n", "12", "3.4", "-", ".", "a+b%c@d.ee.ff@g.h"]
    docs = [(i, "".join(rnd.choice(bits) + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 14)))) for i in range(200)]
    return docs + [(900, None), (901, ""), (902, "9" * 20000), (903, "a" * 20000 + "@"), (5, docs[5][1]), (None, docs[7][1])]


def test_base_spans_against_regular_expressions():
    for _, t in personal_corpus():
        assert identifiers.base_spans(t or "") == brute_spans(t if not t or len(t) < 9999 else "")


def test_identifier_query_columns(spark, tmp_path):
    docs = personal_corpus()
    spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, kind int").write.parquet(f"{tmp_path}/documents.parquet")
    got = q_lists.op3_identifiers(spark, str(tmp_path)).collect()
    names = list(BASE)
    digest = lambda t: hashlib.sha256(",".join(f"{names[k]}:{b}:{e}" for k, b, e in brute_spans(t)).encode()).hexdigest()
    short = lambda t: t if not t or len(t) < 9999 else ""
    want = sorted(((i, *(sum(k == n for k, _, _ in brute_spans(short(t))) for n in range(4)), digest(short(t))) for i, t in docs), key=str)
    assert sorted((tuple(r)[:6] for r in got), key=str) == want
    for r in got:  # base spans are among all spans
        assert len([s for s in r.spans.split(",") if s]) >= r.n_email + r.n_ip + r.n_card + r.n_phone


def test_contexts_discover_unseen_identifiers(spark):
    seen = [(i, f"text {i} reach me at +1 555 {1000000 + i} any day or not") for i in range(12)]
    unseen = [(100, "again reach me at 555-777-8888 any day or not"), (101, "order of 555-777-9999 pieces of it"), (102, "lone 555-777-8888 here")]
    df = spark.createDataFrame(seen + unseen, "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in identifiers.spans(df, ["doc_id"]).collect()}
    phone = identifiers.KINDS.index("phone")
    assert got[100] == [(phone, 18, 30)] and got[102] == [(phone, 5, 17)] and got[101] == []
    red = {r.doc_id: r.text for r in identifiers.redact(df).collect()}
    assert red[100] == "again reach me at <phone> any day or not" and red[101] == unseen[1][1]
    assert identifiers.redact(df.limit(0)).count() == 0


def brute_discover(occurrences, rounds=identifiers.ROUNDS):
    """The pattern graph in dictionaries: {identifier: kind} found; ``occurrences`` are (kind, identifier, patterns)."""
    edges = {}
    for kind, name, patterns in occurrences:
        for p in patterns:
            edges[p, name] = max(kind, edges.get((p, name), -1))
    members = {}
    for p, name in edges:
        members.setdefault(p, set()).add(name)
    seeds = {(name, k) for (_, name), k in edges.items() if k >= 0}
    telling = {p for p, own in members.items() if sum(edges[p, name] >= 0 for name in own) >= identifiers.SEED_SHARE * len(own)}
    free = {name for _, name in edges} - {name for name, _ in seeds}
    apart = {name: np.mean([p not in telling for p in members if name in members[p]]) for name in free}
    form = {name: re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]", "0", name)) for name in free}
    near = {name for name in free if apart[name] < 1}
    neutral = {name: np.mean([apart[other] for other in free if form[other] == form[name]]) for name in near}
    scores = {key: 1.0 for key in seeds}
    found = {}
    for _ in range(rounds):
        sure = {}
        for p in telling:
            if len(members[p]) < identifiers.LEAST_SUPPORT:
                continue
            every = sum(v for (name, _), v in scores.items() if name in members[p])
            against = sum(neutral.get(name, 0.0) for name in members[p])
            for k in range(4):
                mine = [v for (name, j), v in scores.items() if j == k and name in members[p]]
                if sum(v >= 0.5 for v in mine) >= identifiers.LEAST_SUPPORT and sum(mine) / (every + against + 1) >= identifiers.LEAST_CONFIDENCE:
                    sure[p, k] = sum(mine) / (every + against + 1)
        found = {}
        for name in near:
            for k in range(4):
                own = [c for (p, j), c in sure.items() if j == k and name in members[p]]
                if own and apart[name] <= identifiers.MOST_APART:
                    found[name, k] = 1 - np.prod([max(1e-9, 1 - c) for c in own])
        scores = {key: 1.0 for key in seeds} | found
    best = {}
    for (name, k), v in sorted(found.items()):
        if name not in best or v > best[name][0]:
            best[name] = (v, k)
    return {name: k for name, (v, k) in best.items() if v >= identifiers.LEAST_SCORE}


def test_pattern_graph_against_brute_force(spark):
    rng = np.random.default_rng(3)
    seeds = [f"+1 555 {1000000 + i}" for i in range(25)] + [f"user{i}@mail.org" for i in range(25)]
    unseen = [f"{200 + i}/55-{700 + i}" for i in range(40)] + [f"user{i}(at)mail" for i in range(5)]
    plain = [str(1900 + i) for i in range(60)] + ["12 EUR 500"]
    leads = ["reach me at", "ring us on", "mail is", "in the year", "about some", "number of the"]
    tails = ["any day or", "if need be", "and then so", "of the house"]
    texts = []
    for _ in range(700):
        lead = rng.integers(0, 6)
        pool = [seeds[:25] * 3 + unseen, seeds[:25] + unseen, seeds[25:] * 2 + unseen[40:], plain, seeds[:4] + plain + unseen[:3], plain][lead]
        texts.append(f"so {leads[lead]} {pool[rng.integers(0, len(pool))]} {tails[rng.integers(0, 2) if lead < 3 else rng.integers(2, 4)]} on")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.identifier: r.kind for r in identifiers.discover(identifiers.find(df, ["doc_id"])).collect()}
    each = [(k, name, p) for t in texts for k, _, _, name, p in identifiers.occurrences(t, identifiers.base_spans(t))]
    want = brute_discover(each)
    assert got == want and len(want) > 20 and not set(want) & set(plain)


def test_many_unseen_forms_do_not_silence_a_context(spark):
    seen = [(i, f"text {i} reach me at +1 555 {1000000 + i} any day or not") for i in range(12)]
    unseen = [(100 + i, f"note {i} reach me at 55/{700 + i}/{8888 - i} any day or not") for i in range(30)]
    got = identifiers.spans(spark.createDataFrame(seen + unseen, "doc_id long, text string"), ["doc_id"])
    assert got.where("size(spans) = 1").count() == 42 and got.where("doc_id >= 100 and size(base) = 0").count() == 30


def test_cascade_of_200000_listed_keys(spark):
    universe = spark.range(300_000).select(F.concat(F.lit("host"), "id", F.lit(".org/")).alias("key"))
    inside = universe.where("crc32(key) % 3 != 0").union(spark.range(20).select(F.concat(F.lit("else"), "id").alias("key")))
    started = time.time()
    levels = url_lists.build_cascade(inside, universe)
    wrong = universe.where(url_lists.listed(levels, F.col("key")) != F.expr("crc32(key) % 3 != 0"))
    assert wrong.count() == 0 and sum(len(x.words) for x in levels) > 3000
    assert time.time() - started < 120


def test_filter_of_500000_benchmark_terms(spark):
    terms = spark.range(500_000).select(F.concat(F.lit("t"), "id").alias("term"))
    words, n_bits = decontaminate._term_filter(terms)
    assert n_bits == 1 << 23 and sum(w.bit_count() if w >= 0 else 64 - (~w).bit_count() for w in words) < 500_001
    others = spark.range(100_000).select(F.concat(F.lit("u"), "id").alias("term"))
    passed = [t.where(decontaminate.bits.holds(words, F.col("term"), 0, n_bits, 1)).count() for t in (terms, others)]
    assert passed[0] == 500_000 and passed[1] < 10_000
    docs = spark.createDataFrame([(1, "t7 u7 t499999 t7")], "doc_id long, text string")
    assert {(r.term, r.n) for r in decontaminate.term_frequencies(docs, terms, "text").collect()} == {("t7", 2), ("t499999", 1)}
