"""Centroid clustering, archives and the divergence audit against brute force."""

import hashlib
import io
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from joulebox.llm import bundles, centroids, divergence
from joulebox.session import scratch_path


def brute_clusters(rows, k, rounds, width, scale):
    """Plain k-means of (id, vector) rows in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    own = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(own)) for _, v in kept]

    for _ in range(rounds):
        to = assign()
        for j in range(len(own)):
            of = [v for (_, v), (_, c) in zip(kept, to, strict=True) if c == j]
            if of:
                own[j] = [sum(x) // len(of) for x in zip(*of, strict=True)]
    to = assign()
    total = sum(d for d, _ in to)
    each = {j: sum(d for d, c in to if c == j) for j in range(len(own))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in own]
    top = (1 << 63) - 1
    return sorted((i, c, min(d, top), min(each[c], top), min(total, top), digest[c]) for (i, _), (d, c) in zip(kept, to, strict=True))


def test_clusters_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 5, 1) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, [0.0] * 8) for i in range(200)]  # one vector in two fifths of the rows: ties
    rows += [(7, [1.0] * 8), (7, [1.0] * 8), (None, [1.0] * 8), (2000, None), (2001, []), (2002, [1.0] * 9), (2003, [None] + [1.0] * 7)]
    rows += [(2004, [float("nan")] * 8), (2005, [float("inf")] * 8), (2006, [-0.001] * 8)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, n string")
    for k, rounds in ((16, 3), (3, 0), (1, 1)):
        got = sorted(map(tuple, centroids.cluster(df, k=k, rounds=rounds, width=8).collect()))
        assert got == brute_clusters(rows, k, rounds, 8, 64)
    few = df.where("vec_id in (3, 4, 2000)")
    assert sorted(map(tuple, centroids.cluster(few, width=8).collect())) == brute_clusters([r for r in rows if r[0] in (3, 4)], 16, 3, 8, 64)
    empty = centroids.cluster(df.limit(0), width=8)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_beyond_64_bits(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1.0, -1.0]) * 10 ** rng.uniform(0, 16) for _ in range(4)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, centroids.cluster(df, k=5, rounds=2, width=4).collect()))
    assert got == brute_clusters(rows, 5, 2, 4, 64)


def test_search_rejects_most_centroids_and_stays_exact():
    rng = np.random.default_rng(2)
    middle = rng.integers(-2000, 2000, (200, 1))
    own = middle + rng.integers(-50, 50, (200, 32))
    m = middle[rng.integers(0, 200, 3000)] + rng.integers(-60, 60, (3000, 32))
    own[17] = own[3]  # a tie between two centroids
    count = {}
    who, far = centroids.Centroids(own).nearest(m, count)
    all_far = ((m[:, None, :] - own[None, :, :]) ** 2).sum(axis=2)
    assert (far == all_far.min(axis=1)).all() and (who == all_far.argmin(axis=1)).all()
    assert count["exact"] < 0.1 * all_far.size


def brute_audit(rows, least, top):
    """All sums over all kept terms of (lang, source, text) rows, term by term."""
    docs = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = [t for t in df if df[t] >= least]
        count = defaultdict(Counter)
        for _, source, words in own:
            count[source].update({t: words[t] for t in kept if words[t]})
        whole = sum(count.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def ranked(source, part, values):
            best = sorted(values, key=lambda x: (-x[1], x[0].encode()))
            out.update((lang, source, part, item, v, r) for r, (item, v) in enumerate(best, 1) if part == "pair" or r <= top)

        for g in list(count):
            p = {t: share(count[g], t) for t in kept}
            others = {h: {t: share(count[h], t) for t in kept} for h in count if h != g}
            ranked(g, "pair", [(h, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)) for h, q in others.items()])
            q = {t: share(whole, t) for t in kept}
            ranked(g, "term", [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if count[g][t] and p[t] > q[t]])
    return out


def test_audit_against_brute_force(spark):
    rng = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "délta", "Étà", "日本", "x", "rare"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = []
    for i in range(400):
        source = f"s{rng.choice([0, 0, 0, 1, 2, 3, 4])}"
        rows.append((rng.choice(["en", "en", "de"]), source, " ".join(rng.choice(words[: 20 + 20 * int(source[1])]) + rng.choice(["", ".", "_", "9"]) for _ in range(rng.randrange(40)))))
    rows += [("en", "s0", "one copy of many")] * 150 + [(None, None, None), ("", "", "a b"), ("fr", "only", "seul"), ("xx", "a", ""), ("xx", "b", None), ("xx", "c", "12 _ -")]
    rows += [("en", "long", "beta " * 60000 + "y" * 100000), ("en", "s9\n", "Alpha\x00beta\nGAMMA\x7fdélta")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, c long, rank int").repartition(5)
    for entries in (50, divergence.BLOCK_ENTRIES):  # many runs, or one a task
        got = divergence.audit(df, top=7, block_entries=entries)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        found = [tuple(r) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == brute_audit(rows, 3, 7)
    assert divergence.audit(df.limit(0)).count() == 0
    one = [("en", "s", "w w w")] * 3
    assert {tuple(r) for r in divergence.audit(spark.createDataFrame(one, "lang string, source string, text string")).collect()} == brute_audit(one, 3, 200)


def test_runs_are_sorted_and_merge_in_order():
    rng = random.Random(4)
    words = ["", "b", "é", "zz" * 30, "A", "a"]
    docs = [(rng.choice("xy"), rng.choice("pqr"), " ".join(rng.choices(words, k=5))) for _ in range(200)]
    pieces = []
    for lo in range(0, 200, 23):
        block = divergence.Block()
        for d in docs[lo : lo + 23]:
            block.add(*d)
        pieces += [p for p in block.pieces(3)]
    want = defaultdict(lambda: [0, 0])
    for lang, source, text in docs:
        for t, n in Counter(divergence.terms(text)).items():
            want[lang, t, source][0] += n
            want[lang, t, source][1] += 1
    got = defaultdict(lambda: [0, 0])
    for shard in range(3):
        own = sorted((p for p in pieces if p[0] == shard), key=lambda p: (p[1], p[2]))
        keys = []
        for (lang, term), postings in divergence.merge_pieces(((p[1], p[2]), divergence.unpack_piece(p[3], p[4])) for p in own):
            keys.append((lang, term))
            for source, n, m in postings:
                got[lang, term, source][0] += n
                got[lang, term, source][1] += m
        assert keys == sorted(keys)
    assert {k: v for k, v in got.items() if k[1]} == want


def test_large_counts_stay_exact():
    count, of = np.array([0, 10**12, 9 * 10**9]), np.array([10**13, 10**13, 10**11])
    assert divergence.shares(count, of).tolist() == [1 + 10**9 * (c + 1) // n for c, n in zip(count.tolist(), of.tolist(), strict=True)]


def brute_archive(rows, least=1000):
    groups = defaultdict(list)
    for number, _, html in rows:
        groups[html or ""].append(number)
    out = []
    for number, _, html in rows:
        body = (html or "").encode()
        known = [n for n in groups[html or ""] if n is not None]
        to = max(known) if len(body) >= least and known and number != max(known) else None
        out.append((number, len(body), hashlib.sha1(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_archive_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, f"http://h{i}/", "<p>" + "".join(rng.choices("abé 日\r\n", k=rng.randrange(2500)))) for i in range(150)]
    rows += [(1000 + i, "http://hot/", "same page " * 200) for i in range(300)] + [(2000 + i, None, "pair" * 400 + str(i // 2)) for i in range(40)]
    rows += [(5, None, None), (6, "x\r\nWARC-Type: revisit", ""), (7, "u", "a" * 999), (8, "u", "a" * 999), (9, "u", "é" * 500), (10, "u", "é" * 500)]
    rows += [(None, "u", "same page " * 200), (None, None, "nobody" * 300), (None, None, "nobody" * 300), (3000, "r", "twice" * 300), (3000, "r", "twice" * 300)]
    rows += [(4000, "long", "WARC/1.1\r\n\r\n" * 200000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, kept string, n long").repartition(3)
    path = scratch_path(spark, "warc-test")
    index = bundles.write_bundles(df, path, frame_bytes=5000, bundle_bytes=60000)
    assert index.count() == len(rows) and index.select("archive").distinct().count() > 3
    got = bundles.digests(bundles.read_records(spark, path))
    assert sorted(map(tuple, got.collect()), key=str) == brute_archive(rows)
    whole = {(r.id, bytes(r.payload).decode(), r.url) for r in bundles.read_records(spark, path, payloads=True).where("payload is not null").collect()}
    answers = {r[0]: r for r in brute_archive(rows)}
    assert {w[0] for w in whole} == {r[0] for r in brute_archive(rows) if r[3] == "response"} and (6, "", "x%0D%0AWARC-Type: revisit") in whole
    # by id: revisits are resolved, only named frames are read
    some = [1000, 1007, 2000, 2001, 5, 3000, 4000, 77, 123456]
    found = {r.id: bytes(r.payload).decode() for r in bundles.fetch(spark, path, spark.createDataFrame([(i,) for i in some], "page_id long")).collect()}
    assert found == {n: h or "" for n, _, h in rows if n in some} and answers[1000][4] == 1299
    # any Zstandard reader sees plain WARC
    name = index.select("archive").first()[0].removeprefix("file:")
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open("/" + name.lstrip("/"), "rb").read()), read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1\r\n") and plain.endswith(b"\r\n\r\n")
    empty = bundles.archive(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_files_of_failed_attempts_are_not_part_of_the_archive(spark):
    df = spark.createDataFrame([(i, "u", "x" * i) for i in range(20)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-orphans")
    local = "/" + path.removeprefix("file:").lstrip("/") + "/bundles"
    import os

    os.makedirs(local)
    with open(f"{local}/part-000000-lost.warc.zst", "wb") as f:
        f.write(b"half a fra")
    bundles.write_bundles(df, path)
    assert not os.path.exists(f"{local}/part-000000-lost.warc.zst") and bundles.read_records(spark, path).count() == 20
    victim = next(f"{local}/{n}" for n in sorted(os.listdir(local)) if n.endswith(".zst"))
    data = bytearray(open(victim, "rb").read())
    data[len(data) // 2 if len(data) < 200 else 60] ^= 0xFF
    open(victim, "wb").write(data)
    with pytest.raises(Exception, match="damaged|decompress|digest|record"):
        bundles.read_records(spark, path).collect()
