import random

import __spark_entry__
import corpus_pipeline
from joulebox.llm import near_copies, pieces
from joulebox.llm.queries import ORACLES, QUERIES
from joulebox.llm.tables import stage

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, c0 int, row int, `found` string"


def tables(spark, path):
    rnd = random.Random(8)
    en = ["the", "and", "with", "river", "stone", "house", "there", "would", "from", "this"]
    de = ["der", "und", "nicht", "schön", "haus", "über", "auch", "noch", "ist", "groß"]
    text = lambda words, n: " ".join(rnd.choice(words) + str(rnd.choice(["", "s", "en", "er"])) for _ in range(n))
    docs = [(i, text(en if i % 2 else de, 60), "en" if i % 2 else "de") for i in range(60)]
    item = text(en, 30)
    docs += [(100, docs[1][1], "en"), (101, docs[1][1] + " end", "en"), (102, f"{text(en, 20)} {item}", "en")]
    docs += [(103, text(en, 40) + " mail me a.b@c.org now", "en"), (104, None, "en"), (105, "", "en"), (106, "1234 !!", "de"), (107, text(en, 40), None)]
    docs += [(2, docs[2][1], "de"), (None, text(de, 50), "de")]
    rows = [(i, t, l, "s", len(t or ""), 1, 2, "z") for i, t, l in docs]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs


def test_stages_take_effect(spark, tmp_path):
    docs = tables(spark, str(tmp_path))
    here = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = here.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        here = stage(step(spark, here, str(tmp_path)), f"test-{name}")
        assert here.columns == names
    got = here.collect()
    want = {i for i, _, _ in docs} - {100, 101, 102, 104, 105, 106}
    assert {r.doc_id for r in got} == want and len(got) == len(want)
    texts = {r.doc_id: r.text for r in got}
    assert texts[103].endswith(" mail me <email> now") and all(texts[i] == t for i, t, _ in docs if i in want and i != 103)
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert last.columns == ["doc_id", "lang", "source", "n_pieces", "ids"]
    back = pieces.decode(last, pieces.load_vocabulary(pieces.MODEL_PATH)).collect()
    assert {r.doc_id: r.text for r in back} == texts


def test_texts_of_three_languages_and_tables_without_languages_stay(spark):
    rnd = random.Random(3)
    own = {
        "en": ["the", "and", "with", "river", "stone", "house", "there", "would"],
        "de": ["der", "und", "nicht", "schön", "haus", "über", "auch", "noch"],
        "es": ["el", "pero", "años", "niño", "casa", "también", "donde", "ella"],
    }
    rows = [(i, " ".join(rnd.choices(own[lang], k=40)), lang) for i in range(120) for lang in [["en", "de", "es"][i % 3]]]
    mixed = " ".join(" ".join(rnd.choices(words, k=15)) for words in own.values())
    rows += [(500, mixed, None), (501, "12 34", None), (502, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.keep_languages(spark, df, "").collect()}
    assert kept == {r[0] for r in rows} - {501, 502}
    bare = df.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.doc_id for r in corpus_pipeline.keep_languages(spark, bare, "").collect()} == kept


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_names():
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert near_copies.THRESHOLD == 0.8 and near_copies.SHINGLE == 5
