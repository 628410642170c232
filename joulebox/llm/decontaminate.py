"""Benchmark decontamination with a distributed positional inverted index.

1. ``term_frequencies``: how often each benchmark term occurs in the corpus.
2. ``anchors``: each benchmark window is searched from its rarest term. Windows
   in a row with the same rarest term occurrence share one anchor.
3. ``build_index``: one pass over the corpus stores, for anchor terms, postings
   (row, position) with the neighbouring terms up to the window's width, so that
   the lists of the other terms can be intersected by offset where the posting
   lies, without moving the frequent terms' lists.
4. ``phrase_matches`` / ``proximity_matches``: postings meet anchors by term;
   the offset-adjusted neighbours are intersected, first the adjacent ones, then
   all of the window.

Only the postings of rare terms are shuffled, with partial aggregation before
every other shuffle. A frequent passage makes its rare terms frequent too; such
a term's postings are then joined by a join that Spark may split. No step uses
Python on the executors.

Words: A-Z in lower case, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.

Edge cases: null or empty texts and items have no words: such a document is
clean, such an item never occurs. An item of fewer than ``width`` words is one
window. Items with equal ids count once; an item whose id is null hits words but
is not listed. Repeated document rows are judged one by one. Extra columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bits
from .tables import stage

WIDTH = 10
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Largest filter of benchmark terms that travels with a query, in bits (4 MB: 16 bits for each of two million terms).
#: With more terms more of the documents' other words pass it, up to all of them: the cost grows, the result is the same.
MAX_FILTER_BITS = 1 << 25


def words_of(text: Column) -> Column:
    """Words of a text in order; none for null."""
    t = F.coalesce(text, F.lit(""))
    plain = F.octet_length(t) == F.char_length(t)
    low = F.when(plain, F.lower(t)).otherwise(F.translate(t, UPPER, SMALL))
    return F.array_remove(F.split(low, BREAKS), "")


def _term_filter(terms: DataFrame) -> tuple[list[int], int]:
    """A one-hash filter of the distinct terms with about 16 bits each, up to MAX_FILTER_BITS."""
    n_bits = 1 << 10
    n = terms.count()
    while n_bits < 16 * n and n_bits < MAX_FILTER_BITS:
        n_bits *= 2
    return bits.fill(terms, F.col("term"), 0, n_bits, 1), n_bits


def item_windows(benchmark: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, words, start, size): every window of every item."""
    items = benchmark.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("item", F.xxhash64("item_id", "words"))
    size = F.least(F.lit(width), F.size("words"))
    return items.withColumn("size", size).withColumn(
        "start", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size")))
    )


def term_frequencies(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """(term, n): occurrences of each of ``terms`` (column term) in all documents."""
    words, n_bits = _term_filter(terms)
    each = docs.select(F.explode(words_of(F.col(text_col))).alias("term"))
    counted = each.where(bits.holds(words, F.col("term"), 0, n_bits, 1)).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return terms.join(counted, "term")


def anchors(windows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(term, item, item_id, at, first, last, size, near, near_from): windows by their rarest term.

    Windows with a term that never occurs are left out: they match nowhere.
    """
    slots = windows.select(
        "item", "item_id", "words", "size", "start", F.posexplode(F.expr("slice(words, start + 1, size)")).alias("k", "term")
    )
    rarest = (
        slots.join(frequencies, "term", "left")
        .groupBy("item", "item_id", "words", "size", "start")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (F.col("start") + F.col("k")).alias("at"), "term")).alias("r"))
        .where("r.n > 0")
    )
    each = rarest.groupBy("item", "item_id", "words", "size", F.col("r.at").alias("at"), F.col("r.term").alias("term")).agg(
        F.min("start").alias("first"), F.max("start").alias("last")
    )
    return each.select("term", "item", "item_id", "at", "first", "last", "size", "words")


def build_index(docs: DataFrame, terms: DataFrame, width: int, text_col: str, keep: list[str]) -> DataFrame:
    """One stored row per document: row, ``keep`` columns, n_words and its postings of ``terms``.

    A posting is (term, at, near_from, near): near are the words around the position, up to
    ``width`` - 1 on either side, from position near_from on.
    """
    words, n_bits = _term_filter(terms)
    reach = width - 1
    at = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: bits.holds(words, F.get(F.col("words"), i), 0, n_bits, 1),
    )

    def posting(i: Column) -> Column:
        since = F.greatest(i - F.lit(reach), F.lit(0))
        return F.struct(
            F.get(F.col("words"), i).alias("term"),
            i.alias("at"),
            since.alias("near_from"),
            F.slice(F.col("words"), since + 1, i - since + F.lit(width)).alias("near"),
        )

    stored = docs.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(c) for c in keep], words_of(F.col(text_col)).alias("words")
    ).select(
        "row",
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.when(F.size("words") > 0, F.transform(at, posting)).alias("postings"),
    )
    return stage(stored, "token-postings")


def _candidates(index: DataFrame, found: DataFrame) -> DataFrame:
    """Postings beside the anchors of their term."""
    posts = index.select("row", F.explode("postings").alias("p")).select("row", "p.*")
    return posts.join(found, "term")


def phrase_matches(index: DataFrame, found: DataFrame) -> DataFrame:
    """(row, item, item_id, begin, end): stretches of words inside exact occurrences of windows.

    The windows of one anchor that occur around one posting overlap there, so
    they form one stretch.
    """
    near = F.col("near")
    shift = F.col("at_doc") - F.col("at") - F.col("near_from")
    left = F.get(near, F.col("at_doc") - 1 - F.col("near_from")).eqNullSafe(F.get("words", F.col("at") - 1))
    right = F.get(near, F.col("at_doc") + 1 - F.col("near_from")).eqNullSafe(F.get("words", F.col("at") + 1))
    low = F.greatest(F.col("first"), -shift)

    def occurs(s: Column) -> Column:
        return F.slice(near, s + shift + 1, F.col("size")) == F.slice(F.col("words"), s + 1, F.col("size"))

    cand = _candidates(index.select("row", F.transform("postings", lambda p: p.withField("at_doc", p["at"]).dropFields("at")).alias("postings")), found)
    tested = cand.where((F.col("size") == 1) | left | right).where(low <= F.col("last"))
    starts = tested.withColumn("starts", F.filter(F.sequence(low, F.col("last")), occurs)).where(F.size("starts") > 0)
    base = F.col("at_doc") - F.col("at")
    return starts.select(
        "row",
        "item",
        "item_id",
        (F.array_min("starts") + base).alias("begin"),
        (F.array_max("starts") + base + F.col("size")).alias("end"),
    )


def proximity_matches(index: DataFrame, found: DataFrame, slop: int) -> DataFrame:
    """(row, item, item_id, start, at): windows all of whose terms occur within ``slop`` words of
    the rarest one, in any order; ``slop`` may not exceed the stored width - 1."""
    index = index.select("row", F.transform("postings", lambda p: p.withField("at_doc", p["at"]).dropFields("at")).alias("postings"))
    cand = _candidates(index, found)
    since = F.greatest(F.col("at_doc") - F.lit(slop), F.lit(0))
    around = F.slice(F.col("near"), since - F.col("near_from") + 1, F.col("at_doc") - since + 1 + F.lit(slop))
    each = cand.withColumn("start", F.explode(F.sequence("first", "last"))).withColumn("around", around)
    every = F.size(F.array_except(F.slice(F.col("words"), F.col("start") + 1, F.col("size")), F.col("around"))) == 0
    return each.where(every).select("row", "item", "item_id", "start", F.col("at_doc").alias("at"))


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    keep: list[str] | None = None,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(index, matches): the stored index with one row per document, and its phrase matches."""
    windows = stage(item_windows(benchmark, width, item_id_col, item_text_col), "benchmark-windows")
    terms = windows.select(F.explode("words").alias("term")).distinct()
    seen = stage(term_frequencies(docs, terms, text_col), "benchmark-terms")
    found = stage(anchors(windows, seen), "benchmark-anchors")
    index = build_index(docs, found.select("term").distinct(), width, text_col, keep or [])
    return index, phrase_matches(index, found)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, keep: list[str] | None = None, **cols) -> DataFrame:
    """Per document: row, ``keep`` columns, n_words, n_hit, items (ids as strings, sorted), contaminated."""
    index, matches = search(docs, benchmark, width, keep, **cols)
    spans = F.array_sort(F.collect_list(F.struct("begin", "end")))
    covered = F.aggregate(
        F.col("spans"),
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["upto"], x["end"]).alias("upto"),
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["upto"], x["begin"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    hit = (
        matches.groupBy("row")
        .agg(spans.alias("spans"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
        .select("row", covered.alias("n_hit"), "items")
    )
    none = F.array().cast("array<string>")
    return index.drop("postings").join(hit, "row", "left").select(
        "row",
        *(keep or []),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
