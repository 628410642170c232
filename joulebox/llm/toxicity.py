"""Toxicity by weak supervision.

Voters: a fixed list of insults, and lists of words and of word beginnings that
labelled texts show to go with toxic ones (document counts by hashed slot, from the
allowed labels only), dealt to several voters by hash; and two patterns.
Every voter votes toxic or clean on every document.

Label model: a latent class and, for each voter, a probability table given the
class and one other voter, its parent in a tree. EM with independent voters gives the
first accuracies; the tree is the maximum spanning tree of the voters' conditional mutual
information, which is where voters are correlated; EM with the tree gives the
final accuracies and the posterior of every vote pattern. Its input is the number of
documents of each vote pattern over the whole corpus (at most 2 ** voters rows), and how
many of them have an allowed label of either kind, which anchors the classes.

Classifier: logistic regression on hashed words and word beginnings, present or not, and on
the votes, fitted to the posteriors of a bounded number of documents, and applied to all.
The documents are chosen by stratum: those that the label model takes for toxic, others with
a list's vote, and the rest get equal shares of the bound, and a stratum within its share is
taken whole. The posterior depends on the votes alone, which are inputs, so choosing by votes
leaves it unbiased given the inputs and rows need no weights. L1 applies neither to the votes nor to
the slots of listed terms: a listed term too rare for a weight of its own counts by its list's vote.

Lists and weights are learned by hashed slot. What then counts is the words and beginnings
themselves, by 64-bit hash, that the learning texts have in the chosen slots and that go
with the same class there: so a clean word that happens to share a slot with an insult neither votes nor scores.

Edge cases: null and empty texts have no features and get the bias. If labels hold no toxic text, the lists
are empty and the fixed list alone speaks. Labels that contradict each other for one id count as toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import distinct_features, featurise, labelled_sample, train_ftrl
from .quality import TOKENS
from .tables import stage
from .textblock import LOWER, U64, Spans, blocks

BITS = 19
EPOCHS = 8
#: Bound on the labelled rows that the voters' lists come from.
MAX_LABELLED_ROWS = 30_000
#: Bound on the documents that the classifier is fitted on.
MAX_TRAINING_ROWS = 12_000
#: Bytes of the word beginnings.
BEGINNINGS = (4, 5, 6)
#: A slot is listed if this many toxic texts have it, at this many times the clean texts' rate.
LEAST_TEXTS, LEAST_RATIO = 3, 25.0
#: L1 strength for each root of the number of rows: noise in a sum of gradients grows as that root.
L1_PER_ROOT_ROW = 0.04
#: Voters that the learned terms are dealt to.
LISTS = 8
#: Common insults.
INSULTS = (
    "asshole bastard bitch clown creep cretin disgusting dumb dumbass fool garbage idiot idiotic imbecile jerk liar loser moron"
    " moronic pathetic pig retard scum shit shithead shut stupid trash ugly vermin worthless"
    " abruti connard connasse crétin débile imbécile merde pourriture salaud salope"
    " abschaum arschloch blödmann depp dreckskerl dummkopf idiotin schwachkopf trottel vollidiot"
    " basura cabrón estúpido gilipollas idiota imbécil mierda pendejo puta tonto"
).split()


def _tokens(data: np.ndarray, offs: np.ndarray) -> Spans:
    return Spans(data, offs, TOKENS, LOWER)


def _terms(t: Spans) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of all words and word beginnings of a block."""
    word = t.kind == 1
    begin, end, row = t.begin[word], t.end[word], t.row[word]
    rows, terms = [row], [t.span_hash(begin, end, 1)]
    for size in BEGINNINGS:
        long = end - begin > size
        rows.append(row[long])
        terms.append(t.span_hash(begin[long], begin[long] + size, 2 + size))
    return np.concatenate(rows), np.concatenate(terms)


def _slot(terms: np.ndarray) -> np.ndarray:
    return (terms & U64((1 << BITS) - 1)).astype(np.int64)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, 1.0): the slots of the words and word beginnings that each row of a block has."""
    row, term = _terms(_tokens(data, offs))
    row, slot, _ = distinct_features(row, _slot(term), np.ones(len(row)), BITS)
    return row, slot, np.ones(len(row))


@dataclass
class Terms:
    """Known words and beginnings: their hashes in order, a value for each, and the slots that have any."""

    keys: np.ndarray
    values: np.ndarray
    slots: np.ndarray

    def __reduce__(self) -> tuple:
        return Terms.of, (self.keys, self.values)  # tasks make the slots anew: they are many times the rest

    @staticmethod
    def of(keys: np.ndarray, values: np.ndarray) -> Terms:
        order = np.argsort(keys)
        slots = np.zeros(1 << BITS, bool)
        slots[_slot(keys)] = True
        return Terms(keys[order], values[order], slots)

    def found(self, row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in keys) of every occurrence of a known one among a block's terms."""
        maybe = self.slots[_slot(term)]
        row, term = row[maybe], term[maybe]
        at = np.minimum(np.searchsorted(self.keys, term), max(0, len(self.keys) - 1))
        known = self.keys[at] == term if len(self.keys) else np.zeros(0, bool)
        return row[known], at[known]


def _term_counts(rows: DataFrame, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, toxic, clean): the terms of rows (y, text) in the given slots, and how many texts of either class have them.

    The slots are a few hundred, so the terms are a few thousand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False) > 0.5
            for lo, hi, data, offs in blocks(batch.column(1)):
                row, term = _terms(_tokens(data, offs))
                here = slots[_slot(term)]
                pair = np.unique(np.rec.fromarrays([row[here], term[here]], names="row,term"))
                toxic = y[lo:hi][pair.row]
                yield pa.record_batch([pa.array(pair.term.view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array(1 - toxic.astype(np.int64))], ["term", "toxic", "clean"])

    each = rows.select("y", "text").mapInArrow(run, "term long, toxic long, clean long")
    got = each.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).orderBy("term").collect()
    return tuple(np.array([r[c] for r in got], np.int64) for c in ("term", "toxic", "clean"))


def _slot_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have each slot, toxic and clean (arrays of 2 ** BITS)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False) > 0.5
            for lo, hi, data, offs in blocks(batch.column(1)):
                row, slot, _ = features(data, offs)
                toxic = y[lo:hi][row]
                counts[1] += np.bincount(slot[toxic], minlength=1 << BITS)
                counts[0] += np.bincount(slot[~toxic], minlength=1 << BITS)
        full = np.flatnonzero(counts[1])
        yield pa.record_batch([pa.array(full), pa.array(counts[1][full]), pa.array(counts[0][full])], ["slot", "toxic", "clean"])
        rest = np.flatnonzero((counts[1] == 0) & (counts[0] > 0))
        yield pa.record_batch([pa.array(rest), pa.array(counts[1][rest]), pa.array(counts[0][rest])], ["slot", "toxic", "clean"])

    parts = rows.select("y", "text").mapInArrow(run, "slot long, toxic long, clean long")
    toxic, clean = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    listed = parts.groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= LEAST_TEXTS)
    for r in listed.toLocalIterator():
        toxic[r["slot"]], clean[r["slot"]] = r["toxic"], r["clean"]
    return toxic, clean


@dataclass
class Voters:
    """Term lists (a term's value is its list's number), and two patterns as the last voters."""

    terms: Terms
    number: int

    def votes(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Each row's votes as bits: bit v is 1 if voter v votes toxic."""
        t = _tokens(data, offs)
        return self.votes_of(t, *_terms(t))

    def votes_of(self, t: Spans, row: np.ndarray, term: np.ndarray) -> np.ndarray:
        """``votes`` of a block whose tokens and terms are at hand."""
        data, offs, rows = t.data, t.offs, t.rows
        row, at = self.terms.found(row, term)
        out = np.zeros(rows, np.int64)
        np.bitwise_or.at(out, row, np.left_shift(1, self.terms.values[at]))
        marks = np.diff(np.concatenate([[0], np.cumsum(data == 33)])[offs])
        short = np.flatnonzero(t.end - t.begin <= 5)
        you = short[np.isin(t.span_hash(t.begin[short], t.end[short], 9), _hashes(["you", "your", "youre", "du", "tu", "toi", "vous"], 9))]
        out |= (marks >= 3).astype(np.int64) << (self.number - 2)
        out |= (np.bincount(t.row[you], minlength=rows) >= 2).astype(np.int64) << (self.number - 1)
        return out


def _hashes(words: list[str], salt: int) -> np.ndarray:
    raw = [w.encode() for w in words]
    offs = np.concatenate([[0], np.cumsum([len(w) for w in raw])])
    return Spans(np.frombuffer(b"".join(raw), np.uint8), offs, TOKENS, LOWER).span_hash(offs[:-1], offs[1:], salt)


def learn_voters(rows: DataFrame) -> Voters:
    """Voters from labelled rows (y, text)."""
    n = rows.agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).first()
    n_toxic, n_clean = float(n["t"] or 0), float(n["n"] - (n["t"] or 0))

    def telling(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
        odds = (toxic + 0.5) / max(1.0, n_toxic) / ((clean + 0.5) / max(1.0, n_clean))
        return (toxic >= LEAST_TEXTS) & (odds >= LEAST_RATIO)

    # a slot may hold a telling term beside common ones, so slots are chosen by their toxic texts alone
    toxic, _ = _slot_counts(rows)
    term, toxic, clean = _term_counts(rows, toxic >= LEAST_TEXTS)
    good = telling(toxic, clean)
    keys = np.concatenate([term[good].view(U64), _hashes(INSULTS, 1)])
    lists = np.concatenate([1 + term[good] % LISTS, np.zeros(len(INSULTS), np.int64)])
    # a term of the fixed list keeps its place there
    keys, first = np.unique(keys[::-1], return_index=True)
    return Voters(Terms.of(keys, lists[::-1][first]), 1 + LISTS + 2)


@dataclass
class LabelModel:
    prior: float
    parent: list[int]
    #: table[v][class, parent's vote] = probability that v votes toxic
    table: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of toxic for rows of votes (n x voters)."""
        logs = np.empty((len(votes), 2))
        for y, p in ((0, 1 - self.prior), (1, self.prior)):
            logs[:, y] = np.log(p)
            for v, q in enumerate(self.parent):
                one = self.table[v][y, votes[:, q] if q >= 0 else 0]
                logs[:, y] += np.log(np.where(votes[:, v] == 1, one, 1 - one))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))


def _tables(votes: np.ndarray, mass: tuple[np.ndarray, np.ndarray], parent: list[int]) -> np.ndarray:
    out = np.empty((votes.shape[1], 2, 2))
    for v, q in enumerate(parent):
        for y in (0, 1):
            for u in (0, 1):
                here = mass[y] * ((votes[:, q] == u) if q >= 0 else 1)
                # a prior of two documents: toxic voters vote toxic more often on toxic texts
                out[v][y, u] = ((here * votes[:, v]).sum() + (0.2, 0.8)[y] * 2) / (here.sum() + 2)
    return np.clip(out, 1e-6, 1 - 1e-6)


def _dependence(votes: np.ndarray, mass: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Mutual information of each two voters given the class."""
    n = votes.shape[1]
    out = np.zeros((n, n))
    total = mass[0].sum() + mass[1].sum()
    for own in mass:
        whole = own.sum()
        if whole <= 0:
            continue
        for i in range(n):
            for j in range(i):
                for a in (0, 1):
                    for b in (0, 1):
                        ab = own[(votes[:, i] == a) & (votes[:, j] == b)].sum() / whole
                        a_, b_ = own[votes[:, i] == a].sum() / whole, own[votes[:, j] == b].sum() / whole
                        if ab > 0:
                            out[i, j] += whole / total * ab * np.log(ab / (a_ * b_))
                out[j, i] = out[i, j]
    return out


def _tree(dependence: np.ndarray) -> list[int]:
    """Each voter's parent in the maximum spanning tree (-1: the root)."""
    n = len(dependence)
    parent, inside = [-1] * n, {0}
    while len(inside) < n:
        gain, v, q = max((dependence[v, q], -v, q) for v in range(n) if v not in inside for q in inside)
        parent[-v] = q
        inside.add(-v)
    return parent


def fit_label_model(
    patterns: np.ndarray, counts: np.ndarray, number: int, toxic: np.ndarray | None = None, clean: np.ndarray | None = None, rounds: int = 60
) -> LabelModel:
    """EM over the distinct vote patterns and how many documents have each.

    ``toxic`` and ``clean`` are how many of them have an allowed label: those are of their
    class with certainty, which keeps the latent class from settling on one language's voters.
    """
    votes = (patterns[:, None] >> np.arange(number)) & 1
    toxic = np.zeros(len(counts)) if toxic is None else toxic.astype(float)
    clean = np.zeros(len(counts)) if clean is None else clean.astype(float)
    open_ = np.maximum(0.0, counts - toxic - clean)
    post = np.where(votes[:, : number - 2].any(axis=1), 0.9, 0.02)
    parent = [-1] * number
    model = None
    for stage_ in range(2):
        for _ in range(rounds):
            mass = (open_ * (1 - post) + clean, open_ * post + toxic)
            prior = float(np.clip(mass[1].sum() / max(1.0, mass[0].sum() + mass[1].sum()), 1e-6, 1 - 1e-6))
            model = LabelModel(prior, parent, _tables(votes, mass, parent))
            post = model.posterior(votes)
        if stage_ == 0:
            parent = _tree(_dependence(votes, mass))
    return model


def labelled_patterns(rows: DataFrame, voters: Voters, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(toxic, clean): how many rows (y, text) of either label have each of ``patterns``."""
    out = []
    for condition in ("y > 0.5", "y <= 0.5"):
        seen, n = vote_patterns(rows.where(condition), voters, "text")
        by = dict(zip(seen.tolist(), n.tolist(), strict=True))
        out.append(np.array([by.get(x, 0) for x in patterns.tolist()], np.int64))
    return out[0], out[1]


def vote_patterns(docs: DataFrame, voters: Voters, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct vote patterns of all documents, and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << voters.number, np.int64)
        for batch in batches:
            for _, _, data, offs in blocks(batch.column(0)):
                seen += np.bincount(voters.votes(data, offs), minlength=1 << voters.number)
        full = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(full), pa.array(seen[full])], ["pattern", "n"])

    each = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "pattern long, n long")
    got = each.groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    return np.array([r["pattern"] for r in got], np.int64), np.array([r["n"] for r in got], np.int64)


@dataclass
class Classifier:
    """Weights by term, a bias, and the voters with a weight for each."""

    terms: Terms
    bias: float
    voters: Voters
    vote_weights: np.ndarray


def stratum_rates(counts: np.ndarray, stratum: np.ndarray, max_rows: int) -> np.ndarray:
    """The share of documents to take of each vote pattern: equal shares of ``max_rows`` by stratum, what one leaves goes to larger ones."""
    sizes = np.bincount(stratum, weights=counts)
    rate, left = np.zeros(len(sizes)), float(max_rows)
    order = np.argsort(sizes, kind="stable")
    for i, k in enumerate(order.tolist()):
        rate[k] = min(1.0, left / (len(order) - i) / max(1.0, sizes[k]))
        left -= rate[k] * sizes[k]
    return rate[stratum]


def fit(
    docs: DataFrame, labels: DataFrame, allowed, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    max_labelled: int = MAX_LABELLED_ROWS, max_rows: int = MAX_TRAINING_ROWS,
) -> Classifier:
    """The classifier; labels are read for the ids that ``allowed`` admits only."""
    own = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    known = stage(labelled_sample(own, labels, label, allowed, max_labelled, id_col), "labelled-texts")
    voters = learn_voters(known)
    patterns, counts = vote_patterns(docs, voters, text_col)
    if not len(patterns):
        return Classifier(Terms.of(np.zeros(0, U64), np.zeros(0)), 0.0, voters, np.zeros(voters.number))
    model = fit_label_model(patterns, counts, voters.number, *labelled_patterns(known, voters, patterns))
    posterior = model.posterior((patterns[:, None] >> np.arange(voters.number)) & 1)
    listed = patterns & ((1 << voters.number - 2) - 1) > 0
    least = np.zeros(1 << voters.number)
    least[patterns] = stratum_rates(counts, np.where(posterior >= 0.5, 2, listed.astype(np.int64)), max_rows) * (1 << 20)
    place = F.pmod(F.xxhash64(id_col, F.lit(13)), F.lit(1 << 20))
    chosen = own.select(id_col, F.coalesce("text", F.lit("")).alias("text"), place.alias("place")).where(F.col("place") < float(least.max()))

    def soften(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column(1)):
                votes = voters.votes(data, offs)
                here = batch.column(2).slice(lo, hi - lo).to_numpy() < least[votes]
                post = model.posterior((votes[here, None] >> np.arange(voters.number)) & 1)
                doc, text = (batch.column(i).slice(lo, hi - lo).filter(pa.array(here)) for i in (0, 1))
                yield pa.record_batch([doc, text, pa.array(post)], ["doc", "text", "y"])

    first = (1 << BITS) - voters.number  # the last slots are the votes'; terms that fall there have no weight

    def with_votes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, slot, _ = features(data, offs)
        below = slot < first
        voted, voter = np.nonzero((voters.votes(data, offs)[:, None] >> np.arange(voters.number)) & 1)
        row, slot = np.concatenate([row[below], voted]), np.concatenate([slot[below], first + voter])
        return row, slot, np.ones(len(row))

    kind = docs.schema[id_col].dataType.simpleString()
    soft = stage(chosen.mapInArrow(soften, f"doc {kind}, text string, y double"), "soft-labels")
    l1 = L1_PER_ROOT_ROW * float(min(max_rows, counts.sum())) ** 0.5
    free = np.union1d(_slot(voters.terms.keys), np.arange(first, 1 << BITS))
    w = train_ftrl(featurise(soft, with_votes, BITS), BITS, EPOCHS, alpha=1.0, l1=l1, l2=0.01, free=free)
    bias, votes, w = float(w[-1]), w[first:-1].copy(), w[:-1]
    w[first:] = 0
    term, toxic, clean = _term_counts(soft, w != 0)
    weight = w[_slot(term.view(U64))]
    agree = np.where(weight > 0, toxic >= clean, clean >= toxic)
    return Classifier(Terms.of(term[agree].view(U64), weight[agree]), bias, voters, votes)


def toxicity_scores(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, score in 0 to 1: the logistic function of the weights of the terms and votes that a text has."""
    kind = docs.schema[id_col].dataType.simpleString()
    terms, bias, voters = model.terms, model.bias, model.voters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in blocks(batch.column(1)):
                t = _tokens(data, offs)
                row, term = _terms(t)
                votes = (voters.votes_of(t, row, term)[:, None] >> np.arange(voters.number)) & 1
                row, at = terms.found(row, term)
                pair = np.unique(row * max(1, len(terms.keys)) + at)
                row, at = np.divmod(pair, max(1, len(terms.keys)))
                total = bias + votes @ model.vote_weights + np.bincount(row, weights=terms.values[at], minlength=hi - lo)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))], [id_col, "score"])

    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"{id_col} {kind}, score double")
