"""Toxicity: a lexicon trie met by Levenshtein automata, and context windows around each hit.

The lexicon is learned: words, and stems of words, that stand in toxic texts
many times as often as in clean ones. The trie of its terms and the automata of
all terms are run as one machine whose states are sets of (trie node, edits);
states are built when a word first reaches them. A word within the edits
allowed for a term's length is a hit, unless clean texts use that very word. A
window around each hit tells quotation and report from address. A logistic
model over the sums of the hits gives the score.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.llm.languages import held_out
from modelweave.llm.tokens import pieces, tidy
from modelweave.plans.workspace import scratch, store

THRESHOLD = 0.7
SUPPORT = 3  # toxic texts that hold a term, at least
SIGNIFICANCE = 10.83  # log likelihood ratio of the counts of a term, at least: one in a thousand by chance
ODDS = 20.0  # how many times as often as in clean texts
SAMPLE = 100_000  # labelled rows the logistic model is fitted on
WINDOW = 8
_STEMS = (4, 6)
_STRIP = string.punctuation + "«»“”„‘’…¿¡–—"
# fixed values: marks and words of quotation and of address
_QUOTES = "\"“”„«»"
_REPORT = frozenset("said says wrote writes called quoted quote reported claimed dit écrit sagte schrieb dijo escribió citó".split())
_ADDRESS = frozenset("you your you're ur u tu toi vous ton ta du dich dein deine sie usted tú tus".split())
FEATURES = 9


def clean_word(word: str) -> str:
    return word.strip(_STRIP)


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


@dataclass
class Machine:
    """All Levenshtein automata of the terms, intersected with their trie; built state by state."""

    terms: list[str]
    stems: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.limit, self.end, self.stem = [0], [-1], [False]
        for term, is_stem in [(t, False) for t in self.terms] + [(s, True) for s in self.stems]:
            node, allowed = 0, 0 if is_stem else edits_allowed(term)
            self.limit[0] = max(self.limit[0], allowed)
            for c in term:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.limit.append(0)
                    self.end.append(-1)
                    self.stem.append(False)
                node = self.next[node][c]
                self.limit[node] = max(self.limit[node], allowed)
            if is_stem:
                self.stem[node] = True
            else:
                self.end[node] = max(self.end[node], allowed)
        self._reset()

    def _reset(self) -> None:
        self._of: dict[frozenset, int] = {frozenset(): 0}
        self._states: list[frozenset] = [frozenset()]
        self._moves: list[dict[str, int]] = [{}]
        self._found: list[tuple[int, bool]] = [(-1, False)]
        self._start = self._number(self._closed({0: 0}))

    def _closed(self, reached: dict[int, int]) -> frozenset:
        """With the nodes reached by leaving out letters of a term."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            for child in self.next[node].values():
                edits = reached[node] + 1
                if edits <= self.limit[child] and edits < reached.get(child, 99):
                    reached[child] = edits
                    todo.append(child)
        return frozenset(reached.items())

    def _number(self, state: frozenset) -> int:
        if state not in self._of:
            self._of[state] = len(self._states)
            self._states.append(state)
            self._moves.append({})
            ends = [e for n, e in state if self.end[n] >= e]
            self._found.append((min(ends, default=-1), any(self.stem[n] and e == 0 for n, e in state)))
        return self._of[state]

    def _step(self, at: int, c: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.limit[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self._states[at]:
            reach(node, edits + 1)
            for letter, child in self.next[node].items():
                reach(child, edits + (letter != c))
        # a stem's nodes allow no edit of their own
        to = self._number(self._closed(reached))
        self._moves[at][c] = to
        return to

    def edits(self, word: str) -> int:
        """Fewest edits to a term, 0 too where a stem begins the word; -1 if none is near enough."""
        if len(self._states) > 200_000:
            self._reset()
        at = self._start
        for c in word:
            to = self._moves[at].get(c)
            at = self._step(at, c) if to is None else to
            if not at:
                return -1
            if self._found[at][1]:
                return 0
        return self._found[at][0]


@dataclass
class Model:
    terms: list[str]
    stems: list[str]
    spared: list[str]
    weights: np.ndarray | None = None


class Reader:
    """Features of whole texts; what a word is gets remembered, within bounds."""

    def __init__(self, model: Model) -> None:
        self.machine = Machine(model.terms, model.stems)
        self.spared = frozenset(model.spared)
        self.hits: dict[str, int] = {}
        self.passed: set[str] = set()

    def _look(self, raw: str) -> None:
        word = clean_word(raw)
        edits = self.machine.edits(word) if 3 <= len(word) <= 64 else -1
        if edits > 0 and word in self.spared:
            edits = -1
        if edits >= 0:
            self.hits[raw] = edits
        else:
            self.passed.add(raw)

    def features(self, text: str | None) -> list[float]:
        words = (text or "").lower().split()
        different = set(words)
        if len(self.passed) + len(self.hits) > 300_000:
            self.passed.clear()
            self.hits.clear()
        for w in different - self.passed:
            if w not in self.hits:
                self._look(w)
        if not words or different.isdisjoint(self.hits):
            return [0.0] * FEATURES
        places = [i for i, w in enumerate(words) if w in self.hits]
        exact = near = quoted = addressed = 0
        kinds = set()
        for i in places:
            around = words[max(0, i - WINDOW) : i]
            behind = words[i + 1 : i + 1 + WINDOW]
            own = words[i]
            opened = any(q in w for w in around for q in _QUOTES) or own[0] in _QUOTES
            closed = any(q in w for w in behind for q in _QUOTES) or own[-1] in _QUOTES
            told = any(clean_word(w) in _REPORT for w in around[-4:])
            if (opened and closed) or (told and (opened or closed)):
                quoted += 1
            elif self.hits[own] == 0:
                exact += 1
            else:
                near += 1
            addressed += any(clean_word(w) in _ADDRESS for w in around[-3:] + behind[:3])
            kinds.add(clean_word(own))
        open_hits = exact + near
        at = np.array(places)
        densest = int((np.searchsorted(at, at + 4 * WINDOW) - np.arange(len(at))).max())
        log = np.log1p
        return [float(x) for x in (exact > 0, log(exact), log(near), log(quoted), log(addressed), log(len(kinds)), log(densest), log(100 * open_hits / len(words)), exact + near > 1)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts of a task each word stands."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def told() -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(words, pa.string())] + [pa.array([counts[k][w] for w in words], pa.int64()) for k in (1, 0)]
        counts[0].clear()
        counts[1].clear()
        return pa.RecordBatch.from_arrays(columns, ["word", "pos", "neg"])

    for batch in pieces(batches, "text"):
        for kind, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[kind].update({clean_word(w) for w in set((text or "").lower().split())})
        if len(counts[0]) + len(counts[1]) > 500_000:
            yield told()
    yield told()


def learn_terms(labelled: DataFrame, bad: int, good: int, support: int = SUPPORT, odds: float = ODDS, significance: float = SIGNIFICANCE) -> Model:
    """Lexicon of (text, toxic) rows, ``bad`` toxic and ``good`` clean ones: every word whose counts are significant is a term.

    Words are counted within a task before they are shuffled; the rows are read once.
    """
    if not bad:
        return Model([], [], [])
    counted = labelled.select("toxic", "text").mapInArrow(tidy(_counted), "word string, pos long, neg long")
    counted = counted.filter("length(word) between 3 and 64").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counted = store(counted, "words")

    def ratio(pos: str, neg: str):
        return ((F.col(pos) + 0.5) / (bad + 1)) / ((F.col(neg) + 0.5) / (good + 1))

    def likelihood():
        pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")

        def part(seen, of: int, rows):
            expected = F.greatest(rows, F.lit(1e-9)) * of / (bad + good)
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

        holds, lacks = pos + neg, bad + good - pos - neg
        return 2 * (part(pos, bad, holds) + part(neg, good, holds) + part(bad - pos, bad, lacks) + part(good - neg, good, lacks))

    strong = counted.filter((F.col("pos") >= support) & (ratio("pos", "neg") >= odds) & (likelihood() >= significance))
    words = [r[0] for r in strong.orderBy("word").select("word").collect()]
    cut = F.explode(F.array(*[F.when(F.length("word") > k, F.substring("word", 1, k)) for k in _STEMS])).alias("stem")
    stems = counted.select("pos", "neg", cut).filter("stem is not null").groupBy("stem")
    stems = stems.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count(F.when(F.col("neg") * 20 <= F.col("pos"), 1)).alias("kinds"))
    stems = stems.filter((F.col("pos") >= 3 * support) & (F.col("kinds") >= 3) & (ratio("pos", "neg") >= odds) & (F.col("neg") * 20 <= F.col("pos")) & (likelihood() >= significance))
    found = [r[0] for r in stems.orderBy("stem").select("stem").collect()]
    names = set(found)
    model = Model(words, [s for s in found if not any(s[:k] in names for k in range(1, len(s)))], [])
    # the words of clean texts that the machine would take for a misspelled term
    near = counted.filter("neg > 0").select("word").mapInArrow(tidy(_near(model)), "word string")
    model.spared = sorted(r[0] for r in near.collect())
    return model


def _near(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(model.terms, model.stems)
        for batch in batches:
            yield batch.filter(pa.array([machine.edits(w) > 0 for w in batch.column(0).to_pylist()], pa.bool_()))

    return run


def _featured(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in pieces(batches, "text"):
            rows = [reader.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "x"])

    return run


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _words_hash(text: str):
    """Hash of the sequence of words of a text."""
    return F.unhex(F.md5(F.regexp_replace(F.trim(F.lower(F.col(text))), r"\s+", " ")))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: int = SAMPLE) -> Model:
    """Lexicon from all labelled rows, weights from at most ``sample`` of them (the smallest hashes of their ids).

    Of a class's rows with the same sequence of words one counts for the
    lexicon. They are told apart by (id, hash of the words), without texts; the
    texts then meet the chosen ones in one shuffle, straight into the counts,
    and are never stored. Labels grow with the documents, so the join is a merge
    at any size.
    """
    with scratch(docs.sparkSession):
        marks = labels.filter(F.col(f"`{toxic}`").isin(0, 1)).select(F.col(f"`{doc_id}`").alias("_l"), F.col(f"`{toxic}`").cast("int").alias("toxic")).distinct()
        rows = docs.select(F.col(f"`{doc_id}`").alias("_d"), F.col(f"`{text}`").alias("text")).withColumn("_h", _words_hash("text"))
        narrow = rows.select("_d", "_h").join(marks.hint("merge"), F.col("_d") == F.col("_l")).select("_d", "_h", "toxic")
        labelled = store(narrow, "labelled")
        one = store(labelled.groupBy("toxic", "_h").agg(F.min("_d").alias("_c")), "chosen")
        totals = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        # a null text has no hash and no words
        chosen = one.filter("_h is not null").select(F.col("_c"), F.col("_h").alias("_g"), "toxic")
        met = rows.join(chosen.hint("merge"), (F.col("_d") == F.col("_c")) & (F.col("_h") == F.col("_g")))
        texts = met.dropDuplicates(["_d", "_h", "toxic"]).select("toxic", "text")  # rows that are repeated with their id
        model = learn_terms(texts, totals.get(1, 0), totals.get(0, 0))
        few = labelled.distinct().withColumn("_o", F.xxhash64("_d")).orderBy("_o", "_d", "_h").limit(sample)
        # at most ``sample`` rows; a row that is repeated with its id counts as often as it stands there
        few = F.broadcast(store(few.select(F.col("_d").alias("_i"), F.col("_h").alias("_g"), "toxic"), "sample"))
        fitted = rows.join(few, (F.col("_d") == F.col("_i")) & F.col("_h").eqNullSafe(F.col("_g"))).select("toxic", "text")
        table = fitted.mapInArrow(tidy(_featured(model)), "toxic int, x array<double>").limit(sample).toArrow()
        if table.num_rows:
            x = np.array(table.column("x").to_pylist()).reshape(-1, FEATURES)
            model.weights = fit(x, table.column("toxic").to_numpy().astype(float))
        return model


def _scored(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = Reader(model)
        for batch in pieces(batches, "_t"):
            x = np.array([reader.features(t) for t in batch.column(1).to_pylist()]).reshape(-1, FEATURES)
            if model.weights is None:
                score = np.zeros(len(x))
            else:
                score = 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score)], ["doc_id", "held_out", "score"])

    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score and predicted.

    Null and empty texts have no hits and get the score of a text without any;
    with nothing learned every score is 0. Repeated rows and ids give a row each.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_t"), held_out(doc_id).alias("held_out"))
    kind = docs.schema[doc_id].dataType.simpleString()
    # the significant terms and the clean words within an edit or two of them
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.mapInArrow(tidy(_scored(shared)), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and scores all."""
    return score(docs, learn(docs.filter(~held_out()), labels.filter(~held_out())))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, columns unchanged; judged in the same pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = Reader(shared.value), shared.value.weights
        for batch in pieces(batches, "text"):
            if weights is not None:
                x = np.array([reader.features(t) for t in batch.column(at).to_pylist()]).reshape(-1, FEATURES)
                logit = x @ weights[:-1] + weights[-1]
                batch = batch.filter(pa.array(logit < np.log(THRESHOLD / (1 - THRESHOLD))))
            yield pa.RecordBatch.from_arrays(batch.columns, names)

    return docs.mapInArrow(tidy(run), docs.schema)
