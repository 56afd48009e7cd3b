"""Toxicity: misspelled lexicon terms by Levenshtein automata, weighed by their context.

A lexicon of terms and stems is learnt from labelled texts: those far more frequent in toxic
ones. The Levenshtein automata of the terms run along the trie of the lexicon, which finds
the terms one edit away from a word. Hits near quotation marks or words of reporting count
as quotation. A logistic regression over sums of hits and the densest context window gives
the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changefold.llm.frames import annotate

#: Labelled rows from which lexicon and weights are learnt: the ones with the smallest hashes
#: of their ids. All other labelled rows are left out of the fit, none out of the scoring.
SAMPLE = 8_000
#: A term is in the lexicon if so many toxic texts of the sample have it ...
LEAST_TOXIC = 4
#: ... and its share of toxic texts is this many times its share of other texts.
LIFT = 12.0
#: Lengths of stems that are tried, and how many different words a stem must begin.
STEMS = (5, 6, 7)
STEM_WORDS = 4
#: Terms at least this long are also found one edit away.
FUZZY_CHARS = 5
#: Words before and after a hit that are its context.
NEAR = 8
#: Words of a context window in which hits add up.
SPAN = 12
#: States of the automaton that are kept; beyond it starts anew.
STATES = 200_000
WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
QUOTES = re.compile("[\"“”„«»‹›]")
#: Words that tell of what others say; in a context they speak for quotation.
REPORTS = frozenset("said says quoted quote called wrote word term slur insult reported "
                    "sagte schrieb wort zitat dit mot citation dijo palabra cita".split())
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FEATURES = ("hits", "kinds", "fuzzy", "quoted", "weight", "window", "density", "length")


class Neighbours:
    """The Levenshtein automata of all terms, run along the terms' trie as one automaton.

    A state are the trie's nodes that the letters read so far can have led to, with the
    edits spent on the way. States are made deterministic as words ask for them, so a
    word costs a look-up a letter and most words die after a few.
    """

    def __init__(self, terms: Iterable[str], most: int = 1):
        self.most = most
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for term in terms:
            at = 0
            for char in term:
                if char not in self.children[at]:
                    self.children[at][char] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                at = self.children[at][char]
            self.term[at] = term
        self.numbers: dict[frozenset, int] = {}
        self.nodes: list[dict[int, int]] = []
        self.after: list[dict[str, int]] = []
        self.found: list[list[str]] = []
        start: dict[int, int] = {}
        self._reach(start, 0, 0)
        self.start = self._state(start)

    def _reach(self, nodes: dict[int, int], node: int, edits: int) -> None:
        """Reach a node, and by leaving out letters of the term those below it."""
        if edits <= self.most and edits < nodes.get(node, self.most + 1):
            nodes[node] = edits
            for child in self.children[node].values():
                self._reach(nodes, child, edits + 1)

    def _state(self, nodes: dict[int, int]) -> int:
        name = frozenset(nodes.items())
        if name not in self.numbers:
            self.numbers[name] = len(self.nodes)
            self.nodes.append(nodes)
            self.after.append({})
            self.found.append([self.term[n] for n in nodes if self.term[n] is not None])
        return self.numbers[name]

    def _step(self, state: int, char: str) -> int:
        """The state after one more letter, -1 if no term can follow."""
        nodes: dict[int, int] = {}
        for node, edits in self.nodes[state].items():
            for letter, child in self.children[node].items():
                self._reach(nodes, child, edits + (letter != char))
            self._reach(nodes, node, edits + 1)
        self.after[state][char] = out = self._state(nodes) if nodes else -1
        return out

    def of(self, word: str) -> list[str]:
        """The terms at most ``most`` edits from ``word``."""
        if len(self.nodes) > STATES:
            self.__init__([t for t in self.term if t is not None], self.most)
        at = self.start
        for char in word:
            known = self.after[at].get(char)
            at = self._step(at, char) if known is None else known
            if at < 0:
                return []
        return self.found[at]


@dataclass
class Lexicon:
    """Terms and stems with their weights."""

    terms: dict[str, float]
    stems: dict[str, float]

    def __post_init__(self):
        self.near = Neighbours(sorted(t for t in self.terms if len(t) >= FUZZY_CHARS))

    def __getstate__(self):
        return {"terms": self.terms, "stems": self.stems}

    def __setstate__(self, state):
        self.__init__(**state)

    def find(self, word: str) -> tuple[str, float, bool] | None:
        """The lexicon's entry for a word, its weight, and whether it is misspelled."""
        if word in self.terms:
            return word, self.terms[word], False
        for n in STEMS:
            if word[:n] in self.stems:
                return word[:n], self.stems[word[:n]], False
        if near := self.near.of(word):
            best = max(near, key=lambda t: (self.terms[t], t))
            return best, self.terms[best], True
        return None

    def look_up(self, words: set[str]) -> dict[str, tuple[str, float, bool]]:
        return {w: found for w in words if (found := self.find(w))}


def lowered(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(UPPER)


def words_of(text: str) -> list[str]:
    return WORD.findall(lowered(text))


def hits(text: str, lexicon: Lexicon) -> tuple[int, list[tuple[int, str, float, bool, bool]]]:
    """The number of words, and for each hit its place, entry, weight, whether it is
    misspelled, and whether its context speaks for quotation."""
    low = lowered(text)
    words = WORD.findall(low)
    found = lexicon.look_up(set(words))
    if not found:
        return len(words), []
    out = []
    places = [m.span() for m in WORD.finditer(low)]
    for i, w in enumerate(words):
        if w in found:
            entry, weight, fuzzy = found[w]
            lo, hi = max(0, i - NEAR), min(len(words), i + NEAR + 1)
            before, after = low[places[lo][0]:places[i][0]], low[places[i][1]:places[hi - 1][1] + 1]
            quoted = bool(QUOTES.search(before) and QUOTES.search(after)) or not REPORTS.isdisjoint(words[lo:hi])
            out.append((i, entry, weight, fuzzy, quoted))
    return len(words), out


def features(text: str, lexicon: Lexicon) -> list[float]:
    n, found = hits(text, lexicon)
    abuse = [h for h in found if not h[4]]
    best = total = 0.0
    first = 0
    for k, h in enumerate(found):
        total += h[2] * (0.25 if h[4] else 1.0)
        while found[first][0] <= h[0] - SPAN:
            total -= found[first][2] * (0.25 if found[first][4] else 1.0)
            first += 1
        best = max(best, total)
    return [math.log1p(len(abuse)), math.log1p(len({h[1] for h in abuse})),
            math.log1p(sum(h[3] for h in abuse)), math.log1p(len(found) - len(abuse)),
            math.log1p(sum(h[2] for h in abuse)), math.log1p(best),
            math.log1p(100 * len(abuse) / n) if n else 0.0, math.log1p(n)]


@dataclass
class Model:
    lexicon: Lexicon
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        x = np.column_stack([np.ones(len(rows)), (rows - self.mean) / self.scale])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def regression(rows: np.ndarray, labels: np.ndarray, lexicon: Lexicon, ridge: float = 1.0) -> Model:
    """Logistic regression by Newton's steps, with a small penalty on all but the constant."""
    if not len(rows):
        k = len(FEATURES)
        return Model(lexicon, np.zeros(k), np.ones(k), np.concatenate([[-30.0], np.zeros(k)]))
    mean, scale = rows.mean(0), np.maximum(rows.std(0), 1e-6)
    x = np.column_stack([np.ones(len(rows)), (rows - mean) / scale])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-3, *[ridge] * rows.shape[1]])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (labels - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return Model(lexicon, mean, scale, w)


def _entries(column: pa.Array) -> list:
    """Each text's distinct words, and its stems with the words that begin with them."""
    return [[sorted(set(words_of(t))) for t in column.to_pylist()]]


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms and stems whose share of toxic texts is far above their share of others.

    ``sample``: text and label of ``SAMPLE`` rows at most. Words are counted in Spark, and
    those that pass come to the driver: each is in ``LEAST_TOXIC`` texts of the sample.
    """
    rows = annotate(sample, _entries, "words array<string>", keep=["label"])
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, other = max(sizes.get(1, 0), 1), max(sizes.get(0, 0), 1)
    words = rows.select("label", F.explode("words").alias("term"))
    words = words.groupBy("term").agg(F.sum("label").alias("t"), F.count("*").alias("n")).withColumn(
        "o", F.col("n") - F.col("t"))
    lift = (F.col("t") / toxic) / ((F.col("o") + 0.5) / other)

    def best(counted: DataFrame) -> dict[str, float]:
        top = counted.filter((F.col("t") >= LEAST_TOXIC) & (lift >= LIFT))
        return {r.term: math.log(r.lift) for r in top.select("term", lift.alias("lift")).orderBy("term").collect()}

    stems = words.select(
        F.explode(F.array(*[F.when(F.length("term") > n, F.substring("term", 1, n)) for n in STEMS])).alias("term"),
        "t", "o").filter("term IS NOT NULL").groupBy("term").agg(
        F.sum("t").alias("t"), F.sum("o").alias("o"), F.count_if(F.col("t") > 0).alias("different")).filter(
        F.col("different") >= STEM_WORDS)
    return Lexicon(best(words), best(stems))


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Model:
    """Learn from the labelled documents whose CRC of the id is no multiple of five.

    Rows without an id or a label teach nothing; a document with both labels is left out, and
    of rows that repeat an id the smallest text teaches, so that ``SAMPLE`` bounds all that
    comes to the driver.
    Without labelled rows every score is near 0.
    """
    told = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col(doc_id))).groupBy(
        F.col(doc_id).alias("of_id")).agg(F.min(label).alias("label"), F.max(label).alias("most")).filter("label = most")
    told = told.select("of_id", F.col("label").cast("int").alias("label")).orderBy(
        F.xxhash64("of_id"), "of_id").limit(SAMPLE)
    sample = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(told), F.col("doc_id") == F.col("of_id")).groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("label").alias("label")).select("text", "label")
    lexicon = learn_lexicon(sample)
    seen = annotate(sample, partial(_features, lexicon=lexicon), "x array<double>", keep=["label"]).collect()
    rows = np.array([r.x for r in seen], float).reshape(len(seen), len(FEATURES))
    return regression(rows, np.array([r.label for r in seen], float), lexicon)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _features(column: pa.Array, lexicon: Lexicon) -> list:
    return [[features(t, lexicon) for t in column.to_pylist()]]


def _scores(column: pa.Array, sent) -> list:
    model = sent.value
    rows = np.array([features(t, model.lexicon) for t in column.to_pylist()]).reshape(len(column), len(FEATURES))
    return [model.score(rows)]


def score(docs: DataFrame, model: Model, *, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the ``score`` of each text; a null or empty one has no hits."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return annotate(docs, partial(_scores, sent=sent), "score double", keep=keep, text=text)
