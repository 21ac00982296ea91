"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features: densities of lexicon words and stems (learned from training labels, besides a fixed list), how near they stand to
second-person words, capitals, punctuation and obfuscation rates, and lexicon hits after undoing obfuscation. Labels,
language, source and doc_id are never inputs of a score.

Bound: lexicon, trees and calibration are fitted on labelled documents chosen by a hash of doc_id, ``LABELLED`` in expectation.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.llm import scratch

LABELLED = 30_000
#: Share of the labelled documents that calibrate; the others grow the trees.
CALIBRATE = 0.25
STEMS = (4, 5, 6, 7, 8)
#: A word or stem is learned if so many toxic documents have it and its odds in them are so much higher (logarithm).
MIN_TOXIC, MIN_SHARE, MIN_ODDS = 4, 0.01, 2.0
NEAR = 40
#: Words of abuse known beforehand.
SEED_WORDS = "idiot idiots moron morons stupid pathetic loser losers worthless scum trash disgusting dumb jerk bastard retard imbecile clown".split()
#: Second-person words of four languages.
SECOND = "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes".split()
#: Signs that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_TOKEN = re.compile(r"[^\W\d_]+")
_BROKEN = re.compile(r"(?<=\w)[*._\-](?=\w)")
FEATURES = ("words", "hits", "hit_density", "weight_density", "distinct_hits", "heaviest", "near_second", "second_density", "capitals", "capital_words", "exclamations", "questions", "punctuation", "repeated_punctuation", "obfuscated", "hidden_hits", "repeated_letters", "digits")


def _terms(text: str) -> set[str]:
    """Words (ended by $) and stems of a text, once each."""
    out: set[str] = set()
    for w in set(_TOKEN.findall(text.lower())):
        out.add(w + "$")
        out.update(w[:n] for n in STEMS if len(w) > n)
    return out


def learn_lexicon(labelled: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Terms of (text, toxic) rows to logarithms of their odds; words end with $, stems don't."""
    floor = max(MIN_TOXIC, int(MIN_SHARE * toxic))

    def terms_of(batches: Iterator[pa.RecordBatch], wanted: set[str] | None) -> Iterator[pa.RecordBatch]:
        for b in scratch.slices(batches, 0):
            seen: Counter[str] = Counter()
            for t in b.column(0).to_pylist():
                got = _terms(t or "")
                seen.update(got if wanted is None else got & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    count = lambda rows, wanted: rows.select("text").mapInArrow(lambda it: terms_of(it, wanted), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # a document has few terms, so those of a bounded number of documents with this frequency are bounded
    found = {r["term"]: r["n"] for r in count(labelled.filter("toxic = 1"), None).filter(F.col("n") >= floor).toLocalIterator()} if toxic else {}
    also = {r["term"]: r["n"] for r in count(labelled.filter("toxic = 0"), set(found)).toLocalIterator()} if found and clean else {}
    odds = {t: float(np.log((n + 0.5) / (toxic + 1)) - np.log((also.get(t, 0) + 0.5) / (clean + 1))) for t, n in found.items()}
    lexicon = {w + "$": max(MIN_ODDS, odds.get(w + "$", 3.0)) for w in SEED_WORDS}
    for t in sorted((t for t, o in odds.items() if o >= MIN_ODDS), key=lambda t: (len(t.rstrip("$")), t)):
        word = t.rstrip("$")
        # a stem that is kept already covers what starts with it, unless it says much less
        cover = max((lexicon[word[:n]] for n in STEMS if n < len(word) and word[:n] in lexicon), default=None)
        if cover is None or odds[t] > cover + 1:
            lexicon[t] = odds[t]
    return lexicon


class Extractor:
    """Features of texts by one automaton over the lexicon and second-person words."""

    def __init__(self, lexicon: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for term, weight in lexicon.items():
            entries.setdefault(term.rstrip("$"), []).append((term.endswith("$"), weight))
        for w in SECOND:
            entries.setdefault(w, []).append((True, None))
        for word, kinds in entries.items():
            self.automaton.add_word(word, (len(word), word, kinds))
        self.automaton.make_automaton()

    def _hits(self, low: str) -> tuple[list[tuple[int, str, float]], list[int]]:
        found, second = [], []
        for end, (size, word, kinds) in self.automaton.iter(low):
            start = end - size + 1
            if start and low[start - 1].isalpha():
                continue
            whole = end + 1 == len(low) or not low[end + 1].isalpha()
            for must_end, weight in kinds:
                if must_end and not whole:
                    continue
                if weight is None:
                    second.append(start)
                else:
                    found.append((start, word, weight))
        return found, second

    def one(self, text: str) -> list[float]:
        if not text:
            return [0.0] * len(FEATURES)
        low = text.lower()
        found, second = self._hits(low)
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        upper = (data >= 65) & (data <= 90)
        letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        digit = (data >= 48) & (data <= 57)
        sign = ~(letter | blank | digit)
        size = len(data)
        words = int((~blank[1:] & blank[:-1]).sum()) + int(not blank[0])
        starts = np.concatenate([[True], ~letter[:-1]]) & letter
        capital_words = int((upper[:-1] & upper[1:] & starts[:-1]).sum()) if size > 1 else 0
        odd = sign & (data != 39) | digit
        inner = int((letter[:-2] & odd[1:-1] & letter[2:]).sum()) if size > 2 else 0
        same = (data[:-2] == data[1:-1]) & (data[1:-1] == data[2:]) if size > 2 else np.zeros(0, bool)
        hidden = 0
        if inner:
            plain = _BROKEN.sub("", low.translate(LEET))
            hidden = max(0, len(self._hits(plain)[0]) - len(found))
        places = np.array(second)
        near = sum(bool((np.abs(places - s) <= NEAR).any()) for s, _, _ in found) if second else 0
        n, marks = max(words, 1), np.bincount(data, minlength=128)
        weights = [w for _, _, w in found]
        return [np.log1p(words), np.log1p(len(found)), len(found) / n, sum(weights) / n, float(len({w for _, w, _ in found})), max(weights, default=0.0), near / n, len(second) / n, upper.sum() / max(letter.sum(), 1), capital_words / n, marks[33] / size, marks[63] / size, sign.sum() / size, (same & sign[2:]).sum() / size if size > 2 else 0.0, inner / n, hidden / n, (same & letter[2:]).sum() / n if size > 2 else 0.0, digit.sum() / size]

    def many(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.one(t or "") for t in texts], np.float64).reshape(len(texts), len(FEATURES))


class Boosted:
    """Binary trees on binned features, grown level by level on the logistic loss."""

    def __init__(self, trees: int = 80, depth: int = 4, rate: float = 0.12, bins: int = 48, leaf: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.leaf = trees, depth, rate, bins, leaf
        self.grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.cuts = [np.unique(np.quantile(np.unique(c), np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        b = self._binned(x)
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.base)
        width = self.bins + 1
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, np.maximum(p * (1 - p), 1e-9)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, width, np.int64)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                gains = np.full((count, x.shape[1], width), -np.inf)
                for j in range(x.shape[1]):
                    at = (node - first) * width + b[:, j]
                    gs = np.bincount(at, g, count * width).reshape(count, width)
                    hs = np.bincount(at, h, count * width).reshape(count, width)
                    gl, hl = gs.cumsum(1), hs.cumsum(1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl**2 / (hl + self.leaf) + (gt - gl) ** 2 / (ht - hl + self.leaf) - gt**2 / (ht + self.leaf)
                    gains[:, j] = np.where((hl > 0.5) & (ht - hl > 0.5), gain, -np.inf)
                flat = gains.reshape(count, -1)
                best = flat.argmax(1)
                good = flat[np.arange(count), best] > 1e-6
                feature[first : first + count] = np.where(good, best // width, 0)
                cut[first : first + count] = np.where(good, best % width, width)
                node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = -np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + self.leaf) * self.rate
            self.grown.append((feature, cut, value))
            margin += value[leaf]
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        b, out = self._binned(x), np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.grown:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out


def isotonic(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising map from margins to probabilities: pools of violators, joined by lines between their means."""
    order = np.argsort(margins, kind="stable")
    pools: list[list[float]] = []  # sum of margins, sum of labels, weight
    for m, t in zip(margins[order], y[order], strict=True):
        pools.append([float(m), float(t), 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            a = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], a, strict=True)]
    x = np.array([p[0] / p[2] for p in pools])
    # half a case of either kind keeps ends off 0 and 1
    return x, np.array([(p[1] + 0.5 * y.mean()) / (p[2] + 0.5) for p in pools])


class Model:
    def __init__(self, lexicon: dict[str, float], trees: Boosted | None, knots: tuple[np.ndarray, np.ndarray] | None):
        self.lexicon, self.trees, self.knots = lexicon, trees, knots
        self.extract: Extractor | None = None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """0 to 1: the calibrated probability; the raw one where labels are too few to calibrate."""
        self.extract = self.extract or Extractor(self.lexicon)
        if self.trees is None:
            return np.zeros(len(texts))
        m = self.trees.margins(self.extract.many(texts))
        return np.interp(m, *self.knots) if self.knots is not None else 1 / (1 + np.exp(-m))


def held_out() -> Column:
    return (F.crc32(F.col("doc_id").cast("string")) % 4) == 2


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out. Without labels of both kinds every score is 0."""
    scratch.ship(docs.sparkSession)
    known = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")).filter(~held_out())
    share = min(1.0, LABELLED / max(known.count(), 1))
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # a bounded set, by the filter above
    rows = scratch.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1000)).alias("draw")), "tox-labelled")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        scratch.drop(rows)
        return Model({}, None, None)
    # calibration sees documents that neither the lexicon nor the trees were made from
    grown = rows.filter(F.col("draw") >= CALIBRATE * 1000)
    grown_toxic = grown.filter("toxic = 1").count()
    lexicon = learn_lexicon(grown, grown_toxic, grown.count() - grown_toxic)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Extractor(lexicon)
        for b in scratch.slices(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array(list(extract.many(b.column(0).to_pylist())), pa.list_(pa.float64())), b.column(1), b.column(2)], names=["x", "toxic", "draw"])

    t = rows.select("text", F.col("toxic").cast("int").alias("toxic"), "draw").mapInArrow(run, "x array<double>, toxic int, draw long").orderBy("draw", "x").toArrow()
    scratch.drop(rows)
    x = t.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y, draw = t.column("toxic").to_numpy().astype(np.float64), t.column("draw").to_numpy()
    hold = draw < CALIBRATE * 1000
    if min(y[hold].sum(), (1 - y[hold]).sum(), y[~hold].sum(), (1 - y[~hold]).sum()) < 3:
        return Model(lexicon, Boosted().fit(x, y), None)
    trees = Boosted().fit(x[~hold], y[~hold])
    return Model(lexicon, trees, isotonic(trees.margins(x[hold]), y[hold]))


def score(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``cut`` on): a row for each row of ``docs``. Null texts count as empty; equal
    texts get equal scores; other columns are not looked at."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scratch.slices(batches, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.value.scores(b.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
