"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words counts the triples of letters they share as
subsequences with gaps, each weighted by DECAY for every letter it spans (at
most SPAN) and normalised: words with inserted, dropped or spaced-out letters
stay near the word they hide. A word is folded first (case, digits and signs
that stand for letters, punctuation inside); single letters in a row are read
as one word.

Training: the sentences of the sample carry their document's label; which of
their words bear it is found by alternating (the words of toxic documents that
score highest are the positive ones in the next round). Kernel values to the
landmark words, whitened by the landmarks' own kernel matrix, are the features
of a linear machine with squared hinge loss. The machine is linear in the
triples too, so it is compiled to one weight per triple, and scoring a word is
a sum of weights. A document's best words, scored by a machine that did not see
it, train the logistic step from which the probability comes.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import Kernel, map_slices, texts_of

DECAY, SPAN = 0.75, 5
#: Words are read in windows of this many letters, which overlap by half.
WINDOW = 24
LANDMARKS = 256
#: At most so many labelled documents are used to fit the machine.
SAMPLE_DOCS = 4_000
THRESHOLD = 0.7
#: Words whose kernel values are computed at once.
BLOCK = 500
#: Words whose scores a task keeps before it starts afresh; bounds memory, not results.
MAX_WORDS = 150_000

#: Signs that stand for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_WEIGHTS = np.array([DECAY ** (b + 1) for _, b in _OFFSETS], np.float32)
_SYMBOLS = 64
_CODES = _SYMBOLS**3
_EDGE = 63
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S){3,}(?!\S)")


def fold(chunk: str) -> str:
    """A word's letters in lower case. Signs stand for letters only between or beside letters."""
    low = chunk.lower()
    if not low.isalpha():
        core = low.strip(".,;:!?\"'()[]{}|-*#%&$")
        low = "".join(c for c in core.translate(LOOKALIKES) if c.isalpha()) if any(c.isalpha() for c in core) else ""
    return low


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 36


def windows(word: str) -> list[str]:
    if len(word) <= WINDOW:
        return [word]
    step = WINDOW // 2
    return [word[i : i + WINDOW] for i in range(0, len(word) - step, step)]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple, weight) of every distinct triple of every word, normalised to unit length; sorted by word."""
    wide = max(map(len, words), default=0) + 2
    letters = np.zeros((len(words), wide), np.int64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    flat = [s for w in words for s in (_EDGE, *map(_symbol, w), _EDGE)]
    letters[np.arange(wide) < sizes[:, None]] = flat
    keys, weights = [], []
    rows = np.arange(len(words))[:, None] * _CODES
    for (a, b), weight in zip(_OFFSETS, _WEIGHTS):
        if wide > b:
            key = rows + (letters[:, : wide - b] * _SYMBOLS + letters[:, a : wide - b + a]) * _SYMBOLS + letters[:, b:]
            key = key[np.arange(wide - b) + b < sizes[:, None]]
            keys.append(key)
            weights.append(np.full(len(key), weight, np.float32))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    weight = np.add.reduceat(weight, first)
    word, triple = np.divmod(key[first], _CODES)
    norm = np.sqrt(np.bincount(word, weight * weight, len(words)))
    return word, triple, (weight / norm[word]).astype(np.float32)


@dataclass
class Machine:
    weights: np.ndarray
    bias: float

    def scores(self, words: list[str]) -> np.ndarray:
        """The margin of each word; the best of its windows where it is long. The empty word has the bias."""
        out = np.full(len(words), self.bias, np.float64)
        for start in range(0, len(words), 4096):
            part = words[start : start + 4096]
            pieces = [(k, w) for k, word in enumerate(part) if word for w in windows(word)]
            if pieces:
                owner = np.array([k for k, _ in pieces])
                word, triple, weight = triples([w for _, w in pieces])
                margin = np.bincount(word, weight * self.weights[triple], len(pieces))
                best = np.full(len(part), -np.inf)
                np.maximum.at(best, owner, margin)
                out[start : start + len(part)] += np.where(np.isfinite(best), best, 0)
        return out


class Landmarks:
    """Kernel values of words to landmark words."""

    def __init__(self, words: list[str]):
        owner, triple, weight = triples(words)
        self.present, at = np.unique(triple, return_inverse=True)
        self.table = np.zeros((len(self.present), len(words)), np.float32)
        self.table[at, owner] = weight
        self.index = np.full(_CODES, -1, np.int32)
        self.index[self.present] = np.arange(len(self.present))

    def values(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.table.shape[1]), np.float32)
        word, found, value = triples(words)
        hit = self.index[found] >= 0
        word, found, value = word[hit], self.index[found[hit]], value[hit]
        if len(word):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            out[word[first]] = np.add.reduceat(self.table[found] * value[:, None], first, axis=0)
        return out

    def features(self, words: list[str], whiten: np.ndarray, out: np.ndarray) -> None:
        """Whitened values into the rows of ``out``, some hundred words at a time."""
        for start in range(0, len(words), BLOCK):
            part = words[start : start + BLOCK]
            out[start : start + len(part)] = self.values(part) @ whiten


def _hinge(x: np.ndarray, rows: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 6) -> np.ndarray:
    """Squared hinge loss with a ridge over some rows of x, by Newton's method in blocks; the last coefficient is the bias."""
    v = np.zeros(x.shape[1])
    for _ in range(rounds):
        square, side = ridge * np.eye(len(v)), np.zeros(len(v))
        for start in range(0, len(rows), 4096):
            cut = slice(start, start + 4096)
            part = x[rows[cut]]
            on = 1 - y[cut] * (part @ v.astype(part.dtype)) > 0
            part, weighted = part[on], part[on] * weight[cut][on, None]
            square += part.T @ weighted
            side += weighted.T @ y[cut][on]
        step = np.linalg.solve(square, side)
        if np.abs(step - v).max() < 1e-3:
            return step
        v = step
    return v


def fit_machine(docs: list[list[str]], labels: np.ndarray, rounds: int = 3, witnesses: int = 10) -> Machine | None:
    """From documents' distinct words, none longer than a window, and their labels; None unless both labels occur."""
    toxic = int(labels.sum())
    if toxic in (0, len(labels)):
        return None
    counts: dict[str, list[int]] = {}
    for words, label in zip(docs, labels):
        for w in words:
            counts.setdefault(w, [0, 0])[int(label)] += 1
    # rare words tell nothing that others of their kind don't; of equals the first in order of letters comes first
    vocabulary = sorted(w for w, n in counts.items() if sum(n) >= 3)
    if not vocabulary:
        return None
    n = np.array([counts[w] for w in vocabulary], float)
    del counts
    clean = len(labels) - toxic
    rates = (n + 0.5) / (np.array([clean, toxic]) + 1)
    told = n[:, 1] / toxic * np.log(rates[:, 1] / rates[:, 0])
    # labels are noisy: a word may bear one if toxic documents hold it far more often than chance would have it
    expected = n.sum(1) * toxic / len(labels)
    bearing = (n[:, 1] >= 3) & (n[:, 1] - expected > 4 * np.sqrt(expected * clean / len(labels)))
    positive = np.where(bearing, n[:, 1] / toxic, 0)
    chosen = dict.fromkeys(int(i) for i in np.argsort(-told, kind="stable")[: LANDMARKS // 2])
    chosen |= dict.fromkeys(int(i) for i in np.argsort(-n.sum(1), kind="stable")[: LANDMARKS // 2])
    landmarks = [vocabulary[i] for i in chosen]
    kernel = Landmarks(landmarks)
    # what bears the label also does so with a letter put in: as many copies as places, in all a quarter of the word's own weight
    disguised = [(i, w[:k] + c + w[k:]) for i in np.argsort(-told, kind="stable")[:64] if bearing[i] and len(vocabulary[i]) < WINDOW for w in [vocabulary[i]] for k in range(1, len(w)) for c in "xeo"]
    parents = np.array([i for i, _ in disguised], np.int64)
    share = 0.25 / np.maximum(np.bincount(parents, minlength=len(vocabulary)), 1)
    own = kernel.values(landmarks).astype(float)
    spectrum, basis = np.linalg.eigh((own + own.T) / 2)
    sound = spectrum > 1e-4 * spectrum[-1]
    whiten = basis[:, sound] / np.sqrt(spectrum[sound])
    x = np.ones((len(vocabulary) + len(disguised), int(sound.sum()) + 1), np.float32)
    kernel.features([*vocabulary, *(w for _, w in disguised)], whiten.astype(np.float32), x[:, :-1])
    index = {w: i for i, w in enumerate(vocabulary)}
    negative = n[:, 0] / clean
    v = np.zeros(x.shape[1])
    bags = [np.array(sorted({index[w] for w in words if w in index})) for words, label in zip(docs, labels) if label]
    for _ in range(rounds):
        if not positive.any():
            break
        keep_p, keep_n = positive > 0, negative > 0
        extra = positive[parents] * share[parents]
        rows = np.concatenate([np.flatnonzero(keep_p), len(vocabulary) + np.arange(len(disguised)), np.flatnonzero(keep_n)])
        y = np.concatenate([np.ones(keep_p.sum() + len(extra), np.float32), -np.ones(keep_n.sum(), np.float32)])
        weight = np.concatenate([positive[keep_p] / positive.sum(), extra / positive.sum(), 4 * negative[keep_n] / negative.sum()]) * len(y) / 100
        weight = weight.astype(np.float32)
        v = _hinge(x, rows, y, weight)
        margin = x[: len(vocabulary)] @ v.astype(x.dtype)
        positive = np.zeros(len(vocabulary))
        for bag in bags:
            if len(bag):
                best = bag[np.argsort(-margin[bag], kind="stable")[:witnesses]]
                positive[best] += 1 / toxic
        positive = np.where(bearing, positive, 0)
    compiled = np.zeros(_CODES, np.float64)
    compiled[kernel.present] = kernel.table.astype(float) @ (whiten @ v[:-1])
    return Machine(compiled, float(v[-1]))


def summary(scores: np.ndarray) -> list[float]:
    """What the logistic step sees of a document: its three best words, how many score above 1, and how many there are."""
    if not len(scores):
        return [-2.0, -2.0, -2.0, 0.0, 0.0]
    top = np.sort(scores)[::-1][:3]
    top = np.concatenate([top, np.full(3 - len(top), min(top[-1], -1.0))])
    return [*np.clip(top, -2, 3), math.log1p((scores > 1).sum()), math.log1p(len(scores))]


@dataclass
class Model:
    machine: Machine | None
    coefficients: np.ndarray

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(features @ self.coefficients[:-1] + self.coefficients[-1], -40, 40)
        return 1 / (1 + np.exp(-z))


def words_of(text: str) -> list[str]:
    """The chunks of a text and its spaced-out words."""
    found = text.split()
    found += [re.sub(r"\s", "", m.group()) for m in _SPACED.finditer(text)]
    return list(dict.fromkeys(found))


def windows_of(text: str) -> list[str]:
    """What a text is learned from: its distinct words in windows, folded."""
    return sorted({w for c in words_of(text) if (f := fold(c)) for w in windows(f)})


def fit(sample: list[tuple[list[str], int]]) -> Model:
    """From the windows of labelled texts. Without both labels nothing is toxic: every score is 0."""
    labels = np.array([y for _, y in sample], int)
    docs = [w for w, _ in sample]
    half = np.zeros(len(docs), int)
    for y in (0, 1):
        half[labels == y] = np.arange((labels == y).sum()) % 2
    features = np.zeros((len(docs), 5))
    for k in (0, 1):
        other = fit_machine([d for d, h in zip(docs, half) if h != k], labels[half != k])
        if other is None:
            return Model(None, np.zeros(6))
        for i in np.flatnonzero(half == k):
            features[i] = summary(other.scores(docs[i]))
    x = np.concatenate([features, np.ones((len(docs), 1))], 1)
    c = np.zeros(6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -40, 40)))
        w = np.maximum(p * (1 - p), 1e-6)
        c = c + np.linalg.solve((x * w[:, None]).T @ x + 1e-1 * np.eye(6), x.T @ (labels - p) - 1e-1 * c)
    return Model(fit_machine(docs, labels), c)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_column: str = "doc_id", text_column: str = "text", most: int = SAMPLE_DOCS) -> list[tuple[list[str], int]]:
    """The windows and the label of at most ``most`` documents, picked by hash among those with a label; a document's label
    is the largest it has, its text the least. Only distinct words come to the driver."""
    known = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.max(label).alias("label"))
    given = known.join(docs.select(F.col(id_column).alias("id")), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(most)
    texts = (
        docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
        .join(F.broadcast(given), "id")
        .groupBy("id")
        .agg(F.first("label").alias("label"), F.min("text").alias("text"))
    )

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            return {"id": batch.column("id"), "label": batch.column("label"), "words": [windows_of(t) for t in texts_of(batch)]}

        return kernel

    kinds = dict(texts.dtypes)
    rows = map_slices(texts, make, f"id {kinds['id']}, label {kinds['label']}, words array<string>").collect()
    once: dict[str, str] = {}
    return [([once.setdefault(w, w) for w in r["words"]], int(r["label"] == 1)) for r in sorted(rows, key=lambda r: r["id"])]


def score(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, score) of every whole text, with further columns if asked for.

    Null texts count as empty; empty texts have the score of a text without
    words; repeated rows give repeated rows; an empty table gives an empty
    result.
    """
    names = keep if keep is not None else [id_column]

    def make() -> Kernel:
        known: dict[str, float] = {}

        def kernel(batch: pa.RecordBatch) -> dict:
            out = {n: batch.column(n) for n in names}
            texts = texts_of(batch, text_column)
            if model.machine is None:
                return out | {"score": [0.0] * len(texts)}
            if len(known) > MAX_WORDS:
                known.clear()
            words = [words_of(t) for t in texts]
            fresh = list({c for ws in words for c in ws if c not in known})
            folded = [fold(c) for c in fresh]
            for c, f, s in zip(fresh, folded, model.machine.scores(folded).tolist()):
                known[c] = s if f else -9.0
            features = np.array([summary(np.array([s for s in map(known.__getitem__, ws) if s > -9.0])) for ws in words]).reshape(-1, 5)
            return out | {"score": model.probability(features)}

        return kernel

    kinds = dict(df.dtypes)
    ddl = ", ".join([*(f"`{n}` {kinds[n]}" for n in names), "score double"])
    return map_slices(df.select(*dict.fromkeys([*names, text_column])), make, ddl, 128)


def held_out(id_column: str = "doc_id"):
    """Whether a row's labels are kept from training."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every document, by a model fitted on labels that aren't held out."""
    model = fit(labelled_sample(docs, labels.where(~held_out(id_column)), id_column=id_column, text_column=text_column))
    return score(docs, model, id_column, text_column).select(
        id_column, held_out(id_column).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that score below the threshold, with all their columns.

    Null and empty texts score as texts without words and stay unless such
    score above; repeated rows stay or go together; an empty table stays empty.
    """
    model = fit(labelled_sample(docs, labels.where(~held_out(id_column)), id_column=id_column, text_column=text_column))
    named = docs.columns
    hidden = "score"
    while hidden in named:
        hidden = f"_{hidden}"
    scored = docs if "score" not in named else docs.withColumnRenamed("score", hidden)
    names = scored.columns
    kept = score(scored, model, id_column, text_column, names).where(F.col("score") < threshold).drop("score")
    return kept.toDF(*named)
