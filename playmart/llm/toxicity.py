"""Toxicity: a support vector machine on a gap-weighted subsequence kernel.

The kernel of two words counts the ordered triples of letters that they share, each
weighted by DECAY to the length it spans, up to MAX_SPAN letters. A letter put into an
insult, left out or masked changes some triples and keeps the others. The machine sees
a word through its kernel values with landmark words (Nyström). As it is linear in
them, the landmarks fold into one weight per triple, by which any number of words is
scored without them.

Labels belong to documents, so training takes the sentences of toxic documents as bags:
each has a witness, its most toxic word by the present machine, and the words of the
other documents are negative.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.llm.common import bound_batches, documents, table, text_chunks

#: Labelled documents that training takes at most, by class; longer texts are passed
#: over there. These bounds hold for training only: scoring reads every whole text.
TRAIN_TOXIC, TRAIN_OTHER, TRAIN_CHARS = 1200, 2400, 20_000
TOXIC_LANDMARKS, OTHER_LANDMARKS = 96, 96
#: Different words of non-toxic documents used as negative examples, at most.
NEGATIVE_WORDS = 20_000
#: Words whose kernel values are computed together.
KERNEL_WORDS = 4000
#: A witness leans to toxic documents by so many standard deviations at least.
LEAST_LEANING = 0.5
ROUNDS = 4
#: Weight of a toxic document's witness against a word of another document.
POSITIVE_WEIGHT = 1.0
DECAY, MAX_SPAN = 0.6, 5
#: Longer words are read in overlapping windows of so many letters.
WINDOW = 24
#: Words remembered by one task until it ends, and the longest worth remembering: some
#: 40 MB. Workers live on for later jobs, so that what outlasts a task adds to theirs.
CACHED_WORDS, CACHED_CHARS = 200_000, 64
HELD_OUT_FOLDS = 5

# Letter codes: a to z, then 37 shared by all other letters, then what is no letter.
CODES, GAP = 64, 63
#: Places of the second and third letter of a triple after the first.
TRIPLES = [(a, b) for b in range(2, MAX_SPAN) for a in range(1, b)]
#: Letters set apart by blanks, as in an insult spelled out.
SPELLED = re.compile(r"(?<!\S)(?:\S ){3,}\S(?!\S)")


def letter_code(letter: str) -> int:
    if "a" <= letter <= "z":
        return ord(letter) - ord("a")
    return 26 + ord(letter) % 37 if letter.isalpha() else GAP


@cache
def _codes() -> np.ndarray:
    return np.array([letter_code(chr(c)) for c in range(0x3000)], dtype=np.int64)


def words_of(text: str) -> list[str]:
    """Lower-case words between white space; letters spelled out also as one word."""
    lowered = text.lower()
    words = lowered.split()
    words.extend(m.replace(" ", "") for m in SPELLED.findall(lowered))
    return words


def _windows(word: str) -> list[str]:
    word = word.strip("!?.,;:&%$#*|<>()[]{}\"'’`-_=+/\\") or word[:1]
    if len(word) <= WINDOW:
        return [word]
    return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, triple, weight) of all triples of the words, scaled so that the weights of
    a word have norm 1 (equal triples of a word counted apart)."""
    width = max((len(w) for w in words), default=0)
    padded = "".join(w.ljust(width, "\0") for w in words)
    points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    table = _codes()
    letters = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 26 + points % 37)
    grid = letters.reshape(len(words), width) if width else np.zeros((len(words), 0), dtype=np.int64)
    rows, names, weights = [], [], []
    for a, b in TRIPLES:
        if b >= width:
            continue
        first, second, third = grid[:, : width - b], grid[:, a : width - b + a], grid[:, b:]
        row, place = np.nonzero((first != GAP) & (second != GAP) & (third != GAP))
        rows.append(row)
        names.append((first[row, place] * CODES + second[row, place]) * CODES + third[row, place])
        weights.append(np.full(len(row), DECAY ** (b + 1)))
    if not rows:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
    row, name, weight = np.concatenate(rows), np.concatenate(names), np.concatenate(weights)
    norms = np.sqrt(np.bincount(row, weight**2, minlength=len(words)))
    return row, name, weight / norms[row]


def _machine(
    features: np.ndarray, signs: np.ndarray, weights: np.ndarray, penalty: float, start: np.ndarray | None
) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))])
    solution = np.zeros(x.shape[1]) if start is None else start
    shrink = np.full(x.shape[1], penalty)
    shrink[-1] = 1e-6
    for _ in range(25):
        margin = signs * (x @ solution)
        inside = margin < 1
        part, w = x[inside], weights[inside]
        slope = shrink * solution - part.T @ (w * signs[inside] * (1 - margin[inside]))
        part *= np.sqrt(w)[:, None]
        curve = np.diag(shrink) + part.T @ part
        step = np.linalg.solve(curve, slope)
        solution = solution - step
        if np.abs(step).max() < 1e-4:
            break
    return solution


@dataclass(frozen=True)
class Model:
    """One weight per triple, a bias, and the map from a text's features to probability."""

    weights: np.ndarray
    bias: float
    curve: tuple[float, ...]

    def margins(self, words: list[str]) -> np.ndarray:
        """The largest margin among each word's windows."""
        cut = [_windows(w) for w in words]
        row, name, weight = triples([w for windows in cut for w in windows])
        sizes = [len(windows) for windows in cut]
        flat = np.bincount(row, weight * self.weights[name], minlength=sum(sizes)) + self.bias
        return np.maximum.reduceat(flat, np.cumsum([0, *sizes[:-1]])) if sizes else flat

    def features(self, margins: list[float]) -> tuple[float, float, float, float]:
        """Of a text with these margins of its different words: the largest, the second
        one, how many words there were to choose from, and 1."""
        worst = heapq.nlargest(2, margins)
        worst += [self.bias] * (2 - len(worst))
        return max(worst[0], self.bias), max(worst[1], self.bias), float(np.log1p(len(margins))), 1.0

    def probability(self, features: list[tuple[float, float, float, float]]) -> np.ndarray:
        logits = np.array(features, dtype=np.float64).reshape(-1, 4) @ np.array(self.curve)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    own_row, own_name, own_weight = triples(landmarks)
    # The landmarks' triples side by side, those that none has in a last row of zeros.
    names, place = np.unique(own_name, return_inverse=True)
    dense = np.zeros((len(names) + 1, len(landmarks)))
    np.add.at(dense, (place, own_row), own_weight)
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    for start in range(0, len(words), KERNEL_WORDS):
        row, name, weight = triples(words[start : start + KERNEL_WORDS])
        at = np.minimum(np.searchsorted(names, name), len(names) - 1)
        known = names[at] == name
        row, at, weight = row[known], at[known], weight[known]
        order = np.argsort(row, kind="stable")
        row, at, weight = row[order], at[order], weight[order]
        for piece in range(0, len(row), 50_000):
            some = slice(piece, piece + 50_000)
            values = dense[at[some]] * weight[some, None]
            firsts = np.flatnonzero(np.append(True, row[some][1:] != row[some][:-1]))
            out[start + row[some][firsts]] += np.add.reduceat(values, firsts, axis=0)
    return out


def _calibrated(x: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """A logistic curve through the features, by Newton steps."""
    high, low = toxic.sum() + 1.0, (~toxic).sum() + 1.0
    wanted = np.where(toxic, high / (high + 1), 1 / (low + 1))
    solution = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ solution, -30, 30)))
        slope = x.T @ (p - wanted) + 0.1 * solution
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        solution = solution - np.linalg.solve(curve, slope)
    return tuple(solution.tolist())


def train(bags: Iterable[tuple[list[str], bool]]) -> Model:
    """Fit on (words, toxic) of labelled documents; constant without both classes.

    The curve is fitted on margins by machines that have not seen the document: two
    halves, each judged by the machine of the other.
    """
    seen: dict[tuple[str, ...], bool] = {}
    shared: dict[str, str] = {}  # one object for each word, however many bags have it
    labels = []
    for words, toxic in bags:
        labels.append(toxic)
        bag = {v for w in set(words) for v in _windows(w)}
        seen.setdefault(tuple(sorted(shared.setdefault(v, v) for v in bag)), toxic)
    share = (sum(labels) + 1) / (len(labels) + 2)
    constant = Model(np.zeros(CODES**3, dtype=np.float32), 0.0, (0.0, 0.0, 0.0, float(np.log(share / (1 - share)))))
    # Both classes are spread evenly over the halves.
    ranked = sorted(seen, key=lambda b: (seen[b], len(b), b))
    halves = [ranked[0::2], ranked[1::2]]
    whole, *parts = (_weights({b: seen[b] for b in part}) for part in (ranked, *halves))
    if whole is None or None in parts:
        return constant
    features = [
        other.features(other.margins(list(b)).tolist())
        for half, other in zip(halves, (Model(*p, constant.curve) for p in reversed(parts)), strict=True)
        for b in half
    ]
    toxic = np.array([seen[b] for half in halves for b in half])
    return Model(*whole, _calibrated(np.array(features), toxic))


def _weights(seen: dict[tuple[str, ...], bool]) -> tuple[np.ndarray, float] | None:
    """Triple weights and bias of a machine for bags of words, or None without both
    classes."""
    toxic_bags = [list(b) for b, toxic in seen.items() if toxic]
    other_bags = [list(b) for b, toxic in seen.items() if not toxic]
    counts, against = Counter(), Counter()
    for bag in toxic_bags:
        counts.update(bag)
    for bag in other_bags:
        against.update(bag)
    if not counts or not against:
        return None

    def leaning(word: str) -> float:
        """How far the word's share of toxic documents exceeds that of others, in
        standard deviations."""
        a, b = counts[word], against[word]
        p, q = len(toxic_bags), len(other_bags)
        common = (a + b + 1) / (p + q + 2)
        return (a / p - b / q) / (common * (1 - common) * (1 / p + 1 / q)) ** 0.5

    usable = sorted(w for w in counts if len(w) >= 3)
    marked = sorted(usable, key=lambda w: (-leaning(w), w))[:TOXIC_LANDMARKS]
    plain = [w for w in sorted(against, key=lambda w: (-against[w], w)) if len(w) >= 3]
    usual = [w for w in plain if w not in set(marked)]
    spread = usual[:: max(1, len(usual) // OTHER_LANDMARKS)][:OTHER_LANDMARKS]
    landmarks = marked + spread
    if not marked or not spread:
        return None

    inner = _kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh(inner)
    good = values > 1e-6
    root = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)

    negative = plain[:: max(1, len(plain) // NEGATIVE_WORDS)][:NEGATIVE_WORDS]
    below = _kernel(negative, landmarks) @ root
    everything = sorted(w for w in counts if len(w) >= 3 and leaning(w) > LEAST_LEANING)
    place = {w: i for i, w in enumerate(everything)}
    above = _kernel(everything, landmarks) @ root
    members = [np.array([place[w] for w in bag if w in place], dtype=np.int64) for bag in toxic_bags]
    members = [m for m in members if len(m)]
    leanings = np.array([leaning(w) for w in everything])
    solution = None
    for turn in range(ROUNDS):
        margin = leanings if solution is None else above @ solution[:-1].astype(np.float32) + solution[-1]
        chosen = np.array([m[margin[m].argmax()] for m in members])
        # A bag whose best word is no more than the words of other documents are is
        # left out: its label comes from something else than a word.
        limit = 2.0 if solution is None else -0.5
        chosen = chosen[margin[chosen] > limit]
        if not len(chosen):
            break
        x = np.vstack([above[chosen], below]).astype(np.float64)
        signs = np.concatenate([np.ones(len(chosen)), -np.ones(len(below))])
        # A word counts by the documents that it stands for; both classes weigh alike.
        evened = np.full(len(chosen), POSITIVE_WEIGHT * len(other_bags) / len(toxic_bags))
        balance = np.concatenate([evened, [against[w] for w in negative]])
        solution = _machine(x, signs, balance, 1.0, solution)
    if solution is None:
        return None
    by_landmark = root @ solution[:-1]
    row, name, weight = triples(landmarks)
    weights = np.zeros(CODES**3)
    np.add.at(weights, name, weight * by_landmark[row])
    return weights.astype(np.float32), float(solution[-1])


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees."""
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A bounded sample (doc_id, toxic, text) of the labelled documents outside the
    held-out fold.

    It has at most TRAIN_TOXIC and TRAIN_OTHER documents of TRAIN_CHARS characters at most,
    chosen by a hash of the id, so that it is the same at each call. Of rows that repeat an
    id the one of greatest text counts. Null texts and ids, labels that are null and those
    that contradict each other for one id are passed over.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter(F.col("toxic") == F.col("most"))
        .select("doc_id", "toxic")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.filter("toxic = 1").orderBy(*order).limit(TRAIN_TOXIC)
    picked = picked.unionAll(known.filter("toxic = 0").orderBy(*order).limit(TRAIN_OTHER))
    texts = docs.select("doc_id", "text").filter(F.length("text") <= TRAIN_CHARS)
    # Broadcast: TRAIN_TOXIC + TRAIN_OTHER rows of two numbers at most.
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic")
    return rows.agg(F.max("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the bounded sample of training_rows().

    One task trains on it; the driver gets the weights, about a megabyte. Without documents
    or labels the model is constant.
    """
    sample = training_rows(docs, labels).repartition(1)
    found = sample.mapInArrow(_trained, "weights binary, bias double, curve array<double>").collect()
    if not found:
        return train([])
    return Model(np.frombuffer(found[0]["weights"], dtype=np.float32), found[0]["bias"], tuple(found[0]["curve"]))


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the model of all rows (doc_id, toxic, text)."""
    rows = sorted((r["doc_id"], r["toxic"], r["text"]) for batch in batches for r in batch.to_pylist())
    model = train((words_of(text), toxic == 1) for _, toxic, text in rows)
    row = {"weights": model.weights.tobytes(), "bias": float(model.bias), "curve": list(model.curve)}
    kinds = [("weights", pa.binary()), ("bias", pa.float64()), ("curve", pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_pylist([row], pa.schema(kinds))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """Add ``name``: the probability that a text is toxic, from its two worst words and
    the number of its different words.

    Every whole text is read. A null text counts as an empty one; a text without words
    gets the value of a word without letters. Repeated rows get equal values. An empty
    table gives an empty one. Other columns stay; one of that name is replaced.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.drop(name)
    schema = T.StructType([*plain.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        for batch, texts in text_chunks(batches, text):
            words = [set(words_of(t)) for t in texts]
            new = list(set().union(*words).difference(known))
            known.update(zip(new, model.margins(new).tolist(), strict=True))
            worst = [model.features(list(map(known.__getitem__, w))) for w in words]
            room = CACHED_WORDS - len(known) + len(new)
            for place, word in enumerate(new):
                if place >= room or len(word) > CACHED_CHARS:
                    del known[word]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.probability(worst))], schema=pa.schema([*batch.schema, (name, pa.float64())])
            )

    return plain.mapInArrow(run, schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labelled ones."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    # The text goes into the scoring only, its id comes out.
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
