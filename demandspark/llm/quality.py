"""Quality classifier: overlapping heuristic labellers, their accuracies by EM, a hashed linear scorer."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.blocks import KEPT_PIECES, Places, map_blocks
from demandspark.llm.common import sent

#: (name, good up to, bad from): a share up to the first number is a vote for good, from the second one for
#: bad, and between them no vote. Up to SHORT_WORDS words give no vote on repetition.
LABELLERS = (("upper", 0.25, 0.5), ("symbols", 0.02, 0.05), ("cells", 0.02, 0.08), ("odd_words", 0.15, 0.25), ("same_next", 0.1, 0.2),
             ("repeated", 0.5, 0.65), ("repeated_lines", 0.2, 0.5), ("digits", 0.1, 0.3), ("long_words", 0.05, 0.2), ("seen_runs", 0.1, 0.3))
LINES, RUNS = (next(i for i, labeller in enumerate(LABELLERS) if labeller[0] == name) for name in ("repeated_lines", "seen_runs"))
SHORT_WORDS = 10
#: Words in a stretch over which repetition is measured, as it grows with the stretch in any prose.
STRETCH = 200
#: Words in a run that "seen_runs" looks for earlier in the whole text; prose hardly repeats so many, however long it is.
RUN = 5
PLAIN_WORD = re.compile(rb"(?<!\S)[(\"']?[A-Za-z\x80-\xff][a-z\x80-\xff'-]*[.,;:?!)\"']?(?!\S)")
#: Hash buckets of the scorer, documents of the fit, steps of its descent.
BUCKETS = 1 << 15
FIT_DOCS = 4_000
FIT_STEPS = 300
L2 = 1e-4
#: Documents at this probability of being good, or above, stay: those that are rather good than junk.
KEEP_FROM = 0.5
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))


def shares(text: bytes) -> tuple[float, ...]:
    """The labellers' shares of one text; words are what white space separates."""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.lower().split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, solid = len(words), max(1, len(text) - int(count[[9, 10, 11, 12, 13, 32]].sum()))
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    symbols = int(count[list(b"#$%&*+<=>@[\\]^_`{}~!")].sum())
    return (upper / max(1, upper + lower), symbols / solid, int(count[124]) / max(1, n),
            1 - len(PLAIN_WORD.findall(text)) / max(1, n), sum(map(bytes.__eq__, words, words[1:])) / max(1, n),
            1 - sum(len(set(words[i:i + STRETCH])) for i in range(0, n, STRETCH)) / max(1, n),
            1 - len(set(lines)) / max(1, len(lines)), int(count[48:58].sum()) / solid, sum(map((40).__lt__, map(len, words))) / max(1, n),
            1 - len(set(map(hash, zip(*(islice(words, k, None) for k in range(RUN)))))) / (n - RUN + 1) if n >= RUN else 0.0)


def votes(text: bytes, found: tuple[float, ...] | None = None) -> str:
    """One letter per labeller: g, b or - for no vote. An empty text gets no votes. ``found`` are its ``shares``, if known."""
    if not text.split():
        return "-" * len(LABELLERS)
    short = len(text.split(None, SHORT_WORDS)) <= SHORT_WORDS
    return "".join("-" if short and name in ("same_next", "repeated", "repeated_lines", "seen_runs") else "b" if x >= bad else "g" if x <= good else "-"
                   for x, (name, good, bad) in zip(found or shares(text), LABELLERS))


@dataclass
class LabelModel:
    """Chances of a good and a bad vote given the class and that there is a vote, and the share of good documents."""
    prior: float
    given_good: np.ndarray
    given_bad: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        """Probability of being good. Labellers count as independent given the class."""
        at = _codes(patterns)
        column = np.arange(at.shape[1])
        good = np.log(self.prior) + np.log(self.given_good[column, at]).sum(1)
        bad = np.log(1 - self.prior) + np.log(self.given_bad[column, at]).sum(1)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def _codes(patterns: list[str]) -> np.ndarray:
    return np.array([["gb-".index(c) for c in p] for p in patterns], int).reshape(len(patterns), -1)


def fit_label_model(patterns: list[str], counts: np.ndarray, rounds: int = 500) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns.

    The start takes half the votes or more for bad, or two of them, as bad: most labellers see only one
    kind of junk and find nothing wrong with the others. Smoothing keeps every chance above zero. The patterns are at
    most 3 to the power of the labellers, whatever the corpus.
    """
    at, n = _codes(patterns), np.asarray(counts, float)
    bad = (at == 1).sum(1)
    good = np.where((bad >= 2) | (2 * bad >= (at != 2).sum(1)) & (bad > 0), 0.02, 0.98)
    for _ in range(rounds):
        tables = []
        for weight in (n * good, n * (1 - good)):
            table = np.array([np.bincount(votes, weight, 3) for votes in at.T]) + 0.5
            table /= table[:, :2].sum(1, keepdims=True)
            table[:, 2] = 1.0  # no vote says nothing
            tables.append(table)
        model = LabelModel(float(((n * good).sum() + 1) / (n.sum() + 2)), *tables)
        new = model.posterior(patterns)
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return model


SHAPES = bytes(65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 97 if b >= 128 or 97 <= b <= 122 else b for b in range(256))
LONG_RUN = re.compile(rb"(.)\1{2,}", re.S)


def _shape(word: bytes) -> bytes:
    """Case, digits and marks of a word, runs cut short; other bytes count as small letters."""
    return LONG_RUN.sub(rb"\1\1", word.translate(SHAPES))


class Features:
    """Hashed features of texts: each word, its shape, whether it, a line or a run of words repeats one before it.

    A feature's value is its share of the words; features per distinct word are computed once while kept.
    """

    def __init__(self, buckets: int = BUCKETS, kept: int = KEPT_PIECES):
        self.buckets, self.kept = buckets, kept
        self.whole = [crc32(s) % buckets for s in (b"\x00same", b"\x00again", b"\x00line", b"\x00runs", b"\x00bias")]
        self.forget()

    def forget(self) -> None:
        self.place, self.lower = Places(), Places()
        self.word, self.shape, self.low = array("i"), array("i"), array("i")

    def of(self, texts: list[bytes], found: list[tuple[float, ...]] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Buckets and values of each text; buckets may occur twice. ``found`` are the texts' ``shares``, if known."""
        if len(self.place) > self.kept:
            self.forget()
        docs = []
        for text in texts:
            words = text.split()
            docs.append(np.fromiter(map(self.place.__getitem__, words), np.int64, len(words)))
        for w in list(islice(self.place, len(self.word), None)):
            low = w.lower()
            self.word.append(crc32(b"\x01" + low) % self.buckets)
            self.shape.append(crc32(b"\x02" + _shape(w)) % self.buckets)
            self.low.append(self.lower[low])
        word, shape, low = (np.array(x, np.int32) for x in (self.word, self.shape, self.low))
        for doc, share in zip(docs, map(shares, texts) if found is None else found):
            n = max(1, len(doc))
            small = low[doc]
            same = float((small[1:] == small[:-1]).sum()) / n
            again = 1 - len(np.unique(small)) / n if len(doc) else 0.0
            index = np.concatenate([word[doc], shape[doc], self.whole])
            value = np.full(len(index), 1 / n)
            value[-5:] = same, again, share[LINES], share[RUNS], 1.0
            yield index, value


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, buckets: int = BUCKETS, steps: int = FIT_STEPS) -> np.ndarray:
    """Logistic weights for soft targets, by full-batch descent with per-weight step sizes.

    Both classes weigh the same in sum, so that a rare one is not drowned.
    """
    of = np.repeat(np.arange(len(rows), dtype=np.int32), [len(i) for i, _ in rows])
    index = np.concatenate([i for i, _ in rows])
    value = np.concatenate([v for _, v in rows])
    n = len(rows)
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    weight = target * 0.5 / share + (1 - target) * 0.5 / (1 - share)
    weight /= weight.sum()
    w, squares = np.zeros(buckets), np.full(buckets, 1e-12)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, value * w[index], n), -30, 30)))
        grad = np.bincount(index, value * (weight * (p - target))[of], buckets) + L2 * w / buckets
        squares += grad ** 2
        w -= 0.5 * grad / np.sqrt(squares)
    return w


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fit_docs: int = FIT_DOCS) -> QualityModel | None:
    """Label model from the votes on all documents, scorer from at most ``fit_docs`` picked by a hash.

    None if no document has a word.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            given = pd.Series([votes(t.encode()) for t in part["text"]], dtype=object)
            yield given.value_counts().rename_axis("pattern").reset_index(name="n")

    counts = map_blocks(rows.select("text"), vote, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    counts = counts[counts["pattern"] != "-" * len(LABELLERS)].sort_values("pattern")
    if counts.empty:
        return None
    labels = fit_label_model(counts["pattern"].tolist(), counts["n"].to_numpy())

    def prepare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for part in frames:
            texts = [t.encode() for t in part["text"]]
            found, made = list(map(shares, texts)), []
            for index, value in features.of(texts, found):
                bucket, where = np.unique(index, return_inverse=True)
                made.append((bucket.astype(np.int32), np.bincount(where, value).astype(np.float32)))
            yield pd.DataFrame({"pattern": list(map(votes, texts, found)), "bucket": [m[0] for m in made], "value": [m[1] for m in made]})

    picked = rows.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("h", F.xxhash64("id")).select("h", "text")
    chosen = pick_by_hash(picked, fit_docs)
    sample = map_blocks(chosen, prepare, "pattern string, bucket array<int>, value array<float>").toPandas()
    target = labels.posterior(sample["pattern"].tolist())
    return QualityModel(labels, fit_scorer(list(zip(sample["bucket"], sample["value"])), target))


def pick_by_hash(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hashes ``h``; the cut is found on the hashes alone."""
    smallest = rows.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return rows.filter(F.col("h") <= F.lit(smallest if smallest is not None else 0)).drop("h").limit(most)


class Judge:
    """Votes, posterior and quality of texts under a model; patterns met before are looked up."""

    def __init__(self, model: QualityModel | None):
        self.model, self.features, self.known = model, Features(), {}

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float], np.ndarray]:
        coded = [t.encode() for t in texts]
        found = list(map(shares, coded))
        given = list(map(votes, coded, found))
        new = [p for p in set(given) if p not in self.known]
        if new:
            self.known.update(zip(new, self.model.labels.posterior(new).tolist() if self.model else [0.0] * len(new)))
        total = np.array([float(self.model.weights[i] @ v) if self.model else 0.0 for i, v in self.features.of(coded, found)])
        some = np.array([bool(t.strip()) for t in coded], bool)
        return given, [self.known[p] for p in given], np.where(some, 1 / (1 + np.exp(-np.clip(total, -500, 500))), 0.0)


def score(docs: DataFrame, model: QualityModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, votes, weak_label, quality, kept`` for every row of ``docs``.

    ``weak_label`` is the label model's posterior, ``quality`` the scorer's probability. A text that is
    null, empty or white space has no votes, quality 0 and is rejected, as it holds nothing to train on.
    Repeated rows give repeated answers; no rows give no rows; other columns are not read. Each text
    is read whole, in blocks of bounded size.
    """
    model_of = sent(docs.sparkSession, model)  # BUCKETS weights

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Judge(model_of())
        for rows in frames:
            given, weak, quality = judge(rows["text"].tolist())
            yield pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "votes": given, "weak_label": weak, "quality": quality,
                                "kept": quality >= KEEP_FROM})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return map_blocks(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, votes string, weak_label double, quality double, kept boolean")


def keep_good(docs: DataFrame, model: QualityModel | None, text: str = "text") -> DataFrame:
    """The rows that ``score`` keeps, with all their columns."""
    model_of = sent(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model_of())
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                rows = batch.slice(at, 1_000)
                quality = judge([t or "" for t in rows.column(text).to_pylist()])[2]
                yield rows.filter(pa.array(quality >= KEEP_FROM))

    return docs.mapInArrow(run, docs.schema)
