"""Toxic documents and the sentences that make them so, by multiple-instance learning.

Labels are given for documents, but it is sentences that offend. A sentence gets a probability from the words it
holds and from how they begin, so inflected forms count alike; words and beginnings are hashed into a table of weights. A document is toxic unless none of its sentences is: 1 - prod(1 - p). That noisy-or is trained
from document labels alone, so the weights it finds belong to sentences, and scoring a document
also says where it offends.

The model is fitted on the driver on a bounded sample of labelled texts; its weights have a fixed size. Scoring
reads each text once, in place.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import batches_of, labelled_sample, sigmoid, texts

#: Most labelled texts, and bytes of them, that a model is fitted on.
SAMPLE_ROWS = 10_000
SAMPLE_BYTES = 20_000_000
#: Places of the table of weights, a power of two.
PLACES = 1 << 20
#: Lengths of the beginnings of a word that count besides the whole word.
BEGINNINGS = (3, 4, 5, 6, 8)
#: Words of a task whose weight is looked up again; a full table starts anew.
KNOWN_WORDS = 500_000

_SENTENCE = re.compile(r"[^.!?\n|]+[.!?\n|]*")
_EDGES = " \t\r\n\x0b\x0c.,;:!?\"'()[]{}|*#$%&<>=+-"


def features(raw: str) -> list[int]:
    """Places of a word as it stands in a text: itself and its beginnings, without case and marks around it."""
    word = raw.strip(_EDGES).lower()
    if not word:
        return []
    found = [zlib.crc32(f"={word}".encode())]
    found += [zlib.crc32(word[:n].encode()) for n in BEGINNINGS if n <= len(word)]
    return [x & (PLACES - 1) for x in found]


@dataclass(frozen=True)
class SentenceModel:
    """The table of weights, and the bias of a sentence."""

    weights: np.ndarray
    bias: float

    def sentences(self, text: str, known: dict[str, float]) -> tuple[list[tuple[int, int]], np.ndarray]:
        """First and end place of each sentence, and its probability."""
        spans, scores = [], []
        for m in _SENTENCE.finditer(text):
            total = 0.0
            for raw in set(m.group().split()):
                weight = known.get(raw)
                if weight is None:
                    if len(known) >= KNOWN_WORDS:
                        known.clear()
                    weight = known[raw] = float(self.weights[features(raw)].sum())
                total += weight
            spans.append(m.span())
            scores.append(total)
        return spans, sigmoid(np.array(scores, float) + self.bias)


def noisy_or(probabilities: np.ndarray) -> float:
    """The probability that at least one holds; 0 of none."""
    with np.errstate(divide="ignore"):
        return float(-np.expm1(np.log1p(-probabilities).sum()))


def fit(sample: list[tuple[bytes, int]], rounds: int = 100, rate: float = 0.3, l1: float = 2e-4) -> SentenceModel:
    """Maximise the likelihood of the labels under the noisy-or, with few words of weight.

    Adagrad steps on the whole sample; weights shrink towards 0, so words that tell nothing end there. Without both
    labels there is nothing to learn: every sentence then gets the bias, which is low or high.
    """
    labels = np.array([y for _, y in sample], float)
    nothing = np.zeros(PLACES, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return SentenceModel(nothing, 5.0 if len(labels) and labels[0] else -12.0)
    # Each sentence's distinct words, each word's places.
    number: dict[str, int] = {}
    words, sentence_of, doc_of = array("i"), array("i"), array("i")
    for doc, (text, _) in enumerate(sample):
        for sentence in _SENTENCE.findall(text.decode()):
            own = [number.setdefault(w, len(number)) for w in set(sentence.split())]
            words.extend(own)
            sentence_of.extend([len(doc_of)] * len(own))
            doc_of.append(doc)
    words, sentence_of, doc_of = (np.array(x, np.int32) for x in (words, sentence_of, doc_of))
    at, word_of = array("i"), array("i")
    for w, k in number.items():
        found = features(w)
        at.extend(found)
        word_of.extend([k] * len(found))
    count = len(number)
    del number
    places, at = np.unique(np.array(at, np.int32), return_inverse=True)
    word_of = np.array(word_of, np.int32)
    weight, bias, n = np.zeros(len(places)), -6.0, len(labels)
    seen, seen_bias = np.full(len(places), 1e-8), 1e-8
    share = np.full(n, 1 / n)
    for _ in range(rounds):
        of_word = np.bincount(word_of, weight[at], count)
        z = np.bincount(sentence_of, of_word[words], len(doc_of)) + bias
        p = sigmoid(z)
        # -log(1 - p) of the document: the sum of softplus over its sentences.
        total = np.bincount(doc_of, np.logaddexp(0, z), n)
        pull = np.where(labels > 0, -1 / np.expm1(np.clip(total, 1e-9, 500)), 1.0) * share
        slope = p * pull[doc_of]
        of_word = np.bincount(words, slope[sentence_of], count)
        step = np.bincount(at, of_word[word_of], len(places))
        seen += step**2
        pace = rate / np.sqrt(seen)
        weight -= pace * step
        weight = np.sign(weight) * np.maximum(np.abs(weight) - pace * l1, 0)
        seen_bias += slope.sum() ** 2
        bias -= rate / np.sqrt(seen_bias) * slope.sum()
    nothing[places] = weight
    return SentenceModel(nothing, float(bias))


def train(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    rows: int = SAMPLE_ROWS,
    max_bytes: int = SAMPLE_BYTES,
    required: bool = False,
) -> SentenceModel:
    """Fit on the labelled documents for which ``training`` holds, up to both bounds.

    With ``required``, labelled documents of which none fits into the bounds are an error.
    """
    return fit(labelled_sample(docs, labels, "toxic", training, rows, max_bytes, required))


def score(docs: DataFrame, model: SentenceModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted and the offending sentences of every whole text.

    ``offending`` lists number, first and end place (in characters) and probability of each sentence whose own probability reaches
    ``threshold``. Missing and empty texts have no sentences and score 0. Rows without doc_id, repeated rows and
    texts of any length are scored like others; columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    # A table of fixed size.
    shared = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("sentence", pa.int32()), ("first", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches_of(batches):
            scores, spots = [], []
            for text in batch.column(1):
                spans, p = shared.value.sentences(text.as_py().decode(), known)
                scores.append(noisy_or(p))
                spots.append(
                    [
                        {"sentence": int(i), "first": spans[i][0], "end": spans[i][1], "p": float(p[i])}
                        for i in np.flatnonzero(p >= threshold)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spots, kind)], ["doc_id", "score", "offending"]
            )

    scored = texts(docs).mapInArrow(
        run, "doc_id long, score double, offending array<struct<sentence: int, first: int, end: int, p: double>>"
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: SentenceModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns and nothing else."""
    spark, schema = docs.sparkSession, docs.schema
    shared = spark.sparkContext.broadcast(model)
    at = [f.name for f in schema].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches_of(batches):
            clean = [noisy_or(shared.value.sentences(t.as_py() or "", known)[1]) < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, schema)
