"""Language identification with string kernels.

The kernel of two texts is the mean over n of the cosine of their sets of byte n-grams (a
blended spectrum of presence, ASCII letters lower-cased, everything but letters one
separator). N-grams are hashed into ``DIMENSIONS`` places. Nyström landmarks stand for the
kernel: one-versus-rest kernel ridge regression is solved in their span, and as the kernel is
a sum of scalar products, kernel times weights folds into one matrix per n, so that texts are
scored by a few matrix products per batch.

The training sample is bounded: ``sample`` documents in all, the same number per language (of the ``sample``
most frequent languages, should there be more). A language's documents fall into that many classes by
a hash of id and text, and each class gives the document of its least hash, so that neither a task nor
the driver gets more than the bound, whatever repeats. They are featurised on the executors. Everything else reads whole texts.

Null text and text without a letter get ``und`` and score 0. Documents without a label are
never learned from. Without a single labelled document every text gets ``und``. Rows are
handled one by one; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm import text as tx
from claimweave.llm.tables import fresh, quoted

#: Documents of the training sample and landmarks among them, at most.
SAMPLE, LANDMARKS = 1600, 400
ORDERS = (1, 2, 3, 4)
DIMENSIONS = 1 << 13
RIDGE = 1e-3
#: Sharpness of the softmax that turns ridge outputs into a score.
SHARPNESS = 6.0
UNKNOWN = "und"

_LETTER = np.zeros(256, np.uint64)
for _b in (*range(0x61, 0x7B), *range(0x80, 0x100)):
    _LETTER[_b] = _b
for _b in range(0x41, 0x5B):
    _LETTER[_b] = _b + 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def presence(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each n, a 0/1 matrix of documents by hashed n-grams."""
    n_docs = len(offsets) - 1
    out = [np.zeros((n_docs, DIMENSIONS), np.uint8) for _ in ORDERS]
    for first in range(0, n_docs):
        begin, end = int(offsets[first]), int(offsets[first + 1])
        for at in range(begin, end, tx.PIECE):  # pieces overlap by the longest n-gram
            code = _LETTER[data[at : min(end, at + tx.PIECE + max(ORDERS) - 1)]]
            gram = np.zeros(len(code), np.uint64)
            for k, n in enumerate(ORDERS):
                if len(code) < n:
                    break
                gram = gram[: len(code) - n + 1] * np.uint64(0x100) + code[n - 1 :]
                place = ((gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)
                out[k][first][place.astype(np.int64)] = 1
    return out


def _rows(column: pa.Array, limit: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of at most ``limit`` documents."""
    for _, data, offsets in tx.groups(column):
        for k in range(0, len(offsets) - 1, limit):
            yield data, offsets[k : k + limit + 1]


def has_letter(column: pa.Array) -> np.ndarray:
    """Which texts have a Unicode letter."""
    out = np.zeros(len(column), bool)
    at = 0
    for _, data, offsets in tx.groups(column):
        letters = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data])))
        out[at : at + len(offsets) - 1] = letters[offsets[1:]] > letters[offsets[:-1]]
        at += len(offsets) - 1
    for k in np.flatnonzero(~out):
        value = column[int(k)].as_py()
        out[k] = value is not None and any(c.isalpha() for c in value)
    return out


class Model:
    """Folded weights: one DIMENSIONS x languages matrix per n."""

    def __init__(self, packed: list[bytes], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.languages = sorted(set(labels))
        if not labels:
            self.fold = []
            return
        # grams stay packed; one n and one block of documents at a time are numbers
        bits = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), len(ORDERS), -1)
        marks = np.arange(len(labels))[:: max(1, -(-len(labels) // landmarks))]
        kernel = np.zeros((len(labels), len(marks)))
        for k in range(len(ORDERS)):
            at_marks = self._scaled(bits[marks, k])
            for at in range(0, len(labels), 128):
                kernel[at : at + 128] += self._scaled(bits[at : at + 128, k]) @ at_marks.T
            del at_marks
        kernel /= len(ORDERS)
        target = np.where(np.array(labels)[:, None] == np.array(self.languages)[None, :], 1.0, -1.0)
        weight = 1 / np.array([labels.count(x) for x in labels], float)[:, None]  # languages count alike
        left = kernel.T @ (kernel * weight) + ridge * kernel[marks] + 1e-9 * np.eye(len(marks))
        alpha = np.linalg.solve(left, kernel.T @ (target * weight))
        self.fold = [(self._scaled(bits[marks, k]).T @ (alpha / len(ORDERS)).astype(np.float32)) for k in range(len(ORDERS))]

    @staticmethod
    def _scaled(packed: np.ndarray) -> np.ndarray:
        """Rows of unit length from packed sets of grams."""
        x = np.unpackbits(packed, axis=1).astype(np.float32)
        x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        return x

    def scores(self, grams: list[np.ndarray]) -> np.ndarray:
        total = 0.0
        for x, v in zip(grams, self.fold, strict=True):
            x = x.astype(np.float32)
            total = total + (x @ v) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        return total


def train(docs: DataFrame, text: str, lang: str, doc_id: str, sample: int = SAMPLE) -> Model:
    """Model of the labelled ``docs``; ids are used to choose the sample, nothing else."""
    labelled = docs.where(quoted(lang).isNotNull() & quoted(text).isNotNull()).select(quoted(lang).cast("string").alias("l"), quoted(text).alias("t"), F.xxhash64(quoted(doc_id), quoted(text)).alias("h"))
    languages = [r["l"] for r in labelled.groupBy("l").count().orderBy(F.desc("count"), "l").limit(sample).collect()]
    each = max(1, sample // max(1, len(languages)))
    own = labelled.where(F.col("l").isin(languages)) if len(languages) == sample else labelled
    chosen = own.groupBy("l", F.pmod("h", F.lit(each)).alias("c")).agg(F.min("h").alias("h")).select("l", "h")
    # at most ``sample`` rows of two short columns; a repeated document stands for one
    pairs = labelled.join(F.broadcast(chosen), ["l", "h"], "left_semi").groupBy("l", "h").agg(F.min("t").alias("t")).select("l", "t")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for data, offsets in _rows(batch.column(1)):
                stack = np.stack(presence(data, offsets), axis=1)
                packed += [x.tobytes() for x in np.packbits(stack, axis=2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["l", "bits"])

    rows = sorted(map(tuple, pairs.mapInArrow(features, "l string, bits binary").collect()))
    return Model([bits for _, bits in rows], [label for label, _ in rows])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language`` (renamed with ``_`` where taken): ``lang``, ``score``."""
    out = fresh(docs, "language")
    name = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            column = batch.column(name)
            best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
            known = has_letter(column)
            at = 0
            for data, offsets in _rows(column) if own.languages else ():
                values = own.scores(presence(data, offsets)).astype(np.float64)
                n = len(values)
                weights = np.exp(SHARPNESS * (values - values.max(1, keepdims=True)))
                best[at : at + n] = values.argmax(1)
                score[at : at + n] = weights.max(1) / weights.sum(1)
                at += n
            known &= bool(own.languages)
            langs = pa.array([own.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string())
            struct = pa.StructArray.from_arrays([langs, pa.array(np.where(known, score, 0.0))], names=["lang", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, out])

    struct = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(out, struct)]))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> tuple[DataFrame, Model]:
    """Train on the documents outside the held-out fold, predict all."""
    model = train(docs.where(~held_out(quoted(doc_id)) & quoted(doc_id).isNotNull()), text, lang, doc_id)
    return predict(docs, model, text), model


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` whose language is known with a score of at least ``least``."""
    found = predict(docs, model, text)
    language = F.col(found.columns[-1])
    return found.where((language["lang"] != UNKNOWN) & (language["score"] >= least)).select(*(quoted(c) for c in docs.columns))
