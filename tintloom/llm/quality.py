"""Quality rules: base counts, and a calibrated logistic regression on hashed word and character n-grams.

The regression is fitted on at most MAX_LABELLED labelled documents (those with the smallest hashes of their
ids): three quarters train the weights, the rest fit the calibration from score to probability. Executors
hash the n-grams, so what reaches the driver of a document is bounded by the number of buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tintloom.llm.common import slices, small_batches, utf8
from tintloom.llm.scan import Words, windows

BUCKETS_LOG2, CHAR_GRAMS, WORD_GRAMS = 16, (2, 4), (1, 2)
MAX_LABELLED, STEPS, RATE, RIDGE = 2000, 120, 0.3, 1e-6
#: A text fails the base rules with fewer words, or with a larger percentage of words in repeated windows; it is kept from this probability on.
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_PROBABILITY = 50, 50, 0.5
SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = bytes(range(128, 192)) + b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
PIECE = 1 << 19


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, means: np.ndarray) -> np.ndarray:
        """Calibrated probability of good quality from the mean weights of texts."""
        return 1 / (1 + np.exp(-np.clip(self.slope * (means + self.bias) + self.shift, -500, 500)))


#: Without labels of both kinds nothing can be learned, and the model passes every text.
NEUTRAL = Model(np.zeros(1 << BUCKETS_LOG2, np.float32), 0.0, 0.0, 50.0)


def repeated_words(triples: np.ndarray, n_words: int) -> int:
    """Words inside three-word windows whose hash occurs twice or more."""
    ordered = np.sort(triples)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.unique(twice)
    hit = found[np.minimum(np.searchsorted(found, triples), len(found) - 1)] == triples
    covered = np.zeros(n_words, bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def base_counts(texts: list[bytes], words: Words, hashes: np.ndarray) -> list[tuple[int, ...]]:
    """COUNTS of each text."""
    triples, out = windows(hashes, 3), []
    for text, a, b in zip(texts, words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        out.append(
            (
                b - a,
                len(text.translate(None, _NOT_COUNTED)),
                len(text) - len(text.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)),
                repeated_words(triples[a : max(a, b - 2)], b - a),
            )
        )
    return out


def grams(words: Words, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind of n-gram: buckets by position, and first and last-but-one position of each text."""
    shift = np.uint64(64 - BUCKETS_LOG2)
    found = []
    for n in WORD_GRAMS:
        h = windows(hashes, n)
        found.append(((h >> shift).astype(np.uint32), words.first[:-1], np.maximum(words.first[:-1], words.first[1:] - n + 1)))
    raw = words.raw.astype(np.uint32)
    for n in CHAR_GRAMS:
        h = np.full(max(0, len(raw) - n + 1), n, np.uint32)
        for k in range(n):
            h *= np.uint32(0x01000193)
            h += raw[k : k + len(h)]
        h *= np.uint32(0x9E3779B1)
        starts = words.edges[:-1]
        found.append((h >> np.uint32(32 - BUCKETS_LOG2), starts, np.maximum(starts, words.edges[1:] - 1 - n + 1)))
    return found


def mean_weights(weights: np.ndarray, words: Words, hashes: np.ndarray) -> np.ndarray:
    """The mean weight of each text's n-grams of a kind, summed over the kinds."""
    total = np.zeros(len(words.edges) - 1)
    for buckets, starts, stops in grams(words, hashes):
        w = weights[buckets]
        total += [float(w[a:b].mean(dtype=np.float64)) if b > a else 0.0 for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
    return total


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares, so that shares times weights sum to its mean weight."""
    words = Words([text])
    total = np.zeros(1 << BUCKETS_LOG2)
    for buckets, starts, stops in grams(words, words.hashes()):
        part = buckets[int(starts[0]) : int(stops[0])]
        if len(part):
            total += np.bincount(part, minlength=len(total)) / len(part)
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at].astype(np.float32)


def labelled_features(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(fold, quality, buckets, shares) of at most `most` labelled documents."""
    small_batches(docs.sparkSession)
    chosen = (
        labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("__quality"), F.min("quality").alias("__least"))
        .where("__quality = __least").drop("__least").orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "quality": batch.column("__quality"), "at": pa.array([a.tobytes() for a, _ in made], pa.binary()), "share": pa.array([s.tobytes() for _, s in made], pa.binary())})

    found = rows.mapInArrow(run, "doc_id long, quality int, at binary, share binary").toArrow()
    picked = {}
    # Of several texts of one document the one whose features sort first teaches, whatever order they arrive in.
    for doc, quality, at, share in sorted(zip(*[c.to_pylist() for c in found.columns], strict=True), key=lambda r: (r[0], r[2], r[3])):
        picked.setdefault(doc, ((doc * 0x9E3779B97F4A7C15 >> 62) & 3, quality, np.frombuffer(at, np.int32), np.frombuffer(share, np.float32)))
    return [picked[d] for d in sorted(picked)]


def fit(rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Model:
    """Weights by full-batch Adagrad on folds 1 to 3, then slope and shift of the calibration by Newton steps on fold 0."""
    train, held = [r for r in rows if r[0]], [r for r in rows if not r[0]]
    if len({r[1] for r in train}) < 2 or len({r[1] for r in held}) < 2:
        return NEUTRAL
    size = 1 << BUCKETS_LOG2
    owner = np.repeat(np.arange(len(train)), [len(r[2]) for r in train])
    at, share = np.concatenate([r[2] for r in train]), np.concatenate([r[3] for r in train])
    y = np.array([r[1] for r in train], np.float64)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    w, bias, grown, grown_bias = np.zeros(size), 0.0, np.full(size, 1e-12), 1e-12
    for _ in range(STEPS):
        z = np.bincount(owner, share * w[at], len(train)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * balance
        g = np.bincount(at, share * error[owner], size) + RIDGE * w
        grown += g * g
        w -= RATE * g / np.sqrt(grown)
        grown_bias += error.sum() ** 2
        bias -= RATE * error.sum() / np.sqrt(grown_bias)
    z = np.array([float(r[3] @ w[r[2]]) + bias for r in held])
    # Targets short of 0 and 1 keep the calibration finite where the scores part the classes.
    good = sum(r[1] for r in held)
    t = np.array([(good + 1) / (good + 2) if r[1] else 1 / (len(held) - good + 2) for r in held])
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        v = np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[(v * z * z).sum() + 1e-6, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(hessian, np.array([((p - t) * z).sum(), (p - t).sum()]))
        step *= min(1.0, 1.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
    return Model(w.astype(np.float32), float(bias), float(a), float(b))


def judge(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """`columns` of `docs` (all if None) with __n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words, __base_failed, __probability and __kept.

    A null or empty text has no words and fails the base rules. A text of any length is read whole. Rows are
    judged one by one, so repeated rows are judged alike; no rows give no rows.
    """
    added = [*(f"__{c}" for c in COUNTS), "__base_failed", "__probability", "__kept"]
    carry = [c for c in (columns if columns is not None else docs.columns) if c not in added]
    schema = T.StructType([*[f for f in docs.schema.fields if f.name in carry], *[T.StructField(n, T.LongType()) for n in added[:5]], T.StructField(added[5], T.BooleanType()), T.StructField(added[6], T.DoubleType()), T.StructField(added[7], T.BooleanType())])
    names = [f.name for f in schema.fields[: -len(added)]]
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text", PIECE):
            texts = utf8(batch.column("text"))
            words = Words(texts)
            hashes = words.hashes()
            counts = np.array(base_counts(texts, words, hashes), np.int64).reshape(-1, len(COUNTS))
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
            p = model.probability(mean_weights(model.weights, words, hashes))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *[pa.array(counts[:, i]) for i in range(len(COUNTS))], pa.array(failed), pa.array(p), pa.array(~failed & (p >= MIN_PROBABILITY))], schema.names)

    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(run, schema)


def fit_on(docs: DataFrame, labels: DataFrame) -> Model:
    """The model for `docs` (doc_id, text) from `labels` (doc_id, quality); ids whose labels differ teach nothing."""
    return fit(labelled_features(docs, labels))
