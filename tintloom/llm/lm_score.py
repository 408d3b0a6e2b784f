"""Masked pseudo-likelihood of documents under a small network that reads both sides of every word.

The network predicts a word from the two words before and the two after it: position-wise embeddings are
summed and squashed, and the word is predicted in two steps, its class and its place in the class. The
network lists the most frequent words of the whole corpus, and has hashed buckets for all others. A word of a
bucket has its share of the bucket's count in the corpus, so every word has a probability of its own; an unseen
one counts as UNSEEN. The COMMON most frequent words are sent to the tasks that score, counts of all others are
joined.

Texts are dealt to shards by a hash of their ids and words, and lie in a shard in the order of that hash, so the
weights depend on the rows of the corpus alone, not on how they are stored or on the cluster. In each round
every shard takes Adagrad steps from the same weights, and the shards' weights are averaged, by groups of GROUP
until few are left for the driver. What is counted and averaged grows with the corpus; every word of every text
is predicted once, in one of the rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintloom.llm.common import discard, slices, small_batches, stored, utf8
from tintloom.llm.scan import Words

CLASSES, PER_CLASS, BUCKETS, WIDTH = 32, 32, 64, 16
VOCABULARY = CLASSES * PER_CLASS
OFFSETS = (-2, -1, 1, 2)
#: Rounds of training, which share out the positions of a text between them, words in a step, and its rate.
ROUNDS, STEP_WORDS, RATE = 2, 1024, 0.15
#: What all words that the corpus lacks count in each bucket, and the words whose counts are broadcast.
UNSEEN, COMMON = 0.5, 1 << 18
CHUNK, GROUP, BLOCK, PIECE = 1 << 20, 32, 8192, 1 << 19
#: Words of a shard on average, and partitions that shards are dealt to at most; a partition may hold several shards.
SHARD_WORDS, PARTITIONS = 1 << 21, 1 << 16
#: Equal rows that are a thousandth of all are hot; there can't be more than a thousand such. Copies of one are made in blocks.
HOT, COPIES = 1000, 10_000


class Network(NamedTuple):
    embed: np.ndarray  # offset, word or border, width
    bias: np.ndarray  # width
    to_class: np.ndarray  # width, class
    class_bias: np.ndarray
    to_word: np.ndarray  # class, width, place
    word_bias: np.ndarray  # class, place


def new_network(seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return Network(small(len(OFFSETS), VOCABULARY + 1, WIDTH), np.zeros(WIDTH, np.float32), small(WIDTH, CLASSES), np.zeros(CLASSES, np.float32), small(CLASSES, WIDTH, PER_CLASS), np.zeros((CLASSES, PER_CLASS), np.float32))


class Vocabulary(NamedTuple):
    listed: np.ndarray  # hashes of the words that the network lists, most frequent first
    common: np.ndarray  # sorted hashes of the words whose counts are broadcast
    common_logs: np.ndarray  # logarithms of their counts
    bucket_logs: np.ndarray  # logarithm of each bucket's count
    rare: DataFrame | None  # (word, n) of all words that are not common
    size: int  # words of the corpus


def word_counts(docs: DataFrame) -> DataFrame:
    """The stored counts (word, n) of all words of all texts, by their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def report() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"])

        for batch in slices(batches, "text", PIECE):
            hashes = Words(utf8(batch.column("text")), lower=True).hashes()
            waiting.append(hashes)
            size += len(hashes)
            if size >= CHUNK:
                yield report()
                waiting, size = [], 0
        if size:
            yield report()

    return stored(docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def vocabulary_of(docs: DataFrame) -> Vocabulary:
    counts = word_counts(docs)
    rows = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - BUCKETS).collect()
    listed = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    # The common words are those whose counts have the highest powers of two, as many powers as COMMON allows.
    power, least, size = F.floor(F.log2("n")), 1 << 62, 0
    for r in sorted(counts.groupBy(power.alias("power")).count().collect(), key=lambda r: -r["power"]):
        size += r["count"]
        if size > COMMON:
            break
        least = r["power"]
    found = counts.where(power >= least).toArrow()
    common, n = found.column("word").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(common)
    buckets = np.zeros(BUCKETS, np.int64)
    for r in counts.groupBy(F.shiftrightunsigned("word", 58).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        buckets[r["bucket"]] = r["n"]
    size = int(buckets.sum())
    np.subtract.at(buckets, (listed >> np.uint64(58)).astype(np.int64), np.array([r["n"] for r in rows], np.int64))
    return Vocabulary(listed, common[order], np.log(n[order]), np.log(buckets + UNSEEN), counts.where(power < least), size)


def contexts_of(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The words around each word of texts that begin at `first`, by offset; beyond a text's border there is none."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    context = np.full((len(OFFSETS), len(ids)), VOCABULARY, np.int32)
    for k, o in enumerate(OFFSETS):
        here, there = (slice(-o, None), slice(None, o)) if o < 0 else (slice(None, -o), slice(o, None))
        same = owner[here] == owner[there]
        context[k, here][same] = ids[there][same]
    return context


class Reader:
    """Turns texts into word numbers with their contexts."""

    def __init__(self, vocabulary: Vocabulary):
        order = np.argsort(vocabulary.listed)
        self.hashes, self.numbers, self.vocabulary = vocabulary.listed[order], order.astype(np.int32), vocabulary

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, their contexts by offset, and the first word of each text."""
        return self.read(texts)[:3]

    def shares(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithm of each word's share of its bucket, and which words still lack the logarithm of their count."""
        out, rare = np.zeros(len(ids)), np.zeros(len(ids), bool)
        at = np.flatnonzero(ids >= VOCABULARY - BUCKETS)
        out[at] = -self.vocabulary.bucket_logs[ids[at] - (VOCABULARY - BUCKETS)]
        rare[at] = True
        if len(self.vocabulary.common):
            place = np.minimum(np.searchsorted(self.vocabulary.common, h[at]), len(self.vocabulary.common) - 1)
            known = self.vocabulary.common[place] == h[at]
            out[at[known]] += self.vocabulary.common_logs[place[known]]
            rare[at[known]] = False
        return out, rare

    def read(self, texts: list[bytes], contexts: bool = True) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
        """What a call gives, and the hashes of the words; contexts only if asked for."""
        words = Words(texts, lower=True)
        h = words.hashes()
        ids = (VOCABULARY - BUCKETS + (h >> np.uint64(58)).astype(np.int32) % BUCKETS).astype(np.int32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            known = self.hashes[at] == h
            ids[known] = self.numbers[at[known]]
        return ids, contexts_of(ids, words.first) if contexts else None, words.first, h


def _exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(x) scaled (x is too), with the sum of each row; by one number for all rows, where none gets lost by it."""
    ones = np.ones(x.shape[1], x.dtype)
    x -= x.max(initial=-np.inf)
    e = np.exp(x)
    total = e @ ones
    if len(total) and total.min() < 1e-30:
        x -= x.max(axis=1, keepdims=True)
        e = np.exp(x)
        total = e @ ones
    return e, total


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The entries `at` of the rows' logarithms of softmax; changes x."""
    _, total = _exponentials(x)
    return x[np.arange(len(x)), at] - np.log(total)


def _softmax(x: np.ndarray) -> np.ndarray:
    e, total = _exponentials(x)
    e /= total[:, None]
    return e


def _hidden(net: Network, context: np.ndarray) -> np.ndarray:
    total = net.bias + net.embed[0][context[0]]
    for k in range(1, len(OFFSETS)):
        total += net.embed[k][context[k]]
    return np.tanh(total)


def log_probabilities(net: Network, ids: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Log probability of every word given its context."""
    out = np.empty(len(ids), np.float64)
    for a in range(0, len(ids), BLOCK):
        part = ids[a : a + BLOCK]
        group, place = part // PER_CLASS, part % PER_CLASS
        hidden = _hidden(net, context[:, a : a + BLOCK])
        score = _log_softmax_at(hidden @ net.to_class + net.class_bias, group)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(CLASSES + 1))
        for c in np.flatnonzero(np.diff(cuts)).tolist():
            at = order[cuts[c] : cuts[c + 1]]
            score[at] += _log_softmax_at(hidden[at] @ net.to_word[c] + net.word_bias[c], place[at])
        out[a : a + BLOCK] = score
    return out


def gradients(net: Network, ids: np.ndarray, context: np.ndarray) -> Network:
    """Gradients of the mean negative log probability."""
    n = len(ids)
    group, place = ids // PER_CLASS, ids % PER_CLASS
    hidden = _hidden(net, context)
    g = Network(*[np.zeros_like(p) for p in net])
    delta = _softmax(hidden @ net.to_class + net.class_bias)
    delta[np.arange(n), group] -= 1
    delta /= n
    g.to_class[:] = hidden.T @ delta
    g.class_bias[:] = delta.sum(axis=0)
    back = delta @ net.to_class.T
    # The words in order of their classes, so that each class is one slice.
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.diff(group[order], prepend=-1))
    cuts = [*first.tolist(), n]
    classes, parts = group[order[first]], [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    inside = hidden[order]
    inner = net.word_bias[group[order]]
    for c, at in zip(classes, parts, strict=True):
        inner[at] += inside[at] @ net.to_word[c]
    inner = _softmax(inner)
    inner[np.arange(n), place[order]] -= 1
    inner /= n
    g.word_bias[classes] = np.add.reduceat(inner, first, axis=0)
    below = np.empty_like(inside)
    for c, at in zip(classes, parts, strict=True):
        g.to_word[c] = inside[at].T @ inner[at]
        below[at] = inner[at] @ net.to_word[c].T
    back[order] += below
    back *= 1 - hidden * hidden
    g.bias[:] = back.sum(axis=0)
    for k in range(len(OFFSETS)):
        cells = context[k][:, None] * WIDTH + np.arange(WIDTH, dtype=context.dtype)
        g.embed[k] = np.bincount(cells.ravel(), back.ravel(), g.embed[k].size).reshape(g.embed[k].shape)
    return g


def _bytes(net: Network) -> bytes:
    return b"".join(p.astype(np.float32).tobytes() for p in net)


def _network(data: np.ndarray) -> Network:
    parts, at = [], 0
    for p in new_network():
        parts.append(data[at : at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return Network(*parts)


def sequences(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The stored word numbers (spread, ids) of every row that has words; `spread` is a hash of its id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary._replace(rare=None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in slices(batches, "text", PIECE):
            ids, _, first, _ = reader.read(utf8(batch.column("text")), contexts=False)
            offsets = pa.py_buffer((2 * first).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("spread"), pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(ids.astype(np.uint16))])], ["spread", "ids"])

    found = docs.select(F.xxhash64("doc_id", "text").alias("spread"), "text").mapInArrow(run, "spread long, ids binary")
    return stored(found.where(F.octet_length("ids") > 0), "sequences")


def spread_copies(rows: DataFrame) -> DataFrame:
    """The rows (spread, ids), where those of hot classes of equal rows have a spread of their own each, the same in every layout."""
    total = rows.count()
    hot = rows.groupBy("spread").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & (F.col("n") * HOT >= total)).collect()
    if not hot:
        return rows
    hot = F.broadcast(rows.sparkSession.createDataFrame([(r["spread"], r["n"]) for r in hot], "spread long, n long"))
    one = rows.join(hot, "spread").groupBy("spread").agg(F.min("ids").alias("ids"), F.max("n").alias("n"))
    blocks = one.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES)))).repartition("spread", "block")
    copies = blocks.withColumn("copy", F.explode(F.sequence(F.col("block") * COPIES, F.least((F.col("block") + 1) * COPIES, F.col("n")) - 1)))
    return rows.join(hot, "spread", "left_anti").union(copies.select(F.xxhash64("spread", "copy").alias("spread"), "ids"))


class Trainer:
    """Adagrad steps on the words of one shard, STEP_WORDS at a time however they arrive."""

    def __init__(self, start: Network):
        self.net = Network(*[p.copy() for p in start])
        self.grown = [np.full(p.shape, 1e-6, np.float32) for p in start]
        self.ids, self.contexts, self.waiting, self.trained = [], [], 0, 0

    def add(self, ids: np.ndarray, context: np.ndarray) -> None:
        self.ids.append(ids)
        self.contexts.append(context)
        self.waiting += len(ids)
        if self.waiting >= STEP_WORDS:
            self._steps(self.waiting // STEP_WORDS * STEP_WORDS)

    def _steps(self, most: int) -> None:
        ids, context = np.concatenate(self.ids), np.concatenate(self.contexts, axis=1)
        for a in range(0, most, STEP_WORDS):
            part = slice(a, min(most, a + STEP_WORDS))
            for p, g, s in zip(self.net, gradients(self.net, ids[part], context[:, part]), self.grown, strict=True):
                s += g * g
                p -= RATE * g / np.sqrt(s)
        self.trained += most
        self.ids, self.contexts, self.waiting = [ids[most:]], [context[:, most:]], len(ids) - most

    def finish(self) -> None:
        if self.waiting:
            self._steps(self.waiting)


def train_round(rows: DataFrame, shards: int, net: Network, turn: int) -> Network:
    """The average of the weights that all shards of `rows` (spread, ids) reach from `net`, weighted by words."""
    shared = rows.sparkSession.sparkContext.broadcast(net)
    schema = "shard long, n long, weights binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, trainer = None, None

        def report() -> pa.RecordBatch:
            trainer.finish()
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "n": pa.array([trainer.trained], pa.int64()), "weights": pa.array([_bytes(trainer.net)], pa.binary())})

        for batch in slices(batches, "ids", PIECE):
            names = batch.column("shard").to_numpy()
            cuts = [*np.flatnonzero(np.diff(names, prepend=-1)).tolist(), len(names)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if names[a] != shard:
                    if trainer is not None and trainer.trained + trainer.waiting:
                        yield report()
                    shard, trainer = int(names[a]), Trainer(shared.value)
                texts = batch.column("ids").slice(a, b - a).to_pylist()
                first = np.cumsum([0, *[len(t) // 2 for t in texts]])
                word = np.frombuffer(b"".join(texts), np.uint16).astype(np.int32)
                at = np.flatnonzero((np.arange(len(word)) - np.repeat(first[:-1], np.diff(first))) % ROUNDS == turn)
                trainer.add(word[at], contexts_of(word, first)[:, at])
        if trainer is not None and trainer.trained + trainer.waiting:
            yield report()

    def mean(table: pa.Table) -> pa.Table:
        total, n = weighted(table.sort_by("shard").to_pylist())
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py() // GROUP], pa.int64()), "n": pa.array([n], pa.int64()), "weights": pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())})

    def weighted(found) -> tuple[np.ndarray, int]:
        return sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * r["n"] for r in found), sum(r["n"] for r in found)

    count = min(shards, PARTITIONS)
    named = rows.withColumn("shard", F.pmod("spread", F.lit(shards)))
    dealt = named.repartitionById(count, F.pmod("shard", F.lit(count)).cast("int")).sortWithinPartitions("shard", "spread", "ids")
    found = stored(dealt.select("shard", "ids").mapInArrow(run, schema), "weights")
    while shards > GROUP:
        former, shards = found, -(-shards // GROUP)
        found = stored(former.groupBy(F.floor(F.col("shard") / GROUP).alias("group")).applyInArrow(mean, schema), "weights")
        discard(former)
    averaged = sorted(found.collect(), key=lambda r: r["shard"])
    discard(found)
    if not averaged:
        return net
    total, n = weighted(averaged)
    return _network(total / n)


def train(docs: DataFrame) -> tuple[Vocabulary, Network]:
    """Vocabulary and network of a corpus (doc_id, text); they depend on its rows alone, in whatever order and partitions."""
    small_batches(docs.sparkSession)
    vocabulary, net = vocabulary_of(docs), new_network()
    shards = max(1, -(-vocabulary.size // SHARD_WORDS))
    rows = sequences(docs, vocabulary)
    dealt = spread_copies(rows)
    for turn in range(ROUNDS):
        net = train_round(dealt, shards, net, turn)
    discard(rows)
    return vocabulary, net


def score(docs: DataFrame, vocabulary: Vocabulary, net: Network) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) of every row of `docs` (doc_id, text).

    log_likelihood sums the log probability of each word given its neighbours, over the whole text. A text
    without words, or null, has the sum 0 and a null mean. Rows are scored one by one, repeated ones alike;
    no rows give no rows; further columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary._replace(rare=None), net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary, net = shared.value
        reader, row = Reader(vocabulary), TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", PIECE):
            ids, context, first, hashes = reader.read(utf8(batch.column("text")))
            shares, rare = reader.shares(ids, hashes)
            sums = np.concatenate([[0.0], np.cumsum(log_probabilities(net, ids, context) + shares)])
            total = sums[first[1:]] - sums[first[:-1]]
            ends = np.concatenate([[0], np.cumsum(rare)])[first].astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[rare].view(np.int64)))
            rows = pa.array(np.arange(row, row + len(total)))
            row += len(total)
            yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id"), pa.array(np.diff(first).astype(np.int64)), pa.array(total), words], ["row", "doc_id", "n_words", "total", "rare"])

    found = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "row long, doc_id long, n_words long, total double, rare array<long>"), "scores")
    words = found.select("row", F.explode("rare").alias("word")).join(vocabulary.rare, "word", "left")
    counts = words.groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(UNSEEN)))).alias("more"))
    total = F.col("total") + F.coalesce("more", F.lit(0.0))
    mean = F.when(F.col("n_words") > 0, total / F.col("n_words"))
    # The last digits depend on which texts are multiplied together.
    return found.drop("rare").join(counts, "row", "left").select("doc_id", "n_words", F.round(total, 2).alias("log_likelihood"), F.round(mean, 4).alias("mean_log_likelihood"))
