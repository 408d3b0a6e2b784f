"""Byte-exact removal of repeated passages with a distributed enhanced suffix array.

A suffix is placed by the rarest-looking part of its first `length` bytes: of the hashes of all k-byte strings
in that window, the smallest (the leftmost of equal ones) names the bucket. Equal windows have equal hashes,
so all suffixes that share `length` bytes meet in one bucket, whatever documents they are in, and the interval
tree of the whole corpus above that depth falls apart into trees of single buckets. Neighbouring suffixes
mostly have the same place; such a run of window starts is one row (bucket, document, part, first, number).

1. Buckets seen once are dropped: their windows occur once.
2. Runs of a bucket with the same bytes are one context. All but the first run of a context repeat an earlier
   one whole, however many they are.
3. Of buckets with several contexts, the contexts of the first runs form an enhanced suffix array. A stack
   scan of its common prefixes yields the interval tree; every interval of `length` bytes or more with two
   left extensions or more is a maximal repeat, given with all its occurrences. All but the first go.

A bucket with more than MANY_CONTEXTS contexts, as edited copies of one text give, isn't sorted in one task: its
windows are placed anew by longer strings, which most edits break, so that edited windows part from the common
ones and the rest become equal contexts. The last strings are the windows themselves, of which equal ones are
one context, so nothing is left to sort however large the group is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tintloom.llm.common import discard, numbered, release, slices, small_batches, stored, utf8
from tintloom.llm.scan import mix64, powers, prefix_hashes

LENGTH, GRAMS = 100, (32, 80)
#: Contexts of a bucket that are sorted together.
MANY_CONTEXTS = 1000
#: Bytes of text that are hashed at once, and of contexts that are sorted at once.
PIECE, SORT_BYTES = 1 << 19, 1 << 20
NULL_ID = -(1 << 63)


def window_places(raw: np.ndarray, edges: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, start, stop) of the runs of window starts of texts raw[edges[i]:edges[i + 1]].

    Runs don't cross texts; the windows at start to stop - 1 have the leftmost of their smallest hashes at the
    same byte. So equal windows, which have it at equal distance, are never in one run.
    """
    n = len(raw) - gram + 1
    reach = length - gram + 1
    if n < reach:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    prefix = prefix_hashes(raw)
    h = mix64(((prefix[gram:] - prefix[:n]) * powers(n)[1][:n]))
    # The smallest of each window's hashes.
    key, span = h, 1
    while span < reach:
        step = min(span, reach - span)
        key = np.minimum(key[: len(key) - step], key[step:])
        span += step
    starts = np.arange(len(key))
    lengths = np.diff(edges)
    owner_stop = np.repeat(edges[1:], lengths)[: len(key)]
    valid = starts + length <= owner_stop
    change = np.empty(len(key), bool)
    change[0] = True
    # The leftmost place of the smallest hash changes with its value, and where it falls out of the window.
    change[1:] = (key[1:] != key[:-1]) | (key[:-1] == h[: len(key) - 1])
    change[edges[:-1][edges[:-1] < len(key)]] = True
    change[1:] |= valid[1:] != valid[:-1]
    first = np.flatnonzero(change)
    stop = np.append(first[1:], len(key))
    good = valid[first]
    return key[first[good]], first[good], stop[good]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text): null ids as the smallest number; rows that share an id get rising parts in the order of their texts.

    Parts are numbers of one range sort, so that an id that very many rows share isn't numbered in one task.
    """
    known = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), "text")
    twice = stored(known.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    if twice.isEmpty():
        return known.select("doc_id", F.lit(0).cast("long").alias("part"), "text")
    several = stored(known.join(twice, "doc_id", "left_semi").withColumn("start", F.substring("text", 1, 200)), "repeated-texts")
    several = numbered(several, ["doc_id", "start"], ["text"], "part").drop("start")
    return known.join(twice, "doc_id", "left_anti").select("doc_id", F.lit(0).cast("long").alias("part"), "text").unionByName(stored(several, "repeated-rows"))


def runs_of(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(bucket, doc_id, part, place) of every run of every text; place holds first window start and number of starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            raw, edges = _joined(utf8(batch.column("text")))
            bucket, first, stop = window_places(raw, edges, length, gram)
            at = np.searchsorted(edges, first, side="right") - 1
            doc, part = (pa.array(batch.column(c).to_numpy()[at]) for c in ("doc_id", "part"))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), doc, part, pa.array((first - edges[at]) << 8 | (stop - first))], ["bucket", "doc_id", "part", "place"])

    return docs.mapInArrow(run, "bucket long, doc_id long, part long, place long")


def _by_text(runs: DataFrame) -> DataFrame:
    """(doc_id, part, runs) of runs (bucket, doc_id, part, place)."""
    return runs.groupBy("doc_id", "part").agg(F.collect_list(F.struct("bucket", "place")).alias("runs"))


def _with_runs(docs: DataFrame, by_text: DataFrame) -> DataFrame:
    """(text, doc_id, part, runs) of the texts that have any runs.

    Of stored runs the size is known, so that Spark moves the texts only where the runs are too many to send.
    """
    return docs.join(by_text, ["doc_id", "part"])


def context_digests(texts: DataFrame, length: int) -> DataFrame:
    """(bucket, k1, k2, doc_id, part, place) of the runs of `texts`, with a digest of each run's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            lists = batch.column("runs")
            inner = lists.flatten()
            bucket, place = inner.field("bucket"), inner.field("place")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            raw = utf8(batch.column("text"))
            p = place.to_numpy()
            first = p >> 8
            ends = first + (p & 255) + length - 1
            digests = b"".join([xxhash.xxh3_128_digest(raw[o][a:b]) for o, a, b in zip(owner.tolist(), first.tolist(), ends.tolist(), strict=True)])
            k = np.frombuffer(digests, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([bucket, pa.array(k[:, 0]), pa.array(k[:, 1]), *[pa.array(batch.column(c).to_numpy()[owner]) for c in ("doc_id", "part")], place], ["bucket", "k1", "k2", "doc_id", "part", "place"])

    return texts.mapInArrow(run, "bucket long, k1 long, k2 long, doc_id long, part long, place long")


def finer_digests(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Like `context_digests`, of the windows of the runs of `texts` placed anew by strings of `gram` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            rows = [(r["bucket"], doc, part, r["place"], raw[(f := r["place"] >> 8) : f + (r["place"] & 255) + length - 1]) for raw, doc, part, runs in zip(utf8(batch.column("text")), *(batch.column(c).to_pylist() for c in ("doc_id", "part", "runs")), strict=True) for r in runs]
            raw, edges = _joined([r[4] for r in rows])
            bucket, first, stop = window_places(raw, edges, length, gram)
            at = np.searchsorted(edges, first, side="right") - 1
            old = np.array([r[:4] for r in rows], np.int64).reshape(-1, 4)[at]
            whole = raw.tobytes()
            k = np.frombuffer(b"".join([xxhash.xxh3_128_digest(whole[a:b]) for a, b in zip(first.tolist(), (stop + length - 1).tolist(), strict=True)]), np.int64).reshape(-1, 2)
            place = (old[:, 3] >> 8 << 8) + ((first - edges[at]) << 8) + (stop - first)
            finer = mix64(bucket ^ old[:, 0].view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(finer), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(old[:, 1]), pa.array(old[:, 2]), pa.array(place)], ["bucket", "k1", "k2", "doc_id", "part", "place"])

    return texts.mapInArrow(run, "bucket long, k1 long, k2 long, doc_id long, part long, place long")


def context_bytes(texts: DataFrame, length: int) -> DataFrame:
    """(bucket, doc_id, part, place, bytes) of the runs of `texts`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            rows = [(r["bucket"], doc, part, r["place"], raw[(f := r["place"] >> 8) : f + (r["place"] & 255) + length - 1]) for raw, doc, part, runs in zip(utf8(batch.column("text")), *(batch.column(c).to_pylist() for c in ("doc_id", "part", "runs")), strict=True) for r in runs]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())], ["bucket", "doc_id", "part", "place", "bytes"])

    return texts.mapInArrow(run, "bucket long, doc_id long, part long, place long, bytes binary")


def repeated_starts(raw: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the starts have a `length`-byte string whose hash another start has too."""
    prefix = prefix_hashes(raw)
    h = (prefix[starts + length] - prefix[starts]) * powers(len(raw) + 1)[1][starts]
    _, which, counts = np.unique(h, return_inverse=True, return_counts=True)
    return counts[which] > 1


def suffix_array(raw: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The order of the suffixes at `starts`, of limits[i] bytes each; an ended one comes before those that go on."""
    width = int(limits.max(initial=1))
    # UTF-8 has no byte 255, so that every byte can be raised by one and 0 can stand for the end.
    padded = np.concatenate([raw + np.uint8(1), np.zeros(width, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    rows[np.arange(width) >= limits[:, None]] = 0
    return np.argsort(rows.view(f"S{width}").ravel(), kind="stable")


def common_prefixes(text: np.ndarray, order: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix of `order` with the one before it, within its context (limits[i] bytes are left of it)."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    most = np.minimum(limits[1:], limits[:-1])
    alive, a, b, n = np.arange(len(order) - 1), order[:-1].copy(), order[1:].copy(), np.zeros(len(order) - 1, np.int64)
    while len(alive):
        width = 16
        inside = np.arange(width)
        x = text[np.minimum(a[alive, None] + n[alive, None] + inside, len(text) - 1)]
        y = text[np.minimum(b[alive, None] + n[alive, None] + inside, len(text) - 1)]
        same = (x == y) & (n[alive, None] + inside < most[alive, None])
        step = np.where(same.all(axis=1), width, same.argmin(axis=1))
        n[alive] += step
        alive = alive[step == width]
    out[1:] = n
    return out


def repeat_groups(order: np.ndarray, lcp: np.ndarray, left: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, from, to) of the intervals order[from:to] whose suffixes share `depth` >= least bytes and have two left bytes or more.

    `left` holds the byte before each suffix of `order`, or a number of its own where a context begins. One
    stack scan; an interval's left bytes are those of its suffixes, kept as one byte or 'several' (-1).
    """
    inner = np.flatnonzero(np.append(lcp, 0) >= least)
    breaks = np.flatnonzero(np.diff(inner) != 1) + 1
    for part in np.split(inner, breaks) if len(inner) else ():
        first, last = int(part[0]) - 1, int(part[-1])  # suffixes first to last share `least` bytes
        depths, bytes_ = [*lcp[part].tolist(), 0], left[first : last + 1].tolist()
        stack: list[list[int]] = []  # depth, first suffix, left byte or -1
        for k, depth in enumerate(depths):
            begin, byte = first + k, bytes_[k]
            while stack and stack[-1][0] > depth:
                top_depth, begin, top_byte = stack.pop()
                byte = top_byte if top_byte == byte else -1
                if byte == -1:
                    yield top_depth, begin, first + k + 1
            if stack and stack[-1][0] == depth:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else -1
            elif depth:
                stack.append([depth, begin, byte])


def maximal_repeats(contexts: list[bytes], numbers: np.ndarray, ranks: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, contexts, offsets) of every maximal repeat of `least` bytes or more among the window starts of the contexts.

    Context i has numbers[i] window starts, at its offsets 0, 1, ...; ranks[i] is its place in reading order.
    The first occurrence in reading order is put first.
    """
    raw, edges = _joined(contexts)
    owner = np.repeat(np.arange(len(contexts)), numbers)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
    starts = edges[owner] + offset
    again = repeated_starts(raw, starts, least)
    starts, owner, offset = starts[again], owner[again], offset[again]
    at = suffix_array(raw, starts, edges[owner + 1] - starts)
    order, who, where = starts[at], owner[at], offset[at]
    lcp = common_prefixes(raw, order, edges[who + 1] - order)
    left = np.where(where > 0, raw[np.maximum(order - 1, 0)].astype(np.int64), 256 + who)
    for depth, begin, stop in repeat_groups(order, np.where(lcp >= least, lcp, 0), left, least):
        members = np.arange(begin, stop)
        members = members[np.lexsort((where[members], ranks[who[members]]))]
        yield depth, who[members], where[members]


def repeated_spans(contexts: DataFrame, length: int) -> DataFrame:
    """(doc_id, part, start, stop): bytes of the contexts (bucket, doc_id, part, place, bytes) that repeat an earlier one's.

    Buckets are dealt whole; each partition is sorted by bucket and worked in portions of SORT_BYTES.
    """

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        doc, part, place = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
        texts = [r[4] for r in rows]
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort((place, part, doc))] = np.arange(len(rows))
        edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        change = np.zeros(int(edges[-1]) + 1, np.int64)
        for depth, who, where in maximal_repeats(texts, place & 255, rank, length):
            at = edges[who[1:]] + where[1:]
            np.add.at(change, at, 1)
            np.add.at(change, at + depth, -1)
        covered = np.cumsum(change[:-1]) > 0
        border = np.diff(covered.view(np.int8), prepend=0) == 1
        inside = edges[:-1][covered[edges[:-1]]]
        border[inside] = True
        starts = np.flatnonzero(border)
        ends = np.diff(covered.view(np.int8), append=0) == -1
        ends[edges[1:][covered[edges[1:] - 1]] - 1] = True
        stops = np.flatnonzero(ends) + 1
        owner = np.searchsorted(edges, starts, side="right") - 1
        base = (place[owner] >> 8) - edges[owner]
        return pa.RecordBatch.from_arrays([pa.array(doc[owner]), pa.array(part[owner]), pa.array(starts + base), pa.array(stops + base)], ["doc_id", "part", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size >= SORT_BYTES and row[0] != rows[-1][0]:
                    yield spans(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield spans(rows)

    dealt = contexts.select("bucket", "doc_id", "part", "place", "bytes").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "doc_id long, part long, start long, stop long")


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans [start, stop), joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            if stop > out[-1][1]:
                out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
    return out


def first_digests(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The stored digests of all runs whose bucket has another run."""
    spark, runs = texts.sparkSession, runs_of(texts, length, gram)
    again = stored(runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "buckets")
    release(spark)
    found = stored(runs.join(again, "bucket", "left_semi"), "runs")
    discard(again)
    release(spark)
    digests = stored(context_digests(_with_runs(texts, _by_text(found)), length), "digests")
    discard(found)
    release(spark)
    return digests


def repeated_parts(texts: DataFrame, length: int, grams: tuple[int, ...]) -> list[DataFrame]:
    """Stored tables (doc_id, part, start, stop) of all bytes that repeat earlier ones."""
    spark, keys, parts = texts.sparkSession, ["bucket", "k1", "k2"], []
    start, number = F.shiftright("place", 8), F.col("place").bitwiseAND(F.lit(255).cast("long"))
    digests = first_digests(texts, length, grams[0])
    for finer in (*grams[1:], length, None):
        contexts = stored(digests.groupBy(*keys).agg(F.min(F.struct("doc_id", "part", "place")).alias("first"), F.count(F.lit(1)).alias("n")), "contexts")
        later = digests.join(contexts.where("n > 1").select(*keys, "first"), keys).where(F.struct("doc_id", "part", "place") > F.col("first"))
        parts.append(stored(later.select("doc_id", "part", start.alias("start"), (start + number + (length - 1)).alias("stop")), "whole"))
        discard(digests)
        release(spark)
        several = stored(contexts.groupBy("bucket").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1"), "several")
        firsts = stored(contexts.select("bucket", "first.doc_id", "first.part", "first.place").join(several, "bucket"), "firsts")
        discard(contexts, several)
        small = firsts.where(F.col("contexts") <= (MANY_CONTEXTS if finer else 1 << 62)).drop("contexts")
        sorted_ = stored(_by_text(small), "sorted")
        parts.append(stored(repeated_spans(context_bytes(_with_runs(texts, sorted_), length), length), "partly"))
        large = firsts.where(F.col("contexts") > MANY_CONTEXTS).drop("contexts")
        discard(sorted_)
        if finer is None or large.isEmpty():
            discard(firsts)
            break
        anew = stored(_by_text(large), "anew")
        digests = stored(finer_digests(_with_runs(texts, anew), length, finer), "digests")
        discard(firsts, anew)
        release(spark)
    release(spark)
    return parts


def remove_repeats(docs: DataFrame, length: int = LENGTH, grams: tuple[int, ...] = GRAMS, keep: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row of `docs` (doc_id, text), with `kept` (bytes) if asked.

    Removed is every byte covered by a `length`-byte string that also starts earlier: in a smaller doc_id, or
    earlier in the text. `spans` are the removed byte ranges, apart from each other. A null text is empty, a
    null doc_id comes before all others. Rows that share an id come in the order of their texts; a repeated
    row so loses what the first one has. Texts below `length` bytes keep all. Further columns are left out.
    """
    if not 8 <= grams[0] <= length <= 255 or max(grams) > length:
        raise ValueError("8 <= grams <= length <= 255")
    texts = keyed(docs)
    small_batches(docs.sparkSession)
    parts = repeated_parts(texts, length, grams)
    gone = reduce(DataFrame.union, parts).groupBy("doc_id", "part").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept_sha256", T.StringType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "stop")])))])
    if keep:
        schema = schema.add("kept", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in slices(batches, "text", PIECE):
            rows = []
            for raw, spans in zip(utf8(batch.column("text")), batch.column("gone").to_pylist(), strict=True):
                cut = merged_spans([(s["start"], s["stop"]) for s in spans or []])
                kept = b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in cut)], [*(a for a, _ in cut), len(raw)], strict=True)) if cut else raw
                rows.append((len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), [{"start": a, "stop": b} for a, b in cut], kept))
            n, removed, count, digest, cuts, kept = zip(*rows, strict=True) if rows else ([],) * 6
            arrays = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(cuts, span_type)]
            yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(kept, pa.binary())] if keep else [])], schema.names)

    ended = texts.join(gone, ["doc_id", "part"], "left").mapInArrow(run, schema)
    return ended.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))
