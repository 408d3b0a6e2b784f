"""Exact Jaccard join of documents on word shingles, with set-relation skipping.

Any two sets of Jaccard similarity 0.8 share an element among the first n - ceil(0.8 n) + 1 of each, in any
common order of elements. The order here is: elements that many sets hold ("heavy") last, else by hash. How
many sets hold an element is counted over the whole corpus.

1. Index lists of light elements are short. They are cut into blocks by set size and prefix position; a block
   whose best possible overlap with a set is too small is skipped. Pairs that share enough light elements to
   be similar at all are compared.
2. Lists of heavy elements belong to groups of near copies and may be very long. Each has a pivot, the set
   with the largest share of heavy elements, which is the least edited one. A set is compared with the pivot
   once; its answer is stored as the difference D between the two. What the pivot leaves open is derived from
   those answers: the overlap of A and B is |P| - missing(A) - missing(B) + |D(A) and D(B)|. Only sets that
   aren't similar to the pivot need this, and only with sets whose distance to the pivot differs by at most
   0.2, by the triangle inequality; blocks of others are skipped.

Equal sets count as one throughout. No link between components is lost; components are what is returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintloom.llm.common import discard, release, slices, small_batches, stored, utf8
from tintloom.llm.components import components
from tintloom.llm.scan import Words, short_window, windows

SHINGLE = 5
#: An element in more than LIGHT sets is heavy. HEAVY_MOST bounds what is broadcast: where more elements are heavy, LIGHT is doubled.
LIGHT, HEAVY_MOST = 16, 2_000_000
#: Elements counted together in a chunk of texts, and bytes of text for each cell of element hashes.
CHUNK, CELL = 1 << 20, 32 << 20
#: Bytes of text handled at once, sets of a block of an index list, sets of a block around a pivot, columns of a product.
PIECE, BLOCK, BALL, COLUMNS = 1 << 19, 8, 1000, 1024
#: A class of equal sets with a thousandth of all rows is hot; there can't be more than a thousand such.
HOT = 1000


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has one for all of them, one without words none."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    all_windows = windows(hashes, size).view(np.int64)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        out.append(np.unique(all_windows[a : b - size + 1]) if b - a >= size else short_window(hashes[a:b]).view(np.int64) if b > a else np.empty(0, np.int64))
    return out


def prefix_length(n: int) -> int:
    """How many first elements of n must hold a common one: n - ceil(0.8 n) + 1."""
    return n - -(-4 * n // 5) + 1 if n else 0


def heavy_keys(docs: DataFrame, light: int = LIGHT) -> tuple[np.ndarray, int]:
    """Sorted keys of the elements in more than `light` rows, and the mask that makes a key of an element.

    Every element of every row is counted. A key is the low bits of an element: 32 and those of its cell. So 4
    bytes of each element move; what occurs several times in a chunk moves once, with its count. Keys that meet
    only change the order of elements, never the result. More than HEAVY_MOST keys double the threshold.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(24, max(8, (size // CELL).bit_length()))
    cells, mask = 1 << bits, (1 << (32 + bits)) - 1

    def binary(values: np.ndarray, cuts: np.ndarray, width: int) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0

        def report() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(waiting).view(np.uint64) & np.uint64(mask), return_counts=True)
            edges = np.arange(cells + 1, dtype=np.uint64) << np.uint64(32)
            single = counts == 1
            once, more = keys[single], keys[~single]
            pairs = np.stack([more.astype(np.uint32), counts[~single].astype(np.uint32)], axis=1)
            columns = [
                pa.array(np.arange(cells, dtype=np.int32)),
                binary(once.astype(np.uint32), np.searchsorted(once, edges), 4),
                binary(pairs, np.searchsorted(more, edges), 8),
            ]
            return pa.RecordBatch.from_arrays(columns, ["cell", "once", "more"])

        for batch in slices(batches, "text", PIECE):
            for s in shingle_sets(utf8(batch.column("text"))):
                waiting.append(s)
                held += len(s)
                if held >= CHUNK:
                    yield report()
                    waiting, held = [], 0
        if held:
            yield report()

    def count(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        once = np.frombuffer(b"".join(table.column("once").to_pylist()), np.uint32)
        more = np.frombuffer(b"".join(table.column("more").to_pylist()), np.uint32).reshape(-1, 2)
        values, counts = np.unique(once, return_counts=True)
        several, which = np.unique(more[:, 0], return_inverse=True)
        total = np.bincount(which, weights=more[:, 1], minlength=len(several)).astype(np.int64)
        if len(values):
            at = np.minimum(np.searchsorted(values, several), len(values) - 1)
            met = values[at] == several
            total[met] += counts[at[met]]
            counts[at[met]] = 0
        keys = np.concatenate([several[total > light], values[counts > light]]).astype(np.int64) | (cell << 32)
        n = np.concatenate([total[total > light], counts[counts > light]])
        return pa.table({"key": pa.array(keys, pa.int64()), "n": pa.array(n, pa.int64())})

    blobs = docs.select("text").mapInArrow(run, "cell int, once binary, more binary")
    frequent = stored(blobs.groupBy("cell").applyInArrow(count, "key long, n long"), "frequent")
    levels = frequent.groupBy(F.floor(F.log2((F.col("n") - 1) / light)).cast("int").alias("level")).count().collect()
    held, level = sum(r["count"] for r in levels), 0
    while held > HEAVY_MOST:
        held -= sum(r["count"] for r in levels if r["level"] == level)
        level += 1
    keys = frequent.where(F.floor(F.log2((F.col("n") - 1) / light)) >= level).select("key").toArrow().column(0).to_numpy()
    discard(frequent)
    return np.sort(keys), mask


def prefix_table(docs: DataFrame, heavy: np.ndarray, mask: int) -> DataFrame:
    """(doc_id, n, common, k1, k2, light, heavy): size, number of heavy elements, digest and prefix elements of every row's set."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    schema = "doc_id long, n long, common long, k1 long, k2 long, light array<long>, heavy array<long>"

    def lists(parts: list[np.ndarray]) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]).astype(np.int32)), pa.array(np.concatenate([*parts, np.empty(0, np.int64)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = shared.value
        for batch in slices(batches, "text", PIECE):
            rows = []
            for s in shingle_sets(utf8(batch.column("text"))):
                p = prefix_length(len(s))
                digest = np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                if len(heavy) and len(s):
                    keys = s & np.int64(mask)
                    late = heavy[np.minimum(np.searchsorted(heavy, keys), len(heavy) - 1)] == keys
                    light, rest = s[~late][:p], s[late]
                else:
                    light, rest = s[:p], s[:0]
                rows.append((len(s), len(rest), digest[0], digest[1], light, rest[: p - len(light)]))
            n, common, k1, k2, light, late = zip(*rows, strict=True) if rows else ([],) * 6
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n, common, k1, k2)], lists(light), lists(late)], ["doc_id", "n", "common", "k1", "k2", "light", "heavy"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _overlap_most(n: np.ndarray, pos: np.ndarray, n2: np.ndarray, low2: np.ndarray, high2: np.ndarray) -> np.ndarray:
    """Overlap at most of a set and others: what stands before the shared element in both, the element, and what comes after in both."""
    return np.minimum(pos, high2) + 1 + np.minimum(n - pos - 1, n2 - low2 - 1)


def list_pairs(element: np.ndarray, node: np.ndarray, n: np.ndarray, heavy: np.ndarray, pos: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs of whole index lists as rows a, b, need: the nodes, smaller first, and how many light elements they must share.

    The rows are sorted by element, n, pos. Each list is cut into blocks; a set skips a block if its sizes are
    out of reach, or if even the best position in it leaves too little overlap.
    """
    start = np.flatnonzero(np.diff(element, prepend=element[0] - 1 if len(element) else 0))
    size = np.diff(np.append(start, len(element)))
    keep = np.repeat(size > 1, size)
    node, n, heavy, pos = node[keep], n[keep], heavy[keep], pos[keep]
    size = size[size > 1]
    if not len(size):
        return
    start = np.cumsum(size) - size
    first = np.flatnonzero((np.arange(len(node)) - np.repeat(start, size)) % BLOCK == 0)
    stop = np.append(first[1:], len(node))
    block = np.repeat(np.arange(len(first)), stop - first)
    low_n, high_n = n[first], n[stop - 1]
    low_pos, high_pos = np.minimum.reduceat(pos, first), np.maximum.reduceat(pos, first)
    many = np.repeat(block[start + size - 1], size) - block + 1
    ends = np.cumsum(many)
    begin = 0
    while begin < len(node):
        base = ends[begin] - many[begin]
        end = max(begin + 1, int(np.searchsorted(ends, base + 200_000, side="right")))
        i = np.repeat(np.arange(begin, end), many[begin:end])
        b = block[i] + np.arange(len(i)) - (ends[i] - many[i] - base)
        reach = (5 * n[i] >= 4 * low_n[b]) & (9 * _overlap_most(n[i], pos[i], high_n[b], low_pos[b], high_pos[b]) >= 4 * (n[i] + np.maximum(n[i], low_n[b])))
        i, b = i[reach], b[reach]
        at = np.maximum(first[b], i + 1)
        count = stop[b] - at
        i, at, count = i[count > 0], at[count > 0], count[count > 0]
        j = np.repeat(at - (np.cumsum(count) - count), count) + np.arange(count.sum())
        i = np.repeat(i, count)
        good = (node[i] != node[j]) & (5 * n[i] >= 4 * n[j]) & (9 * _overlap_most(n[i], pos[i], n[j], pos[j], pos[j]) >= 4 * (n[i] + n[j]))
        i, j = i[good], j[good]
        # Other common elements are heavy ones of both prefixes, or stand behind the prefix of the larger set.
        need = -(-4 * (n[i] + n[j]) // 9) - np.minimum(heavy[i], heavy[j]) - (-(-4 * n[j] // 5) - 1)
        yield np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), need])
        begin = end


def light_pairs(leaders: DataFrame) -> DataFrame:
    """(a, b): nodes that share enough light prefix elements to be similar, from leaders (node, n, light, heavy)."""

    names = ["element", "node", "n", "h", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for found in list_pairs(*columns):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b", "need"])

        rest: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(c).to_numpy().astype(np.int64) for c in names]
            if rest is not None:
                columns = [np.concatenate([r, c]) for r, c in zip(rest, columns, strict=True)]
            if not len(columns[0]):
                continue
            begin = int(np.searchsorted(columns[0], columns[0][-1]))  # the last list may go on in the next batch
            yield from emit([c[:begin] for c in columns]) if begin else ()
            rest = [c[begin:] for c in columns]
        if rest is not None:
            yield from emit(rest)

    size = lambda c: F.size(c).cast("int")
    postings = leaders.select("node", F.col("n").cast("int").alias("n"), size("heavy").alias("h"), F.posexplode("light").alias("pos", "element")).select(*names)
    dealt = postings.repartition("element").sortWithinPartitions("element", "n", "pos")
    pairs = dealt.mapInArrow(run, "a long, b long, need long").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("need").alias("need"))
    return pairs.where("shared >= need").select("a", "b")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of b are in a; both are sorted."""
    return a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b if len(a) else np.zeros(len(b), bool)


def _similar(overlap: Column, na: Column, nb: Column) -> Column:
    return 100 * overlap >= 80 * (na + nb - overlap)


def compared(joined: DataFrame, differences: bool = False) -> DataFrame:
    """(a, b, na, nb, overlap, p, d) of joined (a, b, head, text).

    With differences, d are the elements that only one of both sets has, and p stands for the head's set (a
    document may have several). Rows of one head come together, so that its set is made once.
    """
    schema = "a long, b long, na long, nb long, overlap long, p long, d binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            first = utf8(batch.column("head"))
            changes = [i for i, t in enumerate(first) if i == 0 or t != first[i - 1]]
            heads = shingle_sets([first[i] for i in changes])
            names = [int.from_bytes(blake2b(h.tobytes(), digest_size=8).digest(), "little", signed=True) for h in heads] if differences else [0] * len(heads)
            which = np.searchsorted(changes, np.arange(len(first)), side="right") - 1
            rows = []
            for k, b in zip(which.tolist(), shingle_sets(utf8(batch.column("text"))), strict=True):
                a = heads[k]
                old = _common(a, b)
                d = np.concatenate([a[~_common(b, a)], b[~old]]).tobytes() if differences else b""
                rows.append((len(a), len(b), int(old.sum()), names[k], d))
            *longs, d = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *[pa.array(x, pa.int64()) for x in longs], pa.array(d, pa.binary())], ["a", "b", "na", "nb", "overlap", "p", "d"])

    return joined.select("a", "b", "head", "text").mapInArrow(run, schema)


def similar_pairs(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The links (a, b) among candidate pairs (a, b), from texts (node, text); texts move, as they are shorter than sets."""
    heads = texts.select(F.col("node").alias("a"), F.col("text").alias("head")).hint("merge")
    others = texts.select(F.col("node").alias("b"), "text").join(pairs.hint("merge"), "b")
    found = compared(others.join(heads, "a"))
    return found.where(_similar(F.col("overlap"), F.col("na"), F.col("nb"))).select("a", "b")


def around_pivots(late: DataFrame) -> DataFrame:
    """(pivot, node) of heavy postings (element, node, central): every other set of a list with the list's pivot."""
    best = late.groupBy("element").agg(F.max(F.struct("central", (-F.col("node")).alias("low"))).alias("best"), F.count(F.lit(1)).alias("sets"))
    pivots = best.where("sets > 1").select("element", (-F.col("best")["low"]).alias("pivot"))
    # At most HEAVY_MOST elements (and those few that share their keys) are heavy.
    return late.join(F.broadcast(pivots), "element").where("pivot <> node").select("pivot", "node").distinct()


def answers_of_pivots(texts: DataFrame, placed: DataFrame) -> DataFrame:
    """The answers (a, b, na, nb, overlap, p, d) of every pivot a for each set b around it.

    The sets around a pivot are dealt to blocks, each of which gets the pivot's text: no task has them all.
    """
    blocks = placed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BALL).cast("int").alias("blocks"))
    members = placed.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).drop("blocks")
    heads = blocks.select(F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(texts, "node")
    members = members.join(texts.hint("merge"), "node").select(F.col("pivot").alias("a"), "block", F.col("node").alias("b"), "text")
    heads = heads.select(F.col("node").alias("a"), "block", F.col("text").alias("head"))
    return compared(members.join(heads.hint("merge"), ["a", "block"]), differences=True)


def forest(hit: np.ndarray) -> list[tuple[int, int]]:
    """Entries (row, column) of a boolean matrix that connect all that its entries connect: fewer than rows and columns."""
    found = []
    rows, columns = hit.any(axis=1), np.ones(hit.shape[1], bool)
    for r in range(len(rows)):
        if not rows[r]:
            continue
        rows[r] = False
        waiting = [(0, r)]
        while waiting:
            side, k = waiting.pop()
            fresh = np.flatnonzero(hit[k] & columns) if side == 0 else np.flatnonzero(hit[:, k] & rows)
            (columns if side == 0 else rows)[fresh] = False
            found += [(k, x) if side == 0 else (x, k) for x in fresh.tolist()]
            waiting += [(1 - side, x) for x in fresh.tolist()]
    return found


def derived_links(answers: DataFrame) -> DataFrame:
    """The links (a, b) that the answers of pivots leave open, derived from those answers.

    A stray is a set that isn't similar to the pivot. Strays meet all sets around the pivot in pairs of blocks;
    a block holds about BALL sets of one tenth of distance to the pivot, and blocks more than 0.2 apart don't
    meet. Sets that are similar to the pivot are linked with it, so one link to the pivot stands for all those
    to them; of links among strays, as many as connect the same sets are returned.
    """
    union = F.col("na") + F.col("nb") - F.col("overlap")
    away = F.floor(10 * (union - F.col("overlap")) / union).cast("int")
    stray = ~_similar(F.col("overlap"), F.col("na"), F.col("nb"))
    sets = answers.select("a", "p", "b", "na", "nb", "overlap", "d", stray.alias("stray"), away.alias("band"))
    bands = sets.groupBy("a", "p", "band").agg(F.ceil(F.count(F.lit(1)) / BALL).cast("int").alias("blocks"), F.count_if("stray").alias("strays"))
    sets = sets.join(bands.drop("strays"), ["a", "p", "band"]).withColumn("block", F.pmod(F.xxhash64("b"), "blocks").cast("int"))
    every = bands.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine = every.where("strays > 0").select("a", "p", F.col("band").alias("band1"), F.col("block").alias("block1"))
    theirs = every.select("a", "p", F.col("band").alias("band2"), F.col("block").alias("block2"))
    meets = mine.join(theirs, ["a", "p"]).where("abs(band1 - band2) <= 2")
    key = ["a", "p", "band1", "block1", "band2", "block2"]
    strays = sets.where("stray").withColumnsRenamed({"band": "band1", "block": "block1"}).join(meets, ["a", "p", "band1", "block1"]).withColumn("row", F.lit(True))
    others = sets.withColumnsRenamed({"band": "band2", "block": "block2"}).join(meets, ["a", "p", "band2", "block2"]).withColumn("row", F.lit(False))
    columns = [*key, "b", "na", "nb", "overlap", "stray", "row", "d"]

    def compare(table: pa.Table) -> pa.Table:
        row = table.column("row").to_numpy()
        found: list[tuple[int, int]] = []
        if row.any() and not row.all():
            pivot = table.column("a")[0].as_py()
            node, na, nb, overlap, stray = (table.column(c).to_numpy() for c in ("b", "na", "nb", "overlap", "stray"))
            differences = [np.frombuffer(d, np.int64) for d in table.column("d").to_pylist()]
            of = np.repeat(np.arange(len(node)), [len(d) for d in differences])
            _, which, counts = np.unique(np.concatenate(differences), return_inverse=True, return_counts=True)
            column = np.cumsum(counts > 1) - 1
            keep = counts[which] > 1
            of, column = of[keep], column[which[keep]]
            order = np.argsort(column, kind="stable")
            of, column = of[order], column[order]
            i, j = np.flatnonzero(row), np.flatnonzero(~row)
            both = np.zeros((len(i), len(j)), np.float32)
            for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
                part = slice(*np.searchsorted(column, [begin, begin + COLUMNS]).tolist())
                held = np.zeros((len(node), COLUMNS), np.float32)
                held[of[part], column[part] - begin] = 1
                both += held[i] @ held[j].T
            kept = overlap[i][:, None] - (na[j] - overlap[j]) + both.astype(np.int64)
            hit = (9 * kept >= 4 * (nb[i][:, None] + nb[j])) & (node[i][:, None] != node[j])
            found = [(int(node[i[r]]), pivot) for r in np.flatnonzero((hit & ~stray[j]).any(axis=1)).tolist()]
            found += [(int(node[i[r]]), int(node[j[c]])) for r, c in forest(hit & stray[j])]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return strays.select(*columns).union(others.select(*columns)).groupBy(*key).applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs` (doc_id, text).

    Rows are linked if the Jaccard similarity of their sets is 0.8 or more; component_id is the smallest
    doc_id that links lead to. A null text or one without words has no shingles and no links. Rows that share
    a doc_id count as one document with several texts; rows with a null doc_id are in the component of equal
    texts, if those have an id, and else in none (null). Repeated rows stay; further columns are left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    heavy, mask = heavy_keys(docs)
    release(spark)
    prefixes = stored(prefix_table(docs, heavy, mask), "prefixes")
    sets = stored(prefixes.select("doc_id", "n", "k1", "k2"), "digests")
    classes = stored(sets.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("sets")), "classes")
    leaders = prefixes.where("n > 0").join(classes.select("k1", "k2", F.col("node").alias("doc_id")), ["k1", "k2", "doc_id"], "left_semi")
    leaders = leaders.select(F.col("doc_id").alias("node"), "n", "common", "light", "heavy")

    pairs = stored(light_pairs(leaders), "pairs")
    late = leaders.where(F.size("heavy") > 0).select("node", (F.col("common") / F.col("n")).alias("central"), F.explode("heavy").alias("element"))
    late = stored(late, "heavy-lists")
    discard(prefixes)
    release(spark)
    placed = stored(around_pivots(late), "placed")
    discard(late)
    nodes = stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(placed.select("node")).union(placed.select("pivot")).distinct(), "open-nodes")
    texts = stored(docs.withColumnRenamed("doc_id", "node").join(nodes, "node").distinct(), "open-texts")
    release(spark)

    answers = stored(answers_of_pivots(texts, placed), "answers")
    links = stored(similar_pairs(texts, pairs).union(answers.where(_similar(F.col("overlap"), F.col("na"), F.col("nb"))).select("a", "b")).union(derived_links(answers)).distinct(), "links")
    discard(pairs, placed, nodes, texts, answers)
    release(spark)
    joined = components(links)
    discard(links)
    named = stored(classes.join(joined, "node", "left").select("k1", "k2", "sets", F.coalesce("component", "node").alias("component_id")), "named")
    discard(classes)
    release(spark)
    return with_components(sets, named)


def with_components(sets: DataFrame, named: DataFrame) -> DataFrame:
    """The result: rows of `sets` with the component of their class; rows of hot classes aren't dealt by class."""
    hot = named.where(F.col("sets") * HOT >= named.agg(F.sum("sets")).first()[0]) if not named.isEmpty() else named
    hot = hot.select("k1", "k2", F.col("component_id").alias("hot_id"), F.lit(True).alias("hot"))
    marked = sets.join(F.broadcast(hot), ["k1", "k2"], "left")
    out = lambda rows, component: rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    rest = marked.where("n > 0 and hot is null").join(named.select("k1", "k2", "component_id"), ["k1", "k2"], "left")
    return out(marked.where("n > 0 and hot"), F.col("hot_id")).union(out(rest, F.col("component_id"))).union(out(sets.where("n = 0"), F.col("doc_id")))
