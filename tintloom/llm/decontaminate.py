"""Benchmark decontamination with one Aho-Corasick automaton over the normalised items.

Normalising maps every byte of a text's UTF-8 form to a word byte or a blank and keeps its place, so a hit
in the normalised words leads back to offsets of the original text. Items are collected in blocks of bounded
size; usually there is one block and one automaton. A larger benchmark has several, and each passes over the
texts once and adds to the hits of those before it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tintloom.llm.common import slices, small_batches, utf8

#: Words in a window, and the characters of items that one automaton takes (a trie node for each character of each window).
WINDOW, BLOCK_CHARS = 10, 1_000_000
#: 0-9, a-z and everything beyond ASCII are words, A-Z count as a-z, all else is blank.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("first", "last", "start", "stop")]), False)

_automata: dict[str, ahocorasick.Automaton] = {}


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The windows of an item: `size` consecutive words, or all its words if it has fewer but not none."""
    words = text.translate(NORMAL).split()
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def build(items: Sequence[tuple[str, bytes]], size: int = WINDOW) -> ahocorasick.Automaton:
    """An automaton whose values are (words in the window, ids of its items)."""
    found: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows(text, size):
            found.setdefault(window, set()).add(item)
    automaton = ahocorasick.Automaton()
    for window, ids in found.items():
        automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(sorted(ids))))
    if found:
        automaton.make_automaton()
    return automaton


def scan(automaton: ahocorasick.Automaton, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of the text, hit runs of word numbers (first, last) in order and apart, and the items found."""
    words = text.translate(NORMAL).split()
    if not words or not len(automaton):
        return len(words), [], set()
    line = f" {b' '.join(words).decode('latin-1')} "
    ends, lengths, items = [], [], set()
    for end, (length, ids) in automaton.iter(line):
        ends.append(end)
        lengths.append(length)
        items.update(ids)
    if not ends:
        return len(words), [], items
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(blanks, np.array(ends)) - 1
    return len(words), merged(list(zip((last - np.array(lengths) + 1).tolist(), last.tolist(), strict=True))), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of runs (first, last), joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def offsets(text: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """The runs with code point offsets [start, stop) in the original text."""
    if not runs:
        return []
    raw = np.frombuffer(text, np.uint8)
    word = np.frombuffer(text.translate(NORMAL), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [{"first": a, "last": b, "start": int(points[edge[2 * a]]), "stop": int(points[edge[2 * b + 1]])} for a, b in runs]


def _pass(docs: DataFrame, block, size: int, carry: list[str], text: str) -> DataFrame:
    """`docs` through one automaton; adds to __words, __runs and __items."""
    kept = [f for f in docs.schema.fields if f.name in carry]
    schema = T.StructType([*kept, T.StructField("__words", T.LongType()), T.StructField("__runs", RUNS), T.StructField("__items", T.ArrayType(T.StringType()))])
    shared = docs.sparkSession.sparkContext.broadcast(block)
    key = hashlib.sha256(repr((size, block)).encode()).hexdigest()
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _automata:
            _automata.clear()  # one automaton in memory at a time
            _automata[key] = build(shared.value, size)
        automaton = _automata[key]
        for batch in slices(batches, text):
            had = batch.schema.get_field_index("__runs") >= 0
            before = zip(batch.column("__runs").to_pylist(), batch.column("__items").to_pylist(), strict=True) if had else ((None, None) for _ in range(batch.num_rows))
            counts, runs, items = [], [], []
            for raw, (old_runs, old_items) in zip(utf8(batch.column(text)), before, strict=True):
                n, new, ids = scan(automaton, raw)
                counts.append(n)
                runs.append(offsets(raw, merged(new + [(r["first"], r["last"]) for r in old_runs or []])))
                items.append(sorted(ids.union(old_items or [])))
            run_type = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in ("first", "last", "start", "stop")]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(counts, pa.int64()), pa.array(runs, run_type), pa.array(items, pa.list_(pa.string()))], [*names, "__words", "__runs", "__items"])

    return docs.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, columns: list[str] | None = None, text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """`columns` of `docs` (all if None) with __words, __runs and __items.

    __words counts the words of the whole text (null: none); __runs are the maximal runs of words inside
    occurrences of windows of `benchmark` (item_id, text), with word numbers and code point offsets; __items
    are the ids, as sorted text, of the items that occur. Null or wordless items have no windows, a null
    item_id is the id 'null', repeated items count once, an empty benchmark hits nothing. Columns of these
    three names are replaced.
    """
    small_batches(docs.sparkSession)
    carry = [c for c in (columns if columns is not None else docs.columns) if c not in {"__words", "__runs", "__items"}]
    docs = docs.select(*dict.fromkeys([*carry, text]))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text")).where("text is not null").distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(chars / block_chars))
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        rows = sorted((r["item"], r["text"].encode()) for r in part.collect())
        docs = _pass(docs, rows, window, carry if block == blocks - 1 else [*dict.fromkeys([*carry, text])], text)
    return docs


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of what `decontaminate` returns."""
    hit = F.aggregate("__runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id",
        F.col("__words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.size("__runs") > 0).alias("contaminated"),
    )
