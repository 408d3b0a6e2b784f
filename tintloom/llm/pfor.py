"""Token ids in files of patched frame-of-reference blocks.

Of each block of ids the minimum is subtracted; the rest is packed at the width that holds the given
percentile, and what is wider goes to the block's exception list. A file is: magic, blocks, footer (starts of
the blocks, ids and token counts of the documents), length of the footer, magic. A block is: minimum, width,
number of exceptions, packed words, places and values of the exceptions.
"""

from __future__ import annotations

import io
import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tintloom.llm.common import new_path, slices, small_batches, stored, utf8
from tintloom.llm.scan import BLANK

MAGIC, BLOCK, PERCENTILE, END_ID = b"PFRB0001", 1024, 90, 1
#: Distinct words and their bytes that a worker remembers with their ids, and ids that are packed at once.
CACHE_WORDS, CACHE_BYTES, AT_ONCE = 1_000_000, 32 << 20, 1 << 20
#: Words of letters encoded together, and marks that may follow them.
TOGETHER, MARKS = 32, b".,!?;:"
HEAD = struct.Struct("<IBxH")


def _lanes(width: int) -> Iterator[tuple[int, int, int]]:
    """Of 64 values of `width` bits in `width` 64-bit words: lane, word and shift of each."""
    for lane in range(64):
        yield lane, lane * width // 64, lane * width % 64


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values, 64 or a multiple of it each, as rows of 64-bit words."""
    v = values.reshape(-1, 64).astype(np.uint64) & np.uint64((1 << width) - 1)
    out = np.zeros((len(v), width), np.uint64)
    for lane, word, shift in _lanes(width) if width else ():
        out[:, word] |= v[:, lane] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= v[:, lane] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1)


def unpack(words: np.ndarray, width: int, size: int) -> np.ndarray:
    """The rows of `size` values that `pack` made the rows of words from."""
    if not width:
        return np.zeros((len(words), size), np.uint64)
    w = np.ascontiguousarray(words).reshape(-1, width)
    out = np.empty((len(w), 64), np.uint64)
    for lane, word, shift in _lanes(width):
        out[:, lane] = w[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, lane] |= w[:, word + 1] << np.uint64(64 - shift)
    return (out & np.uint64((1 << width) - 1)).reshape(len(words), size)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE, size: int = BLOCK) -> list[bytes]:
    """Blocks of `size` ids each; a last one of fewer is filled up with its minimum."""
    if not len(ids):
        return []
    n = -(-len(ids) // size)
    rows = np.full(n * size, ids[(n - 1) * size :].min(), np.uint32)
    rows[: len(ids)] = ids
    rows = rows.reshape(n, size)
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    place = min(size - 1, int(np.ceil(size * percentile / 100)) - 1)
    widths = np.ceil(np.log2(np.partition(rest, place, axis=1)[:, place].astype(np.float64) + 1)).astype(np.int64)
    out: list[bytes] = [b""] * n
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        packed = pack(rest[at], width)
        odd = rest[at] >> np.uint32(width) if width < 32 else np.zeros_like(rest[at])
        for k, i in enumerate(at.tolist()):
            places = np.flatnonzero(odd[k])
            out[i] = HEAD.pack(int(low[i]), width, len(places)) + packed[k].tobytes() + places.astype("<u2").tobytes() + rest[i, places].astype("<u4").tobytes()
    return out


def decode_blocks(data: bytes, starts: np.ndarray, size: int = BLOCK) -> np.ndarray:
    """The ids of the blocks that begin at `starts` in `data`."""
    heads = [HEAD.unpack_from(data, s) for s in starts.tolist()]
    out = np.empty((len(heads), size), np.uint32)
    by_width: dict[int, list[int]] = {}
    for i, (_, width, _) in enumerate(heads):
        by_width.setdefault(width, []).append(i)
    for width, at in by_width.items():
        words = np.stack([np.frombuffer(data, "<u8", width * size // 64, int(starts[i]) + HEAD.size) for i in at])
        out[at] = unpack(words, width, size).astype(np.uint32)
    for i, (low, width, n) in enumerate(heads):
        if n:
            places = int(starts[i]) + HEAD.size + width * size // 8
            out[i, np.frombuffer(data, "<u2", n, places)] = np.frombuffer(data, "<u4", n, places + 2 * n)
        out[i] += np.uint32(low)
    return out.reshape(-1)


class Writer:
    """Writes one file; ids come in any portions, documents are told by their number of ids."""

    def __init__(self, sink):
        self.sink, self.at, self.starts, self.docs, self.lengths = sink, len(MAGIC), [], [], []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        sink.write(MAGIC)

    def add(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs += doc_ids
        self.lengths.append(lengths)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= AT_ONCE:
            self._flush(self.n_waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for block in encode_blocks(ids[:n]):
            self.starts.append(self.at)
            self.sink.write(block)
            self.at += len(block)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.n_waiting)
        foot = io.BytesIO()
        np.save(foot, np.array([self.at, *self.starts], np.int64))
        np.save(foot, np.array([d or 0 for d in self.docs], np.int64))
        np.save(foot, np.array([d is None for d in self.docs], bool))
        np.save(foot, np.concatenate([*self.lengths, np.empty(0, np.int64)]).astype(np.int64))
        self.sink.write(foot.getvalue() + struct.pack("<Q", len(foot.getvalue())) + MAGIC)


def read(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(document, number of its ids, next portion of them) of the file at a URI, in the file's order."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as f:
        size = f.size()
        tail = f.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"not a complete file: {path}")
        length = struct.unpack("<Q", tail[:8])[0]
        foot = io.BytesIO(f.read_at(length, size - 16 - length))
        index, docs, nulls, lengths = (np.load(foot) for _ in range(4))
        end, starts = int(index[0]), index[1:]
        edges, done, doc = np.cumsum(lengths), 0, 0
        for i in range(0, len(starts), AT_ONCE // BLOCK):
            part = starts[i : i + AT_ONCE // BLOCK]
            stop = int(starts[i + len(part)]) if i + len(part) < len(starts) else end
            ids = decode_blocks(f.read_at(stop - int(part[0]), int(part[0])), part - part[0])
            here = 0
            while here < len(ids) and doc < len(docs):
                n = min(len(ids) - here, int(edges[doc]) - done)
                yield (None if nulls[doc] else int(docs[doc])), int(lengths[doc]), ids[here : here + n]
                here, done = here + n, done + n
                doc += done == edges[doc]


def is_letters(text: str) -> bool:
    """Whether the text is letters alone, in the form in which the tokenizer sees it too."""
    return text.isalpha() and (text.isascii() or unicodedata.normalize("NFC", text).lower().isalpha())


class Sequences:
    """Id sequences in a row, told by number."""

    def __init__(self):
        self.flat, self.used = np.empty(1 << 18, np.uint32), 0
        self.starts, self.lengths, self.n = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64), 0

    def append(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        while self.n + len(lengths) > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        at = slice(self.n, self.n + len(lengths))
        self.lengths[at] = lengths
        self.starts[at] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.n, self.used = self.n + len(lengths), self.used + len(ids)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lengths of the sequences `at`, and their ids one after the other."""
        sizes = self.lengths[at]
        ends = np.cumsum(sizes)
        return sizes, self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[at] - (ends - sizes), sizes)]


#: ASCII bytes that may stand before a mark, marks that are a piece of their own there, and white space.
_PLAIN, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK[list(MARKS)] = True


def pieces(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct pieces, which of them stand in the texts, and how many stand in each text.

    Pieces are the words between ASCII white space, with a mark at the end of a plain word apart.
    """
    # Special tokens keep their case.
    lowered = [t if b"<|" in t else t.lower() for t in texts]
    raw = np.frombuffer(b" ".join([*lowered, b" "]), np.uint8)
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    blank = BLANK[raw]
    marks = np.flatnonzero(_PLAIN[raw[:-2]] & _MARK[raw[1:-1]] & blank[2:]) + 1
    begins = np.concatenate([[True], blank[:-1]]) & ~blank
    begins[marks] = True
    places = np.flatnonzero(begins)
    solid = np.cumsum(~blank, dtype=np.int32)
    offsets = np.append(solid[places] - 1, solid[-1]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~blank])]).dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(), np.diff(np.searchsorted(places, edges))


#: Texts that a tokenizer must encode a piece at a time as it does whole.
PROBES = ("Hello World's re-use, 12.5% of it.", " two  blanks\n\nand\tlines ", "don't STOP! <|endoftext|> (x) [y] a_b", "\u00c9t\u00e9 \u0130 na\u00efve \u4f60\u597d \U0001f600 e\u0301")


class Encoder:
    """Encodes with the tokenizer a piece at a time and remembers pieces.

    The tokenizer lowers the case and never joins what white space parts, nor letters with what isn't one. So
    the ids of a text are those of its pieces, one after the other. New pieces of letters alone are encoded
    many at a time and told apart by the ids that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        for probe in PROBES:
            whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
            words, which, _ = pieces([probe.encode()])
            parts = [self.tokenizer.encode(w.decode(), add_special_tokens=False).ids for w in words]
            if whole != [i for k in which.tolist() for i in parts[k]]:
                raise ValueError(f"{path}: this tokenizer joins what white space parts, so it can't encode a piece at a time")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.bytes = Sequences(), 0

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.fromiter(map(len, found), np.int64, len(found)), np.array([x for ids in found for x in ids], np.uint32)

    def _letters(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of words of letters."""
        groups = [texts[i : i + TOGETHER] for i in range(0, len(texts), TOGETHER)]
        lengths, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        for group, e in zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            found = np.array(e.ids, np.uint32)
            stops = np.flatnonzero(self.ends[found]) + 1
            if len(stops) == len(group) and stops[-1] == len(found):
                lengths.append(np.diff(stops, prepend=0))
            else:  # some letter isn't one to the tokenizer
                n, found = self._one_by_one(group)
                lengths.append(n)
            ids.append(found)
        return np.concatenate(lengths), np.concatenate(ids)

    def _learn(self, new: list[bytes]) -> None:
        letters: list[tuple[bytes, str]] = []
        others: list[tuple[bytes, str]] = []
        for piece in new:
            text = piece.decode()
            (letters if is_letters(text) else others).append((piece, text))
        for encode, chosen in ((self._letters, letters), (self._one_by_one, others)):
            for i in range(0, len(chosen), 20_000):
                raw, texts = zip(*chosen[i : i + 20_000], strict=True)
                self.known.update(zip(raw, range(self.ids.n, self.ids.n + len(raw)), strict=True))
                self.ids.append(*encode(list(texts)))
                self.bytes += sum(map(len, raw))

    def __call__(self, texts: list[bytes], end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, with its end id, and all ids in a row."""
        if len(self.known) > CACHE_WORDS or self.bytes > CACHE_BYTES:
            self._forget()
        words, which, counts = pieces(texts)
        self._learn([w for w in words if w not in self.known])
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[which]
        sizes, ids = self.ids.take(at)
        stops = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        return np.diff(stops, prepend=0) + 1, np.insert(ids, stops, end_id)


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


SHARD = "first_doc long, n_docs long, n_ids long, path string, shard long"


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, shards: int | None = None) -> DataFrame:
    """Writes `docs` (doc_id, text) in ascending doc_id order; returns the stored table of the files.

    (shard, path, n_docs, n_ids, start): a row for each file, start being the ids in the files before it. Null
    ids come first; rows of equal id are ordered by text, and files divide them where the texts' beginnings
    differ, so that an id that very many rows share needn't fit into one. A null text is empty and has the end id alone.
    Each attempt of a task writes a file of its own name and moves it into place when whole, and the table
    names only the files of the attempts that count, so a lost executor leaves nothing but an unused file.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, shard = _encoder(tokenizer), TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"{shard:06d}-{uuid.uuid4().hex}.pfor"
        first, n_docs, writer, sink = None, 0, None, None
        for batch in slices(batches, "text", 6 << 20):
            if not batch.num_rows:
                continue
            if writer is None:
                sink = store.open_output_stream(f"{base}/.{name}")
                writer, first = Writer(sink), batch.column("doc_id")[0].as_py()
            writer.add(batch.column("doc_id").to_pylist(), *encode(utf8(batch.column("text"))))
            n_docs += batch.num_rows
        if writer:
            writer.close()
            sink.close()
            store.move(f"{base}/.{name}", f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"first_doc": pa.array([first], pa.int64()), "n_docs": [n_docs], "n_ids": [writer.n_ids], "path": [f"{folder}/{name}"], "shard": [shard]})

    by_id = F.col("doc_id").asc_nulls_first()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.substring("text", 1, 64).alias("__begin"))
    dealt = rows.repartitionByRange(shards, by_id, "__begin").sortWithinPartitions(by_id, "text").select("doc_id", "text")
    files = stored(dealt.mapInArrow(run, SHARD), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("shard", "path", "n_docs", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start"))


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; one task for each file."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                rows, crc, seen = [], 0, 0
                for doc, length, ids in read(path):
                    crc, seen = zlib.crc32(ids.astype("<u4").tobytes(), crc), seen + len(ids)
                    if seen == length:
                        rows.append((doc, start, length, crc))
                        start, crc, seen = start + length, 0, 0
                    if len(rows) >= 50_000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, files.count())
    return files.select("path", "start").repartition(n).mapInArrow(run, schema)


def tokens_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the token ids of `docs` to files in the shared folder and returns what the files hold."""
    return read_tokens(write_tokens(docs, tokenizer, new_path(docs.sparkSession, "tokens")))
