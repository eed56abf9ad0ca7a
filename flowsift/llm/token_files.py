"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds the documents of one key range, each as a frame of its own, so a reader unpacks no more than the documents it is
asked for. The last frames are skippable ones: an index (file number, width of an id, document ids) and the seek table of the
seekable format, with the compressed size, the plain size and a checksum of each frame. Any reader of zstandard can unpack
such a file from end to end.

Files are written by Spark's text sink, so its commit protocol covers lost executors and any Hadoop file system will do. The sink
ends every row with a separator; its three bytes are the content of a skippable frame after each document, and the last
bytes of the seek table's closing number.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Collection, Iterable, Iterator
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowsift.llm.arrays import pieces, string_buffers

#: Bytes of text whose ids share a file.
FILE_BYTES = 32 << 20
#: Stretches whose ids a worker keeps, those met twice if they are too many. Longer ones are not kept.
CACHE_WORDS, CACHE_LENGTH = 250_000, 48
#: Stretches that are encoded as one text.
JOINED = 200
#: Bytes of text that are encoded together, and rows that are handed to Python at once.
SLICE_BYTES, BATCH_ROWS = 3 << 20, 1000

# Numbers of the zstandard frame format and of its seekable format.
SKIPPABLE, SEEK_TABLE, SEEKABLE, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
#: The last three bytes of `SEEKABLE` (little-endian), as a character.
SEPARATOR = "꒏"
_GAP = struct.pack("<II", SKIPPABLE, len(SEPARATOR.encode()))


#: A blank or line feed and no other, without the sign that special tokens begin with; its end is surely no blank.
_PLAIN = re.compile(rb"[ \n][^\x00-\x20<\x7f]*(?:[!-;=-~]|[\xc3-\xdf][\x80-\xbf])").fullmatch


class BlankTokenizer:
    """Ids of whole texts for a byte-level tokenizer that never joins a character with a blank after it.

    Texts are cut before every blank that follows something else, and each distinct stretch is encoded once. A cut is made only
    after ASCII or a letter of two bytes that is surely no blank, so every stretch is met as in the whole text. New
    stretches are encoded many at a time and parted again by the ids that begin with a blank.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab()
        self.width = 2 if len(vocabulary) <= 1 << 16 else 4
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        # fixed values: the characters that stand for a blank and a line feed in byte-level vocabularies
        self.opens[[i for t, i in vocabulary.items() if t.startswith(("Ġ", "Ċ"))]] = True
        self.clear()

    def _reset(self, words: list[bytes], size: np.ndarray, ids: np.ndarray) -> None:
        self.known: dict[bytes, int] = dict(zip(words, range(len(words))))
        self.size = np.zeros(CACHE_WORDS, np.int64)
        self.size[: len(words)] = size
        self.begin = np.zeros(CACHE_WORDS, np.int64)
        self.begin[: len(words)] = np.cumsum(size) - size
        self.met = np.zeros(CACHE_WORDS, dtype=bool)
        self.ids, self.used = np.zeros(max(1 << 16, 2 * len(ids)), np.uint32), len(ids)
        self.ids[: len(ids)] = ids

    def _make_room(self) -> None:
        """Keep what was met again since it was learnt, unless that is most of the store."""
        words = [w for w, i in self.known.items() if self.met[i]]
        words = words if len(words) < CACHE_WORDS // 2 else []
        slot = np.fromiter((self.known[w] for w in words), np.int64, len(words))
        size = self.size[slot]
        self._reset(words, size, self._gather(self.ids, self.begin[slot], size)[0])

    @staticmethod
    def _gather(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.concatenate(([0], np.cumsum(size)))
        return ids[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])], ends

    def _rows(self, texts: Iterable[str], at_once: int) -> Iterator[np.ndarray]:
        """Ids of each text; `at_once` at a time, since the library's results are many times larger than the ids."""
        for some in iter(lambda it=iter(texts): list(islice(it, at_once)), []):
            for found in self.model.encode_batch_fast(some, add_special_tokens=False):
                yield np.array(found.ids, np.uint32)

    def clear(self) -> None:
        """Forget all stretches, as a task does at its end: the next job in this worker may need the memory."""
        self._reset([], np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in their order, number of each word's ids)."""
        plain = [i for i, w in enumerate(words) if _PLAIN(w)]
        groups = [plain[a : a + JOINED] for a in range(0, len(plain), JOINED)]
        order, parts, sizes = [], [], []
        for group, ids in zip(groups, self._rows(("".join([words[i].decode("utf-8", "replace") for i in g]) for g in groups), 50)):
            first = np.flatnonzero(self.opens[ids])
            if len(first) == len(group) and first[0] == 0:
                order.extend(group)
                parts.append(ids)
                sizes.append(np.diff(first, append=len(ids)))
        left = sorted(set(range(len(words))) - set(order))
        rows = list(self._rows((words[i].decode("utf-8", "replace") for i in left), 5000))
        order = np.array(order + left, np.int64)
        flat = np.concatenate([*parts, *rows, np.zeros(0, np.uint32)])
        size = np.concatenate([*sizes, np.array([len(r) for r in rows], np.int64)]).astype(np.int64)
        begin, back = np.cumsum(size) - size, np.argsort(order, kind="stable")
        return self._gather(flat, begin[back], size[back])[0], size[back]

    def _learn(self, words: list[bytes]) -> None:
        ids, size = self._encode(words)
        n = len(self.known)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[n : n + len(words)] = size
        self.begin[n : n + len(words)] = self.used + np.cumsum(size) - size
        self.known.update(zip(words, range(n, n + len(words))))
        self.used += len(ids)

    @staticmethod
    def cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Where stretches begin: texts, and blanks after what is surely not a blank."""
        n = len(data)
        blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
        solid = (data > 0x20) & (data < 0x7F)
        solid[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        first = np.zeros(n + 1, dtype=bool)
        first[1:n] = blank[1:] & solid[:-1] if n else False
        first[offs] = True
        return np.flatnonzero(first[:n])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text's ids)."""
        data, offs = string_buffers(column)
        start = self.cuts(data, offs)
        of_text = np.searchsorted(start, offs)
        bounds = pa.py_buffer(np.append(start, len(data)).astype(np.int64))
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, bounds, pa.py_buffer(np.ascontiguousarray(data))])
        coded = coded.dictionary_encode()
        words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        slot = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        self.met[slot[slot >= 0]] = True
        new = np.flatnonzero(slot < 0).tolist()
        short = [i for i in new if len(words[i]) <= CACHE_LENGTH]
        if len(self.known) + len(short) > CACHE_WORDS:
            self._make_room()
            slot = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
            new = np.flatnonzero(slot < 0).tolist()
            room = CACHE_WORDS - len(self.known)
            short = [i for i in new if len(words[i]) <= CACHE_LENGTH][:room]
        slot[short] = np.arange(len(self.known), len(self.known) + len(short))
        self._learn([words[i] for i in short])
        begin, size, store = self.begin[slot], self.size[slot], self.ids[: self.used]
        rest = np.flatnonzero(slot < 0)
        if len(rest):  # encoded for this slice alone
            ids, sizes = self._encode([words[i] for i in rest.tolist()])
            size[rest], begin[rest] = sizes, self.used + np.cumsum(sizes) - sizes
            store = np.concatenate([store, ids])
        flat, ends = self._gather(store, begin[code], size[code])
        return flat, ends[of_text]


_TOKENIZERS: dict[str, BlankTokenizer] = {}


def _tokenizer(path: str) -> BlankTokenizer:
    """One tokenizer with its word store per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = BlankTokenizer(path)
    return _TOKENIZERS[path]


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


def _write(tokenizer_path: str, end_id: int):
    """Rows of one file: a frame per document, then index and seek table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, press = _tokenizer(tokenizer_path), zstandard.ZstdCompressor(level=1)
        kind = "<u2" if model.width == 2 else "<u4"
        keys, entries = [], []
        for batch in batches:
            for piece in pieces(batch, "text", SLICE_BYTES):
                flat, bounds = model.encode(piece.column("text"))
                rows = []
                for i in range(piece.num_rows):
                    raw = np.append(flat[bounds[i] : bounds[i + 1]], np.uint32(end_id)).astype(kind).tobytes()
                    frame = press.compress(raw)
                    rows.append(frame + _GAP)
                    entries.append((len(frame) + len(_GAP) + len(SEPARATOR.encode()), len(raw), _checksum(raw)))
                keys.append(piece.column("id"))
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["frame"])
        model.clear()
        if not entries:
            return
        ids = pa.chunked_array(keys)
        null = np.packbits(ids.is_null().to_numpy().astype(np.uint8)).tobytes()
        index = struct.pack("<IBI", TaskContext.get().partitionId(), model.width, len(entries))
        index += null + ids.fill_null(0).to_numpy().astype("<i8").tobytes()
        index = struct.pack("<II", SKIPPABLE, len(index)) + index
        entries.append((len(index), 0, _checksum(b"")))
        table = np.array(entries, "<u4").tobytes() + struct.pack("<IB", len(entries), CHECKSUMS)
        closing = struct.pack("<I", SEEKABLE)
        table = struct.pack("<II", SEEK_TABLE, len(table) + len(closing)) + table
        yield pa.RecordBatch.from_arrays([pa.array([index + table + closing[:1]], pa.binary())], ["frame"])

    return run


class TokenFile:
    """The index and the frames of one file, given its bytes."""

    def __init__(self, content: bytes):
        self.content = content
        if len(content) < 17 or struct.unpack("<I", content[-4:])[0] != SEEKABLE:
            raise ValueError("the file has no seek table")
        n = struct.unpack("<I", content[-9:-5])[0]
        table = np.frombuffer(content, "<u4", 3 * n, len(content) - 9 - 12 * n).reshape(n, 3).astype(np.int64)
        self.begin = np.concatenate(([0], np.cumsum(table[:, 0])))
        if self.begin[-1] + 8 + 12 * n + 9 != len(content):
            raise ValueError("the seek table does not fit the file")
        at = int(self.begin[n - 1]) + 8
        self.number, self.width, self.n = struct.unpack("<IBI", content[at : at + 9])
        at += 9
        flags = np.frombuffer(content, np.uint8, -(-self.n // 8), at)
        self.null = np.unpackbits(flags, count=self.n).astype(bool) if self.n else np.zeros(0, bool)
        self.ids = np.frombuffer(content, "<i8", self.n, at + len(flags))
        self.tokens = table[: self.n, 1] // self.width
        self.checksums = table[:, 2]
        self._unpack = zstandard.ZstdDecompressor()

    def read(self, i: int) -> np.ndarray:
        """Ids of the i-th document; a frame that does not match its checksum is an error."""
        frame = self.content[self.begin[i] : self.begin[i + 1]]
        raw = self._unpack.decompress(frame)
        if _checksum(raw) != self.checksums[i]:
            raise ValueError(f"frame {i} does not match its checksum")
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")


def _manifest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("name").to_pylist(), batch.column("content")):
            file = TokenFile(content.as_py())
            ids = file.ids[~file.null]
            low, high = (int(ids.min()), int(ids.max())) if len(ids) else (None, None)
            row = {"name": path, "number": file.number, "documents": file.n, "tokens": int(file.tokens.sum()), "low": low, "high": high}
            yield pa.RecordBatch.from_pylist([{**row, "nulls": int(file.null.sum())}], _MANIFEST_FIELDS)


_MANIFEST_FIELDS = pa.schema([
    ("name", pa.string()), ("number", pa.int64()), ("documents", pa.int64()), ("tokens", pa.int64()), ("low", pa.int64()),
    ("high", pa.int64()), ("nulls", pa.int64()),
])
MANIFEST = "name string, number long, documents long, tokens long, low long, high long, nulls long"


def _files(spark: SparkSession, path: str, names: Collection[str] | None = None) -> DataFrame:
    """`name`, `content` of the files below `path`, or of some of them; files without a byte are passed over."""
    # fixed values: columns of this source
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile")
    files = files.load(path if names is None else [f"{path}/{n}" for n in names])
    return files.where("length > 0").select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "content")


@contextmanager
def _batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand at most `rows` rows to Python at once while a job of the block runs; a smaller setting of the user's stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0
) -> None:
    """Write the ids of each text and `end_id` to files below `path`, documents ascending by id over all files and within each.

    Null and empty texts are `end_id` alone. Rows with a null id come first; rows that repeat an id stand by a hash of their text,
    and what is then still equal is the same row again. Other columns are not read. An empty table gives an empty folder with a
    manifest without rows. Give this operator a table or a scan, whose rows have a fixed order.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    extent = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    files = max(1, -(-((extent[0] or 0) + 16 * extent[1]) // FILE_BYTES))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "spread": F.monotonically_increasing_id()})
    placed = rows.repartitionByRange(files, "id", "tie", "spread").sortWithinPartitions("id", "tie", "spread")
    frames = placed.select("id", "text").mapInArrow(_write(tokenizer_path, end_id), "frame binary")
    sink = frames.select(F.col("frame").cast("string").alias("value")).write
    spark = docs.sparkSession
    with _batches_of(spark, BATCH_ROWS):
        sink.option("lineSep", SEPARATOR).option("compression", "none").option("maxRecordsPerFile", 0).text(path)
    manifest = _files(spark, path).mapInArrow(_manifest, MANIFEST)
    before = F.sum("tokens").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # one row per file, as many as there are tasks
    manifest.withColumn("first", before - F.col("tokens")).coalesce(1).write.parquet(f"{path}/_manifest")


def read_token_files(spark: SparkSession, path: str, wanted: Collection[int] | None = None, id_col: str = "doc_id") -> DataFrame:
    """Documents of files that `write_token_files` made: `id_col`, `start` (ids of all documents before), `n_tokens`, `ids`.

    `ids` holds little-endian unsigned 32-bit ids, the closing one included. With `wanted` (a collection that fits the driver) only
    files whose range of ids meets it are read, and of these only the frames of wanted documents are unpacked; an id that
    is not there gives no row. Every frame read is held against its checksum.
    """
    manifest = spark.read.schema(f"{MANIFEST}, first long").parquet(f"{path}/_manifest")
    keep = None if wanted is None else np.unique(np.fromiter((i for i in wanted if i is not None), np.int64))
    nulls = wanted is not None and None in wanted
    names = None
    if keep is not None:
        names = []
        for row in manifest.select("name", "low", "high", "nulls").toLocalIterator():
            meets = row.low is not None and np.searchsorted(keep, row.low) < np.searchsorted(keep, row.high, side="right")
            if meets or (nulls and row.nulls):
                names.append(row.name)
        if not names:
            return spark.createDataFrame([], f"{id_col} long, start long, n_tokens long, ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, first in zip(batch.column("content"), batch.column("first").to_pylist()):
                file = TokenFile(content.as_py())
                start = first + np.concatenate(([0], np.cumsum(file.tokens)))
                asked = np.ones(file.n, bool)
                if keep is not None:
                    asked = np.where(file.null, nulls, np.isin(file.ids, keep))
                rows, held = [], 0
                for i in np.flatnonzero(asked).tolist():
                    ids = file.read(i)
                    key = None if file.null[i] else int(file.ids[i])
                    rows.append((key, int(start[i]), len(ids), ids.tobytes()))
                    held += len(rows[-1][3]) + 100
                    if held > 4 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["id", "start", "n_tokens", "ids"])

    files = _files(spark, path, names).join(manifest.select("name", "first"), "name")
    found = files.select("content", "first").mapInArrow(run, "id long, start long, n_tokens long, ids binary")
    return found.withColumnRenamed("id", id_col)
