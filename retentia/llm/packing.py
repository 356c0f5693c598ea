"""Token-id output in fixed-width bit packing (operator 10).

``write_packed`` stores documents' ids in files of this layout (little endian):

    header   magic ``TIDP``, version, bits an id, number of documents, number of ids,
             number of blocks, ids a block
    blocks   the byte offset of each block in the payload (uint64)
    docs     the document key (int64, with a flag byte for null) and the number of ids
             before it in the file (uint64, one more than documents)
    payload  the ids, each in the minimum number of bits that holds the vocabulary,
             first id in the lowest bits; a block of ids begins on a whole byte

so that any range of ids is read by seeking to its blocks and unpacked with numpy.
File k holds smaller keys than file k + 1, and keys ascend within a file.

Tasks write under a name of their own and then rename, so a task that is run again
(lost executor, speculation) leaves one whole file. The folder lies in storage that
all executors see; paths go through ``pyarrow.fs``, which opens local, HDFS and
object-store addresses.

Defined results: a null text has no ids of its own, only the end id; very long texts are encoded whole;
the strings of added tokens in a text are those tokens; null keys sort
first; repeated keys stay separate documents, ordered by their ids' bytes; an empty
table writes no files and reads back no rows; extra columns are not stored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm.common import partitions
from retentia.llm.word_split import Splitter

BLOCK_IDS = 4096
MAGIC = b"TIDP"
HEADER = struct.Struct("<4sHHQQQI")
# Words kept with their ids in a worker; once full, further words are encoded anew.
CACHE_WORDS = 600_000

_CACHE: dict = {}


# ---- packing ---------------------------------------------------------------------


def bits_for(vocabulary_size: int) -> int:
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, first id in the lowest bits."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    if bits == 32:
        return ids.astype("<u4").tobytes()
    digits = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(digits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a packed block as uint32."""
    if bits == 16:
        return np.frombuffer(data, "<u2", n).astype("<u4")
    if bits == 32:
        return np.frombuffer(data, "<u4", n).copy()
    digits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little")
    return (digits.reshape(n, bits).astype(np.uint32)
            << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32).astype("<u4")


def packed_file(keys: list, runs: list[bytes], bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """One file from documents' keys and their ids as uint32 bytes."""
    ids = np.frombuffer(b"".join(runs), "<u4")
    blocks = [pack(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    offsets = np.cumsum([0, *map(len, blocks)], dtype="<u8")
    before = np.cumsum([0, *(len(r) // 4 for r in runs)], dtype="<u8")
    return b"".join([
        HEADER.pack(MAGIC, 1, bits, len(keys), len(ids), len(blocks), block_ids),
        offsets.tobytes(),
        np.array([k is None for k in keys], np.uint8).tobytes(),
        np.array([k or 0 for k in keys], "<i8").tobytes(),
        before.tobytes(), *blocks])


class PackedReader:
    """Random access to one packed file."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(0)
        magic, _, self.bits, self.n_docs, self.n_ids, n_blocks, self.block_ids = HEADER.unpack(
            source.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a packed token-id file")
        self.offsets = np.frombuffer(source.read(8 * (n_blocks + 1)), "<u8")
        null = np.frombuffer(source.read(self.n_docs), np.uint8)
        keys = np.frombuffer(source.read(8 * self.n_docs), "<i8")
        self.keys = [None if z else int(k) for z, k in zip(null, keys, strict=True)]
        self.before = np.frombuffer(source.read(8 * (self.n_docs + 1)), "<u8")
        self.payload = source.tell()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        self.source.seek(self.payload + int(self.offsets[first]))
        data = self.source.read(int(self.offsets[last + 1] - self.offsets[first]))
        parts = []
        for b in range(first, last + 1):
            n = min(self.block_ids, self.n_ids - b * self.block_ids)
            at = int(self.offsets[b] - self.offsets[first])
            parts.append(unpack(data[at:at + -(-n * self.bits // 8)], self.bits, n))
        return np.concatenate(parts)[start - first * self.block_ids:stop - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.before[k]), int(self.before[k + 1]))


# ---- encoding --------------------------------------------------------------------

class WordEncoder(dict):
    """Ids of plain lower-case words as uint32 bytes, kept per worker.

    Merges never cross pre-tokens, so a word's ids are those of its pre-tokens; each
    distinct one goes through the library's merges once. Other words, and every text of a
    definition whose rules ``word_split`` does not know, go through the whole library. The
    strings of added tokens are those tokens, as the library has it."""

    def __init__(self, definition: str) -> None:
        super().__init__()
        self.splitter = Splitter(definition)
        self.library = self.splitter.library
        self.merges = self.library.model.tokenize

    def __missing__(self, word: str) -> bytes:
        made = array("I", [t.id for piece in self.splitter.pieces(True, word)
                           for t in self.merges(piece)]).tobytes()
        if len(word) <= 32 and len(self) < CACHE_WORDS:
            self[word] = made
        return made

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def text(self, text: str) -> bytes:
        """A text's ids."""
        plain = self.splitter.plain_words(text)
        if plain is not None:
            return b"".join(map(self.__getitem__, plain))
        if not self.splitter.known:
            return self.whole(text)
        made = []
        for added, part in self.splitter.parts(text):
            if added is not None:
                made.append(array("I", [added]).tobytes())
            else:
                made.extend([self[word] if plain else self.whole(word)
                             for plain, word in self.splitter.words(part)])
        return b"".join(made)


def vocabulary_size(definition: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True)


def key_cuts(df: DataFrame, n: int, key_col: str = "doc_id") -> list[int]:
    """Ascending keys that cut the table into at most ``n`` ranges of about equal rows."""
    shares = [i / n for i in range(1, n)]
    found = df.select(F.percentile_approx(F.col(key_col).cast("long"), shares, 10_000)
                      .alias("cuts")).first() if shares else None
    return sorted(set(found["cuts"] or [])) if found else []


def encode_packed(df: DataFrame, definition: Broadcast, end_id: int, bits: int, cuts: list[int],
                  key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(range, key, n, packed): each whole text's ids and the end id, packed, and the
    number of the key range between ``cuts`` that the document falls into."""
    tail = np.array([end_id], "<u4").tobytes()
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "words" not in _CACHE or _CACHE["words"][0] != definition.value:
            _CACHE["words"] = (definition.value, WordEncoder(definition.value))
        one = _CACHE["words"][1].text
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys = part.column(0).to_pylist()
                ids = [np.frombuffer(one(t or "") + tail, "<u4") for t in part.column(1).to_pylist()]
                made = ([0 if k is None else bisect_left(cuts, k) for k in keys], keys,
                        [len(x) for x in ids], [pack(x, bits) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(made, kinds, strict=True)],
                    names=["range", "key", "n", "packed"])

    return (df.select(F.col(key_col).cast("long").alias("key"), F.col(text_col).alias("text"))
            .mapInArrow(run, "range int, key long, n int, packed binary"))


# ---- files -----------------------------------------------------------------------


def filesystem(uri: str):
    from pyarrow import fs

    if "://" not in uri and not re.match(r"\w+:/", uri):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def write_packed(encoded: DataFrame, folder: str, bits: int, n_ranges: int,
                 block_ids: int = BLOCK_IDS, file_ids: int = 1 << 22) -> DataFrame:
    """Write the rows of ``encode_packed`` in ascending key order; gives one row for each
    file: file, n_docs, n_ids. File names sort as their keys do. A range goes on in a
    further file after ``file_ids`` ids, so a task holds no more than one file's ids."""
    ordered = (encoded.repartitionById(n_ranges, F.col("range"))
               .sortWithinPartitions("range", "key", "n", "packed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        current, number = None, 0
        keys, runs, held = [], [], 0

        def close() -> pa.RecordBatch:
            name = f"part-{current:06d}-{number:06d}.tidp"
            own = f"{root}/.{name}-{uuid.uuid4().hex}"
            with store.open_output_stream(own) as out:
                out.write(packed_file(keys, runs, bits, block_ids))
            store.move(own, f"{root}/{name}")
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(keys)], pa.int64()), pa.array([held], pa.int64())],
                names=["file", "n_docs", "n_ids"])

        for batch in batches:
            for at, key, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if keys and (at != current or held >= file_ids):
                    yield close()
                    number = number + 1 if at == current else 0
                    keys, runs, held = [], [], 0
                current = at
                keys.append(key)
                runs.append(unpack(data, bits, n).tobytes())
                held += n
        if keys:
            yield close()

    return ordered.mapInArrow(run, "file string, n_docs long, n_ids long")


def read_packed(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """Read packed files back: key, start (ids of all documents before it), n_tokens,
    ids_crc32 of the ids as little-endian uint32. ``files``: (file, n_docs, n_ids) one
    entry a file; each file is read by the task that is dealt its name."""
    base, rows = 0, []
    for name, _, n_ids in sorted(files):
        rows.append((name, base))
        base += n_ids
    named = spark.createDataFrame(rows, "file string, base long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                with store.open_input_file(f"{root}/{name}") as source:
                    file = PackedReader(source)
                    sums = [zlib.crc32(file.document(k).tobytes()) for k in range(file.n_docs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.keys, pa.int64()),
                     pa.array(file.before[:-1].astype("i8") + base, pa.int64()),
                     pa.array(np.diff(file.before.astype("i8")), pa.int64()),
                     pa.array(sums, pa.int64())],
                    names=["key", "start", "n_tokens", "ids_crc32"])

    return (named.repartition(max(1, min(len(rows), partitions(named))))
            .mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long"))
