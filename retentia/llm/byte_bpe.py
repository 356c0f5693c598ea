"""Byte-level BPE encoding and decoding (operator 9).

``encode`` gives the ids that the tiktoken library gives for each whole text
without special tokens; ``decode`` turns ids back into raw bytes. The rank file is
read once on the driver (a vocabulary, below a megabyte) and broadcast, so that
executors need neither the file nor a network.

Defined results: null text is encoded as the empty text (no ids); null ids decode
to null; ids that hold a null or a number outside the vocabulary decode to null;
repeated rows are encoded each; an input column with the name of the output
column is replaced, all others are kept.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# A text longer than this is cut before it is given to the library.
CHUNK_CHARS = 1 << 16

# A white-space character directly after a character that is none. No match of the
# pre-token pattern crosses such a place: every alternative that takes white space
# takes it at its start. Chunks never end in white space but for the last, so the
# alternatives that look ahead to a text's end see what they see in the whole text.
_SAFE = re.compile(r"(?<=\S)[ \n]")

_CACHE: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at safe boundaries; a run
    without any boundary stays whole."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def _encoding(ranks: Broadcast, pattern: str):
    import tiktoken

    key = ("encoding", ranks.value[0], pattern)
    if key not in _CACHE:
        _CACHE[key] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks.value[1], special_tokens={})
    return _CACHE[key]


def _vocabulary(ranks: Broadcast) -> list:
    key = ("bytes", ranks.value[0])
    if key not in _CACHE:
        words: list = [None] * (1 + max(ranks.value[1].values(), default=-1))
        for word, i in ranks.value[1].items():
            words[i] = word
        _CACHE[key] = words
    return _CACHE[key]


def share_ranks(spark: SparkSession, path: str) -> Broadcast:
    ranks = read_ranks(path)
    return spark.sparkContext.broadcast((f"{path}:{len(ranks)}", ranks))


def _mapped(df: DataFrame, source: str, outputs: list[tuple[str, T.DataType, pa.DataType]],
            make) -> DataFrame:
    """``df`` with columns computed from the column ``source``: ``make()`` gives a function
    of one value that returns a value for each output."""
    names = [name for name, _, _ in outputs]
    keep = [c for c in df.columns if c not in names]
    schema = T.StructType([*df.select(*[f"`{c}`" for c in keep]).schema,
                           *[T.StructField(name, kind, True) for name, kind, _ in outputs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                made = [one(x) for x in part.column(source).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep],
                     *[pa.array([row[i] for row in made], type=arrow)
                       for i, (_, _, arrow) in enumerate(outputs)]], names=[*keep, *names])

    return df.mapInArrow(run, schema)


def _encoder(ranks: Broadcast, pattern: str, chunk_chars: int):
    one = _encoding(ranks, pattern).encode_ordinary

    def ids(text):
        if not text:
            return []
        if len(text) <= chunk_chars:
            return one(text)
        return [i for part in chunks(text, chunk_chars) for i in one(part)]

    return ids


def _decoder(ranks: Broadcast):
    words = _vocabulary(ranks)

    def raw(ids):
        if ids is None:
            return None
        try:
            if ids and min(ids) < 0:
                return None
            return b"".join([words[i] for i in ids])
        except (TypeError, IndexError):
            return None

    return raw


IDS = (T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))
BYTES = (T.BinaryType(), pa.binary())


def encode(df: DataFrame, ranks: Broadcast, pattern: str, text_col: str = "text",
           output_col: str = "token_ids", decoded_col: str | None = None,
           chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Adds ``output_col``, the ids of each whole text as ``array<int>``, and, if it is
    named, ``decoded_col``: the raw bytes that these ids decode to, in the same pass."""

    def make():
        ids, raw = _encoder(ranks, pattern, chunk_chars), _decoder(ranks)

        def both(text):
            made = ids(text)
            return made, raw(made) if decoded_col else None

        return both

    outputs = [(output_col, *IDS), *([(decoded_col, *BYTES)] if decoded_col else [])]
    return _mapped(df, text_col, outputs, make)


def decode(df: DataFrame, ranks: Broadcast, ids_col: str = "token_ids",
           output_col: str = "decoded") -> DataFrame:
    """Adds ``output_col``, the raw bytes that the ids stand for."""

    def make():
        raw = _decoder(ranks)
        return lambda ids: (raw(ids),)

    return _mapped(df, ids_col, [(output_col, *BYTES)], make)
