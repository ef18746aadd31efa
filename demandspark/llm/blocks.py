"""Blocks of whole texts and the distinct pieces in them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Texts are taken together up to this many characters; a longer text is a block of its own.
BLOCK_CHARS = 4_000_000
#: Distinct pieces a task keeps before it starts afresh; a bound on memory, not on results.
KEPT_PIECES = 200_000


class Places(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key) -> int:
        self[key] = value = len(self)
        return value


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` with these starts and sizes, one after another."""
    offset = np.repeat(start - (np.cumsum(size) - size), size)
    return flat[offset + np.arange(len(offset))]


class PieceEncoder:
    """Encodes whole texts block by block; each distinct piece is encoded once while it is kept.

    ``split`` cuts a text into pieces; ``encode_all`` returns the ids of many pieces in a row and the
    number of ids of each.
    """

    def __init__(self, split: Callable[[str], list], encode_all: Callable[[list], tuple[np.ndarray, np.ndarray]], kept: int = KEPT_PIECES):
        self.split, self.encode_all, self.kept = split, encode_all, kept
        self.forget()

    def forget(self) -> None:
        self.place, self.flat, self.size = Places(), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        if len(self.place) > self.kept:
            self.forget()
        number, docs = self.place.__getitem__, []
        for text in texts:
            pieces = self.split(text)
            docs.append(np.fromiter(map(number, pieces), np.int32, len(pieces)))
        flat, size = self.encode_all(list(islice(self.place, len(self.size), None)))
        self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, size])
        start = np.cumsum(self.size) - self.size
        for doc in docs:
            yield gather(self.flat, start[doc], self.size[doc])


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = BLOCK_CHARS) -> Iterator[pd.DataFrame]:
    """The same rows in order, in frames of about ``chars`` bytes of text or of one longer row."""
    for rows in batches:
        size = pc.binary_length(rows.column(rows.schema.get_field_index(column))).to_numpy(zero_copy_only=False)
        block = (np.cumsum(size) - size) // chars
        for at in np.split(np.arange(len(block)), np.flatnonzero(np.diff(block)) + 1):
            if len(at):
                yield rows.slice(at[0], len(at)).to_pandas(integer_object_nulls=True)  # ids beside nulls stay exact


def map_blocks(rows: DataFrame, work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, chars: int = BLOCK_CHARS) -> DataFrame:
    """Run ``work`` over each partition's blocks; only one block of a batch is turned into Python strings at a time."""
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(blocks(batches, chars=chars)):
            yield pa.RecordBatch.from_pandas(out, schema=shape, preserve_index=False)

    return rows.mapInArrow(run, schema)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes, which keeps small and similar numbers short."""
    head = "\n".join(f"{a.dtype.str} {len(a)}" for a in arrays).encode()
    body = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays if len(a))
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + body)


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for line in raw[4:at].decode().split("\n"):
        kind, n = line.split(" ")
        size = np.dtype(kind).itemsize * int(n)
        out.append(np.frombuffer(raw, np.uint8, size, at).reshape(-1, max(int(n), 1)).T.copy().reshape(-1).view(kind)[:int(n)])
        at += size
    return out
