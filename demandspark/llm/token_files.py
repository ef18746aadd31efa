"""Token ids as Arrow files of equal-length sequences with masks."""

from __future__ import annotations

import json
import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.blocks import BLOCK_CHARS, KEPT_PIECES, PieceEncoder, Places, gather, map_blocks
from demandspark.session import shared_path, staged

#: Ids in a sequence, sequences in a record batch.
SEQUENCE = 2_048
BATCH_SEQUENCES = 64

MANIFEST = "part int, file string, n_docs long, n_ids long"


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as path or address."""
    if re.match(r"file:/(?!/)", folder):
        folder = folder.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


class WordTable:
    """Ids of pieces between blanks by the tokenizers library, each distinct word encoded once while kept.

    Only for tokenizers that lower-case, drop white space, cut words into runs of letters, and mark the
    end of a run in its last token. A piece of letters with marks behind it, as most are, is its
    lower-cased letters and its marks; many words of letters go to the library as one text and are told
    apart by the end marks. Any other piece goes to the library as it is.
    """

    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\\[-`{}~]*)")

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.word, self.mark = Places(), Places()
        self.flat = {name: np.zeros(0, np.int32) for name in ("word", "mark")}
        self.size = {name: np.zeros(0, np.int64) for name in ("word", "mark")}

    def _add(self, name: str, flat: np.ndarray, size: np.ndarray) -> None:
        self.flat[name], self.size[name] = np.concatenate([self.flat[name], flat]), np.concatenate([self.size[name], size])

    def _one_by_one(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int32, int(size.sum())), size

    def _runs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, _ = self._one_by_one([" ".join(words[i:i + 256]) for i in range(0, len(words), 256)])
        last = np.flatnonzero(self.ends[flat])
        if len(last) != len(words):
            raise ValueError("the tokenizer does not mark the ends of words")
        return flat, np.diff(last, prepend=-1)

    def encode_all(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        if len(self.word) > KEPT_PIECES:
            self.forget()
        lower, match = self.word.__getitem__, self.PLAIN.fullmatch
        word, mark, odd = np.full(len(pieces), -1), np.full(len(pieces), -1), []
        for i, piece in enumerate(pieces):
            m = match(piece)
            if m:
                word[i], mark[i] = lower(m[1].lower()), self.mark[m[2]]
            elif piece:
                odd.append(i)
        fresh = list(islice(self.word, len(self.size["word"]), None))
        if fresh:
            self._add("word", *self._runs(fresh))
        fresh = list(islice(self.mark, len(self.size["mark"]), None))
        if fresh:
            self._add("mark", *self._one_by_one(fresh))
        others, other_size = self._one_by_one([pieces[i] for i in odd]) if odd else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        flat = np.concatenate([self.flat["word"], self.flat["mark"], others])
        start, size = np.zeros((len(pieces), 2), np.int64), np.zeros((len(pieces), 2), np.int64)
        plain = word >= 0
        for column, name, at, base in ((0, "word", word, 0), (1, "mark", mark, len(self.flat["word"]))):
            own = self.size[name]
            start[plain, column], size[plain, column] = base + (np.cumsum(own) - own)[at[plain]], own[at[plain]]
        base = len(flat) - len(others)
        start[odd, 0], size[odd, 0] = base + np.cumsum(other_size) - other_size, other_size
        return gather(flat, start.reshape(-1), size.reshape(-1)), size.sum(1)


def word_encoder(tokenizer_json: str) -> PieceEncoder:
    """Encoder of whole texts, the same for all tasks of a Python worker, so words met before are known."""
    kept = sys.modules.setdefault("_kept_word_encoders", types.ModuleType("_kept_word_encoders")).__dict__
    if tokenizer_json not in kept:
        table = WordTable(tokenizer_json)
        kept[tokenizer_json] = PieceEncoder(lambda text: text.replace("\n", " ").split(" "), table.encode_all, KEPT_PIECES)
    return kept[tokenizer_json]


class SequenceWriter:
    """One Arrow file of ids and masks, and one of the documents in it.

    Ids run on from document to document. The last sequence is filled with zeros that its mask marks.
    Batches have the same number of sequences, but for the last, and are not compressed.
    """

    def __init__(self, file_system: fs.FileSystem, path: str, width: str, sequence: int = SEQUENCE, batch: int = BATCH_SEQUENCES):
        self.sequence, self.batch, self.type = sequence, batch, np.dtype(width)
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.type), sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [file_system.open_output_stream(path + end) for end in (".arrow", ".docs.arrow")]
        self.files = [pa.ipc.new_file(sink, schema) for sink, schema in zip(self.sinks, (self.schema, self.docs_schema))]
        self.rest: list[np.ndarray] = []
        self.waiting = self.n_ids = self.n_docs = 0

    def add(self, doc_ids: list, docs: list[np.ndarray]) -> None:
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        starts = self.n_ids + np.cumsum(sizes) - sizes
        self.files[1].write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes)], schema=self.docs_schema))
        self.n_docs += len(docs)
        self.n_ids += int(sizes.sum())
        self.rest.append(np.concatenate([d.astype(self.type) for d in docs]) if docs else np.zeros(0, self.type))
        self.waiting += len(self.rest[-1])
        full = self.waiting // (self.sequence * self.batch) * self.sequence * self.batch
        if full:
            ids = np.concatenate(self.rest)
            self._write(ids[:full], full)
            self.rest, self.waiting = [ids[full:]], len(ids) - full

    def _write(self, ids: np.ndarray, real: int) -> None:
        lists = lambda values: pa.FixedSizeListArray.from_arrays(values, self.sequence)
        mask = np.arange(len(ids)) < real
        table = pa.record_batch([lists(pa.array(ids)), lists(pa.array(mask))], schema=self.schema)
        for at in range(0, table.num_rows, self.batch):
            self.files[0].write_batch(table.slice(at, self.batch))

    def close(self) -> None:
        if self.waiting:
            ids = np.concatenate(self.rest)
            self._write(np.pad(ids, (0, -len(ids) % self.sequence)), len(ids))
        for x in (*self.files, *self.sinks):
            x.close()


class SequenceReader:
    """Random access to sequences, masks and documents without copying; local files are mapped."""

    def __init__(self, file_system: fs.FileSystem, path: str):
        opened = [pa.memory_map(path + end) if isinstance(file_system, fs.LocalFileSystem) else file_system.open_input_file(path + end)
                  for end in (".arrow", ".docs.arrow")]
        self.file, self.docs = map(pa.ipc.open_file, opened)
        self.sequence = self.file.schema.field("ids").type.list_size
        self.batch = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0

    def sequence_at(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        batch = self.file.get_batch(i // self.batch)
        at = i % self.batch
        return batch.column(0)[at].values.to_numpy(), batch.column(1)[at].values.to_numpy(zero_copy_only=False)

    def stretch(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Views of ``n`` ids from ``start``, one for each record batch they touch."""
        width = self.sequence * self.batch
        while n > 0:
            ids = self.file.get_batch(start // width).column(0).flatten().to_numpy()
            part = ids[start % width:start % width + n]
            yield part
            start, n = start + len(part), n - len(part)


def write_tokens(docs: DataFrame, tokenizer_json: str, end_id: int, folder: str | None = None, doc_id: str = "doc_id", text: str = "text",
                 sequence: int = SEQUENCE, batch: int = BATCH_SEQUENCES, block_chars: int = BLOCK_CHARS) -> tuple[str, DataFrame]:
    """Write the ids of all documents, in ascending id order, and return the folder and its manifest.

    The manifest, itself a stored table, has ``part, file, n_docs, n_ids``. Each task writes files of
    its own name, so a repeated task never spoils another's, and only files in the manifest count.
    Null texts are empty and yield the end id; null ids come first; rows with one id are ordered by a
    hash of their text. An empty table gives an empty manifest. Documents are dealt by ranges of
    (id, hash), so one id that fills the table is still spread.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-files", keep=True)
    file_system, root = open_folder(folder)
    file_system.create_dir(root, recursive=True)
    top = max(max(json.loads(tokenizer_json)["model"]["vocab"].values(), default=0),
              max((t["id"] for t in json.loads(tokenizer_json).get("added_tokens", [])), default=0), end_id)
    width = "uint16" if top < 1 << 16 else "uint32"
    shared = spark.sparkContext.broadcast(tokenizer_json)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, writer, encoder = TaskContext.get().partitionId(), None, None
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        files, path = open_folder(folder)
        for rows in frames:
            encoder = encoder or word_encoder(shared.value)
            writer = writer or SequenceWriter(files, f"{path}/{name}", width, sequence, batch)
            ids = [np.append(x, end_id) for x in encoder.encode(rows["text"].tolist())]
            writer.add([None if pd.isna(i) else int(i) for i in rows["doc_id"]], ids)
        if writer:
            writer.close()
            yield pd.DataFrame({"part": [part], "file": [name], "n_docs": [writer.n_docs], "n_ids": [writer.n_ids]})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(tasks, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return folder, staged(map_blocks(dealt, write, MANIFEST, block_chars))


def read_documents(folder: str, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    ``start`` counts the ids of all documents before it. The running sum sees one row per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file_system, root = open_folder(folder)
        for listed in batches:
            for name, base in zip(listed["file"], listed["base"]):
                reader = SequenceReader(file_system, f"{root}/{name}")
                for i in range(reader.docs.num_record_batches):
                    docs = reader.docs.get_batch(i).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
                    sums = []
                    for start, n in zip(docs["start"], docs["n_tokens"]):
                        crc = 0
                        for ids in reader.stretch(start, n):
                            crc = zlib.crc32(ids.astype("<u4"), crc)
                        sums.append(crc)
                    yield docs.assign(start=docs["start"] + base, ids_crc32=sums)

    tasks = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return files.repartition(tasks, "file").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
