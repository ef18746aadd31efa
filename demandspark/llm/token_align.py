"""Alignment of two tokenizers' tokens by lockstep merging of their byte offsets."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from demandspark.llm.blocks import KEPT_PIECES, Places, blocks, gather, pack, unpack
from demandspark.llm.common import sent, whole_text
from demandspark.session import staged

#: Bytes of a document that one lane of the merge covers.
LANE_BYTES = 2048
#: Chunks that go to a tokenizer at once.
BATCH_CHUNKS = 10_000
#: What any of the two tokenizers might take for white space.
SPACES = "\\s\u180e\u200b-\u200f\u2028-\u202f\u2060-\u2064\ufeff\x1c-\x1f\x85"
#: A space after white space, which may belong to the chunk before; all other spaces begin a chunk in both tokenizers.
UNSAFE, SAFE = re.compile(f"[{SPACES}] "), re.compile(f"(?<=[^{SPACES}]) ")

ALIGNED = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
           "sha array<string>, groups array<string>, links binary, pairs array<long>, n array<long>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write: printable bytes stand for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenizerPair:
    """The two tokenizers with the bytes of their tokens."""

    def __init__(self, tokenizer_json: str, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        alphabet, vocab = byte_alphabet(), self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("\u2581", " ").encode() for i in range(self.b.get_piece_size())]
        self.space = self.b.piece_to_id("\u2581")

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of chunks that follow a space each; the second tokenizer adds that space by itself."""
        a, b = [], []
        for at in range(0, len(chunks), BATCH_CHUNKS):
            some = chunks[at:at + BATCH_CHUNKS]
            a += [x.ids for x in self.a.encode_batch_fast([" " + c for c in some], add_special_tokens=False)]
            b += self.b.encode(some, num_threads=1)
        return a, [ids if chunk else [self.space] for chunk, ids in zip(chunks, b)]


def split_chunks(text: str) -> list[str]:
    """What follows each space of space+text that both tokenizers begin anew at."""
    if UNSAFE.search(text) or text[:1] == " ":
        first, *rest = SAFE.split(" " + text)
        return [first[1:], *rest]
    return text.split(" ")


class ChunkEncoder:
    """Ids of whole texts by both tokenizers; each distinct chunk is encoded once while it is kept."""

    def __init__(self, pair: TokenizerPair, kept: int = KEPT_PIECES):
        self.pair, self.kept = pair, kept
        self.forget()

    def forget(self) -> None:
        self.place, self.bad = Places(), np.zeros(0, bool)
        self.flat, self.size = [np.zeros(0, np.int32)] * 2, [np.zeros(0, np.int64)] * 2

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Two arrays of ids a text; both empty for empty texts and where joined token bytes differ from space+text."""
        if len(self.place) > self.kept:
            self.forget()
        number, docs = self.place.__getitem__, []
        for text in texts:
            chunks = split_chunks(text) if text else []
            docs.append(np.fromiter(map(number, chunks), np.int64, len(chunks)))
        fresh = list(islice(self.place, len(self.bad), None))
        if fresh:
            both, wanted, bad = self.pair.encode(fresh), [(" " + c).encode() for c in fresh], np.zeros(len(fresh), bool)
            for k, spelled in enumerate((self.pair.bytes_a, self.pair.bytes_b)):
                size = np.fromiter(map(len, both[k]), np.int64, len(fresh))
                self.flat[k] = np.concatenate([self.flat[k], np.fromiter(chain.from_iterable(both[k]), np.int32, size.sum())])
                self.size[k] = np.concatenate([self.size[k], size])
                bad |= [b"".join([spelled[i] for i in ids]) != w for ids, w in zip(both[k], wanted)]
            self.bad = np.concatenate([self.bad, bad])
        start, out = [np.cumsum(s) - s for s in self.size], []
        for text, doc in zip(texts, docs):
            a, b = (gather(self.flat[k], start[k][doc], self.size[k][doc]) for k in (0, 1))
            if self.bad[doc].any() and not self._spells(text, a, b):
                a, b = a[:0], b[:0]
            out.append((a, b))
        return out

    def _spells(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        whole = (" " + text).encode()
        return all(b"".join([spelled[i] for i in ids.tolist()]) == whole for spelled, ids in ((self.pair.bytes_a, a), (self.pair.bytes_b, b)))


def lockstep(end_a: np.ndarray, end_b: np.ndarray, doc_starts: np.ndarray, total: int, lane_bytes: int = LANE_BYTES):
    """Positions (a, b) of all overlapping token pairs in byte order, and which of them both tokens end.

    ``end_a`` and ``end_b`` are the tokens' end offsets over all documents written one after another, so a
    document's end is one in both. Each document is a lane, a long one several; the lanes' pointers are one
    state vector. A step emits the pair that every lane points at and advances the pointer whose token ends
    first, or both at a cut; lanes that reached their end leave the vector. A lane owns the overlaps
    that begin in its stretch of bytes, so a stretch may begin inside tokens.
    """
    sizes = np.diff(np.append(doc_starts, total))
    lanes = -(-sizes // lane_bytes)
    offset = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = np.repeat(doc_starts, lanes) + offset * lane_bytes
    stop = np.append(at, total)[1:]
    a, b = np.searchsorted(end_a, at, "right"), np.searchsorted(end_b, at, "right")
    room = np.searchsorted(end_a, stop, "right") - a + np.searchsorted(end_b, stop, "right") - b + 1
    out = np.cumsum(room) - room
    # A pair that began before the stretch belongs to the lane before.
    begin = np.maximum(np.where(a > 0, end_a[a - 1], 0), np.where(b > 0, end_b[b - 1], 0)) if len(a) else at
    inside = begin < at
    first_end = np.minimum(end_a[a], end_b[b])
    moved_a, moved_b = inside & (end_a[a] == first_end), inside & (end_b[b] == first_end)
    at = np.where(inside, first_end, at)
    a, b = a + moved_a, b + moved_b
    alive = at < stop
    a, b, out, stop = a[alive], b[alive], out[alive], stop[alive]
    link_a, link_b = np.full(room.sum(), -1, np.int64), np.zeros(room.sum(), np.int64)
    cut = np.zeros(room.sum(), bool)
    while len(a):
        ends_a, ends_b = end_a[a], end_b[b]
        first = np.minimum(ends_a, ends_b)
        link_a[out], link_b[out], cut[out] = a, b, ends_a == ends_b
        a, b, out = a + (ends_a == first), b + (ends_b == first), out + 1
        going = first < stop
        if not going.all():
            a, b, out, stop = a[going], b[going], out[going], stop[going]
    made = link_a >= 0
    return link_a[made], link_b[made], cut[made]


class Aligner:
    """Aligns the texts of a block."""

    def __init__(self, pair: TokenizerPair, kept: int = KEPT_PIECES, lane_bytes: int = LANE_BYTES):
        self.encoder, self.lane_bytes = ChunkEncoder(pair, kept), lane_bytes
        self.length = [np.array([len(x) for x in spelled]) for spelled in (pair.bytes_a, pair.bytes_b)]
        #: Ids in writing, before another token of the group and as the last of its side.
        self.written = [np.array([[f"{i},", f"{i}{end}"] for i in range(len(n))], object) for n, end in zip(self.length, "|;")]

    def align(self, texts: list[str], with_groups: bool = False) -> dict:
        """Numbers, digests and links of each text; a link is the number of its pair in ``pairs``, most frequent first."""
        docs = self.encoder.encode(texts)
        ids = [np.concatenate([d[k] for d in docs]).astype(np.int64) for k in (0, 1)]
        n = [np.array([len(d[k]) for d in docs]) for k in (0, 1)]
        ends = [np.cumsum(self.length[k][ids[k]]) for k in (0, 1)]
        some = n[0] > 0
        last = np.concatenate([[0], np.cumsum(n[0])])
        doc_end = np.concatenate([[0], ends[0]])[last[1:]]
        total = int(doc_end[-1]) if len(texts) else 0
        a, b, cut = lockstep(*ends, np.concatenate([[0], doc_end[:-1]])[some], total, self.lane_bytes)
        closed = np.flatnonzero(cut)
        group_a, group_b = a[closed], b[closed]
        n_groups = np.diff(np.searchsorted(group_a, last, "left"))
        n_links = np.diff(np.searchsorted(a, last, "left"))
        # A token's place in writing: its own number and the other side's tokens before it.
        of_a, of_b = np.searchsorted(group_a, np.arange(len(ids[0]))), np.searchsorted(group_b, np.arange(len(ids[1])))
        words, closes = np.empty(len(ids[0]) + len(ids[1]), object), [np.zeros(len(i), np.int64) for i in ids]
        closes[0][group_a] = closes[1][group_b] = 1
        words[np.arange(len(ids[0])) + np.concatenate([[0], group_b + 1])[of_a]] = self.written[0][ids[0], closes[0]]
        words[np.arange(len(ids[1])) + group_a[of_b] + 1] = self.written[1][ids[1], closes[1]]
        bounds = np.cumsum(n[0] + n[1])
        groups = ["".join(words[hi - size:hi])[:-1] for hi, size in zip(bounds.tolist(), (n[0] + n[1]).tolist())]
        pairs, link, times = np.unique(ids[0][a] * len(self.length[1]) + ids[1][b], return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return {"n_a": n[0], "n_b": n[1], "n_groups": n_groups, "n_links": n_links,
                "sha": [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups], "groups": groups if with_groups else None,
                "links": pack(rank[link].astype(np.uint32)), "pairs": pairs[order], "n": times[order]}


def align_blocks(docs: DataFrame, tokenizer_json: str, piece_model: bytes, doc_id: str = "doc_id", text: str = "text",
                 with_groups: bool = False, block_chars: int = 2_000_000, lane_bytes: int = LANE_BYTES) -> DataFrame:
    """One stored row per block of documents: their numbers and links, and the id pairs linked in the block with their counts."""
    spark, shape = docs.sparkSession, to_arrow_schema(StructType.fromDDL(ALIGNED))
    files = sent(spark, (tokenizer_json, piece_model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner, block = Aligner(TokenizerPair(*files()), lane_bytes=lane_bytes), TaskContext.get().partitionId() << 32
        for rows in blocks(batches, chars=block_chars):
            found = aligner.align(rows["text"].tolist(), with_groups)
            found |= {"block": block, "doc_ids": [None if pd.isna(i) else int(i) for i in rows["doc_id"]]}
            yield pa.RecordBatch.from_arrays([pa.array([found[f.name]], f.type) for f in shape], schema=shape)
            block += 1

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return staged(rows.mapInArrow(run, ALIGNED))


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, a, b, count, best``: links of each id pair over all blocks, and whether its B id has no pair with more.

    A pair occurs once a block at most, so a frequent pair is no hot key.
    """
    counts = staged(aligned.select(F.explode(F.arrays_zip("pairs", "n")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
                    .agg(F.sum("p.n").alias("count")))
    b = F.pmod("pair", F.lit(size_b))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))  # as many rows as B has ids at most
    return (counts.withColumn("b", b).join(F.broadcast(most), "b")
            .select("pair", F.floor(F.col("pair") / size_b).alias("a"), "b", "count", (F.col("count") == F.col("most")).alias("best")))


def align_documents(docs: DataFrame, tokenizer_json: str, piece_model: bytes, doc_id: str = "doc_id", text: str = "text",
                    with_groups: bool = False, **options) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``, ``groups`` on demand.

    Texts that are null or empty, or that one of the tokenizers does not spell, have no tokens: zeros and an empty
    digest. Repeated rows are aligned and counted each; an empty table gives no rows; other columns are
    not read. Texts are encoded once. Their links are kept as numbers of id pairs of their block, so what is
    shuffled are a block's distinct pairs and the packed links, never a row a link.
    """
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_proto=piece_model).get_piece_size()
    aligned = align_blocks(docs, tokenizer_json, piece_model, doc_id, text, with_groups, **options)
    known = pair_counts(aligned, size_b).select("pair", "count", "best")
    asked = aligned.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(known, "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("facts"))
    told = aligned.join(answers.select("block", F.col("facts.count").alias("count"), F.col("facts.best").alias("best")), "block", "left")
    schema = RESULT + (", groups string" if with_groups else "")
    shape = to_arrow_schema(StructType.fromDDL(schema))
    plain = ("n_a", "n_b", "n_groups", "n_links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            column = {f.name: rows.column(i) for i, f in enumerate(rows.schema)}
            for i in range(rows.num_rows):
                values = lambda name: column[name][i].values
                link, n_links = unpack(column["links"][i].as_py())[0], values("n_links").to_numpy()
                sums = []
                for name in ("best", "count"):
                    facts = values(name).to_numpy(zero_copy_only=False) if column[name][i].is_valid else np.zeros(0)
                    upto = np.concatenate([[0], np.cumsum(facts.astype(np.int64)[link])])
                    ends = np.cumsum(n_links)
                    sums.append(pa.array(upto[ends] - upto[ends - n_links]))
                arrays = [values("doc_ids"), *map(values, plain), *sums, values("sha")] + ([values("groups")] if with_groups else [])
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, shape)], schema=shape)

    return told.select("doc_ids", *plain, "sha", "groups", "links", "count", "best").mapInArrow(run, schema)
