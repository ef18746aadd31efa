"""Byte-level BPE by merge replay over the distinct pieces of a block of text."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.blocks import BLOCK_CHARS, KEPT_PIECES, PieceEncoder, gather, map_blocks

def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Token bytes and ranks from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class MergeTable:
    """Which two tokens join into which; the result's id is its rank, lowest first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, result = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), result.append(rank)
        self.base = max(ranks.values()) + 2
        key = np.array(left, np.int64) * self.base + np.array(right, np.int64)
        by = np.argsort(key)
        self.key, self.result = key[by], np.array(result, np.int64)[by]

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        if not len(self.key):
            return np.full(len(left), -1)
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.result[at], -1)


def encode_piece(piece: bytes, table: MergeTable) -> list[int]:
    """One piece alone: join the adjacent pair of lowest rank, leftmost first, until none is left.

    A heap of pairs and a linked list of neighbours keep a piece of any length near linear.
    """
    if piece in table.ranks:
        return [table.ranks[piece]]
    ids = table.byte_id[np.frombuffer(piece, np.uint8)].tolist()
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    bytes_of = table.token
    ranks = table.ranks

    def rank(i: int) -> int | None:
        j = after[i]
        return ranks.get(bytes_of[ids[i]] + bytes_of[ids[j]]) if j < n else None

    heap = [(r, i, ids[i], ids[after[i]]) for i in range(n - 1) if (r := rank(i)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j], after[i] = r, -1, after[j]
        if after[j] < n:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and (new := rank(k)) is not None:
                heapq.heappush(heap, (new, k, ids[k], ids[after[k]]))
    return [x for x in ids if x >= 0]


def replay(pieces: list[bytes], table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces in a row, and how many each piece has.

    All symbols lie in one array with links to their neighbours. An inverted index maps each rank to
    the positions of its pairs. Ranks are taken in ascending order; a merge touches its positions at
    once, then looks up only the new pairs on either side and files them under their ranks. Where a
    new pair ranks no later than the merge that made it, order within the piece matters: such pieces,
    and pieces with overlapping pairs like a a a, leave the replay and are encoded alone. A piece
    that is a token is that token.
    """
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    whole = np.fromiter((table.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
    ids = table.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
    n = len(ids)
    of = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    ends = np.cumsum(lengths)[lengths > 0]
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    after[ends - 1] = -1
    before[ends - lengths[lengths > 0]] = -1
    alone = whole >= 0
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def file(at: np.ndarray, ranks: np.ndarray) -> None:
        by = np.argsort(ranks, kind="stable")
        at, ranks = at[by], ranks[by]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for lo, hi in zip(cuts, cuts[1:]):
            rank = int(ranks[lo])
            if rank not in index:
                index[rank] = []
                heapq.heappush(queue, rank)
            index[rank].append(at[lo:hi])

    start = np.flatnonzero((after >= 0) & ~alone[of]).astype(np.int32)
    ranks = table.lookup(ids[start], ids[start + 1])
    file(start[ranks >= 0], ranks[ranks >= 0]) if (ranks >= 0).any() else None
    while queue:
        rank = heapq.heappop(queue)
        parts = index.pop(rank)
        at = np.sort(parts[0] if len(parts) == 1 else np.concatenate(parts))
        at = at[(ids[at] >= 0) & (after[at] >= 0) & ~alone[of[at]]]
        at = at[table.lookup(ids[at], ids[after[at]]) == rank]
        if not len(at):
            continue
        nxt = after[at]
        beyond = after[nxt]
        if len(at) > 1:
            bad = nxt[:-1] == at[1:]
            beside = np.flatnonzero(beyond[:-1] == at[1:])
            if len(beside):  # after the first of two neighbouring merges, its pair with the other's left half
                between = table.lookup(np.full(len(beside), rank), ids[at[beside + 1]])
                bad[beside] |= (between >= 0) & (between <= rank)
            if bad.any():
                alone[of[at[:-1][bad]]] = True
                at = at[~alone[of[at]]]
                if not len(at):
                    continue
                nxt = after[at]
                beyond = after[nxt]
        ids[at], ids[nxt] = rank, -1
        after[at] = beyond
        followed = beyond >= 0
        before[beyond[followed]] = at[followed]
        left = before[at]
        free = left >= 0
        free[1:] &= left[1:] != at[:-1]
        touched = np.concatenate([left[free], at[followed]])
        if len(touched):
            new = table.lookup(ids[touched], ids[after[touched]])
            late = (new >= 0) & (new <= rank)
            if late.any():
                alone[of[touched[late]]] = True
            later = new > rank
            if later.any():
                file(touched[later], new[later])
    live = (ids >= 0) & ~alone[of]
    sizes = np.bincount(of[live], minlength=len(pieces))
    own = {i: [int(whole[i])] if whole[i] >= 0 else encode_piece(pieces[i], table) for i in np.flatnonzero(alone).tolist()}
    for i, x in own.items():
        sizes[i] = len(x)
    first = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.int32)
    filled = np.ones(len(out), bool)
    for i, x in own.items():
        out[first[i]:first[i] + len(x)] = x
        filled[first[i]:first[i] + len(x)] = False
    out[filled] = ids[live]
    return out, sizes


def piece_encoder(table: MergeTable, pattern: str, kept: int = KEPT_PIECES) -> PieceEncoder:
    """Encodes whole texts; each distinct match of ``pattern`` goes through a replay once."""
    return PieceEncoder(regex.compile(pattern).findall, lambda pieces: replay([p.encode("utf-8", "surrogatepass") for p in pieces], table), kept)


class Decoder:
    """Bytes of token ids, by gathering from all tokens' bytes laid end to end."""

    def __init__(self, token: dict[int, bytes]):
        top = max(token) + 1
        self.flat = np.frombuffer(b"".join(token.get(i, b"") for i in range(top)), np.uint8)
        self.size = np.fromiter((len(token.get(i, b"")) for i in range(top)), np.int64, top)
        self.start = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.start[ids], self.size[ids]).tobytes()


def encode_documents(docs: DataFrame, ranks: list[bytes], pattern: str, doc_id: str = "doc_id", text: str = "text",
                     with_ids: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row, and ``ids`` when asked for.

    ``ranks`` are the lines of a rank file of fixed size, which travels with the tasks. A null text is
    empty and has no tokens; repeated rows give repeated answers; no rows give no rows; other columns
    are not read. A very long text is encoded whole. There is no shuffle by key, so no hot task.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = MergeTable(read_ranks(shared.value))
        encoder, decoder = piece_encoder(table, pattern), Decoder(table.token)
        names = np.array([str(i) for i in range(max(table.token) + 1)], dtype=object)
        for rows in frames:
            out = []
            for ids in encoder.encode(rows["text"].tolist()):
                said = " ".join(names[ids])
                out.append((len(ids), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(decoder.decode(ids)).hexdigest(), ids if with_ids else None))
            frame = pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "n_tokens": [x[0] for x in out],
                                  "ids_sha256": [x[1] for x in out], "decoded_sha256": [x[2] for x in out]})
            if with_ids:
                frame["ids"] = [x[3] for x in out]
            yield frame

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return map_blocks(rows, run, schema, block_chars)
