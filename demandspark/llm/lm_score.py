"""Language-model scores of documents by tries of Elias-Fano levels, one for each shard of the n-grams."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from demandspark.llm.blocks import Places, map_blocks, pack, unpack
from demandspark.llm.ngram_trie import Trie, restore
from demandspark.session import staged

#: Documents whose id's crc32 leaves HELD_OUT over FOLDS are scored but not learned from.
FOLDS, HELD_OUT = 7, 2
#: The end of a text as a word, which no word can be, and what stands before a text's first word.
END, START = b" ", 0
#: Counts are exact up to EXACT and in steps of 1 / STEPS of an octave above; ids carry them in their top bits,
#: the word's class in the next six, and a number below.
EXACT, STEPS, CODES, ID_BITS, CLASS_AT = 32_768, 992, 65_535, 40, 34
#: The number alone tells words apart.
NUMBER = (1 << CLASS_AT) - 1
#: After words that make up 1 / FREQUENT of all tokens or more, the next word's class is predicted first.
FREQUENT, CLASSES = 1_024, 64
#: A triple that this many documents of a block have is answered to the block instead of summed where it is looked up.
ASK_FROM = 64
#: Room above zero for the log10 of weights.
REST_SHIFT = 6.0
BLOCK_DOCS = 30_000
#: Larger blocks than elsewhere, as each sends its words and triples once.
BLOCK_CHARS = 8_000_000
#: Characters of the corpus to a shard, which bounds what one task holds, and bits of a triple's packed numbers.
SHARD_CHARS, PACKED_BITS = 50_000_000, 63

MESSAGE = "shard int, block string, kind string, body binary"


def code_of(count: np.ndarray) -> np.ndarray:
    big = np.maximum(count, EXACT).astype(float)
    return np.where(count < EXACT, count, np.minimum(EXACT + np.rint(np.log2(big / EXACT) * STEPS), CODES)).astype(np.int64)


def count_of(ids: np.ndarray) -> np.ndarray:
    """The training count that an id carries."""
    code = CODES - (ids >> ID_BITS)
    return np.where(code < EXACT, code, EXACT * 2.0 ** ((code - EXACT) / STEPS))


def class_of(ids: np.ndarray) -> np.ndarray:
    """The class that an id carries, from a hash of the word."""
    return (ids >> CLASS_AT) & (CLASSES - 1)


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at white space, with the end of the text."""
    return text.encode("utf-8", "surrogatepass").lower().split() + [END]


class Block:
    """The words of a block of documents, numbered shard by shard, so that every pass numbers them alike."""

    def __init__(self, rows: pd.DataFrame, number: int, shards: int):
        self.name = f"{TaskContext.get().partitionId()}-{number}"
        place = Places()
        docs = []
        for text in rows["text"]:
            words = words_of(text)
            docs.append(np.fromiter(map(place.__getitem__, words), np.int32, len(words)))
        words = list(place)
        shard = np.fromiter((xxh64_intdigest(w) % shards for w in words), np.int64, len(words))
        order = np.argsort(shard, kind="stable")
        number_of = np.empty(len(words), np.int32)
        number_of[order] = np.arange(len(words), dtype=np.int32)
        self.words = [words[i] for i in order]
        self.edges = np.searchsorted(shard[order], np.arange(shards + 1))
        self.sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        self.tokens = number_of[np.concatenate(docs)]
        self.held = rows["held_out"].to_numpy(bool)
        self.ids, self.nulls = rows["doc_id"].fillna(0).to_numpy(np.int64), rows["doc_id"].isna().to_numpy()


def read_blocks(frames: Iterator[pd.DataFrame], shards: int) -> Iterator[Block]:
    number = 0
    for rows in frames:
        for at in range(0, len(rows), BLOCK_DOCS):
            yield Block(rows.iloc[at:at + BLOCK_DOCS], number, shards)
            number += 1


def vocabulary(docs: DataFrame, shards: int, block_chars: int) -> DataFrame:
    """Training counts and ids of each block's words, in the block's order, and each shard's sums.

    A block sends each distinct word once with its count; so a word in every text is one entry per block.
    Ids rise as counts fall, carry the count, and differ for all words.
    """
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=1).compress
        for block in read_blocks(frames, shards):
            learned = np.repeat(~block.held, block.sizes)
            count = np.bincount(block.tokens[learned], minlength=len(block.words))
            out = [(s, block.name, press(b"\n".join(block.words[a:b])), pack(count[a:b]))
                   for s, (a, b) in enumerate(zip(block.edges, block.edges[1:])) if b > a]
            yield pd.DataFrame(out, columns=["shard", "block", "words", "counts"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        shard, read = int(rows["shard"].iloc[0]), zstandard.ZstdDecompressor().decompress
        place, at = Places(), []
        for words in rows["words"]:
            words = read(words).split(b"\n")
            at.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
        total = np.zeros(len(place), np.int64)
        for where, counts in zip(at, rows["counts"]):
            total[where] += unpack(counts)[0]
        rank = np.empty(len(place), np.int64)
        # Equal counts are told apart by the word, so that a repeated task gives the same ids.
        names = list(place)
        rank[sorted(range(len(place)), key=lambda i: (-total[i], names[i]))] = np.arange(len(place))
        kind = np.fromiter((xxh64_intdigest(w, seed=1) % CLASSES for w in names), np.int64, len(names))
        ids = ((CODES - code_of(total)) << ID_BITS) + (kind << CLASS_AT) + rank * shards + shard + 1
        out = [(shard, block, "ids", pack(ids[where], total[where])) for block, where in zip(rows["block"], at)]
        seen = total > 0
        mass = np.bincount(class_of(ids[seen]), count_of(ids[seen]) + 1, CLASSES)
        ends = int(total[place[END]]) if END in place else 0
        out.append((shard, "", "sums", pack(np.array([total.sum(), seen.sum(), ends], float), mass)))
        return pd.DataFrame(out, columns=["shard", "block", "kind", "body"])

    return (map_blocks(docs, send, "shard int, block string, words binary, counts binary", block_chars)
            .groupBy("shard").applyInPandas(merge, MESSAGE))


class Totals:
    """Corpus sums: tokens, distinct words, training documents, and each class's share of the unigram mass."""

    def __init__(self, sums: list[list[np.ndarray]]):
        parts = np.array([s[0] for s in sums]).reshape(-1, 3).sum(0)
        self.tokens, self.words, self.docs = (float(x) for x in parts)
        self.room = self.tokens + self.words + 1
        self.mass = (np.array([s[1] for s in sums]).reshape(-1, CLASSES).sum(0) + 1 / CLASSES) / self.room

    def frequent(self, before: np.ndarray) -> np.ndarray:
        return (before == START) | (count_of(before) * FREQUENT >= max(self.tokens, 1))

    def context(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The word before; where that is frequent, also the class of the next word."""
        return (before << 6) + np.where(self.frequent(before), class_of(word), 0)

    def class_share(self, before: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Chance of the class after a frequent word, one added to each class's count, over its unigram share."""
        total = np.where(before == START, self.docs, count_of(before))
        return (seen + 1) / (np.maximum(total, seen) + CLASSES)


def _assemble(shards: int, totals: Totals):
    """The blocks' three words in a row, sent to the shard of the middle one, and the documents' own sums."""
    def assemble(tokens: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        name = tokens["block"].iloc[0]
        local, sizes, held, doc_ids, nulls = unpack(tokens["body"].iloc[0])
        answers = [unpack(b) for b in found.sort_values("shard")["body"]]
        word_id, count = (np.concatenate([a[i] for a in answers]) for i in (0, 1))
        if len(word_id) != int(tokens["shard"].iloc[0]):
            raise RuntimeError("a block's words differ between two passes; store the documents first")
        doc = np.repeat(np.arange(len(sizes)), sizes)
        known = np.bincount(doc, count[local] > 0, len(sizes)).astype(np.int64)
        logs = np.bincount(doc, np.log10(count[local] + 1.0), len(sizes))
        # Words by rank of their ids, the text's start below all, so that one integer orders n-grams and documents.
        ranked = np.sort(word_id)
        rank = np.searchsorted(ranked, word_id) + 1
        word = rank[local]
        starts = np.cumsum(sizes) - sizes
        before = np.concatenate([[0], word[:-1]])
        before[starts] = 0
        earlier = np.concatenate([[0], before[:-1]])
        earlier[starts] = 0
        bits = int(len(ranked) + 1).bit_length()
        contexts, at = np.unique((before << bits) + earlier, return_inverse=True)
        key = (((at << bits) + word) << 15) + doc
        del before, earlier, at, word, doc
        key, times = np.unique(key, return_counts=True)
        gram, doc = key >> 15, (key & 0x7FFF).astype(np.uint16)
        first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        n_docs = np.diff(np.r_[first, len(gram)])
        learned = np.add.reduceat(np.where(held[doc].astype(bool), 0, times), first)
        ids = np.concatenate([[START], ranked])
        pair = contexts[gram[first] >> bits]
        one, mid, two = ids[pair >> bits], ids[pair & ((1 << bits) - 1)], ids[gram[first] & ((1 << bits) - 1)]
        context = totals.context(one, two)
        shard = ((context.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)).astype(np.int64) % shards
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        asked = n_docs >= ASK_FROM
        home = crc32(name.encode()) % shards
        starts = np.cumsum(n_docs) - n_docs
        out, kept = [], []
        for s, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                own = order[a:b]
                sent, ask = own[~asked[own]], own[asked[own]]
                entries = _stretches(starts[sent], n_docs[sent])
                kept.append(ask)
                out.append((s, name, "pairs", pack(one[own], mid[own] & NUMBER, two[own], learned[own].astype(np.uint32), asked[own].astype(np.uint8),
                                                   n_docs[sent].astype(np.uint16), doc[entries], times[entries].astype(np.uint32))))
        kept = np.concatenate(kept)
        entries = _stretches(starts[kept], n_docs[kept])
        out.append((home, name, "docs", pack(doc_ids, nulls, held, sizes, known, logs, n_docs[kept], doc[entries], times[entries])))
        return pd.DataFrame(out, columns=["shard", "block", "kind", "body"])
    return assemble


def _stretches(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _ranked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each one's place."""
    values, place = np.unique(x, return_inverse=True)
    return values, place.reshape(-1)


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal keys start, and each entry's run."""
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    return np.flatnonzero(new), np.cumsum(new) - 1


class ShardModel:
    """A shard's trie: contexts, the word before each context, and the words after both.

    A context is the word before, with the next word's class where that word is frequent. Under each
    context the word ANY stands for every word before it, so that the same path leads to pairs and to
    triples. Probabilities are interpolated by Witten-Bell: triples with pairs, pairs with the unigram,
    after a frequent word within the class; a context's own value is the chance of its class.
    """

    ANY = 0

    def __init__(self, trie: Trie, words: np.ndarray, middles: np.ndarray, totals: Totals, context_of: np.ndarray, nodes: np.ndarray):
        self.trie, self.words, self.middles, self.totals = trie, words, middles, totals
        self.context_of, self.nodes = context_of, nodes

    @classmethod
    def build(cls, one: np.ndarray, mid: np.ndarray, two: np.ndarray, n: np.ndarray, totals: Totals) -> ShardModel:
        """From learned distinct triples, ``mid`` before ``one`` before ``two``, with their counts."""
        context = totals.context(one, two)
        contexts, c = _ranked(context)
        middles, m = _ranked(mid)
        words, w = _ranked(two)
        bits_m, bits_w = int(len(middles) + 1).bit_length(), int(len(words) + 1).bit_length()
        if int(len(contexts)).bit_length() + bits_m + bits_w > 63:
            raise ValueError("a shard is too large; use more shards")
        frequent = np.zeros(len(contexts), bool)
        before = np.zeros(len(contexts), np.int64)
        frequent[c], before[c] = totals.frequent(one), one
        mass = np.where(frequent, totals.mass[contexts & 63], 1.0)
        # Pairs: counts over all middles.
        pair, at = np.unique((c << bits_w) + w, return_inverse=True)
        pair_n = np.bincount(at.reshape(-1), n, len(pair))
        of = pair >> bits_w
        seen, kinds = np.bincount(of, pair_n, len(contexts)), np.bincount(of, minlength=len(contexts))
        unigram = (count_of(words[pair & ((1 << bits_w) - 1)]) + 1) / totals.room / mass[of]
        pair_p = (pair_n + kinds[of] * unigram) / (seen + kinds)[of]
        # Triples, in order of context, middle and word.
        key = (((c << bits_m) + m + 1) << bits_w) + w
        given = np.argsort(key)
        context_of, (key, n, c, w) = c, (key[given], n[given].astype(float), c[given], w[given])
        first, run = _groups(key >> bits_w)
        seen3, kinds3 = np.bincount(run, n, len(first)), np.bincount(run, minlength=len(first))
        below = pair_p[np.searchsorted(pair, (c << bits_w) + w)]
        p = (n + kinds3[run] * below) / (seen3 + kinds3)[run]
        # Both under one path; ANY is the lowest middle.
        any_key = ((of << bits_m) << bits_w) + (pair & ((1 << bits_w) - 1))
        both, logs = np.concatenate([any_key, key]), np.log10(np.concatenate([pair_p, p]))
        order = np.argsort(both)
        place = np.empty(len(both), np.int64)
        place[order] = np.arange(len(both))
        nodes = np.empty(len(key), np.int64)
        nodes[given] = place[len(any_key):]
        both, logs = both[order], logs[order]
        rest = {"key": np.concatenate([np.arange(len(contexts)) << bits_m, key[first] >> bits_w]),
                "value": np.log10(np.concatenate([kinds / (seen + kinds) / mass, kinds3 / (seen3 + kinds3)]))}
        order = np.argsort(rest["key"])
        node, value = rest["key"][order], rest["value"][order]
        share = np.where(frequent, totals.class_share(before, seen), 1.0)
        low = (1 << bits_m) - 1
        grams = [contexts[:, None], np.stack([node >> bits_m, node & low], 1),
                 np.stack([both >> bits_w >> bits_m, (both >> bits_w) & low, both & ((1 << bits_w) - 1)], 1)]
        trie = Trie.build(grams, [np.log10(share), np.zeros(len(node)), np.minimum(logs, 0.0)],
                          [np.zeros(len(contexts)), value - REST_SHIFT, np.zeros(len(both))])
        return cls(trie, words, middles, totals, context_of, nodes)

    def learned(self) -> np.ndarray:
        """Log10 probability of the triples it was built from, in their order, at the nodes they became."""
        return restore(self.trie.levels[2].logp[self.nodes]) + restore(self.trie.levels[0].logp[self.context_of])

    def look_up(self, one: np.ndarray, mid: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Log10 probability of ``two`` after ``mid`` and ``one``.

        The successor among the children of (context, middle); else that node's weight for the unseen
        times what ANY has; there again the successor, or the weight times the unigram probability.
        """
        totals = self.totals
        unigram = np.log10((count_of(two) + 1) / totals.room)
        context = totals.context(one, two)
        beyond = [int(level.stride) for level in self.trie.levels]
        w = np.where(*_known(self.words, two), beyond[2])
        m = np.where(*_known(self.middles, mid, 1), beyond[1])
        pairs = self.trie.find(np.stack([context, np.full(len(two), self.ANY), w], 1))
        triples = self.trie.find(np.stack([context, m, w], 1))
        logp, rest = (lambda k, at: restore(self.trie.levels[k].logp[at])), (lambda at: restore(self.trie.levels[1].rest[at]) + REST_SHIFT)
        frequent = totals.frequent(one)
        unseen = np.where(frequent, np.log10(totals.class_share(one, np.zeros(len(one))) / totals.mass[context & 63]), 0.0)
        out, has = unigram + unseen, pairs[:, 0] >= 0
        inside = unigram[has] + rest(pairs[has, 1])
        hit = pairs[has, 2] >= 0
        inside[hit] = logp(2, pairs[has, 2][hit])
        led = triples[has, 1] >= 0
        inside[led] += rest(triples[has, 1][led])
        full = triples[has, 2] >= 0
        inside[full] = logp(2, triples[has, 2][full])
        out[has] = inside + logp(0, pairs[has, 0])
        return out


def _known(values: np.ndarray, x: np.ndarray, shift: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Whether each x is among the ordered values, and its place plus ``shift``."""
    at = np.minimum(np.searchsorted(values, x), max(len(values) - 1, 0))
    return (values[at] == x if len(values) else np.zeros(len(x), bool)), at + shift


def packed_bits(*counts: int, most: int = PACKED_BITS) -> list[int]:
    """Bits of the numbers of all kinds but the first; raises before numbers of all kinds would not fit one integer."""
    bits = [int(n).bit_length() for n in counts]
    if sum(bits) > most:
        raise ValueError(f"a shard's triples need {sum(bits)} bits of {most}; use more shards")
    return bits[1:]


def _score(totals: Totals):
    """A shard's trie from the counts of all blocks, and its answers to each block."""
    def score(rows: pd.DataFrame) -> pd.DataFrame:
        out = [(r.block, -1, r.kind, r.body) for r in rows.itertuples(index=False) if r.kind != "pairs"]
        rows = rows[rows["kind"] == "pairs"]
        if not len(rows):
            return pd.DataFrame(out, columns=["block", "shard", "kind", "body"])
        parts = [unpack(b) for b in rows["body"]]
        lengths = [len(p[0]) for p in parts]
        one, mid, two, learned = (np.concatenate([p[i] for p in parts]) for i in range(4))
        parts = [p[4:] for p in parts]
        (ones, a), (mids, b), (twos, c) = _ranked(one), _ranked(mid), _ranked(two)
        bits_b, bits_c = packed_bits(len(ones), len(mids), len(twos))
        gram, number = _ranked((((a << bits_b) + b) << bits_c) + c)
        del one, mid, two, a, b, c
        n = np.bincount(number, learned, len(gram)).astype(np.int64)
        del learned
        one, mid, two = ones[gram >> bits_c >> bits_b], mids[(gram >> bits_c) & ((1 << bits_b) - 1)], twos[gram & ((1 << bits_c) - 1)]
        with tempfile.TemporaryFile() as file:  # gone when the task is
            known, logp = n > 0, np.empty(len(n))
            model = ShardModel.build(*(x[known] for x in (one, mid, two, n)), totals)
            model.trie.write(file)
            model.trie = Trie.open(file)
            logp[known] = model.learned()
            logp[~known] = model.look_up(*(x[~known] for x in (one, mid, two)))
        shard, at = int(rows["shard"].iloc[0]), 0
        for block, (asked, n_docs, doc, times), size in zip(rows["block"], parts, lengths):
            own = logp[number[at:at + size]]
            at += size
            asked = asked.astype(bool)
            total = np.bincount(doc, np.repeat(own[~asked], n_docs) * times, 1)
            some = np.unique(doc)
            out.append((block, shard, "answers", pack(some, total[some].astype(np.float32), own[asked])))
        return pd.DataFrame(out, columns=["block", "shard", "kind", "body"])
    return score


def _total(rows: pd.DataFrame) -> pd.DataFrame:
    ids, nulls, held, sizes, known, logs, n_docs, doc, times = unpack(rows[rows["kind"] == "docs"]["body"].iloc[0])
    score, asked = np.zeros(len(ids)), []
    for body in rows[rows["kind"] == "answers"].sort_values("shard")["body"]:
        some, total, answers = unpack(body)
        score[some] += total
        asked.append(answers)
    score += np.bincount(doc, np.repeat(np.concatenate(asked), n_docs) * times, len(ids))
    doc_id = pd.array(ids, dtype="Int64")
    doc_id[nulls.astype(bool)] = pd.NA
    return pd.DataFrame({"doc_id": doc_id, "held_out": held.astype(bool), "n_tokens": sizes, "n_known": known, "logs": logs, "score": score})


def _shards(docs: DataFrame, text: str) -> int:
    """Three for every task that runs at once, and more where a shard's part of the text would pass SHARD_CHARS."""
    spark = docs.sparkSession
    parallel = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    return max(3 * parallel, -(-chars // SHARD_CHARS))


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT,
                    block_chars: int = BLOCK_CHARS, shards: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    The model learns from the documents that are not held out: those whose crc32 of the id as text, empty
    for null, does not leave ``held_out`` over ``folds``. Null texts are empty and have one token, their
    end. Without training documents every token has probability 1. Repeated rows count and are
    answered each; no rows give no rows; other columns are not read. Texts are read whole.

    Every three words in a row are counted in the shard of the middle one's hash, with the last one's
    class where the middle is frequent, so no word holds a shard. A block of documents sends each
    distinct triple once, with the documents that have it; those in many of its documents are answered
    back instead. The documents must read the same twice, as stored tables do.
    """
    spark = docs.sparkSession
    shards = shards or _shards(docs, text)
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       (F.crc32(name) % folds == held_out).alias("held_out"))
    found = staged(vocabulary(rows, shards, block_chars))
    totals = Totals([unpack(bytes(r.body)) for r in found.filter("kind = 'sums'").select("body").collect()])

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in read_blocks(frames, shards):
            body = pack(block.tokens, block.sizes, block.held.astype(np.uint8), block.ids, block.nulls.astype(np.uint8))
            yield pd.DataFrame({"shard": [len(block.words)], "block": [block.name], "kind": ["tokens"], "body": [body]})

    sent = (map_blocks(rows, send, MESSAGE, block_chars).groupBy("block")
            .cogroup(found.filter("kind = 'ids'").groupBy("block")).applyInPandas(_assemble(shards, totals), MESSAGE))
    answers = sent.groupBy("shard").applyInPandas(_score(totals), "block string, shard int, kind string, body binary")
    done = answers.groupBy("block").applyInPandas(_total, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double")
    room = float(np.log10(totals.room))
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(totals.tokens)).cast("long").alias("train_tokens"),
                       (F.col("logs") - F.col("n_tokens") * F.lit(room)).alias("base_score"), "score")
