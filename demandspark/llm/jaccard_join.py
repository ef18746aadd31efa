"""Exact Jaccard join of documents in the metric space of their shingle sets, by pivots and their regions."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from demandspark.llm.blocks import BLOCK_CHARS, Places, map_blocks
from demandspark.llm.common import components
from demandspark.session import staged

#: Words in a shingle, and the link: PERCENT * union <= 100 * intersection.
SHINGLE = 5
PERCENT = 80
#: Minimum hashes under which documents meet candidates for their pivot.
MEETINGS = 12
#: Levels of pivots, and the share of what is left that a level must settle for another to follow; what no pivot
#: holds then becomes a pivot itself.
LEVELS = 12
LEVEL_SHARE = 0.05
#: A block has fewer documents than a 16-bit number can tell apart, and one marks keys the block itself repeats.
BLOCK_DOCS = 60_000
REPEATED = 65_535
#: Words whose hashes a task keeps; a bound on memory, not on results.
KEPT_WORDS = 200_000
#: Bits of a key beyond those that tell all shingles apart, so that few keys meet by chance.
SPARE_BITS = 5
SHINGLES_PER_DOC = 512


class Shingler:
    """Shingle sets of whole texts as sorted 64-bit hashes; the hash of a distinct word is kept."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.place, self.hash = Places(), []

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """A-Z lower-cased, words cut at white space; fewer words than a shingle are one shingle of all."""
        if len(self.place) > KEPT_WORDS:
            self.place, self.hash = Places(), []
        docs = []
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").lower().split()
            docs.append(np.fromiter(map(self.place.__getitem__, words), np.int64, len(words)))
        self.hash += map(xxh64_intdigest, list(self.place)[len(self.hash):])
        code = np.array(self.hash, np.uint64)
        return [self._shingles(code[doc]) for doc in docs]

    def _shingles(self, words: np.ndarray) -> np.ndarray:
        if not len(words):
            return np.zeros(0, np.uint64)
        width = min(self.size, len(words))
        n = len(words) - width + 1
        h = np.full(n, width, np.uint64)
        for k in range(width):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[k:n + k]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return np.unique(h)


def digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _planes(x: np.ndarray) -> bytes:
    """Ascending integers as byte planes of their differences, of which compression removes the empty ones."""
    return np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").reshape(-1), dtype=np.uint64)


SENT = "shard int, block string, kind string, keys binary, docs binary, ids array<long>, nulls array<boolean>, sizes array<int>, digests array<binary>"
MET = "block string, shared binary, ids array<long>, nulls array<boolean>, sizes array<int>, digests array<binary>"
DOCS = "doc_id long, n_shingles int, digest binary, shared int"


def shared_counts(docs: DataFrame, bits: int, shards: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """For every document the size and digest of its set, and how many of its shingles another has too.

    A block of documents sends each of its keys, a shingle's first ``bits``, once to the key's shard:
    with the document's number, or marked when several of the block have it. So a shingle that all
    documents share costs one entry per block. A shard answers with the documents whose keys it
    met twice. Keys that meet by chance only raise counts.
    """
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, number = Shingler(), 0
        for rows in frames:
            for at in range(0, len(rows), BLOCK_DOCS):
                part = rows.iloc[at:at + BLOCK_DOCS]
                # A repeated task must give its blocks the same names, as others may have read the first ones.
                name, number = f"{TaskContext.get().partitionId()}-{number}", number + 1
                home = crc32(name.encode()) % shards
                sets = shingler.sets(part["text"].tolist())
                sizes = [len(s) for s in sets]
                yield pd.DataFrame({"shard": [home], "block": [name], "kind": ["docs"], "keys": [b""], "docs": [b""],
                                    "ids": [part["doc_id"].fillna(0).astype(np.int64).to_numpy()], "nulls": [part["doc_id"].isna().to_numpy()],
                                    "sizes": [sizes], "digests": [[digest(s) for s in sets]]})
                key = np.concatenate(sets) >> np.uint64(64 - bits)
                doc = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
                by = np.argsort(key, kind="stable")
                key, doc = key[by], doc[by]
                twice = np.zeros(len(key), bool)
                twice[1:] = key[1:] == key[:-1]
                many = twice.copy()
                many[:-1] |= twice[1:]
                # What the block repeats is known here; the answer is sent the way all answers go.
                own = doc[many]
                keep = ~twice
                key, doc = key[keep], np.where(many, REPEATED, doc)[keep].astype("<u2")
                edges = np.searchsorted(key, [math.ceil(s * 2 ** bits / shards) for s in range(shards)] + [2 ** bits], side="left")
                out = [(s, name, "keys", _planes(key[a:b]), doc[a:b].tobytes()) for s, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                out.append((home, name, "own", b"", own.astype("<u2").tobytes()))
                frame = pd.DataFrame(out, columns=["shard", "block", "kind", "keys", "docs"])
                yield frame.assign(ids=None, nulls=None, sizes=None, digests=None)

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        kept = rows[rows["kind"] != "keys"]
        out = [(r.block, r.docs, r.ids, r.nulls, r.sizes, r.digests) for r in kept.itertuples(index=False)]
        sent = rows[rows["kind"] == "keys"]
        if len(sent):
            keys = [_from_planes(k) for k in sent["keys"]]
            doc = np.concatenate([np.frombuffer(d, "<u2") for d in sent["docs"]])
            of = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            key = np.concatenate(keys)
            by = np.argsort(key, kind="stable")
            key = key[by]
            same = np.zeros(len(key), bool)
            same[1:] = key[1:] == key[:-1]
            same[:-1] |= same[1:].copy()
            hit = by[same]
            hit = np.sort(hit[doc[hit] != REPEATED])
            for i, part in zip(*_runs(of[hit], doc[hit])):
                out.append((sent["block"].iloc[i], part.tobytes(), None, None, None, None))
        return pd.DataFrame(out, columns=["block", "shared", "ids", "nulls", "sizes", "digests"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        listed = rows[rows["ids"].notna()].iloc[0]
        count = sum(np.bincount(np.frombuffer(s, "<u2"), minlength=len(listed["ids"])) for s in rows["shared"])
        ids = pd.array(np.asarray(listed["ids"], np.int64), dtype="Int64")
        ids[np.asarray(listed["nulls"], bool)] = pd.NA
        return pd.DataFrame({"doc_id": ids, "n_shingles": np.asarray(listed["sizes"], np.int32), "digest": list(listed["digests"]),
                             "shared": count.astype(np.int32)})

    return (map_blocks(docs, send, SENT, block_chars).groupBy("shard").applyInPandas(meet, MET).groupBy("block").applyInPandas(total, DOCS))


def _runs(group: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(group):
        return [], []
    cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
    return group[np.concatenate([[0], cuts])].tolist(), np.split(values, cuts)


def _class_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The set of one document of each class."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for rows in frames:
            sets = shingler.sets(rows["text"].tolist())
            right = [digest(s) == bytes(d) for s, d in zip(sets, rows["digest"])]  # an id may have other rows
            yield pd.DataFrame({"digest": rows["digest"][right], "n": rows["n"][right], "grams": [s.astype(np.int64) for s, r in zip(sets, right) if r]})

    texts = docs.join(classes, F.col("doc_id").eqNullSafe(F.col("first_id"))).select("text", "digest", "n")
    return map_blocks(texts, read, "digest binary, n int, grams array<long>").dropDuplicates(["digest"])


def _prepare(window: int):
    """Minimum hashes, the prefix for the window, and the set in order of its hashes, of each ordered set."""
    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd = np.arange(MEETINGS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C16) + np.uint64(0xD1B54A32D192ED03)
        for rows in batches:
            meet, prefix, grams = [], [], []
            for n, ordered in zip(rows["n"], rows["grams"]):
                g = np.asarray(ordered, np.int64)
                mixed = g.view(np.uint64)[None, :] * odd[:, None]
                mixed ^= mixed >> np.uint64(31)
                mixed *= np.uint64(0x94D049BB133111EB)
                meet.append(mixed.min(axis=1).view(np.int64))
                # Shingles that no other set has come first in the order and are not in g.
                prefix.append(g[:max(0, n - -(-window * n // 100) + 1 - (n - len(g)))])
                grams.append(np.sort(g).tobytes())
            alone = rows["n"] - rows["grams"].str.len()
            yield pd.DataFrame({"sid": rows["sid"], "n": rows["n"], "alone": alone, "apart": alone / rows["n"], "meet": meet, "prefix": prefix,
                                "grams": grams})
    return prepare


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, common, either``: sizes of intersection and union of the sets of each pair."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            common, last, of_b = [], None, None
            for b, x, y in zip(rows["b"], rows["grams_a"], rows["grams_b"]):
                if b != last:
                    last, of_b = b, np.frombuffer(y, np.int64)
                x = np.frombuffer(x, np.int64)
                at = np.searchsorted(of_b, x)
                at[at == len(of_b)] = 0
                common.append(int((of_b[at] == x).sum()) if len(of_b) else 0)
            common = np.array(common, np.int64)
            yield pd.DataFrame({"a": rows["a"], "b": rows["b"], "common": common, "either": rows["n_a"] + rows["n_b"] - common})

    one = sets.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    two = sets.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    return pairs.join(one, "a").join(two, "b").mapInPandas(count, "a long, b long, common long, either long")


def pivots(sets: DataFrame, percent: int = PERCENT, levels: int = LEVELS) -> DataFrame:
    """``sid, home, d, common``: the pivot whose region holds each set, at a distance that is a link, or itself at 0.

    Sets meet where they share a minimum hash. On each level the sets that come first in all their
    meetings are the pivots; first is what has the largest share of its shingles in other sets, as the
    middle of a group of copies has. Sets linked to a pivot they meet join the nearest one's region,
    and the rest goes to the next level. A dense group so has few pivots however large it is.
    """
    active = sets.select("sid", "apart", "meet")
    done = None
    for _ in range(levels):
        met = active.select("sid", F.struct("apart", "sid").alias("rank"), F.posexplode("meet").alias("k", "value"))
        first = met.groupBy("k", "value").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
        behind = staged(met.join(first, ["k", "value"]).filter("first.sid <> sid").select("sid", F.col("first.sid").alias("first")).distinct())
        chosen = active.select("sid").join(behind.select("sid").distinct(), "sid", "left_anti")
        near = behind.join(chosen.select(F.col("sid").alias("first")), "first").select(F.col("sid").alias("a"), F.col("first").alias("b"))
        linked = (_overlaps(near, sets).filter(F.col("common") * 100 >= F.col("either") * percent)
                  .groupBy("a").agg(F.min(F.struct((1 - F.col("common") / F.col("either")).alias("d"), F.col("b").alias("home"), "common")).alias("best"))
                  .select(F.col("a").alias("sid"), "best.home", "best.d", "best.common"))
        found = staged(linked.unionByName(chosen.select("sid", F.col("sid").alias("home"), F.lit(0.0).alias("d"), F.lit(None).cast("long").alias("common"))))
        done = found if done is None else done.unionByName(found)
        active = staged(active.join(found.select("sid"), "sid", "left_anti"))
        left, settled = active.count(), found.count()
        if not left:
            return done
        if settled < LEVEL_SHARE * (left + settled):
            break
    return done.unionByName(active.select("sid", F.col("sid").alias("home"), F.lit(0.0).alias("d"), F.lit(None).cast("long").alias("common")))


def _candidates(sets: DataFrame, heads: DataFrame) -> DataFrame:
    """Pairs that hold every set and pivot within the pivot's window, ``t`` as a similarity, and few others.

    Shingles are in one order for all sets, the rarest first. Two sets as similar as t share one of
    the first n - ceil(t n) + 1 of both, and behind the first one they share, both still have what
    the overlap needs.
    """
    rows = sets.select("sid", "n", F.posexplode("prefix").alias("at", "g"), "alone").withColumn("at", F.col("at") + F.col("alone")).drop("alone")
    centres = (rows.join(heads, rows.sid == heads.home).filter(F.col("at") <= F.col("n") - F.ceil(F.col("t") * F.col("n")))
               .select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), "g", "t"))
    t, n, n_b = F.col("t"), F.col("n"), F.col("n_b")
    met = rows.join(centres, "g").filter(
        (F.col("sid") != F.col("b")) & (n >= t * n_b) & (n_b >= t * n) & (F.col("at") <= n - F.ceil(t * n))
        & (F.least(n - F.col("at"), n_b - F.col("at_b")) >= t / (1 + t) * (n + n_b)))
    return met.select(F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b")).distinct()


def links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b``: links between sets that connect all that are linked, directly or over others.

    Let r be the largest distance of a link. What links to a set of pivot p's region, at a distance d
    from p, lies within d + r of p: a window of the region's radius plus r, joined exactly, gives each
    region the boundary sets of others. What lies within r of p is linked to p, hence connected to all
    of its region. A boundary set beyond r is compared with the region's sets unless the links so far
    connect them, and only where the distances to p differ by r at most.
    """
    reach = (100 - percent) / 100 + 1e-9
    regions = staged(pivots(sets, percent))
    heads = staged(regions.groupBy("home").agg(F.max("d").alias("radius"))
                   .select("home", "radius", F.greatest(F.lit(0.0), 1 - reach - F.col("radius") - 1e-9).alias("t")))
    seen = staged(_overlaps(_candidates(sets, heads), sets))
    link = F.col("common") * 100 >= F.col("either") * percent
    stars = staged(seen.filter(link).select("a", "b").unionByName(regions.filter("sid <> home").select(F.col("sid").alias("a"), F.col("home").alias("b"))))
    part = components(stars)
    edge = seen.filter(~link).withColumn("d_p", 1 - F.col("common") / F.col("either"))
    wide = heads.filter("radius > 0").select(F.col("home").alias("p"), "radius")
    both = (edge.select("a", F.col("b").alias("p"), "d_p", "common").unionByName(edge.select(F.col("b").alias("a"), F.col("a").alias("p"), "d_p", "common"))
            .join(wide, "p").filter(F.col("d_p") <= F.col("radius") + reach))
    mine = part.select(F.col("id").alias("a"), F.col("component_id").alias("of_a"))
    theirs = part.select(F.col("id").alias("p"), F.col("component_id").alias("of_p"))
    size = sets.select("sid", "n", "alone")
    outer = (both.join(mine, "a", "left").join(theirs, "p", "left").filter(F.coalesce("of_a", "a") != F.coalesce("of_p", "p"))
             .join(size, F.col("a") == F.col("sid")).select("a", "p", "d_p", F.col("n").alias("n_a"), F.col("common").alias("in_a"),
                                                            (F.col("n") - F.col("common") - F.col("alone")).alias("out_a")))
    inner = regions.filter("sid <> home").join(size, "sid").select(
        F.col("sid").alias("x"), F.col("home").alias("p"), "d", F.col("n").alias("n_x"), F.col("common").alias("in_x"),
        (F.col("n") - F.col("common") - F.col("alone")).alias("out_x"))
    # What two sets share lies in the pivot, as far as each does, or outside it among what others have too.
    most = F.least("in_a", "in_x") + F.least("out_a", "out_x")
    pairs = outer.join(inner, "p").filter(
        (F.col("d_p") - F.col("d") <= reach) & (F.col("x") != F.col("a"))
        & (most * (100 + percent) >= (F.col("n_a") + F.col("n_x")) * percent)).select(
        F.least("a", "x").alias("a"), F.greatest("a", "x").alias("b")).distinct()
    return stars.unionByName(_overlaps(pairs, sets).filter(link).select("a", "b"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text",
                       block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    A document's set holds the shingles of its whole text; two documents link when their sets' Jaccard
    similarity reaches ``percent`` (more than 50), and a component is named by its smallest id. Texts that
    are null or without words have no shingle, link with nothing and are their own component. Equal
    sets are compared once. Repeated rows get the same answer each; a null id names no component that
    has another. No rows give no rows; other columns are not read. Shingles are told apart by 64 bits.

    First each document learns how many of its shingles any other has. Below ``percent`` of them it
    cannot link, which settles all but the copies; only their sets are joined.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spark = docs.sparkSession
    bits = min(64, max(24, math.ceil(math.log2(max(1, docs.count()) * SHINGLES_PER_DOC)) + SPARE_BITS))
    shards = 2 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = staged(shared_counts(docs, bits, shards, block_chars))
    able = known.filter((F.col("n_shingles") > 0) & (F.col("shared").cast("long") * 100 >= F.col("n_shingles").cast("long") * percent))
    classes = staged(able.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n")))
    sets = staged(_class_sets(docs, classes).withColumn("sid", F.monotonically_increasing_id()))
    # Within the classes a shingle counts once per class; again, too few shared ones rule links out.
    rows = sets.select("sid", "n", F.explode("grams").alias("g"))
    often = rows.groupBy("g").agg(F.count("*").alias("f")).filter("f > 1")
    ordered = (rows.join(often, "g").groupBy("sid", "n").agg(F.sort_array(F.collect_list(F.struct("f", "g"))).alias("o"))
               .filter(F.size("o") * 100 >= F.col("n") * percent).select("sid", "n", F.col("o.g").alias("grams")))
    ready = staged(ordered.mapInPandas(_prepare(max(0, 2 * percent - 100)),
                                       "sid long, n int, alone int, apart double, meet array<long>, prefix array<long>, grams binary"))
    part = components(links(ready, percent))
    named = sets.select("sid", "digest").join(classes.select("digest", "first_id"), "digest").join(part, F.col("sid") == F.col("id"), "left")
    named = named.withColumn("part", F.coalesce("component_id", "sid"))
    lowest = named.groupBy("part").agg(F.min("first_id").alias("lowest"))
    answer = named.join(lowest, "part").select("digest", "lowest")
    return (known.join(answer, "digest", "left")
            .select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.coalesce("lowest", "doc_id").alias("component_id")))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows whose id names their component, with all their columns; rows without id stay."""
    answer = jaccard_components(docs, percent).filter("doc_id = component_id").select(F.col("doc_id").alias("_stays")).distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"))
    return rows.filter("id is null").unionByName(rows.join(answer, F.col("id") == F.col("_stays"), "left_semi")).select("doc.*")


def one_of_each_group(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns, whatever ids repeat or are null.

    Rows are numbered in a stored table and linked by that number. The smallest id stays, one that is null only
    where the component has no other; of rows with that id the one whose text has the smallest digest.
    """
    order = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.md5(F.coalesce(F.col(text), F.lit(""))))
    rows = staged(docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"), order.alias("order"))
                  .withColumn("row", F.monotonically_increasing_id()))
    answer = jaccard_components(rows, percent, "row", "text").select(F.col("doc_id").alias("of"), "component_id")
    first = (rows.select("order", "row").join(answer, F.col("row") == F.col("of"))
             .groupBy("component_id").agg(F.min(F.struct("order", "row")).alias("first")))
    return rows.select("doc", "row").join(first.select(F.col("first.row").alias("stays")), F.col("row") == F.col("stays"), "left_semi").select("doc.*")
