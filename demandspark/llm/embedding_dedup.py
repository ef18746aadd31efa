"""Near-duplicate vectors by PCA-ordered tiles with suffix-norm bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import components
from demandspark.session import staged

THRESHOLD = 0.93
#: Vectors in a tile, leading dimensions added in one step, vectors that fit the rotation.
TILE_ROWS = 1024
STEP = 16
PCA_SAMPLE = 10_000
#: Room for rounding where a bound decides; what passes it is compared in full.
SLACK = 1e-9
#: Width of the cells of the first coordinate by which tiles meet.
CELL = 0.25

TILE = "label string, dim int, tile string, low double, high double, ids binary, weights binary, matrix binary"
FOUND = "kind string, a long, b long, n long"


def usable(embedding: str) -> F.Column:
    """Neither null, empty nor zero, and all components finite numbers."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def rotations(classes: DataFrame, sample: int = PCA_SAMPLE) -> dict[int, np.ndarray]:
    """Principal axes for each dimension, from at most ``sample`` unit vectors picked by hash.

    The axes only decide how early a comparison stops, never its result.
    """
    picked = classes.select("dim", "vector", F.xxhash64("vector").alias("h")).orderBy("h").limit(sample).toPandas()
    axes = {}
    for dim, rows in picked.groupby("dim"):
        x = unit(np.array(rows["vector"].tolist(), dtype=float))
        axes[int(dim)] = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    return axes


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest part first, so that squares stay in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _rotated(x: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    return x @ axes[x.shape[1]] if x.shape[1] in axes else x


def close_pairs(a: np.ndarray, b: np.ndarray, axes: dict[int, np.ndarray], threshold: float = THRESHOLD, step: int = STEP) -> np.ndarray:
    """Boolean matrix of pairs with cosine at or above the threshold.

    Products are summed over the leading principal dimensions; what the remaining ones can add is at
    most the product of the two suffix norms. Rows and columns without a pair that can still reach the
    threshold leave, and the sum stops when none is left. Surviving pairs are decided by the cosine of
    the given components.
    """
    linked = np.zeros((len(a), len(b)), dtype=bool)
    ra, rb = _rotated(a, axes), _rotated(b, axes)
    sa, sb = (np.sqrt(np.maximum(np.cumsum(r[:, ::-1] ** 2, axis=1)[:, ::-1], 0)) for r in (ra, rb))
    rows, cols, dim = np.arange(len(a)), np.arange(len(b)), a.shape[1]
    total = np.zeros((len(a), len(b)))
    for at in range(0, dim, step):
        total += ra[rows, at:at + step] @ rb[cols, at:at + step].T
        nxt = at + step
        bound = total + np.outer(sa[rows, nxt], sb[cols, nxt]) if nxt < dim else total
        alive = bound >= threshold - SLACK
        keep_r, keep_c = alive.any(axis=1), alive.any(axis=0)
        if not keep_r.any():
            return linked
        if not (keep_r.all() and keep_c.all()):
            rows, cols, total = rows[keep_r], cols[keep_c], total[np.ix_(keep_r, keep_c)]
    i, j = np.nonzero(total >= threshold - SLACK)
    i, j = rows[i], cols[j]
    for lo in range(0, len(i), 65_536):
        p, q = i[lo:lo + 65_536], j[lo:lo + 65_536]
        linked[p, q] = np.einsum("ij,ij->i", a[p], b[q]) >= threshold
    return linked


def tiles(classes: DataFrame, axes: dict[int, np.ndarray], tile_rows: int = TILE_ROWS) -> DataFrame:
    """Vectors of one label and dimension, ordered by the first principal coordinate and cut into tiles."""
    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows["at"] = 0.0
            for dim, part in rows.groupby("dim"):
                x = unit(np.array(part["vector"].tolist(), dtype=float))
                rows.loc[part.index, "at"] = _rotated(x, axes)[:, 0]
            yield rows

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from uuid import uuid4

        def tile(rows: pd.DataFrame) -> dict:
            matrix = np.array(rows["vector"].tolist(), dtype=float)
            return {"label": rows["label"].iloc[0], "dim": rows["dim"].iloc[0], "tile": uuid4().hex, "low": rows["at"].min(),
                    "high": rows["at"].max(), "ids": rows["id"].to_numpy(np.int64).tobytes(),
                    "weights": rows["weight"].to_numpy(np.int64).tobytes(), "matrix": matrix.tobytes()}

        rest = None
        for rows in batches:
            rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
            rest, made = None, []
            for _, part in rows.groupby(["label", "dim"], sort=False):
                whole = [part.iloc[i:i + tile_rows] for i in range(0, len(part), tile_rows)]
                if part.index[-1] == len(rows) - 1:  # the next batch may go on with it
                    rest = whole.pop()
                made += map(tile, whole)
            if made:
                yield pd.DataFrame(made)
        if rest is not None and len(rest):
            yield pd.DataFrame([tile(rest)])

    placed = classes.mapInPandas(first, "label string, dim int, id long, weight long, vector array<double>, at double")
    spark = classes.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartitionByRange(tasks, "label", "dim", "at").sortWithinPartitions("label", "dim", "at").mapInPandas(cut, TILE)


def _compare(axes: dict[int, np.ndarray], threshold: float):
    def labels(linked: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Smallest position in each component of the tile pair; rows first, then columns."""
        n, m = linked.shape
        left, right = np.arange(n), np.arange(m) + (0 if same else n)
        while True:
            low = np.where(linked, left[:, None], n + m).min(axis=0, initial=n + m)
            new_right = np.minimum(right, low)
            new_left = np.minimum(left, np.where(linked, new_right[None, :], n + m).min(axis=1, initial=n + m))
            if same:
                new_left = new_right = np.minimum(new_left, new_right)
            if (new_left == left).all() and (new_right == right).all():
                return left, right
            left, right = new_left, new_right

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples(index=False):
                same = r.tile == r.other_tile
                ids_a, ids_b = np.frombuffer(r.ids, np.int64), np.frombuffer(r.other_ids, np.int64)
                wa, wb = np.frombuffer(r.weights, np.int64), np.frombuffer(r.other_weights, np.int64)
                a = unit(np.frombuffer(r.matrix).reshape(len(ids_a), -1))
                b = a if same else unit(np.frombuffer(r.other_matrix).reshape(len(ids_b), -1))
                linked = close_pairs(a, b, axes, threshold)
                if same:
                    linked |= linked.T
                    np.fill_diagonal(linked, False)
                if not linked.any():
                    continue
                parts = [("links", ids_a, ids_a, linked @ wb)] + ([] if same else [("links", ids_b, ids_b, wa @ linked)])
                everyone = ids_a if same else np.concatenate([ids_a, ids_b])
                left, right = labels(linked, same)
                parts += [("edge", ids, everyone[low], low) for ids, low in ((ids_a, left),) + (() if same else ((ids_b, right),))]
                for kind, one, two, n in parts:
                    keep = n > 0 if kind == "links" else one != two
                    if keep.any():
                        yield pd.DataFrame({"kind": kind, "a": one[keep], "b": two[keep], "n": n[keep]})
    return compare


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS, vec_id: str = "vec_id",
                    embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors of one label, not null, and one dimension link when their cosine in double precision
    reaches ``threshold``. Null, empty or zero vectors, and those with null or infinite parts or parts
    that are no number, link with nothing and stay. Equal vectors of one label are compared once and
    weighted by their number; repeated rows count as vectors. Null ids, as any id, get the answer of
    their vector but do not name a component unless all of it is null. No rows give no rows.

    Unit vectors that reach the threshold differ by sqrt(2 - 2 threshold) at most in every coordinate,
    so tiles meet only where their ranges of the first principal coordinate come that near. A pair of
    tiles is one bounded task: it returns sums per vector and a spanning set of links, never the pairs.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.col(embedding).cast("array<double>").alias("vector"))
    good = rows.filter(usable("vector") & F.col("label").isNotNull()).withColumn("vector", F.transform("vector", lambda x: x + 0.0))
    classes = staged(good.groupBy("label", "vector")
                     .agg(F.min("vec_id").alias("vec"), F.count("*").alias("weight"))
                     .select("label", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("id"), "weight", "vector", "vec"))
    shape = classes.select("label", "dim", "id", "weight", "vector")
    axes = rotations(shape)
    cut = staged(tiles(shape, axes, tile_rows))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    where = cut.select("label", "dim", "tile", "low", "high")
    cell = lambda x: F.floor(x / CELL)
    home = where.withColumn("cell", cell(F.col("low")))
    wide = where.select("label", "dim", F.col("tile").alias("other_tile"), F.col("low").alias("other_low"), F.col("high").alias("other_high"),
                        F.explode(F.sequence(cell(F.col("low") - reach), cell(F.col("high") + reach))).alias("cell"))
    # A pair is kept where the tile that starts later has its start; the earlier one reaches there.
    later = (F.col("other_low") < F.col("low")) | ((F.col("other_low") == F.col("low")) & (F.col("other_tile") <= F.col("tile")))
    pairs = home.join(wide, ["label", "dim", "cell"]).filter(later & (F.col("low") <= F.col("other_high") + reach)).select("tile", "other_tile")
    mine = cut.select("tile", "ids", "weights", "matrix")
    other = mine.toDF("other_tile", "other_ids", "other_weights", "other_matrix")
    found = staged(pairs.join(mine, "tile").join(other, "other_tile").mapInPandas(_compare(axes, threshold), FOUND))
    links = found.filter("kind = 'links'").groupBy("a").agg(F.sum("n").alias("n"))
    parts = components(found.filter("kind = 'edge'"))
    own = classes.select("id", "weight", "vec")
    joined = own.join(parts, "id", "left").withColumn("part", F.coalesce("component_id", "id"))
    lowest = joined.groupBy("part").agg(F.min("vec").alias("lowest"))
    known = (joined.join(lowest, "part").join(links, joined.id == links.a, "left")
             .select("id", "lowest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    named = classes.select(F.col("label").alias("_label"), F.col("vector").alias("_vector"), "id").join(known, "id")
    vector = F.transform("vector", lambda x: x + 0.0)
    return (rows.join(named, (rows.label == named._label) & (vector == named._vector), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("id").isNull(), F.col("vec_id")).otherwise(F.col("lowest")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
