"""Approximate nearest neighbours by shifted Hilbert curves.

Vectors are rotated at random and projected to a few dimensions, once for each ordering and
with a random shift of the grid; their cells' places on a Hilbert curve order them.  Spark
range-partitions all orderings, each ordering is cut into blocks of ``block_rows`` neighbours, and a
query is compared, in double precision, with the blocks around its own in every ordering.  The
best of all blocks are merged and ranked.

How many blocks to each side are looked at is calibrated: for ``SAMPLE`` queries (a bounded
sample, by a hash of the id) the true neighbours are found by comparison with every row, and the
smallest window is taken that holds ``target`` of them.  Where vectors have hardly any structure
to order by, windows so become wide instead of results poor.

Equal vectors are one class and take one place.  A class hands on its ``k + 1`` smallest ids, which
is exact: no query can return more of one class, itself left out.  So a vector that
a third of all rows share is ordered and compared once.

Defined results: vectors that are null, zero, hold null or non-finite components, or differ in
length from ``dimension`` take no part, neither as queries nor as results; null keys likewise.  Ties go to the smaller
id.  With fewer candidates than ``k`` all are returned.  Rows that repeat an id with the same vector
count once; columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackroom.llm.store import stored

CURVES = 8
#: Dimensions and bits for each: a place on a curve has DIMENSIONS * BITS bits.
DIMENSIONS, BITS = 8, 7
BLOCK_ROWS = 1024
#: Queries whose true neighbours calibrate the window.
SAMPLE = 96
SEED = 20240501


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (rows of small non-negative integers) on the Hilbert curve.

    After J. Skilling, "Programming the Hilbert curve" (2004): Gray-code each axis against the
    first, from the highest bit down, then read the bits of all axes in turn.
    """
    axes = [column.astype(np.int64) for column in cells.T]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i, axis in enumerate(axes):
            high = (axis >> bit) & 1 == 1
            swapped = np.where(high, 0, (axes[0] ^ axis) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swapped)
            axes[i] = axes[i] ^ swapped if i else axes[0]
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        turn = np.where((axes[-1] >> bit) & 1 == 1, turn ^ ((1 << bit) - 1), turn)
    place = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << 1) | (((axis ^ turn) >> bit) & 1)
    return place


def _curve_keys(vectors: np.ndarray, curves: int) -> np.ndarray:
    """(rows, curves) places.  Directions count, not lengths, as for normalised vectors."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rng = np.random.default_rng(SEED)
    size = vectors.shape[1]
    out = np.empty((len(vectors), curves), np.int64)
    for c in range(curves):
        axes, _ = np.linalg.qr(rng.normal(size=(size, min(DIMENSIONS, size))))
        # Projections of unit vectors spread like 1/sqrt(size); 3 deviations fill the grid.
        spread = (unit @ axes) * np.sqrt(size) / 3.0
        shifted = (spread + 1.0) / 2.0 * 0.7 + 0.3 * rng.random(axes.shape[1])
        cells = np.clip(np.floor(shifted * (1 << BITS)), 0, (1 << BITS) - 1)
        out[:, c] = hilbert_places(cells, BITS)
    return out


def _matrix(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(-1, size)


def _usable(vector: Column, dimension: int) -> Column:
    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return (
        vector.isNotNull()
        & (F.size(vector) == dimension)
        & ~F.exists(vector, bad)
        & F.exists(vector, lambda x: x != 0)
    )


def _packed(rows: DataFrame) -> DataFrame:
    """Vectors as little-endian doubles, so that tasks read them without copying lists."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("v"))
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            width = 8 * (len(values) // max(1, len(lists)))
            raw = values.tobytes()
            packed = [raw[i : i + width] for i in range(0, len(raw), width)] if width else []
            kept = [batch.column(n) for n in ("id", "query")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(packed, pa.binary())], names=["id", "query", "vector"]
            )

    return rows.select("id", "query", "v").mapInArrow(pack, "id long, query boolean, vector binary")


def _ordered(classes: DataFrame, curves: int, size: int, block_rows: int) -> DataFrame:
    """(curve, block, class, vector): every class in every ordering, blocks numbered in order."""
    fields = "curve int, place long, class long, vector binary"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                keys = _curve_keys(_matrix(batch["vector"], size), curves)
                for c in range(curves):
                    yield pd.DataFrame(
                        {"curve": c, "place": keys[:, c], "class": batch["class"],
                         "vector": batch["vector"]}
                    )

    placed = stored(classes.select("class", "vector").mapInPandas(place, fields), "curve-places")
    ranged = placed.repartitionByRange("curve", "place", "class").sortWithinPartitions(
        "curve", "place", "class"
    )
    # The id holds the partition in its upper bits and the row's number there in the lower 33.
    numbered = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "curve-order")
    part = F.shiftright("at", 33)
    row = F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(part.alias("part")).agg(
        F.ceil((F.max(row) + 1) / block_rows).alias("blocks")
    )
    # One row for each partition of the ordering: a number the session's settings fix.
    first, starts = 0, []
    for part_id, blocks in sorted((r["part"], r["blocks"]) for r in sizes.collect()):
        starts.append((part_id, first))
        first += blocks
    starts = numbered.sparkSession.createDataFrame(starts, "part long, first long")
    return numbered.join(F.broadcast(starts), part == F.col("part")).select(
        "curve", (F.col("first") + F.floor(row / block_rows)).alias("block"), "class", "vector"
    )


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``scores`` the k largest, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    scores, ids = scores[:, order], ids[order]
    top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, top, 1), ids[top]


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products whose value does not depend on how rows are grouped into blocks."""
    out = np.empty((len(queries), len(rows)))
    for i, query in enumerate(queries):
        out[i] = (rows * query).sum(axis=1)
    return out


def _true_blocks(sample: DataFrame, classes: DataFrame, size: int, k: int) -> DataFrame:
    """(query, class): the true nearest classes of the sampled queries."""
    queries = sample.toPandas()
    ids, matrix = queries["class"].to_numpy(), _matrix(queries["vector"], size)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                scores = _products(matrix, _matrix(batch["vector"], size))
                scores[ids[:, None] == batch["class"].to_numpy()[None, :]] = -np.inf
                best, found = _best(scores, batch["class"].to_numpy(), k)
                yield pd.DataFrame(
                    {"query": np.repeat(ids, best.shape[1]), "class": found.ravel(),
                     "score": best.ravel()}
                )

    pairs = classes.select("class", "vector").mapInPandas(
        compare, "query long, class long, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "class"))
    return pairs.filter(F.col("query") != F.col("class")).withColumn("n", rank).filter(
        F.col("n") <= k
    ).select("query", "class")


def _window(ordered: DataFrame, classes: DataFrame, size: int, k: int, target: float) -> int:
    """Blocks to each side that hold ``target`` of the true neighbours of sampled queries."""
    sample = classes.filter("query").orderBy(F.xxhash64("class"), "class").limit(SAMPLE)
    true = _true_blocks(sample.select("class", "vector"), classes, size, k)
    at = ordered.select("curve", "block", "class")
    far = (
        true.join(at, "class")
        .join(
            at.select("curve", F.col("block").alias("own"), F.col("class").alias("query")),
            ["curve", "query"],
        )
        .groupBy("query", "class")
        .agg(F.min(F.abs(F.col("block") - F.col("own"))).alias("far"))
    )
    # At most SAMPLE * k numbers.
    found = sorted(r["far"] for r in far.select("far").collect())
    return int(found[min(len(found) - 1, int(np.ceil(target * len(found))) - 1)]) if found else 0


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    dimension: int | None = None,
    curves: int = CURVES,
    block_rows: int = BLOCK_ROWS,
    target: float = 0.96,
) -> DataFrame:
    """query_id, rank (from 1), key and score (inner product) of the k nearest found.

    ``is_query`` is a condition over the rows of ``vectors``.  ``dimension`` defaults to the most
    frequent length.
    """
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), is_query.alias("query"),
        F.col(vector).cast("array<double>").alias("v"),
    ).filter("id is not null")
    if dimension is None:
        sizes = rows.filter("v is not null").groupBy(F.size("v").alias("n")).count()
        most = sizes.orderBy(F.desc("count"), "n").first()
        dimension = most["n"] if most else 0
    fields = f"query_id long, rank int, {key} long, score double"
    if not dimension:
        return vectors.sparkSession.createDataFrame([], fields)
    rows = rows.filter(_usable(F.col("v"), dimension)).withColumn(
        "query", F.coalesce("query", F.lit(False))
    )
    packed = _packed(rows).withColumns(
        {"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), F.col("vector"))}
    )
    packed = stored(packed, "curve-vectors")
    # The window keeps k + 1 rows of a class in each task before they are shuffled.
    number = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    members = (
        packed.select("id", "h1", "h2").groupBy("id", "h1", "h2").agg(F.lit(0).alias("_"))
        .withColumn("n", number).filter(F.col("n") <= k + 1)
        .groupBy("h1", "h2").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .withColumn("class", F.col("ids")[0])
    )
    members = stored(members, "curve-classes")
    asked = stored(
        packed.filter("query").select("id", "h1", "h2").distinct()
        .join(members.select("h1", "h2", "class"), ["h1", "h2"]).select("id", "class"),
        "curve-queries",
    )
    first = members.select(F.col("class").alias("id"), "class")
    used = asked.select("class").distinct().withColumn("asked", F.lit(True))
    classes = stored(
        packed.dropDuplicates(["id"]).join(first, "id").join(used, "class", "left")
        .select("class", "vector", F.coalesce("asked", F.lit(False)).alias("query")),
        "curve-representatives",
    )
    ordered = stored(_ordered(classes, curves, dimension, block_rows), "curve-blocks")
    window = _window(ordered, classes, dimension, k, target)

    around = F.sequence(F.col("block") - window, F.col("block") + window)
    probes = (
        ordered.join(classes.filter("query").select("class"), "class")
        .select(
            F.col("curve").alias("curve"), F.explode(around).alias("block"),
            F.col("class").alias("probe"), F.col("vector").alias("vector"),
        )
    )

    def compare(keys, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"probe": [], "classes": [], "scores": []}
        if len(left) and len(right):
            found, ids = _matrix(right["vector"], dimension), right["class"].to_numpy()
            for i in range(0, len(left), 256):
                some = left.iloc[i : i + 256]
                best, near = _best(_products(_matrix(some["vector"], dimension), found), ids, k + 1)
                out["probe"] += some["probe"].tolist()
                out["classes"] += list(near)
                out["scores"] += list(best)
        return pd.DataFrame({name: pd.Series(column, dtype=object) for name, column in out.items()})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        classes, at = np.unique(np.concatenate(list(group["classes"])), return_index=True)
        best, near = _best(np.concatenate(list(group["scores"]))[at][None, :], classes, k + 1)
        return pd.DataFrame({"probe": group["probe"].iloc[0], "class": near[0], "score": best[0]})

    # A block holds ``block_rows`` classes and meets the probes of a window of such blocks.
    blocks = ordered.select(
        *[F.col(name).alias(name) for name in ("curve", "block", "class", "vector")]
    )
    pairs = (
        probes.groupBy("curve", "block").cogroup(blocks.groupBy("curve", "block"))
        .applyInPandas(compare, "probe long, classes array<long>, scores array<double>")
    )
    # The class itself stays in: its other members are neighbours of a query.
    near = pairs.groupBy("probe").applyInPandas(merge, "probe long, class long, score double")
    lists = (
        near.join(members.select("class", "ids"), "class")
        .groupBy("probe").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    )
    expanded = F.flatten(
        F.transform("found", lambda f: F.transform(
            f["ids"], lambda i: F.struct((-f["score"]).alias("minus"), i.alias("id"))
        ))
    )
    others = F.filter(F.array_sort(expanded), lambda p: p["id"] != F.col("id"))
    return (
        asked.join(lists, asked["class"] == lists["probe"])
        .select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)))
        .select(
            "query_id", (F.col("pos") + 1).cast("int").alias("rank"),
            F.col("col.id").alias(key), (-F.col("col.minus")).alias("score"),
        )
    )
