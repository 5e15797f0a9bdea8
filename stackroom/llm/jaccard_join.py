"""Near duplicates: exact Jaccard join of word shingles by prefix trees.

Two documents link when the Jaccard similarity of their sets of word shingles is ``percent`` or
more.  The result is exact; no link between different texts is lost.

1. Documents with equal sets are one class.  Every task also counts its shingles in
   a sketch of fixed size, and the sums of all tasks give each shingle a level, the logarithm of
   how often it occurs.  Shingles are ordered by level, then by hash: rare ones first.
2. Of sets of sizes n that link, the first n - ceil(n * percent) + k in that order share k.
   Those entries (shingle, class, size) meet in buckets of the hash, packed as arrays.  The classes of a
   *list* share a first shingle.  Of lists of up to ``SMALL`` classes a bucket hands on the pairs whose sizes
   allow a link, of others each class with the smallest one, the list's head.  Spark counts how many lists show each.
   With k a tenth of n, what shares fewer first shingles than k cannot link and is left out: classes, pairs, and
   of a class's heads the weakest ones that hold less than half of k together.
3. Classes connected by pairs or heads are a *piece*: links are within pieces.  A task takes the texts of one piece, and
   links its classes by a prefix tree of their sets: first what links with one class, then what
   links with those, and so on, always held against classes that nothing links yet.
4. What a task holds and compares is bounded.  A larger piece is taken apart into the pieces of each head, which
   hold all that share a list; a head's piece that is too large still is dealt into blocks,
   the head in each.  Then all classes outside of the largest component so far are held against all blocks.
   So no pairs of classes are written down or joined, only links that hold.
5. The prefix tree holds sets in an order of its own, frequent elements first.  A probe walks it once; sets
   with a common beginning share the overlap counted so far.  Another pass takes the texts of pieces
   from one document of each class; a bitmap of fixed size tells which to look at.

Defined results: a null or empty text has an empty set and links with nothing; a text of fewer words than a
shingle has one shingle of all its words; texts are used whole; repeated documents are one class and
link; a row with a null key is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackroom.llm.components import components
from stackroom.llm.store import stored
from stackroom.llm.words import shingle_sets, utf8, values

#: Cells of the sketch that orders shingles: a fixed size, sent to every task.
SKETCH_BITS = 20
#: Bits of the bitmap of texts whose sets are needed: a fixed size, sent to every task.
NEEDED_BITS = 26
#: Shingle entries that a bucket holds on average.
BUCKET_ENTRIES = 200_000
#: Classes of a list that is handed on as pairs: six at most.
SMALL = 4
#: Shingles of the sets that a task holds at a time.
HELD = 2_000_000
#: Shingles times sets: what a task compares at most.
COMPARED = 4_000_000_000
WORDS = 5


def needed_overlap(a: int, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of sets of sizes a and b whose similarity suffices."""
    return -(-percent * (a + b) // (100 + percent))


def first_shingles(size: int, percent: int) -> int:
    """How many first elements of a set hold ``size // 10 + 1`` of any larger set that links."""
    return min(size, size + percent * size // -100 + size // 10 + 1)


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _in_order(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes in the global order: rare ones first."""
    return hashes[np.argsort(levels[_cell(hashes)], kind="stable")]


def _class_of(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    yield from zip(values(batch, "key"), shingle_sets(utf8(batch, "text"), n), strict=True)


def _classes(rows: DataFrame, n: int) -> DataFrame:
    """(key, size, class) of every document, and rows (cell, counts) of every task's sketch."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        seen: set[int] = set()
        names = ["key", "size", "class", "cell", "counts"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            keys, sizes, classes = [], [], []
            for key, hashes in _sets(batch, n):
                name = _class_of(hashes)
                keys.append(key)
                sizes.append(len(hashes))
                classes.append(name)
                if name not in seen:
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(name)
                    np.add.at(counts, _cell(hashes), 1)
            none = [None] * len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip([keys, sizes, classes, none, none], types, strict=True)],
                names=names,
            )
        if seen:
            # 64 rows of counts up to 255, which tell rare shingles from common ones well enough.
            small = np.minimum(counts, 255).astype(np.uint8).reshape(64, -1)
            none = [None] * 64
            parts = [row.tobytes() for row in small]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip([none, none, none, range(64), parts], types, strict=True)],
                names=names,
            )

    return rows.mapInArrow(read, "key long, size long, class long, cell int, counts binary")


def _levels(sketches: DataFrame) -> np.ndarray:
    """Level of each cell: the logarithm of its count.  Fixed size: 2^SKETCH_BITS bytes."""

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, counts in zip(batch["cell"], batch["counts"], strict=True):
                got = np.frombuffer(counts, np.uint8 if len(counts) == width else np.int64)
                sums[cell] = sums.get(cell, 0) + got.astype(np.int64)
        if sums:
            yield pd.DataFrame({"cell": list(sums), "counts": [s.tobytes() for s in sums.values()]})

    width = (1 << SKETCH_BITS) // 64
    fields = "cell int, counts binary"
    # Sums of each task, then of each cell: 64 rows come to the driver.
    summed = sketches.mapInPandas(total, fields).repartition(16, "cell").mapInPandas(total, fields)
    counts = np.zeros((64, width), np.int64)
    for row in summed.collect():
        counts[row["cell"]] = np.frombuffer(row["counts"], np.int64)
    return np.ceil(np.log2(counts.reshape(-1) + 1)).astype(np.uint8)


def _shown(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(class, head, pair, size, head_size) of a bucket's lists, each list's by itself.

    Spark counts them, for all buckets of a task at once: a list gives the same rows in however many buckets.
    Pairs whose sizes rule out a link are left out.
    """
    hashes = np.concatenate([np.frombuffer(x, np.uint32) for x in group["hashes"]])
    names = np.concatenate([np.frombuffer(x, np.int64) for x in group["classes"]])
    sizes = np.concatenate([np.frombuffer(x, np.int32) for x in group["sizes"]]).astype(np.int64)
    by = np.lexsort((names, hashes))
    hashes, names, sizes = hashes[by], names[by], sizes[by]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (names[1:] != names[:-1])]
    hashes, names, sizes = hashes[new], names[new], sizes[new]
    starts = np.nonzero(np.r_[True, hashes[1:] != hashes[:-1]])[0]
    lengths = np.diff(np.r_[starts, len(hashes)])
    large = np.repeat(lengths > SMALL, lengths)
    # Places of the class and of the other one; in a list, classes are in order.
    found = [(np.flatnonzero(large), np.repeat(starts, lengths)[large], False)]
    for length in range(2, SMALL + 1):
        begin = starts[lengths == length]
        for a, b in [(begin + i, begin + j) for i in range(length) for j in range(i)]:
            may = np.minimum(sizes[a], sizes[b]) * 100 >= np.maximum(sizes[a], sizes[b]) * percent
            found.append((a[may], b[may], True))
    return pd.concat([
        pd.DataFrame({"class": names[a], "head": names[b], "pair": pair, "size": sizes[a], "head_size": sizes[b]})
        for a, b, pair in found
    ])


def _heads(rows: DataFrame, levels, n: int, percent: int, buckets: int) -> DataFrame:
    """(class, head, pair, size, head_size, shared): pairs of small lists that may link, classes and heads of others.

    ``shared`` is how many lists show it.  Heads of large lists come with themselves, too.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = levels.value
        seen: set[int] = set()
        held: list[tuple] = []
        count = 0

        def emit():
            hashes = np.concatenate([h for h, _, _ in held])
            sizes = [len(h) for h, _, _ in held]
            names = np.repeat(np.array([c for _, c, _ in held], np.int64), sizes)
            whole = np.repeat(np.array([s for _, _, s in held], np.int32), sizes)
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            present, starts = np.unique(bucket[by], return_index=True)
            ends = np.r_[starts[1:], len(by)]
            out = [
                [v[by[a:b]].tobytes() for a, b in zip(starts, ends, strict=True)]
                for v in (hashes // np.uint64(buckets) & np.uint64(0xFFFFFFFF), names, whole)
            ]
            out[0] = [np.frombuffer(x, np.uint64).astype(np.uint32).tobytes() for x in out[0]]
            return pa.RecordBatch.from_arrays(
                [pa.array(present), *[pa.array(x, pa.binary()) for x in out]],
                names=["bucket", "hashes", "classes", "sizes"],
            )

        for batch in batches:
            for _, hashes in _sets(batch, n):
                if not len(hashes):
                    continue
                name = _class_of(hashes)
                if name in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(name)
                first = _in_order(hashes, order)[: first_shingles(len(hashes), percent)]
                held.append((first, name, len(hashes)))
                count += len(first)
                if count > 1_000_000:
                    yield emit()
                    held, count = [], 0
        if held:
            yield emit()

    packed = rows.mapInArrow(entries, "bucket long, hashes binary, classes binary, sizes binary")
    fields = "class long, head long, pair boolean, size long, head_size long"
    found = packed.groupBy("bucket").applyInPandas(lambda group: _shown(group, percent), fields)
    return found.groupBy("class", "head", "pair").agg(
        F.max("size").alias("size"), F.max("head_size").alias("head_size"), F.count("*").alias("shared")
    )


def _that_may_link(heads: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(class, head) and (class, size) of what shares enough."""
    of_large = F.when(~F.col("pair"), F.col("shared"))
    of_pairs = F.when(F.col("pair"), F.col("shared"))
    shares = heads.select("class", "size", of_pairs.alias("near"), of_large.alias("large")).unionByName(
        heads.filter("pair").select(
            F.col("head").alias("class"), F.col("head_size").alias("size"), of_pairs.alias("near"), of_large.alias("large")
        )
    )
    # A partner has at least ``percent`` of the size, and a tenth of that, and one, is its k.
    least = F.floor(F.floor(F.col("size") * percent / 100) / 10) + 1
    shares = shares.groupBy("class").agg(
        F.max("size").alias("size"), F.coalesce(F.max("near"), F.lit(0)).alias("near"),
        F.coalesce(F.sum("large"), F.lit(0)).alias("large"),
    )
    enough = stored(
        shares.filter(F.col("near") + F.col("large") >= least).select("class", "size", "large", least.alias("least")),
        "shingle-enough",
    )
    # A pair shares what its small lists show, and some of the large ones of both.
    other = enough.select(
        F.col("class").alias("head"), F.col("large").alias("head_large"), F.col("least").alias("head_least")
    )
    pairs = (
        heads.filter("pair").join(enough.drop("size"), "class").join(other, "head")
        .filter(F.col("shared") + F.least("large", "head_large") >= F.greatest("least", "head_least"))
    )
    # Both sides leave out less than half of what they share at least, so that something they share is left.
    weakest = Window.partitionBy("class").orderBy("shared", "head").rowsBetween(Window.unboundedPreceding, 0)
    kept = (
        heads.filter(~F.col("pair") & (F.col("class") != F.col("head"))).select("class", "head", "shared")
        .join(enough, "class").withColumn("so_far", F.sum("shared").over(weakest))
        .filter(F.col("so_far") > F.floor((F.col("least") - 1) / 2))
    )
    edges = pairs.select("class", "head").unionByName(kept.select("class", "head"))
    return stored(edges, "shingle-heads"), enough.select("class", "size")


def _needed_bits(texts: DataFrame) -> np.ndarray:
    """Bitmap of hashed keys, 2^NEEDED_BITS bits: rows of 4 KB, as many for any input."""
    # Spark's bitmaps start at 1.
    place = F.col("key").bitwiseAND((1 << NEEDED_BITS) - 1) + 1
    rows = (
        texts.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    )
    bits = np.zeros((1 << NEEDED_BITS) // 8, np.uint8)
    for row in rows:
        at = (row["bucket"] - 1) * 4096
        bits[at : at + 4096] |= np.frombuffer(row["bits"], np.uint8)
    return bits


class PrefixTree:
    """Sets in a common order, frequent elements first, as one tree.

    Sorted as sequences, sets with a common beginning stand side by side.  Each one keeps the stretch
    that it has not in common with the one before, and the anchor whose stretch it branches off.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        bounds = np.r_[0, np.cumsum(self.sizes)]
        self.words, numbers, counts = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        self.rank = np.empty(len(counts), np.int32)
        self.rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts), dtype=np.int32)
        ranked = self.rank[numbers]
        paths = [np.sort(ranked[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.order = np.array(
            sorted(range(len(sets)), key=lambda i: paths[i].astype(">u4").tobytes()), np.int64
        )
        paths = [paths[i] for i in self.order]
        common = [0, *(self._common(a, b) for a, b in zip(paths, paths[1:], strict=False))]
        self.elements = np.concatenate([p[c:] for p, c in zip(paths, common, strict=True)])
        self.bounds = np.r_[0, np.cumsum([len(p) - c for p, c in zip(paths, common, strict=True)])]
        self.seen = np.zeros(len(self.rank), bool)
        # (sets, their anchors, where in the anchors' stretches they branch off), by depth of branches.
        levels: list[tuple[list, list, list]] = []
        depth, open_sets = np.zeros(len(paths), np.int64), []
        for i, c in enumerate(common):
            while open_sets and common[open_sets[-1]] >= c:
                open_sets.pop()
            if c:
                anchor = open_sets[-1]
                depth[i] = depth[anchor] + 1
                if depth[i] > len(levels):
                    levels.append(([], [], []))
                for held, x in zip(
                    levels[depth[i] - 1], (i, anchor, self.bounds[anchor] + c - common[anchor]), strict=True
                ):
                    held.append(x)
            open_sets.append(i)
        self.levels = [tuple(np.array(x, np.int64) for x in level) for level in levels]

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        size = min(len(a), len(b))
        differ = np.nonzero(a[:size] != b[:size])[0]
        return int(differ[0]) if len(differ) else size

    def search(self, probe: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the sets that link with ``probe``."""
        at = np.minimum(np.searchsorted(self.words, probe), len(self.words) - 1)
        shared = self.rank[at[self.words[at] == probe]]
        self.seen[shared] = True
        sums = np.r_[0, np.cumsum(self.seen[self.elements], dtype=np.int32)]
        self.seen[shared] = False
        above = np.zeros(len(self.order), np.int64)
        for sets, anchors, cuts in self.levels:
            above[sets] = above[anchors] + sums[cuts] - sums[self.bounds[anchors]]
        overlap = above + sums[self.bounds[1:]] - sums[self.bounds[:-1]]
        needed = needed_overlap(len(probe), self.sizes[self.order], percent)
        return self.order[overlap >= needed]


def connected(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between ``sets`` that connect all that is linked: no more than there are sets."""
    links: list[tuple[int, int]] = []
    alone = np.ones(len(sets), bool)
    held = np.arange(len(sets))
    tree = PrefixTree(sets)
    left = len(sets)
    for start in range(len(sets)):
        if not alone[start]:
            continue
        alone[start] = False
        left -= 1
        linked = [start]
        while linked and left:
            probe = linked.pop()
            if 2 * left < len(held):
                held = np.flatnonzero(alone)
                tree = PrefixTree([sets[i] for i in held])
            found = held[tree.search(sets[probe], percent)]
            found = found[alone[found]]
            alone[found] = False
            left -= len(found)
            links += [(probe, i) for i in found.tolist()]
            linked += found.tolist()
    return links


def _links(texts: DataFrame, pieces: DataFrame, n: int, percent: int) -> DataFrame:
    """The links (a, b) that connect what is linked in each part of a piece.

    Where ``probe`` is not null, only probes are held against the others, of components other than theirs.
    """
    names = ("piece", "part", "class", "probe", "component")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(
                    *(values(batch, name) for name in names), shingle_sets(utf8(batch, "text"), n), strict=True
                )

        for _, part in groupby(rows(), key=lambda row: row[:2]):
            held, probes = {}, {}
            for _, _, name, probe, component, hashes in part:
                (probes if probe else held)[name] = hashes, component
            classes = list(held)
            links = []
            if not probes:
                found = connected([hashes for hashes, _ in held.values()], percent)
                links = [(classes[a], classes[b]) for a, b in found]
            elif held:
                tree = PrefixTree([hashes for hashes, _ in held.values()])
                for name, (hashes, own) in probes.items():
                    others = {held[classes[i]][1]: classes[i] for i in tree.search(hashes, percent)}
                    links += [(name, other) for component, other in others.items() if component != own]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())],
                names=["a", "b"],
            )

    dealt = texts.join(pieces, "class").repartition("piece", "part")
    return dealt.sortWithinPartitions("piece", "part").select(*names, "text").mapInArrow(
        search, "a long, b long"
    )


def _blocks(sets: str, shingles: str) -> Column:
    """How many blocks make (sets, shingles) small enough for a task."""
    return F.greatest(
        F.ceil(F.col(shingles) / HELD),
        F.ceil(F.sqrt(F.col(shingles).cast("double") * F.col(sets) / COMPARED)),
    )


def _pieces(heads: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(piece, class, size, sets, shingles, blocks): pieces that fit a task, and those too large for one."""
    together = components(heads.select(F.col("class").alias("a"), F.col("head").alias("b")))
    whole = sizes.join(together, F.col("class") == F.col("node")).select(
        F.col("component").alias("piece"), "class", "size"
    )

    def counted(pieces: DataFrame) -> DataFrame:
        counts = pieces.groupBy("piece").agg(F.count("*").alias("sets"), F.sum("size").alias("shingles"))
        counts = counts.filter("sets > 1").withColumn("blocks", _blocks("sets", "shingles"))
        return pieces.join(counts, "piece")

    whole = stored(counted(whole), "shingle-pieces")
    fits, large = whole.filter("blocks = 1"), whole.filter("blocks > 1")
    if large.isEmpty():
        return fits, large
    own = heads.select("head", F.col("head").alias("class"))
    of_heads = heads.select("head", "class").unionByName(own).distinct().join(
        large.select("class", "size"), "class"
    ).select(F.col("head").alias("piece"), "class", "size")
    of_heads = stored(counted(of_heads), "shingle-pieces")
    return fits.unionByName(of_heads.filter("blocks = 1")), of_heads.filter("blocks > 1")


def _numbers(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))


def _in_blocks(large: DataFrame) -> DataFrame:
    """Every class in its block, the head in all."""
    block = F.pmod(F.xxhash64("class"), F.col("blocks"))
    heads = large.filter("class = piece").select("piece", _numbers("blocks").alias("part"), "class")
    return large.filter("class <> piece").select("piece", block.alias("part"), "class").unionByName(heads)


def _across_blocks(large: DataFrame, known: DataFrame) -> DataFrame:
    """All blocks, each with classes outside of its piece's largest component as probes."""
    placed = large.join(known, F.col("class") == F.col("node"), "left").select(
        *large.columns, F.coalesce("component", "class").alias("component")
    )
    placed = stored(placed, "shingle-placed")
    largest = placed.groupBy("piece", "component").agg(F.count("*").alias("n")).groupBy("piece").agg(
        F.max(F.struct("n", "component"))["component"].alias("largest")
    )
    outside = placed.join(largest, "piece").filter("component <> largest").drop("largest")
    lots = outside.groupBy("piece").agg(
        F.greatest(
            F.ceil(F.sum("size") / HELD),
            F.ceil(
                F.count("*") * F.first("shingles").cast("double") / F.first("blocks") / COMPARED
            ),
        ).alias("lots")
    )
    outside = outside.join(lots, "piece").withColumn("lot", F.pmod(F.xxhash64("class"), F.col("lots")))
    block = F.pmod(F.xxhash64("class", F.lit(1)), F.col("blocks"))
    names = ["piece", "part", "class", "probe", "component"]
    probes = outside.withColumn("block", _numbers("blocks")).withColumn("probe", F.lit(True))
    others = placed.join(lots, "piece").withColumn("lot", _numbers("lots")).withColumn(
        "block", block
    ).withColumn("probe", F.lit(False))
    part = F.col("lot") * F.col("blocks") + F.col("block")
    return probes.withColumn("part", part).select(names).unionByName(
        others.withColumn("part", part).select(names)
    )


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = 75
) -> DataFrame:
    """key, n_shingles, component_id (smallest key reachable by links) and n_links to other classes.

    ``n_links`` counts the links found, which are enough to connect all that links; it is no degree.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")
    ).filter("key is not null")
    first = stored(_classes(rows, n), "shingle-classes")
    members = first.filter("key is not null").select("key", "size", "class")
    levels = spark.sparkContext.broadcast(_levels(first.filter("cell is not null").select("cell", "counts")))
    total = members.agg(F.sum("size")).first()[0] or 0
    buckets = max(8, total // 3 // BUCKET_ENTRIES)
    heads = stored(_heads(rows, levels, n, percent, buckets), "shingle-heads")
    heads, sizes = _that_may_link(heads, percent)
    fits, large = _pieces(heads, sizes)

    # One document of each class stands for it.
    classes = fits.select("class").unionByName(large.select("class")).distinct()
    one = stored(members.join(classes, "class").groupBy("class").agg(F.min("key").alias("key")), "shingle-texts")
    needed = spark.sparkContext.broadcast(_needed_bits(one))
    texts = _needed_texts(rows, needed, n)

    pieces = fits.select("piece", F.lit(0).cast("long").alias("part"), "class").unionByName(_in_blocks(large))
    whole = pieces.withColumn("probe", F.lit(None).cast("boolean")).withColumn(
        "component", F.lit(None).cast("long")
    )
    links = stored(_links(texts, whole, n, percent), "shingle-links")
    if not large.isEmpty():
        across = _across_blocks(large, components(links))
        links = links.unionByName(stored(_links(texts, across, n, percent), "shingle-links"))
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    joined = components(links)

    counted = links.select(F.col("a").alias("class")).unionByName(
        links.select(F.col("b").alias("class"))
    ).groupBy("class").agg(F.count("*").alias("n_links"))
    # Classes as components: their smallest key is that of all their documents.
    smallest = members.filter("size > 0").groupBy("class").agg(F.min("key").alias("first"))
    named = smallest.join(joined, F.col("class") == F.col("node"), "left").select(
        "class", "first", F.coalesce("component", "class").alias("component")
    )
    named = stored(named, "shingle-names")
    roots = named.groupBy("component").agg(F.min("first").alias("root"))
    answer = named.join(roots, "component").join(counted, "class", "left").select(
        "class", "root", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return members.join(answer, "class", "left").select(
        F.col("key").alias(key), F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("root")).otherwise(F.col("key")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def _needed_texts(rows: DataFrame, needed, n: int) -> DataFrame:
    """(class, text) of texts whose key is marked as needed; a task hands on one of each class."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = needed.value
        seen: set[int] = set()
        for batch in batches:
            places = np.array(values(batch, "key"), np.int64) & ((1 << NEEDED_BITS) - 1)
            keep = (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
            batch = batch.filter(pa.array(keep))
            classes = [_class_of(hashes) for _, hashes in _sets(batch, n)]
            new = []
            for name in classes:
                new.append(name not in seen)
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(name)
            texts = batch.column(batch.schema.get_field_index("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), texts], names=["class", "text"]
            ).filter(pa.array(new, pa.bool_()))

    return rows.mapInArrow(read, "class long, text string")
