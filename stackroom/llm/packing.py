"""Packing of tokenised documents into sequences, by best fit and swaps.

``pieces`` tokenises documents and cuts those longer than a sequence.  ``pack`` deals the pieces
to shards of bounded size.  A shard is packed by best fit, longest first, and then improved by
local search: documents are moved, or exchanged one for one and two for one, between underfull
bins, so that the sum of squared fills rises, until the least filled bins are empty.  What is left in
bins with much room is dealt and packed once more, in fewer shards.

A shard holds about ``SHARD_ROWS`` pieces whatever the input, so that waste is a part of a bin in
a shard, which no larger group would better by much.

Defined results: a null text is empty; every document ends with ``end_id`` and so has a token at
least; repeated rows are packed as often as they come; a null key is kept; of an empty table nothing
comes.  Long texts are tokenised whole.  Other columns are not looked at.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.llm.store import stored
from stackroom.llm.words import utf8, values

SHARD_ROWS = 16_000
#: A bin with more than this share of room is dealt again.
LOOSE = 0.01
#: Steps of local search in a shard, a bound on its time alone: packing is whole at any step.
STEPS = 4_000


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE of a file of ranks.  It gives the ids that the ``tokenizers`` library gives

    for the same vocabulary (``byte_bpe_50k.json`` beside ``byte_bpe_50k.tiktoken``; a test compares
    them) in an eighth of the time.  Tokens added there are known here: ``encode`` with
    ``allowed_special="all"`` finds them in texts as ``tokenizers`` does.  Texts it fails on, as those
    with very long white space, are encoded by ``tokenizers`` itself.
    """
    import public_tokenizers
    import tiktoken

    beside = Path(path).with_suffix(".json")
    added = json.loads(beside.read_text())["added_tokens"] if beside.exists() else []

    @lru_cache(maxsize=2)
    def slow(with_added: bool):
        import tokenizers

        described = json.loads(beside.read_text())
        if not with_added:
            described["added_tokens"] = []
        return tokenizers.Tokenizer.from_str(json.dumps(described))

    class Encoding(tiktoken.Encoding):
        def encode(self, text, *, allowed_special=frozenset(), **kwargs):
            try:
                return super().encode(text, allowed_special=allowed_special, **kwargs)
            except ValueError as error:
                if "stack size" not in str(error):
                    raise
            return slow(allowed_special == "all").encode(text, add_special_tokens=False).ids

        def encode_to_numpy(self, text, *, allowed_special=frozenset(), **kwargs):
            try:
                return super().encode_to_numpy(text, allowed_special=allowed_special, **kwargs)
            except ValueError as error:
                if "stack size" not in str(error):
                    raise
            ids = slow(allowed_special == "all").encode(text, add_special_tokens=False).ids
            return np.asarray(ids, np.uint32)

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Encoding(
        "bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
        special_tokens={token["content"]: token["id"] for token in added},
    )


def pieces(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """key, piece, start, length and ids (little-endian uint32) of every piece.

    A document of more than ``capacity`` ids is cut into pieces of just that many, but for
    its first, which takes the rest.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    end = np.asarray([end_id], "<u4").tobytes()
    kind = rows.schema["key"].dataType
    schema = T.StructType(
        [T.StructField("key", kind), T.StructField("piece", T.IntegerType()),
         T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
         T.StructField("ids", T.BinaryType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            encode = encoder(tokenizer).encode
            for k, t in zip(values(batch, "key"), utf8(batch, "text"), strict=True):
                ids = np.asarray(encode((t or b"").decode(), allowed_special="all"), "<u4").tobytes() + end
                count = len(ids) // 4
                first = (count - 1) % capacity + 1
                bounds = [0, *range(first, count + 1, capacity)]
                for n, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    out.append((k, n, a, b - a, ids[4 * a : 4 * b]))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            names = ["key", "piece", "start", "length", "ids"]
            types = [batch.schema.field("key").type, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

    return rows.mapInArrow(cut, schema).withColumnRenamed("key", key)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each length: longest first, each to the bin it fills best."""
    bins = np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some bin has room for r
    count = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        enough = rooms >> length
        if enough:
            room = length + (enough & -enough).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, count
            count += 1
        bins[i] = b
        room -= length
        if room:
            open_bins[room].append(b)
            rooms |= 1 << room
    return bins


def improve(lengths: np.ndarray, bins: np.ndarray, capacity: int, steps: int = STEPS) -> np.ndarray:
    """Swap-based local search: empty the least filled bins into the room of others.

    Every step makes the fuller of two bins fuller and the emptier one emptier, so the sum of
    squared fills rises and the search ends.
    """
    bins = bins.copy()
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    stuck: set[int] = set()
    for _ in range(steps):
        used = fill > 0
        if (capacity - fill[used]).sum() < capacity:
            break  # no bin can be spared
        order = np.argsort(np.where(used, fill, capacity + 1), kind="stable")
        source = next((int(b) for b in order[:64] if fill[b] < capacity and used[b] and b not in stuck), None)
        if source is None:
            break
        mine = np.nonzero(bins == source)[0]
        other = np.nonzero((bins != source) & (fill[bins] < capacity) & (fill[bins] >= fill[source]))[0]
        step = _best_step(lengths, bins, fill, capacity, source, mine, other)
        if step is None:
            stuck.add(source)
            continue
        out, back, target = step
        moved = int(lengths[out].sum() - lengths[back].sum())
        bins[out] = target
        bins[back] = source
        fill[target] += moved
        fill[source] -= moved
        stuck.discard(target)
    return np.unique(bins, return_inverse=True)[1]


def _best_step(lengths, bins, fill, capacity, source, mine, other):
    """(items out of the source, items back into it, target bin) of most gain, or None."""
    free = np.where(fill > 0, capacity - fill, 0)
    free[source] = 0
    free[fill < fill[source]] = 0
    widest = int(free.max()) if len(free) else 0
    if not widest:
        return None
    # Move a document whole.
    for i in mine[np.argsort(-lengths[mine], kind="stable")]:
        fitting = np.nonzero(free >= lengths[i])[0]
        if len(fitting):
            return np.array([i]), np.array([], np.int64), int(fitting[np.argmin(free[fitting])])
    if not len(other):
        return None
    best, found = 0, None
    room = free[bins[other]]
    singles = [(np.array([i]), int(lengths[i])) for i in mine]
    pairs = [
        (np.array([i, j]), int(lengths[i] + lengths[j]))
        for n, i in enumerate(mine[:24]) for j in mine[n + 1 : 24]
    ]
    # One or two of the source for one of another bin.
    for items, total in singles + pairs:
        gain = total - lengths[other]
        gain = np.where((gain > 0) & (gain <= room), gain, 0)
        at = int(np.argmax(gain))
        if gain[at] > best:
            best, found = int(gain[at]), (items, other[at : at + 1], int(bins[other[at]]))
    # One of the source for two neighbours of another bin.
    by_bin = other[np.argsort(bins[other], kind="stable")]
    left, right = by_bin[:-1], by_bin[1:]
    same = bins[left] == bins[right]
    left, right = left[same], right[same]
    if len(left):
        room = free[bins[left]]
        both = lengths[left] + lengths[right]
        for items, total in singles:
            gain = total - both
            gain = np.where((gain > 0) & (gain <= room), gain, 0)
            at = int(np.argmax(gain))
            if gain[at] > best:
                best = int(gain[at])
                found = (items, np.array([left[at], right[at]]), int(bins[left[at]]))
    return found


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length."""
    lengths = np.asarray(lengths, np.int64)
    bins = improve(lengths, best_fit(lengths, capacity), capacity)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    starts = ends - lengths[order]
    first = np.r_[True, np.diff(bins[order]) != 0]
    offsets = np.empty(len(lengths), np.int64)
    offsets[order] = starts - np.maximum.accumulate(np.where(first, starts, 0))
    return bins, offsets


def pack(rows: DataFrame, capacity: int = 2048, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``rows`` with sequence_id and offset; their ``length`` is between 1 and ``capacity``.

    ``rows`` must be a stored table: which shard a row goes to hangs on its place there.
    """
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("shard", T.LongType()),
         T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
         T.StructField("fill", T.LongType())]
    )

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack_lengths(group["length"].to_numpy(), capacity)
        fill = np.bincount(bins, weights=group["length"].to_numpy()).astype(np.int64)
        number = (group["shard"].to_numpy() << 32) + bins
        return group.assign(sequence_id=number, offset=offsets, fill=fill[bins])

    def deal(table: DataFrame, first: int) -> tuple[DataFrame, int]:
        shards = max(1, -(-table.count() // shard_rows))
        # A row's place, not its key: a key may be that of many rows.
        shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)) + first
        dealt = table.withColumn("shard", shard).groupBy("shard").applyInPandas(packed, schema)
        return stored(dealt, "packing"), first + shards

    names = [*rows.columns, "sequence_id", "offset"]
    first_round, next_shard = deal(rows, 0)
    tight = F.col("fill") >= int(capacity * (1 - LOOSE))
    loose = stored(first_round.filter(~tight).select(*rows.columns), "packing-rest")
    second_round, _ = deal(loose, next_shard)
    return first_round.filter(tight).select(*names).unionByName(second_round.select(*names))


def sequences(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """sequence_id, documents (key and piece in order) and ids of each sequence.

    A sequence is of bounded length, so its pieces may meet in one row.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(key).alias("key"), "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.transform("parts", lambda p: F.struct(p["key"].alias(key), p["piece"].alias("piece")))
        .alias("documents"),
        F.aggregate(
            "parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])
        ).alias("ids"),
    )
