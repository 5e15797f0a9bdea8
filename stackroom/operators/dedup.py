"""Which row of a key counts.

Every operator names its order, so the answer does not depend on how rows are spread.
A key may hold a large part of all rows: each input partition first reduces its own rows
to one per key (Spark's window group limit, or partial aggregation), so that at most one
row per key and input partition is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackroom.functions.text import blank_to_null

#: Repeated keys that rows may meet where they are: some megabytes, which Spark broadcasts by their measured size.
FEW_KEYS = 50_000


def _few(repeated: DataFrame) -> bool:
    """Whether keys are few enough for rows to stay where they are; counted, as it decides what is shuffled."""
    return repeated.limit(FEW_KEYS + 1).count() <= FEW_KEYS


def _any_null(keys: Sequence[str]) -> Column:
    null = F.col(keys[0]).isNull()
    for key in keys[1:]:
        null = null | F.col(key).isNull()
    return null


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], collation: str | None = None
) -> DataFrame:
    """The first row per key in ``order``; rows with a NULL key are all kept.

    ``order`` must tell rows apart.  ``collation`` compares text keys by one of Spark's
    collations instead of byte by byte.
    """
    text_keys = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    parts = [
        F.collate(F.col(k), collation) if collation and k in text_keys else F.col(k)
        for k in keys
    ]
    # NULL keys are no duplicates: each such row is a group of its own, which also
    # spreads them instead of gathering them in one task.
    own = [F.when(_any_null(keys), F.col(c)) for c in order]
    window = Window.partitionBy(*parts, *own).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def later_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with the place of the row to keep, ``first_place``.

    Only keys and places are shuffled, never the rest of the row.  Where duplicates are rare,
    which is the normal case for dumps, the result is small.
    """
    return (
        df.filter(~_any_null(keys))
        .groupBy(*keys)
        .agg(F.min(F.struct(*order)).alias("first_place"), F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > 1)
        .drop("_rows")
    )


def _numbers_first(df: DataFrame, parts: Sequence[str | Column]) -> list[str | Column]:
    """``parts`` with texts last: a sort compares the first eight bytes of its first column before all else,

    and a text that many keys share, such as a kind, would tell none of them apart.
    """
    texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return sorted(parts, key=lambda p: isinstance(p, Column) or p in texts)


def _at_first(df: DataFrame, parts: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The rows at the first place of each part; several if they share it.  NULL parts are one part."""
    place = F.rank().over(Window.partitionBy(*_numbers_first(df, parts)).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def keep_first_wide(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``keep_first`` for wide rows read from a table.

    Reads ``df`` twice, the first time only keys and places, and joins the duplicated keys
    back.  Rows that have no duplicate are never sorted, and not shuffled either when
    the duplicated keys are few enough for Spark to broadcast by their measured size.  When they are
    not, a join would shuffle every row: each input partition then hands on one row per key.
    """
    repeated = later_duplicates(df, keys, order)
    if not _few(repeated):
        return _at_first(df, [*keys, *[F.when(_any_null(keys), F.col(c)) for c in order]], order)
    duplicated = repeated.select(
        *[F.col(k).alias(f"_dup_{k}") for k in keys],
        *[F.lit(None).cast(df.schema[c].dataType).alias(f"_own_{c}") for c in order],
        "first_place",
    )
    marked, on = df, F.lit(True)
    for key in keys:
        on = on & (F.col(key) == F.col(f"_dup_{key}"))
    # NULL keys never match, but would all hash alike in a shuffled join: spread them.
    for column in order:
        marked = marked.withColumn(f"_at_{column}", F.when(_any_null(keys), F.col(column)))
        on = on & F.col(f"_at_{column}").eqNullSafe(F.col(f"_own_{column}"))
    first = F.col("first_place")
    return (
        marked.join(duplicated, on, "left")
        .filter(first.isNull() | (F.struct(*order) == first))
        .select(*df.columns)
    )


def not_in(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``existing`` lacks; rows with a NULL key are kept."""
    known = existing.select(*keys).filter(~_any_null(keys))
    return df.join(known, list(keys), "left_anti")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Whether columns agree pair by pair; NULL agrees with NULL."""
    equal = F.lit(True)
    for one, other in zip(left, right, strict=True):
        equal = equal & F.col(one).eqNullSafe(F.col(other))
    return equal


def _first_places(df: DataFrame, keys: Sequence[str], order: Sequence[str], named: Column) -> DataFrame:
    """Keys of several rows (as ``_key_…``), with the places of their first and first named row.

    Aggregates hold numbers only, so that Spark hashes and never sorts rows for them.  Where a
    place also names a file, each input partition hands on one row per key and file.
    """
    *files, number = order
    rows = df.select(*keys, *order, named.alias("_is_named"))
    named_number = F.min(F.when(F.col("_is_named"), F.col(number)))
    count = F.count(F.lit(1)).alias("_rows")
    own = [F.col(k).alias(f"_key_{k}") for k in keys]
    if not files:
        places = rows.groupBy(*keys).agg(count, F.min(number).alias("_number"), named_number.alias("_named"))
        return places.filter("_rows > 1").select(
            *own,
            F.struct(F.col("_number").alias(number)).alias("_first"),
            F.when(F.col("_named").isNotNull(), F.struct(F.col("_named").alias(number))).alias("_named"),
        )
    repeated = rows.groupBy(*keys).agg(count).filter("_rows > 1").select(*own)
    of_repeated = rows.join(repeated, _same(keys, [f"_key_{k}" for k in keys]), "left_semi")
    by_file = of_repeated.groupBy(*keys, *files).agg(
        F.min(number).alias("_number"), named_number.alias("_named")
    )
    window = Window.partitionBy(*keys).orderBy(*files)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    has_named = F.when(F.col("_named").isNotNull(), F.struct(*files, F.col("_named").alias(number)))
    return (
        by_file.withColumn("_file", F.row_number().over(window))
        .withColumn("_named", F.first(has_named, True).over(whole))
        .filter("_file = 1")
        .select(*own, F.struct(*files, F.col("_number").alias(number)).alias("_first"), "_named")
    )


def _filled(
    firsts: DataFrame, supplied: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, touched: str
) -> DataFrame:
    """First rows; a first named row at another place supplies name and ``touched``."""
    theirs = supplied.select(
        *[F.col(k).alias(f"_for_{k}") for k in keys],
        F.struct(*order).alias("_from"),
        F.struct(F.col(name).alias("name"), F.col(touched).alias("touched")).alias("_supplied"),
    )
    on = _same(keys, [f"_for_{k}" for k in keys]) & ~F.struct(*order).eqNullSafe(F.col("_from"))
    joined, filled = firsts.join(theirs, on, "left"), F.col("_supplied").isNotNull()
    taken = {
        name: F.when(filled, F.col("_supplied.name")).otherwise(F.col(name)),
        touched: F.when(filled, F.col("_supplied.touched")).otherwise(F.col(touched)),
    }
    return joined.select(*[taken.get(c, F.col(c)).alias(c) for c in firsts.columns])


def first_wins_backfill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "name",
    touched: str = "updated_at",
) -> DataFrame:
    """Attributes of the first row per key; a blank name comes from the first row with one.

    The row that supplies the name also supplies ``touched``.  ``order`` must tell a key's rows apart;
    its last column is a number.  NULL keys are one key.

    Best on rows read from a table, as ``df`` is read more than once: keys and places tell which
    rows win, and only then are whole rows met.  Rows whose key is theirs alone are never sorted, and not
    shuffled either when the repeated keys are few enough for Spark to broadcast.  When they are not, joins would
    shuffle every row more than once: each input partition then hands on one first and one first named
    row per key.
    """
    named = blank_to_null(F.col(name)).isNotNull()
    if not _few(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")):
        # As in the minima below, a NULL number comes last in its file, and its row supplies nothing.
        places = [*order[:-1], F.col(order[-1]).asc_nulls_last()]
        narrow = df.filter(named & F.col(order[-1]).isNotNull()).select(*keys, *order, name, touched)
        return _filled(_at_first(df, keys, places), _at_first(narrow, keys, places), keys, order, name, touched)
    places = _first_places(df, keys, order, named)
    on_key = _same(keys, [f"_key_{k}" for k in keys])
    here = F.struct(*order)
    firsts = df.join(places.drop("_named"), on_key, "left").filter(
        F.col("_first").isNull() | here.eqNullSafe(F.col("_first"))
    )
    # A first named row that is another than the first one means that that one's name is blank.
    later = places.filter(F.col("_named").isNotNull() & ~F.col("_named").eqNullSafe(F.col("_first")))
    supplied = (
        df.select(*keys, *order, name, touched)
        .join(later, on_key & here.eqNullSafe(F.col("_named")))
        .select(*keys, *order, name, touched)
    )
    return _filled(firsts.select(*df.columns), supplied, keys, order, name, touched)


def numbered_slugs(
    df: DataFrame, base: str, number: str, order: Sequence[str], out: str = "slug"
) -> DataFrame:
    """Unique slugs: ``s`` for the first row of a base, then ``s-<number>``, ``s-<number>-2``, …

    Bases come first.  The other rows' proposals are held against all bases and each other; among equal
    ones the first in order keeps its own.  What clashes ends as ``s--<number>-<n>``, n counting from 1 in
    each (base, number).  Bases are slugs, without two hyphens in a row, so that no other row can have
    that one, whatever numbers it ends in.

    A base shared by very many rows ("untitled") is never gathered: its first row is found
    by an aggregate, and the others are numbered per (base, number).
    """
    rest = [c for c in order if c != number]
    first = df.groupBy(base).agg(F.min(F.struct(*order, F.col(number).alias("_number"))).alias("_first"))
    owners = first.select(
        F.col(base).alias("_base"),
        F.col("_first._number").alias("_number"),
        *[F.col(f"_first.{c}").alias(f"_{c}") for c in rest],
    )
    on = (df[base] == owners["_base"]) & (df[number] == owners["_number"])
    for c in rest:
        on = on & (df[c] == owners[f"_{c}"])
    marked = df.join(owners, on, "left").select(
        *[df[c] for c in df.columns], owners["_base"].isNotNull().alias("_owner")
    )
    window = Window.partitionBy(base, number).orderBy(*order)
    place = F.row_number().over(window)
    owned = F.max("_owner").over(Window.partitionBy(base, number))
    numbered = marked.withColumn("_step", place + F.when(owned, 0).otherwise(1))
    base_text, number_text = F.col(base), F.col(number).cast("string")
    proposal = F.when(F.col("_step") == 2, F.concat_ws("-", base_text, number_text)).otherwise(
        F.concat_ws("-", base_text, number_text, (F.col("_step") - 1).cast("string"))
    )
    owning = numbered.filter("_owner").withColumn(out, base_text)
    proposed = numbered.filter("NOT _owner").withColumn(out, proposal)
    # Proposals name their base and number, so equal ones are few.
    among = F.row_number().over(Window.partitionBy(out).orderBy(*order, base, number))
    taken = owners.select(F.col("_base").alias(out), F.lit(True).alias("_taken"))
    held = proposed.withColumn("_among", among).join(taken, out, "left")
    free = (F.col("_among") == 1) & F.col("_taken").isNull()
    last = F.concat(base_text, F.lit("--"), number_text, F.lit("-"), (F.col("_step") - 1).cast("string"))
    settled = held.withColumn(out, F.when(free, F.col(out)).otherwise(last))
    columns = [*df.columns, out]
    return owning.select(*columns).unionByName(settled.select(*columns))
