"""Records to works, editions and authors, and their translations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom import fixed_values as fixed
from stackroom.functions import json, records
from stackroom.functions.dates import iso_datetime, updated_or_created, year_or_date
from stackroom.functions.text import (
    author_name,
    blank_to_null,
    entity_slug,
    intro,
    numeric_key,
)
from stackroom.operators.dedup import first_wins_backfill, keep_first, keep_first_wide

ENTITY_KEYS = ["kind", "ol_num"]
PLACE = ["dataset", "source_file", "source_offset"]
_DATES = ["birth_date", "death_date"]
_TIMES = ["created", "last_modified"]


def check_kind(kind: str) -> str:
    if kind not in fixed.KIND_CONFIG:
        raise ValueError(f"unknown kind: {kind}")
    return kind


def entity_type(kind: Column) -> Column:
    """Entity type in source links for an entity kind."""
    result = F.lit(None).cast("string")
    for name, (value, _, _) in fixed.KIND_CONFIG.items():
        result = F.when(kind == name, value).otherwise(result)
    return result


def extract_records(staged: DataFrame, strict_type: bool = False) -> DataFrame:
    """All fields the catalog needs, one row per usable staged record.

    ``staged`` has kind, ol_key, data_json, data and the place columns.  Records without a
    positive number in their key, or with empty or undecodable JSON, are left out.
    ``strict_type`` also leaves out records whose own type is not that of the dataset.
    The columns are all that later steps read, so JSON is decoded once.
    """
    data = F.col("data")
    usable = staged.withColumn("ol_num", numeric_key(F.col("ol_key"))).filter(
        (F.col("ol_num") > 0) & data.isNotNull() & ~json.is_blank(F.col("data_json"))
    )
    if strict_type:
        own = records.record_type(data)
        kind = F.lit(None).cast("string")
        for type_key, name in fixed.TYPE_TO_KIND:
            kind = F.when(own == type_key, name).otherwise(kind)
        usable = usable.filter(kind == F.col("kind"))

    texts = ["title", "personal_name", "last_name", "name", "bio", "description"]
    names = [*texts, *_DATES, *_TIMES, *fixed.SUBJECT_KEYS, "photos", "covers", "source_records"]
    # One step per projection: a column used twice is computed once.
    opened = usable.select(*ENTITY_KEYS, *PLACE, json.members(data, names).alias("_record"))
    record = F.col("_record")
    taken = opened.select(
        *ENTITY_KEYS,
        *PLACE,
        *[json.own_text(record[t]).alias(f"_{t}") for t in texts],
        *[F.try_variant_get(record[d], "$", "string").alias(f"_{d}") for d in _DATES],
        *[json.text_at(record[t], "value").alias(f"_{t}") for t in _TIMES],
        records.all_subjects(record, records.member).alias("_texts"),
        F.when(F.col("kind") == "author", records.cover_ids(record, "photos", records.member))
        .otherwise(records.cover_ids(record, "covers", records.member))
        .alias("cover_ids"),
        records.source_records(record, records.member).alias("source_records"),
    )
    clean = taken.withColumns({f"_{t}": blank_to_null(F.col(f"_{t}")) for t in texts})
    is_author = F.col("kind") == "author"
    named = clean.select(
        *ENTITY_KEYS,
        *PLACE,
        F.when(is_author, author_name(F.col("_personal_name"), F.col("_last_name"), F.col("_name")))
        .otherwise(F.col("_title"))
        .alias("name"),
        F.when(is_author, F.coalesce("_bio", "_description"))
        .otherwise(F.col("_description"))
        .alias("content"),
        *[F.when(is_author, year_or_date(F.col(f"_{d}"))).alias(d) for d in _DATES],
        "_texts",
        records.folded_items(F.col("_texts")).alias("_folded"),
        "cover_ids",
        "source_records",
        *[iso_datetime(F.col(f"_{t}")).alias(f"_{t}") for t in _TIMES],
    )
    return named.select(
        *ENTITY_KEYS,
        *PLACE,
        "name",
        "content",
        *_DATES,
        records.first_spellings(F.col("_texts"), F.col("_folded")).alias("subjects"),
        "cover_ids",
        "source_records",
        F.col("_created").alias("created_at"),
        updated_or_created(F.col("_last_modified"), F.col("_created")).alias("updated_at"),
    )


def build_entities(
    recs: DataFrame, site_id: int = 0, category_id: int = 0, as_of: Column | None = None
) -> DataFrame:
    """One row per (kind, ol_num): first record wins, blank names are filled in.

    ``recs`` is best a table that may well be read again (see ``first_wins_backfill``).
    ``as_of`` stands in for missing dates; without it they stay NULL.
    """
    columns = recs.select(
        *ENTITY_KEYS, *PLACE, "name", "birth_date", "death_date",
        "subjects", "cover_ids", "created_at", "updated_at",
    )
    firsts = first_wins_backfill(columns, ENTITY_KEYS, PLACE)
    created = updated_or_created(F.col("created_at"), F.lit(None), as_of)
    return firsts.select(
        *ENTITY_KEYS,
        *PLACE,
        F.col("ol_num").alias("entity_id"),
        F.lit(site_id).alias("site_id"),
        F.lit(category_id).alias("category_id"),
        F.lit(None).cast("bigint").alias("book_id"),
        "name",
        "birth_date",
        F.col("birth_date").try_cast("date").alias("birth_day"),
        "death_date",
        F.col("death_date").try_cast("date").alias("death_day"),
        F.col("subjects").alias("genres"),
        F.col("cover_ids").alias("screenshots"),
        F.lit(fixed.STATUS_ACTIVE).alias("status"),
        created.alias("created_at"),
        updated_or_created(F.col("updated_at"), F.col("created_at"), as_of).alias("updated_at"),
    )


def merge_entities(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing rows win; an incoming row adds its entity or fills a blank name.

    Both sides are outputs of ``build_entities``, with one row per entity, so one join does both.
    """
    theirs = incoming.select(*[F.col(c).alias(f"_new_{c}") for c in existing.columns])
    on = F.lit(True)
    for key in ENTITY_KEYS:
        on = on & (F.col(key) == F.col(f"_new_{key}"))
    joined = existing.join(theirs, on, "full")
    is_new = F.col(ENTITY_KEYS[0]).isNull()
    named = blank_to_null(F.col("_new_name")).isNotNull()
    fills = blank_to_null(F.col("name")).isNull() & named
    return joined.select(
        *[
            F.when(is_new | fills if c in ("name", "updated_at") else is_new, F.col(f"_new_{c}"))
            .otherwise(F.col(c))
            .alias(c)
            for c in existing.columns
        ]
    )


def new_entities(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows whose entity does not exist yet."""
    return incoming.join(existing.select(*ENTITY_KEYS), ENTITY_KEYS, "left_anti")


def build_translations(
    recs: DataFrame,
    locale: str = fixed.DEFAULT_LOCALE,
    as_of: Column | None = None,
    written: bool = False,
) -> DataFrame:
    """One row per (kind, entity, locale): title or name, slug, intro, content.

    ``written`` says that ``recs`` is a table that may well be read twice: then texts
    are not shuffled to find the few repeated entities.
    """
    rows = recs.select(
        "kind",
        F.col("ol_num").alias("entity_id"),
        *PLACE,
        F.lit(locale).alias("locale"),
        F.col("name").alias("title"),
        "content",
        F.col("ol_num").alias("ol_key"),
        updated_or_created(F.col("created_at"), F.lit(None), as_of).alias("created_at"),
        updated_or_created(F.col("updated_at"), F.col("created_at"), as_of).alias("updated_at"),
    )
    # One locale per call, so the entity is the key.
    keep = keep_first_wide if written else keep_first
    firsts = keep(rows, ["kind", "entity_id"], PLACE)
    # Slugs and intros are made after duplicates are gone.
    return firsts.select(
        "kind",
        "entity_id",
        "locale",
        "title",
        entity_slug(F.col("title"), F.col("ol_key")).alias("slug"),
        F.lit(None).cast("string").alias("meta_title"),
        F.lit(None).cast("string").alias("meta_description"),
        intro(F.col("content")).alias("introtext"),
        "content",
        "ol_key",
        "created_at",
        "updated_at",
    )


def rows_of_kind(rows: DataFrame, kind: str) -> DataFrame:
    """Translations or tag links of one kind, under the column names of its own table."""
    _, title, foreign_key = fixed.KIND_CONFIG[check_kind(kind)]
    names = {"entity_id": foreign_key, "title": title}
    return rows.filter(F.col("kind") == kind).drop("kind").withColumnsRenamed(names)


def for_target(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Only the columns the target has, in its order."""
    return df.select(*[c for c in target_columns if c in df.columns])


def union_datasets(datasets: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows of many datasets, each with its ``dataset`` name: names order key clashes."""
    parts = [df.withColumn("dataset", F.lit(name)) for name, df in datasets]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
