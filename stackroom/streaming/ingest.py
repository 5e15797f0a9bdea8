"""The same transforms on streams.

Every stream is a writer of its own, named after its checkpoint, and numbers its batches as Spark does: a batch
that is run again after a failure replaces itself, and no other writer's batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stackroom import fixed_values as fixed
from stackroom.operators.dedup import not_in
from stackroom.plans import commits
from stackroom.plans.catalog import Options, update_catalog
from stackroom.plans.staging import (
    PLACE,
    REJECT_SCHEMA,
    layout,
    other_batches,
    parse_lines,
    parse_raw,
    unread_places,
    write_parsed,
)
from stackroom.session import configure, remove_scratch, scratch_dir
from stackroom.sources.lines import SPLIT_BYTES, stream_lines


def writer_of(checkpoint: str) -> str:
    """A stream's name among the writers: the same for every run from a checkpoint."""
    return f"stream_{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:12]}"


def stage_stream(
    spark: SparkSession,
    paths: str | list[str],
    root: str,
    dataset: str,
    checkpoint: str,
    kind: str = fixed.KIND_JSON,
    tsv_columns: int = 0,
    recursive: bool = False,
    hold_partial_line: bool = True,
    split_bytes: int = SPLIT_BYTES,
) -> StreamingQuery:
    """Stage new files and appended tails; stops when everything present is read.

    The checkpoint holds the byte position per file and takes the place of the state
    table of the batch plan.  Lines that the plan or another stream has staged are left out.
    """
    configure(spark)
    lines = stream_lines(
        spark, paths, split_bytes, recursive=recursive, hold_partial_line=hold_partial_line, raw=True
    )
    schema, writer = layout(kind, tsv_columns).schema, writer_of(checkpoint)

    def write(batch_lines: DataFrame, batch: int) -> None:
        session = batch_lines.sparkSession
        scratch = scratch_dir(session, "stream")
        try:
            parse_raw(batch_lines, lambda rows: parse_lines(rows, kind, tsv_columns)).write.parquet(scratch)
            parsed = session.read.parquet(scratch)
            existing = other_batches(session, f"{root}/staging/{dataset}", schema, writer, batch)
            zipped = F.lower("source_file").endswith(".gz")
            if not parsed.filter(zipped).isEmpty():
                # A grown zipped file comes whole once more.
                rejected = other_batches(session, f"{root}/rejects/{dataset}", REJECT_SCHEMA, writer, batch)
                for known in (existing, rejected):
                    parsed = not_in(parsed, known.filter((F.col("writer") == writer) & zipped), PLACE)
            parsed = unread_places(session, parsed, root, dataset, schema, writer)
            write_parsed(parsed, existing, root, dataset, kind, batch, writer)
        finally:
            remove_scratch(scratch)

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def catalog_stream(
    spark: SparkSession,
    staging_root: str,
    dataset: str,
    kind: str,
    root: str,
    checkpoint: str,
    options: Options = Options(),
) -> StreamingQuery:
    """Feed newly staged records of one dataset to the catalog.

    Staged batches that the batch plan, or another stream, has read are left out: the catalog's ledger
    tells.  Several streams may feed one catalog.
    """
    configure(spark)
    path, writer = f"{staging_root}/staging/{dataset}", writer_of(checkpoint)
    staged = (
        spark.readStream.schema(layout(fixed.KIND_JSON).schema)
        .option("basePath", path)
        .parquet(f"{path}/writer=*/batch=*")
        .withColumn("dataset", F.lit(dataset))
        .withColumn("kind", F.lit(kind))
    )

    def write(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        name = F.concat_ws("/", "writer", F.col("batch").cast("string"))
        taken = commits.load(session, root).read(dataset, but=writer)
        if taken:
            rows = rows.filter(~name.isin(*sorted(taken)))
        # One name for each staged batch.
        found = [r["name"] for r in rows.select(name.alias("name")).distinct().collect()]
        if found:
            update_catalog(
                session, rows, root, batch, options, writer=writer, read={dataset: found}, kinds={dataset: kind}
            )

    return (
        staged.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
