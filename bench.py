"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.  Each query runs
to the last row twice; the better time counts, so that Python and JVM start-up do not.
``rates`` gives rows per second of the parts that load dump lines.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from stackroom.queries import QUERIES  # noqa: E402
from stackroom.queries.catalog import item_records  # noqa: E402
from stackroom.session import local_session, scratch_dir  # noqa: E402

HEADLINE = [
    "tag_counts", "tag_links", "document_word_counts", "source_links",
    "keep_first_documents", "first_wins_backfill", "covers_catalog",
    "parse_record_line", "ingest_metrics", "covers_tsv", "generic_tsv", "wikidata_tsv",
    "slugify_texts", "subjects", "cover_ids", "parse_datetime",
    "work_entities", "work_tag_counts", "line_offsets", "staged_in_batch",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def load_rates(spark, sf_dir: str) -> dict[str, float]:
    """Rows per second from a dump file to staging, and from staging to the catalog."""
    from stackroom.plans import catalog, staging
    from stackroom.sources.files import DumpFile
    from stackroom.sources.lines import list_files

    folder = scratch_dir(spark, "bench-dump")
    lines = item_records(spark, sf_dir).select(
        F.concat_ws("\t", F.lit("/type/work"), "ol_key", F.lit("1"), "data_json").alias("value")
    )
    lines.write.option("compression", "none").text(folder)
    rows = spark.read.text(folder).count()
    files = [DumpFile(p, s, "json", "items") for p, s in list_files(folder)]
    best = {}
    for _ in range(2):
        root = scratch_dir(spark, "bench-root")
        stage = timed(lambda: staging.stage_dataset(spark, files, root))
        records = item_records(spark, sf_dir)
        build = timed(lambda: catalog.update_catalog(spark, records, f"{root}/catalog"))
        for name, seconds in (("stage", stage), ("catalog", build)):
            best[name] = max(best.get(name, 0.0), rows / seconds)
    return {name: round(rate) for name, rate in best.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    times = {}
    for name in HEADLINE:
        run = QUERIES[name]
        times[name] = round(min(timed(lambda: drain(run(spark, sf_dir))) for _ in range(2)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cores": cores,
        "rates": load_rates(spark, sf_dir),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
