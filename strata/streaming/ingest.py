"""Incremental bronze ingest with Structured Streaming (SNK1 as a stream).

The batch ingest rereads and overwrites a whole source; when raw files
keep landing in a folder, the file source picks up only new files, and
``trigger(availableNow=True)`` processes everything pending then stops,
so the same code serves a scheduled job. Progress (which files were
done) lives in the checkpoint folder, so a restarted or failed run
continues where it stopped without duplicating rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..sources.readers import NULL_TOKENS, apply_null_tokens, csv_header, csv_options, text_schema
from ..sources.sinks import add_ingest_meta


def stream_bronze(spark: SparkSession, source_dir: str, columns: Sequence[str], bronze_path: str,
                  checkpoint: str, fmt: str = "csv", max_files_per_trigger: int | None = None,
                  multi_line: bool = False) -> None:
    """Ingest every pending raw file of ``source_dir`` into ``bronze_path``
    (Parquet, append) and return when all of them are committed.

    CSV has the dialect of the batch reader, and ``columns`` are bound by the
    names in the header: a missing one raises, and so does a pending file whose
    header is not that of the folder's first file."""
    names = csv_header(spark, source_dir, multi_line) if fmt == "csv" else list(columns)
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"{source_dir}: no column {', '.join(missing)} in the header {', '.join(names)}")
    reader = spark.readStream.schema(text_schema(names))
    if fmt == "csv":
        reader = csv_options(reader, multi_line).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.format(fmt).load(source_dir).select(*columns)
    tokens = NULL_TOKENS if fmt == "csv" else ("",)
    out = add_ingest_meta(apply_null_tokens(raw, list(columns), tokens))
    q = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(bronze_path))
    q.awaitTermination()
