"""Returned files that arrive one by one: each micro-batch is one import in the history.

The manual alternative is to wait a fixed time per asset and then fetch every file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazardlens.operators.joins import staged
from hazardlens.plans.import_run import normalize_import
from hazardlens.sinks.history import History
from hazardlens.sources.workbooks import decode_returns, readable

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_workbooks(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def file_digests(rows: DataFrame) -> DataFrame:
    """``source_file, digest`` of what each file's rows hold, whatever the file is called and how it is packed."""
    names = sorted(c for c in rows.columns if c != "source_file")
    content = F.to_json(F.struct(*names))
    sums = [F.sum(F.xxhash64(F.lit(part), content).cast("decimal(38,0)")).cast("string") for part in ("first", "second")]
    return rows.groupBy("source_file").agg(F.concat_ws(":", F.count("*").cast("string"), *sums).alias("digest"))


def known_digests(history: History) -> DataFrame:
    """``digest, first_file, first_import`` of all files that were imported."""
    if history.entries().where("table = 'arrivals'").isEmpty():
        return history.spark.createDataFrame([], "digest string, first_file string, first_import string")
    new = history.read("arrivals").where(~F.col("repeat"))
    return new.select("digest", F.col("source_file").alias("first_file"), F.col("import_id").alias("first_import"))


def import_batch(
    files: DataFrame, kind: str, manifest: DataFrame, history: History, import_id: str, imported_at: str
) -> int | None:
    """One import of workbooks given as ``path, content``: their rows, and a list of arrivals.

    Files are known by the digest of their rows. One whose rows were imported before,
    under any name, adds no rows and is listed as a repeat of that file; of equal files
    in one import the first by name counts. Each file is decoded once.
    """
    rows = staged(readable(decode_returns(files.select("path", "content"), kind)).drop("extra"))
    mine = file_digests(rows)
    first = mine.groupBy("digest").agg(F.min("source_file").alias("own_first"))
    # the same import again must not see its own files as known
    before = known_digests(history).where(F.col("first_import") != import_id)
    arrived = mine.join(first, "digest").join(before, "digest", "left")
    again = F.col("first_file").isNotNull() | (F.col("own_first") != F.col("source_file"))
    earlier = F.coalesce("first_file", "own_first")
    arrived = staged(
        arrived.select("source_file", "digest", again.alias("repeat"), F.when(again, earlier).alias("repeat_of"))
    )
    new = rows.join(arrived.where(~F.col("repeat")).select("source_file"), "source_file", "left_semi")
    return history.append(
        import_id, **{f"{kind}_long": normalize_import(new, manifest, import_id, imported_at), "arrivals": arrived}
    )


def import_arrivals(
    workbooks: DataFrame,
    kind: str,
    manifest: DataFrame,
    history: str,
    checkpoint: str,
    imported_at: Callable[[int], str],
) -> StreamingQuery:
    """Appends arriving workbooks of one kind to the history until the folder is drained.

    Each micro-batch is one commit (``import_batch``). The import id holds the id of the
    stream, which its checkpoint keeps, and the batch number: a batch that is run again
    after a failure is known by it and not doubled. A stream with a new checkpoint never
    meets the ids of an old one, and the files it delivers again are known by their rows.
    A file that cannot be read or lacks required columns fails the batch.
    """

    def one_batch(files: DataFrame, number: int) -> None:
        stream = files.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        kept = History(files.sparkSession, history)
        import_batch(files, kind, manifest, kept, f"{kind}-{stream}-{number}", imported_at(number))

    return (
        workbooks.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
