"""Running streams: once over what is new, or continuously."""

from __future__ import annotations

from collections.abc import Sequence

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.operators.quality import Rule, expect
from millrace.session import scratch_path


def _parquet_writer(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str]
) -> DataStreamWriter:
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return writer.partitionBy(*partition_by) if partition_by else writer


def run_once(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything not yet processed to a Parquet folder, then stop.

    The checkpoint remembers which files were taken and the folder's log which output
    files count, so a run that dies and is repeated adds every row exactly once.
    """
    query = (
        _parquet_writer(stream, path, checkpoint, partition_by).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def run_continuous(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = "10 seconds",
    table: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """The same stream, kept running; stop it with ``query.stop()``.

    With ``table`` the folder is also registered under that name.
    """
    writer = _parquet_writer(stream, path, checkpoint, partition_by)
    writer = writer.trigger(processingTime=interval)
    return writer.toTable(table) if table else writer.start()


def observed(query: StreamingQuery, name: str, rules: Sequence[Rule]) -> list[tuple]:
    """Report lines (dataset, rule, action, passed, failed, dropped) of a finished run.

    ``name`` is the observation under which ``expect`` counted; the counts of all batches
    are added up, so they are those of the run alone.
    """
    seen = [p.observedMetrics[name] for p in query.recentProgress if name in p.observedMetrics]
    lines = []
    for i, rule in enumerate(rules):
        passed, failed = (sum(row[f"{side}_{i}"] for row in seen) for side in ("passed", "failed"))
        lines.append((name, rule.name, rule.on_violation, passed, failed, failed if rule.on_violation == "drop" else 0))
    return lines


def observed_failure(stream: DataFrame, checkpoint: str, name: str, rules: Sequence[Rule]) -> list[tuple]:
    """Report lines of the rows that a run with ``checkpoint`` failed on, and committed nothing of.

    A batch that fails reports no counts. So the run is made again from a copy of its
    checkpoint, a few small files, with the rules only counting and the rows going nowhere: it sees
    exactly the batches the failed run could not commit, and the next real run still has them.
    """
    spark = stream.sparkSession
    copy = scratch_path(spark, "failed-run")
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    source, target = hadoop.Path(checkpoint), hadoop.Path(copy)
    hadoop.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
    counted = expect(stream, [replace(r, on_violation="keep") for r in rules], observation=name)
    query = counted.writeStream.format("noop").option("checkpointLocation", copy).trigger(availableNow=True).start()
    query.awaitTermination()
    lines = observed(query, name, rules)
    target.getFileSystem(conf).delete(target, True)
    return lines
