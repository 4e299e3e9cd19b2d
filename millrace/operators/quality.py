"""Named expectations over tables and streams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.columns import json_path

ACTIONS = ("keep", "drop", "fail")
# Fixed value: one expectation inside a quality event, as a sample to take the type from.
EXPECTATION_SAMPLE = (
    "[{'name':'str', 'dataset':'str', 'passed_records':42, 'failed_records':42}]"
)


@dataclass(frozen=True)
class Rule:
    """A condition every row should meet. A NULL result counts as a violation.

    ``on_violation``: ``keep`` counts the row, ``drop`` removes it, ``fail`` stops the
    job before anything is committed.
    """

    name: str
    condition: Column | str
    on_violation: str = "keep"

    def __post_init__(self):
        if self.on_violation not in ACTIONS:
            raise ValueError(f"on_violation must be one of {ACTIONS}")

    def holds(self) -> Column:
        test = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return F.coalesce(test, F.lit(False))


def expect(
    df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None
) -> DataFrame:
    """Apply the rules' actions.

    With an observation (a name on streams), pass and fail counts of every rule over
    the rows that came in are gathered in the same pass, as ``passed_<i>``/``failed_<i>``
    in rule order, together with ``rows``.
    """
    if observation is not None:
        counts = [F.count(F.lit(1)).alias("rows")]
        for i, rule in enumerate(rules):
            counts.append(F.count_if(rule.holds()).alias(f"passed_{i}"))
            counts.append(F.count_if(~rule.holds()).alias(f"failed_{i}"))
        df = df.observe(observation, *counts)
    for rule in rules:
        if rule.on_violation == "fail":
            stop = F.raise_error(F.lit(f"expectation failed: {rule.name}")).cast("boolean")
            df = df.where(F.when(rule.holds(), True).otherwise(stop))
    for rule in rules:
        if rule.on_violation == "drop":
            df = df.where(rule.holds())
    return df


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that violate at least one rule, with the names of the broken rules."""
    broken = F.filter(
        F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]), lambda n: n.isNotNull()
    )
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


# The columns of a report.
REPORT = (
    "dataset string, name string, on_violation string, passed_records long, failed_records long, dropped_records long"
)


def quality_report(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per rule: passed, failed and dropped records, from a single aggregation."""
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(r.holds()).alias(f"passed_{i}") for i, r in enumerate(rules)]
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(r.name).alias("name"),
            F.lit(r.on_violation).alias("on_violation"),
            F.col(f"passed_{i}").alias("passed_records"),
            (F.col("rows") - F.col(f"passed_{i}")).alias("failed_records"),
            (
                F.col("rows") - F.col(f"passed_{i}")
                if r.on_violation == "drop"
                else F.lit(0).cast("long")
            ).alias("dropped_records"),
        )
        for i, r in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def quality_events(report: DataFrame, event_id: str, output_rows: Column | None = None) -> DataFrame:
    """Pack a report into one event per dataset with JSON ``details``.

    A report has one line per rule of a dataset, so the list in an event is as long as
    the dataset's list of rules.
    """
    line = F.struct("name", "dataset", "passed_records", "failed_records")
    grouped = report.groupBy("dataset").agg(
        F.sort_array(F.collect_list(line)).alias("expectations"),
        F.sum("dropped_records").alias("dropped_records"),
        F.max(F.col("passed_records") + F.col("failed_records")).alias("rows"),
    )
    details = F.struct(
        F.struct(
            F.struct((output_rows if output_rows is not None else F.col("rows")).alias("num_output_rows")).alias("metrics"),
            F.struct("dropped_records", "expectations").alias("data_quality"),
        ).alias("flow_progress")
    )
    return grouped.select(
        F.concat(F.lit(event_id), F.lit("-"), F.col("dataset")).alias("id"),
        F.current_timestamp().alias("timestamp"),
        F.to_json(details).alias("details"),
    )


def parse_quality_events(events: DataFrame) -> DataFrame:
    """Pass and fail counts per expectation from events with JSON ``details``.

    Events without progress metrics are skipped.
    """
    listed = F.from_json(
        json_path("details", "flow_progress.data_quality.expectations"),
        F.schema_of_json(EXPECTATION_SAMPLE),
    )
    return (
        events.where(json_path("details", "flow_progress.metrics").isNotNull())
        .select("id", F.explode(listed).alias("expectation"))
        .select(
            "id",
            "expectation.dataset",
            "expectation.name",
            "expectation.failed_records",
            "expectation.passed_records",
        )
    )
