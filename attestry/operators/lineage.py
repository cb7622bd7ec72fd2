"""Lineage events of runs and jobs as JSON texts, with facets of data sets, runs and jobs.

Every facet that may be there is a field of one struct; ``to_json`` leaves out what is NULL, so
events of all kinds come from one plan. A date that a source does not declare is left out, never
made up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.scalars import NAMESPACE_URL, uuid5

#: Addresses of the event format (fixed values).
EVENT_SCHEMA = "https://openlineage.io/spec/2-0-2/OpenLineage.json"
JOB_TYPE_SCHEMA = "https://openlineage.io/spec/facets/2-0-3/JobTypeJobFacet.json"
RUN, JOB = "#/$defs/RunEvent", "#/$defs/JobEvent"


@dataclass(frozen=True)
class Names:
    """Who produces the events and in which namespaces jobs and data sets are named."""

    producer: str
    jobs: str
    snapshots: str
    artifacts: str
    facets: str

    def facet(self, name: str) -> list[Column]:
        return [F.lit(self.producer).alias("_producer"), F.lit(f"{self.facets}/{name}.json").alias("_schemaURL")]


def snapshot_facet(names: Names) -> Column:
    """Facet of a snapshot (columns of a manifest); its content's hash is its name."""
    columns = ("snapshot_file", "sha256", "source_url", "bytes", "retrieved_at", "source_as_of", "source", "register_id", "authority")
    return F.struct(*names.facet("snapshot"), *columns)


def artifact_facet(names: Names) -> Column:
    return F.struct(*names.facet("artifact"), "artifact_kind", "path", "sha256", "artifact_version", "result_sha256")


def datasets(names: Names, snapshots: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Data sets of both kinds: ref, and the struct that events carry."""
    made = lambda space, name, facets: F.struct(F.lit(space).alias("namespace"), name.alias("name"), facets.alias("facets")).alias("dataset")
    none = lambda like: F.lit(None).cast(like)
    s = snapshots.select("*", snapshot_facet(names).alias("_s"))
    a = artifacts.select("*", artifact_facet(names).alias("_a"))
    snapshot_type, artifact_type = s.schema["_s"].dataType, a.schema["_a"].dataType
    left = s.select("ref", made(names.snapshots, F.col("sha256"), F.struct(F.col("_s").alias("snapshot"), none(artifact_type).alias("artifact"))))
    return left.union(a.select("ref", made(names.artifacts, F.col("path"), F.struct(none(snapshot_type).alias("snapshot"), F.col("_a").alias("artifact")))))


def _sides(runs: DataFrame, sets: DataFrame) -> DataFrame:
    """Runs with their inputs and outputs as sorted arrays of data sets; refs are met by one join."""
    refs = runs.select("run", F.explode(F.concat(F.transform("inputs", lambda r: F.struct(F.lit("in").alias("side"), r.alias("ref"))), F.transform("outputs", lambda r: F.struct(F.lit("out").alias("side"), r.alias("ref"))))).alias("e")).select("run", "e.*")
    side = lambda s: F.sort_array(F.collect_list(F.when(F.col("side") == s, F.col("dataset")))).alias(f"{s}_sets")
    met = refs.join(sets, "ref", "left")
    missing = F.array_sort(F.collect_set(F.when(F.col("dataset").isNull(), F.col("ref")))).alias("missing")
    return runs.join(met.groupBy("run").agg(side("in"), side("out"), missing), "run", "left")


def events(runs: DataFrame, sets: DataFrame, names: Names) -> DataFrame:
    """Events of runs and jobs: file, event (JSON), missing.

    ``runs`` has run (unique), job, executed_at (text), observed_at, inputs and outputs (refs), and
    the contract's run_version, gate, input_sha256, output_sha256 and code_sha256. A run with a
    time of execution gives START and COMPLETE with one run id (by name, so the same every time);
    one without is told as a job, at the time when it was observed (G02). ``missing`` are refs that
    no data set has.
    """
    r = _sides(runs, sets)
    contract = F.struct(*names.facet("contract"), F.col("run").alias("run_name"), "run_version", "gate", "input_sha256", "output_sha256", "code_sha256")
    job_type = F.struct(F.lit(names.producer).alias("_producer"), F.lit(JOB_TYPE_SCHEMA).alias("_schemaURL"), F.lit("BATCH").alias("processingType"), F.lit("SPARK").alias("integration"), F.lit("TASK").alias("jobType"))
    ran = F.col("executed_at").isNotNull()
    kinds = F.when(ran, F.array(F.lit("START"), F.lit("COMPLETE"))).otherwise(F.array(F.lit(None).cast("string")))
    rows = r.select("*", contract.alias("_contract"), F.explode_outer(kinds).alias("kind"))
    run_id = uuid5(NAMESPACE_URL, F.concat(F.lit(f"{names.jobs}/"), "job", F.lit("/"), "run"))
    body = F.struct(
        F.coalesce("executed_at", "observed_at").alias("eventTime"), F.col("kind").alias("eventType"), F.lit(names.producer).alias("producer"), F.concat(F.lit(EVENT_SCHEMA), F.when(ran, RUN).otherwise(JOB)).alias("schemaURL"),
        F.struct(F.lit(names.jobs).alias("namespace"), F.col("job").alias("name"), F.struct(job_type.alias("jobType"), F.when(~ran, F.col("_contract")).alias("job_contract")).alias("facets")).alias("job"),
        F.when(ran, F.struct(run_id.alias("runId"), F.struct(F.col("_contract").alias("run_contract")).alias("facets"))).alias("run"),
        F.coalesce("in_sets", F.array().cast(r.schema["in_sets"].dataType)).alias("inputs"), F.coalesce("out_sets", F.array().cast(r.schema["out_sets"].dataType)).alias("outputs"),
    )
    file = F.concat_ws(".", "job", "run", F.coalesce(F.lower("kind"), F.lit("jobevent")), F.lit("json"))
    return rows.select(file.alias("file"), F.to_json(body).alias("event"), F.coalesce("missing", F.array().cast("array<string>")).alias("missing"))


def written(events_: DataFrame, path: str) -> None:
    """Events as lines of JSON files, partitioned by nothing: Spark names the files."""
    events_.select("event").write.mode("errorifexists").text(path)


def edges(events_: DataFrame) -> DataFrame:
    """input, job, output of every event that has both, read back from the events themselves."""
    dataset = "array<struct<namespace:string,name:string>>"
    e = events_.select(F.from_json("event", f"job struct<name:string>, inputs {dataset}, outputs {dataset}").alias("e")).select("e.*")
    return e.select(F.col("job.name").alias("job"), F.explode("inputs.name").alias("input"), "outputs").select("job", "input", F.explode("outputs.name").alias("output")).distinct()
