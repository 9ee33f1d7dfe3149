"""A store of rows by label to which runs append, each once however often it is repeated.

A run writes its files into a folder of that attempt, and then one line that names the folder: the run's manifest, put in place by
a rename, which is the commit. Readers go by the manifests, so a run that died midway has left nothing to be read and is
simply run again, and a run that is committed is not written a second time. ``compact`` rewrites many runs
as one, whose manifest says which ones it replaces.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkloom.sinks.files import overwrite_by_label

_MANIFESTS = "_manifests"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest_name(run: str) -> str:
    # Any name may be given to a run; a file name holds hex digits alone.
    return run.encode().hex() + ".json"


def committed(spark: SparkSession, path: str) -> dict[str, dict]:
    """Manifest of each committed run: its folder and the runs it replaces."""
    folder, fs = _path(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(folder):
        return {}
    # One short line for each run.
    lines = spark.read.option("pathGlobFilter", "*.json").text(folder.toString()).collect()
    return {m["run"]: m for m in (json.loads(r[0]) for r in lines)}


def is_committed(spark: SparkSession, path: str, run: str) -> bool:
    manifest, fs = _path(spark, f"{path}/{_MANIFESTS}/{_manifest_name(run)}")
    return fs.exists(manifest)


def _commit(spark: SparkSession, path: str, run: str, folder: str, replaces: list[str]) -> bool:
    """Put the manifest in place; False where another attempt of the run came first."""
    manifest, fs = _path(spark, f"{path}/{_MANIFESTS}/{_manifest_name(run)}")
    draft, _ = _path(spark, f"{path}/{_MANIFESTS}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray((json.dumps({"run": run, "folder": folder, "replaces": replaces}) + "\n").encode()))
    out.close()
    # Renaming onto an existing file fails or moves nothing.
    if not fs.exists(manifest) and fs.rename(draft, manifest):
        return True
    fs.delete(draft, False)
    return False


def append_run(df: DataFrame, path: str, run: str, label: str = "predicted_lid", fmt: str = "json", replaces: list[str] | None = None) -> bool:
    """Append the rows of a run under their labels; False, and nothing written, where the run is committed already."""
    spark = df.sparkSession
    if is_committed(spark, path, run):
        return False
    folder = f"data/{uuid.uuid4().hex}"
    overwrite_by_label(df, f"{path}/{folder}", label, fmt)
    return _commit(spark, path, run, folder, replaces or [])


def read_runs(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """Rows of all committed runs, those of replaced runs once; ``schema`` names the label too."""
    manifests = committed(spark, path)
    replaced = {run for m in manifests.values() for run in m["replaces"]}
    folders = [m["folder"] for run, m in manifests.items() if run not in replaced]
    # A run without rows has no label folder.
    held = [f for f in folders if _has_labels(spark, f"{path}/{f}")]
    if not held:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).format(fmt).option("pathGlobFilter", "part-*")
    if len(held) == 1:
        return reader.load(f"{path}/{held[0]}")
    parts = [reader.option("basePath", f"{path}/{f}").load(f"{path}/{f}") for f in held]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _has_labels(spark: SparkSession, path: str) -> bool:
    pattern, fs = _path(spark, f"{path}/*=*")
    found = fs.globStatus(pattern)
    return found is not None and len(found) > 0


def compact(spark: SparkSession, path: str, schema: str, label: str = "predicted_lid", fmt: str = "json") -> str | None:
    """Rewrite all committed runs as one with few files for each label; its name, or None where there is but one."""
    manifests = committed(spark, path)
    replaced = {run for m in manifests.values() for run in m["replaces"]}
    current = sorted(run for run in manifests if run not in replaced)
    if len(current) < 2:
        return None
    run = f"compacted-{uuid.uuid4().hex}"
    append_run(read_runs(spark, path, schema, fmt), path, run, label, fmt, current)
    return run
