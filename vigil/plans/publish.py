"""Atomic publishing of the batch jobs' tables.

A run writes all its tables into a folder of its own, ``runs/N-...``.  When
every job has succeeded, one rename publishes ``current/N.json``, which names
the run.  Readers resolve the pointer when they open, so they see the tables of
one run: a failed run changes nothing that is served, and a run that is
published meanwhile leaves open readers their files, as the last ``keep`` runs
stay.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from vigil.plans import jobs
from vigil.streaming.folder import Folder


def _pointers(folder: Folder) -> list[str]:
    return [n for n in folder.names("current") if n.endswith(".json")]


def served_folder(spark: SparkSession, root: str) -> str:
    """Folder of the published run; ``root`` itself where nothing was published (tables written in place)."""
    folder = Folder(spark, root)
    names = _pointers(folder)
    return f"{folder.path}/runs/{json.loads(folder.read(f'current/{names[-1]}'))['run']}" if names else folder.path


def publish_all(spark: SparkSession, logs: DataFrame, root: str, only=None, serving: bool = False, keep: int = 2) -> dict[str, str]:
    """Runs the jobs into a new folder and publishes it if all succeed; returns the jobs' status (see ``jobs.run_all``)."""
    folder = Folder(spark, root)
    names = _pointers(folder)
    number = int(names[-1][:-5]) + 1 if names else 1
    run = f"{number:06d}-{uuid.uuid4().hex[:8]}"
    status = jobs.run_all(spark, logs, f"{folder.path}/runs/{run}", only, serving)
    if not status or any(s != "ok" for s in status.values()):
        folder.delete(f"runs/{run}")
        return status
    folder.publish(f"current/{number:06d}.json", json.dumps({"run": run, "jobs": sorted(status)}))
    old = _pointers(folder)[:-keep]
    for name in old:
        gone = json.loads(folder.read(f"current/{name}"))["run"]
        folder.delete(f"current/{name}")
        folder.delete(f"runs/{gone}")
    return status
