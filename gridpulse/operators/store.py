"""A store of versioned models with a manifest that is replaced in one step.

A version is a folder that is complete before the manifest names it; the manifest is written beside itself and renamed over
the old one, so a reader sees the old or the new, never a part. Paths are those of Spark's file systems; versions are never
overwritten, so a stream that still scores with an older one finds it. A model that the gate refuses is kept for
inspection, and the manifest doesn't change.

Edge cases: a store without a manifest has no current version; a name must not hold a slash; two publishers of one name at
a time aren't told apart: the last rename counts, and both versions stay.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class ModelStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def manifest(self) -> dict:
        """What is current: for each name its version, path and facts."""
        path = self._path(f"{self.folder}/manifest.json")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return {}
        return json.loads(self.spark.read.text(f"{self.folder}/manifest.json", wholetext=True).first()[0])

    def current(self, name: str) -> dict | None:
        return self.manifest().get(name)

    def version(self) -> str:
        """Changes with the manifest; for `streams.Versioned`."""
        return ",".join(f"{k}={v['version']}" for k, v in sorted(self.manifest().items()))

    def _replace(self, manifest: dict) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        part, whole = self._path(f"{self.folder}/.manifest-{uuid.uuid4()}"), self._path(f"{self.folder}/manifest.json")
        stream = part.getFileSystem(conf).create(part)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.getFileSystem(conf).getUri(), conf)
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(part, whole, options)

    def publish(self, name: str, write: Callable[[str], None], facts: dict | None = None, accepted: bool = True) -> dict:
        """Writes a version with ``write``, which is given a new folder, and makes it current if it is accepted."""
        if "/" in name:
            raise ValueError("a name without slashes")
        before = self.manifest()
        version = before.get(name, {}).get("version", 0) + 1
        path = f"{self.folder}/{name}/v{version}-{uuid.uuid4()}"
        write(path)
        entry = {"version": version, "path": path, "facts": facts or {}}
        if accepted:
            self._replace(self.manifest() | {name: entry})
        return entry | {"accepted": accepted}


def gated(store: ModelStore, name: str, held_out: DataFrame, label: str, new, load: Callable[[str], object], tolerance: float = 0.02) -> dict:
    """Publishes a model with ``save`` and ``score`` unless it is worse than the current one on held-out rows, by more than
    the tolerance. The accuracies are facts of the version."""
    from .evaluate import accept_model

    now = store.current(name)
    scored = new.score(held_out).withColumnRenamed("predicted_root_cause", "__new").drop("confidence")
    if now:
        scored = load(now["path"]).score(scored).withColumnRenamed("predicted_root_cause", "__old")
    result = accept_model(scored, label, "__old" if now else "__new", "__new", tolerance).first()
    facts = {"accuracy": result.new_accuracy, "before": result.old_accuracy if now else None}
    return store.publish(name, lambda path: new.save(store.spark, path), facts, accepted=now is None or bool(result.accepted))
