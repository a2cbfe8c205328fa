"""Staged commit of a run's output (S9, S10, O10): write aside, swap at once, resume after a stop.

``out_dir`` holds one folder per run under ``runs`` and a manifest that names the
committed run and its stages.  A run writes its stages into its own folder, a marker after
each; when all are there the manifest is replaced by one rename.  Until then readers see the
old output whole.  A run that stopped is found again by its fingerprint, and
only its missing stages are written.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from wardflow.sources.sinks import read_stage, write_stage

MANIFEST = "_manifest.json"


class Folder:
    """Small files of one folder on any file system that Spark knows (Hadoop's API on the driver)."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.conf, self.base = spark._jvm, spark._jsc.hadoopConfiguration(), base.rstrip("/")
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def read(self, name: str) -> dict | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, content: dict) -> None:
        """Write aside and rename, so that a reader finds the old content or the new one."""
        aside = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(aside), True)
        try:
            stream.write(json.dumps(content).encode())
        finally:
            stream.close()
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(
            self.path(aside), self.path(name), options)

    def names(self, name: str) -> list[str]:
        if not self.fs.exists(self.path(name)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name)))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


@dataclass(frozen=True)
class StageInfo:
    path: str
    fmt: str
    rows: int
    schema: str  # JSON

    def read(self, spark: SparkSession) -> DataFrame:
        return read_stage(spark, self.path, StructType.fromJson(json.loads(self.schema)), self.fmt)


class StagedRun:
    """One run into ``out_dir``; the run of the same ``fingerprint`` that stopped earlier, if there is one."""

    def __init__(self, spark: SparkSession, out_dir: str, fingerprint: str):
        self.spark, self.folder = spark, Folder(spark, out_dir)
        manifest = self.folder.read(MANIFEST)
        self.committed = manifest["run"] if manifest else None
        self.run = None
        for name in self.folder.names("runs"):
            mark = self.folder.read(f"runs/{name}/_run.json") if name != self.committed else None
            if mark and mark["fingerprint"] == fingerprint:
                self.run = name
        if self.run is None:
            self.run = uuid.uuid4().hex
            self.folder.write(f"runs/{self.run}/_run.json", {"fingerprint": fingerprint})
        self.resumed = frozenset(self.stages())

    def stages(self) -> dict[str, StageInfo]:
        """The complete stages of this run."""
        names = [n[:-len(".json")] for n in self.folder.names(f"runs/{self.run}/_done") if n.endswith(".json")]
        return {n: StageInfo(**self.folder.read(f"runs/{self.run}/_done/{n}.json")) for n in names}

    def write(self, name: str, df: DataFrame, fmt: str = "parquet") -> StageInfo:
        """Write a stage and mark it; what a stopped attempt left of it is replaced.  Rows are counted while writing."""
        path = f"{self.folder.base}/runs/{self.run}/{name}"
        seen = Observation()
        write_stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt)
        info = StageInfo(path, fmt, int(seen.get["rows"]), df.schema.json())
        self.folder.write(f"runs/{self.run}/_done/{name}.json", info.__dict__)
        return info

    def commit(self, names: list[str]) -> None:
        """Make the stages ``names`` the output; the folders of other runs go, and tables that only served the run."""
        done = self.stages()
        missing = [n for n in names if n not in done]
        if missing:
            raise RuntimeError(f"stages not written: {', '.join(missing)}")
        self.folder.write(MANIFEST, {"run": self.run, "stages": {n: done[n].__dict__ for n in names}})
        for name in set(done) - set(names):
            self.folder.delete(f"runs/{self.run}/{name}")
            self.folder.delete(f"runs/{self.run}/_done/{name}.json")
        for name in self.folder.names("runs"):
            if name != self.run:
                self.folder.delete(f"runs/{name}")


def output(spark: SparkSession, out_dir: str) -> dict[str, StageInfo]:
    """The committed stages of ``out_dir``; none before the first commit."""
    manifest = Folder(spark, out_dir).read(MANIFEST)
    return {n: StageInfo(**s) for n, s in manifest["stages"].items()} if manifest else {}


def read_output(spark: SparkSession, out_dir: str, stage: str) -> DataFrame:
    """One committed stage."""
    return output(spark, out_dir)[stage].read(spark)
