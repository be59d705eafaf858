"""Named, resumable stages: compute once, write Parquet to the shared
folder, read back on later runs."""

from __future__ import annotations

import functools
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS"))


def stage_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def checkpoint_stage(root: str, name: str):
    """Decorator: ``fn(spark, ...) -> DataFrame`` runs only when the stage's
    output (marked complete by ``_SUCCESS``) is absent; otherwise the stored
    result is read back.  Writes are whole-job commits, so a lost executor
    or a crash leaves no half stage that would be mistaken for done."""

    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, *a, **kw) -> DataFrame:
            path = stage_path(root, name)
            if not _exists(spark, path):
                fn(spark, *a, **kw).write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)

        run.stage_name = name
        return run

    return deco


def resume_report(spark: SparkSession, root: str, names: list[str]) -> list[tuple[str, bool]]:
    """Which named stages are already complete."""
    return [(n, _exists(spark, stage_path(root, n))) for n in names]


# --- content-keyed stages -----------------------------------------------------------------------


def files_key(df: DataFrame) -> str:
    """Digest of what a DataFrame reads: its files with length and change
    time, and its columns. It changes when an input is written anew."""
    spark = df.sparkSession
    files = sorted(df.inputFiles())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for f in files:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        s = p.getFileSystem(conf).getFileStatus(p)
        seen.append((f, s.getLen(), s.getModificationTime()))
    return hashlib.sha256(json.dumps([seen, df.schema.jsonValue()]).encode()).hexdigest()


class StageStore:
    """Stages under ``root``, each keyed by its name, its settings and the
    keys of what it reads, so a stage is found again exactly if nothing that
    it depends on has changed, in any session. A stage holds named tables
    (Parquet, committed as a whole) or a fitted model; it counts as done once
    its ``DONE`` marker, written last, is there."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.computed: list[str] = []  # names of the stages that this store ran

    def key(self, name: str, settings: dict, inputs: list[str]) -> str:
        text = json.dumps([name, settings, inputs], sort_keys=True)
        return hashlib.sha256(text.encode()).hexdigest()

    def _folder(self, name: str, key: str) -> str:
        return f"{self.root}/{name}-{key[:24]}"

    def _mark(self, folder: str, text: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(f"{folder}/DONE")
        out = p.getFileSystem(conf).create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _read_mark(self, folder: str) -> str | None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(f"{folder}/DONE")
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            return None
        f = fs.open(p)
        text = bytes(f.readAllBytes()).decode()
        f.close()
        return text

    def done(self, name: str, settings: dict, inputs: list[str]) -> bool:
        return self._read_mark(self._folder(name, self.key(name, settings, inputs))) is not None

    def tables(self, name: str, settings: dict, inputs: list[str], compute) -> tuple[str, dict[str, DataFrame]]:
        """The stage's key and tables. ``compute()`` gives a dict of
        DataFrames and runs only if the stage is not done; the marker holds
        the schemas, so reading a finished stage starts no job."""
        key = self.key(name, settings, inputs)
        folder = self._folder(name, key)
        mark = self._read_mark(folder)
        if mark is None:
            self.computed.append(name)
            made = compute()
            for t, df in made.items():
                df.write.mode("overwrite").parquet(f"{folder}/{t}")
            mark = json.dumps({t: df.schema.jsonValue() for t, df in made.items()})
            self._mark(folder, mark)
        schemas = json.loads(mark)
        return key, {t: self.spark.read.schema(StructType.fromJson(s)).parquet(f"{folder}/{t}") for t, s in schemas.items()}

    def model(self, name: str, settings: dict, inputs: list[str], compute):
        """The stage's key and fitted forest, trained only if it is not stored."""
        from pyspark.ml import PipelineModel

        from locusframe.operators.task_forest import TaskForest
        key = self.key(name, settings, inputs)
        folder = self._folder(name, key)
        mark = self._read_mark(folder)
        if mark is None:
            self.computed.append(name)
            made = compute()
            if isinstance(made, TaskForest):
                made.save(f"{folder}/model")
            else:
                made.write().overwrite().save(f"{folder}/model")
            mark = "forest" if isinstance(made, TaskForest) else "model"
            self._mark(folder, mark)
        return key, TaskForest.load(self.spark, f"{folder}/model") if mark == "forest" else PipelineModel.load(f"{folder}/model")
