"""Sinks."""

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclens import contracts
from civiclens.scratch import discard, materialise
from civiclens.sources.readers import read_csv, read_features

FEATURES_PER_FILE = 50_000


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def csv_to_parquet(spark: SparkSession, folders: Mapping[str, str]) -> None:
    """Convert each CSV path to a Parquet folder. All columns stay text."""
    for csv_path, parquet_path in folders.items():
        write_parquet(read_csv(spark, csv_path), parquet_path)


def convert_new(
    spark: SparkSession, paths: Sequence[str], target: str, read: Callable[[SparkSession, str], DataFrame] = read_csv
) -> list[str]:
    """Convert those of the inputs that ``target`` does not have yet, or has in another state, and return them.

    Each input (a file or a folder) becomes a Parquet folder of its own. When all are written, a manifest that
    names every input with its size, time of change and folder takes the place of the last one in one step.
    :func:`read_converted` reads what the manifest names, so a run that fails at any point changes nothing
    for readers, and the next one does its work again. Folders that no manifest has named since are removed by the
    next run. One run at a time.
    """
    files = _Files(spark, target)
    manifest = files.manifest()
    kept = {entry["folder"] for entry in manifest.values()}
    files.remove_all_but(kept)
    states = {path: files.state(path) for path in dict.fromkeys(paths)}
    new = [p for p, s in states.items() if {k: manifest.get(p, {}).get(k) for k in s} != s]
    entries = dict(manifest)
    for path in new:
        folder = f"input-{uuid.uuid4().hex}"
        read(spark, path).write.parquet(f"{target}/{folder}")
        if files.state(path) != states[path]:
            raise ValueError(f"{path} changed while it was converted")
        entries[path] = {**states[path], "folder": folder}
    if new:
        files.publish(entries)
    return new


def read_converted(spark: SparkSession, target: str) -> DataFrame:
    """All rows of the inputs that the manifest of ``target`` names, matched by column name."""
    folders = [f"{target}/{entry['folder']}" for entry in _Files(spark, target).manifest().values()]
    if not folders:
        raise ValueError(f"nothing has been converted to {target}")
    whole = spark.read.parquet(folders[0])
    for folder in folders[1:]:
        whole = whole.unionByName(spark.read.parquet(folder), allowMissingColumns=True)
    return whole


class _Files:
    """The folder of a conversion in any file system that Spark knows."""

    _MANIFEST = "_manifest.json"

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target
        self.fs = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        path = self.fs.Path(name)
        return path, path.getFileSystem(self.conf)

    def state(self, name: str) -> dict[str, int]:
        """Size and last change of a file, or of all files of a folder."""
        path, system = self._path(name)
        pending, size, changed = [system.getFileStatus(path)], 0, 0
        while pending:
            status = pending.pop()
            changed = max(changed, status.getModificationTime())
            if status.isDirectory():
                pending += list(system.listStatus(status.getPath()))
            else:
                size += status.getLen()
        return {"size": size, "changed": changed}

    def manifest(self) -> dict[str, dict]:
        path, system = self._path(f"{self.target}/{self._MANIFEST}")
        if not system.exists(path):
            return {}
        stream = system.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def remove_all_but(self, kept: set[str]) -> None:
        path, system = self._path(self.target)
        for status in system.listStatus(path) if system.exists(path) else ():
            name = status.getPath().getName()
            if name not in kept and (name.startswith("input-") or name.startswith(f"{self._MANIFEST}.")):
                system.delete(status.getPath(), True)

    def publish(self, entries: dict[str, dict]) -> None:
        path, system = self._path(f"{self.target}/{self._MANIFEST}")
        staged = self.fs.Path(f"{self.target}/{self._MANIFEST}.{uuid.uuid4().hex}")
        stream = system.create(staged, False)
        stream.write(bytearray(json.dumps(entries, indent=1, sort_keys=True).encode()))
        stream.close()
        context = self.fs.FileContext.getFileContext(path.toUri(), self.conf)
        options = self.spark.sparkContext._gateway.new_array(self.fs.Options.Rename, 1)
        options[0] = self.fs.Options.Rename.OVERWRITE
        context.rename(system.makeQualified(staged), system.makeQualified(path), options)


def features_to_parquet(
    spark: SparkSession,
    path: str,
    target: str,
    properties: T.StructType = contracts.BLOCK_PROPERTIES,
) -> None:
    """Convert GeoJSON files to Parquet once; queries over it are not bound to a task per file."""
    write_parquet(read_features(spark, path, properties), target)


def write_rows(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """All rows of a result as CSV with a header, or Parquet; what is there is replaced."""
    if fmt == "parquet":
        write_parquet(df, path)
    else:
        df.write.mode("overwrite").csv(path, header=True, escape='"')


def _feature(df: DataFrame, number: str) -> Column:
    properties = F.struct(*[F.col(f"`{name}`") for name in df.columns if name != number])
    return F.struct(F.lit("Feature").alias("type"), properties.alias("properties"))


def write_features(df: DataFrame, path: str, number: str) -> None:
    """Write rows as GeoJSON, one FeatureCollection per file.

    ``number`` is a whole-number column without duplicates. Rows go to files by
    its ranges, so that no document has over ``FEATURES_PER_FILE`` features; if repeated or missing
    numbers would make one larger, a ``ValueError`` is raised before anything is written.
    """
    file = F.floor(F.col(f"`{number}`") / FEATURES_PER_FILE).alias("file")
    largest = df.groupBy(file).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if (largest or 0) > FEATURES_PER_FILE:
        raise ValueError(f"{number} is missing or repeated too often: a document would have {largest} features")
    documents = df.groupBy(file).agg(F.collect_list(_feature(df, number)).alias("features"))
    text = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"))
    documents.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def write_feature_document(df: DataFrame, path: str, number: str) -> None:
    """Write rows as one GeoJSON document in one file, in order of ``number``.

    Many tasks sort the features and write them in parts; a last task takes these in their order, feature by
    feature. It sorts nothing, so it holds none of the document in memory however large that is.
    """
    rows = df.select(F.struct(F.lit(1).alias("part"), F.col(f"`{number}`").alias("at")).alias("place"),
                     F.to_json(_feature(df, number)).alias("value"))
    first = rows.agg(F.min("place")).scalar()
    value = F.when(F.col("place") == first, F.col("value")).otherwise(F.concat(F.lit(","), "value"))
    rows = rows.select("place", value.alias("value"))
    ends = df.sparkSession.sql(
        """SELECT * FROM VALUES (0, '{"type":"FeatureCollection","features":['), (2, ']}') AS ends(part, value)"""
    )
    ends = ends.select(
        F.struct("part", F.lit(None).cast(df.schema[number].dataType).alias("at")).alias("place"), "value"
    )
    parts = materialise(rows.unionByName(ends).orderBy("place", "value").select("value"), "sorted-features")
    _in_order(parts).coalesce(1).write.option("lineSep", " ").text(path)
    discard(parts)


def _in_order(parts: DataFrame) -> DataFrame:
    """A written table, its files in the order of the tasks that wrote them."""
    files = sorted((name.rsplit("/", 1)[-1] for name in parts.inputFiles()), key=lambda n: (int(n.split("-")[1]), n))
    reader = parts.sparkSession.read.schema(parts.schema)
    return reduce(DataFrame.union, [reader.parquet(f"{parts.scratch_path}/{name}") for name in files])
