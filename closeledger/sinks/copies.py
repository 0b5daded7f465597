"""Byte copies of written folders, and one CSV file out of many parts.

``copy_folder`` copies the data files of a folder to any number of targets.
Executors read every file once, in pieces, and write each piece to all targets,
hashing it on the way; a second pass reads the copies back and holds length and
SHA-256 of each against the manifest.  The copies are made beside their targets
and put in place by renames when all of them are complete, so a failure before
that leaves every target as it was.  A task that runs again writes its file under
another name and moves it over the first, so retries change nothing.

``one_csv_file`` turns header-less CSV parts, written in parallel, into one file
with one header.  Where the file system can concatenate (HDFS), no byte is moved;
elsewhere one task streams the bytes of the parts, without parsing them.

Files are opened with ``pyarrow.fs`` in the tasks (local, HDFS, S3, GCS), so no
data passes through the driver; listings and renames go through Hadoop's own
file system, as Spark's commits do.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closeledger.session import ensure_checkpoint_dir, ship_package

PIECE = 4 << 20
MANIFEST = "_manifest"


def hadoop_path(spark: SparkSession, path: str):  # noqa: ANN201
    """Hadoop's file system of a path, and the path with scheme and folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(place)


def open_uri(uri: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))


def _beside(uri: str, run: str) -> str:
    """A hidden folder next to a target."""
    parent, name = uri.rstrip("/").rsplit("/", 1)
    return f"{parent}/_copying-{run}-{name}"


def data_files(spark: SparkSession, uri: str) -> DataFrame:
    """(file, bytes) of the data files under a folder, names relative to it."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(uri)
    strip = len(re.sub("^file:/+", "file:/", uri.rstrip("/"))) + 2
    plain = F.regexp_replace("path", "^file:/+", "file:/")
    return listed.select(F.expr("path").alias("path"), F.col("length").alias("bytes")).select(F.substring(plain, strip, 1 << 20).alias("file"), "bytes")


def _pieces(uri: str) -> Iterator[bytes]:
    files, path = open_uri(uri)
    with files.open_input_stream(path, compression=None) as stream:
        while piece := stream.read(PIECE):
            yield piece


def _per_file(files: DataFrame, work: Callable[[str], Iterator[tuple[str, str, int, str]]]) -> DataFrame:
    """Rows (target, file, bytes, sha256) that ``work`` gives for each file."""
    ship_package(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                columns = zip(*work(name), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["target", "file", "bytes", "sha256"])

    tasks = files.select("file").repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")
    return tasks.mapInArrow(run, "target string, file string, bytes long, sha256 string")


def checksums(spark: SparkSession, uris: Sequence[str], files: DataFrame) -> DataFrame:
    """(target, file, bytes, sha256) of ``files`` as they lie in each folder."""
    folders = [u.rstrip("/") for u in uris]

    def work(name: str) -> Iterator[tuple[str, str, int, str]]:
        for folder in folders:
            seen, n = hashlib.sha256(), 0
            for piece in _pieces(f"{folder}/{name}"):
                seen.update(piece)
                n += len(piece)
            yield folder, name, n, seen.hexdigest()

    return _per_file(files, work)


def copy_folder(spark: SparkSession, source: str, targets: Sequence[str]) -> DataFrame:
    """Replace each target by a copy of ``source``; the manifest (file, bytes,
    sha256), which every folder also holds as ``_manifest``."""
    run = uuid.uuid4().hex
    source = hadoop_path(spark, source)[1].toString()
    targets = [hadoop_path(spark, t)[1].toString() for t in targets]
    if source in targets or len(set(targets)) < len(targets):
        raise ValueError("a folder cannot be copied onto itself, nor twice to one target")
    stages = [_beside(t, run) for t in targets]
    ensure_checkpoint_dir(spark)
    files = data_files(spark, source)

    def work(name: str) -> Iterator[tuple[str, str, int, str]]:
        outs = []
        for stage in stages:
            at, path = open_uri(f"{stage}/{name}")
            at.create_dir(path.rsplit("/", 1)[0], recursive=True)
            own = f"{path}.{uuid.uuid4().hex}"
            outs.append((at, path, own, at.open_output_stream(own, compression=None)))
        seen, n = hashlib.sha256(), 0
        for piece in _pieces(f"{source}/{name}"):
            seen.update(piece)
            n += len(piece)
            for *_, out in outs:
                out.write(piece)
        for at, path, own, out in outs:
            out.close()
            if at.get_file_info(path).is_file:
                at.delete_file(path)
            at.move(own, path)
        yield source, name, n, seen.hexdigest()

    made = _per_file(files, work).checkpoint(eager=True)
    lengths = made.join(files.withColumnRenamed("bytes", "listed"), "file", "full").where("listed is null or bytes is null or listed <> bytes")
    again = checksums(spark, stages, made).withColumnsRenamed({"bytes": "n", "sha256": "found"})
    wrong = again.join(made.drop("target"), "file").where("n <> bytes or found <> sha256")
    for bad in (lengths.select("file").first(), wrong.select("file").first()):
        if bad is not None:
            raise OSError(f"copy of {bad['file']} differs from {source}")
    manifest = made.select("file", "bytes", "sha256")
    for folder in (*stages, source):
        manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/{MANIFEST}")
    for stage, target in zip(stages, targets, strict=True):
        put_in_place(spark, stage, target)
    return manifest


def put_in_place(spark: SparkSession, stage: str, target: str) -> None:
    """Replace a folder by a finished one that lies beside it."""
    files, place = hadoop_path(spark, target)
    made = hadoop_path(spark, stage)[1]
    files.create(hadoop_path(spark, f"{stage}/_SUCCESS")[1], True).close()
    files.delete(place, True)
    if not files.rename(made, place):
        raise OSError(f"{stage} could not be renamed to {target}")


def differences(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder that are not as its manifest says (none: intact)."""
    uri = hadoop_path(spark, folder)[1].toString()
    told = spark.read.schema("file string, bytes long, sha256 string").json(f"{uri}/{MANIFEST}")
    here = data_files(spark, uri)
    now = checksums(spark, [uri], here).select("file", F.col("bytes").alias("n"), F.col("sha256").alias("found"))
    return told.join(now, "file", "full").where("n is null or bytes is null or n <> bytes or found <> sha256").select("file")


def one_csv_file(spark: SparkSession, parts: str, header: bytes, target: str, name: str = "part-00000.csv") -> None:
    """Replace ``target`` by a folder with one file: ``header`` and the data
    files of the folder ``parts``, in order of their names; ``parts`` goes."""
    run = uuid.uuid4().hex
    parts = hadoop_path(spark, parts)[1].toString()
    files, place = hadoop_path(spark, target)
    stage = _beside(place.toString(), run)
    # one name per part: as many as the write had tasks
    names = [r["file"] for r in data_files(spark, parts).where("bytes > 0").orderBy("file").select("file").collect()]
    out = files.create(hadoop_path(spark, f"{stage}/{name}")[1], True)
    out.write(bytearray(header))
    out.close()
    if names:
        array = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(names))
        for i, n in enumerate(names):
            array[i] = hadoop_path(spark, f"{parts}/{n}")[1]
        try:
            files.concat(hadoop_path(spark, f"{stage}/{name}")[1], array)
        except UnsupportedOperationException:
            files.delete(hadoop_path(spark, f"{stage}/{name}")[1], False)
            _stream(spark, parts, names, header, f"{stage}/{name}")
    put_in_place(spark, stage, target)
    files.delete(hadoop_path(spark, parts)[1], True)


def _stream(spark: SparkSession, parts: str, names: list[str], header: bytes, uri: str) -> None:
    """One task writes header and parts as bytes to one file."""
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, path = open_uri(uri)
        for _ in batches:
            pass
        own, n = f"{path}.{uuid.uuid4().hex}", len(header)
        with at.open_output_stream(own, compression=None) as out:
            out.write(header)
            for name in names:
                for piece in _pieces(f"{parts}/{name}"):
                    out.write(piece)
                    n += len(piece)
        if at.get_file_info(path).is_file:
            at.delete_file(path)
        at.move(own, path)
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["bytes"])

    spark.range(1).coalesce(1).mapInArrow(run, "bytes long").collect()
