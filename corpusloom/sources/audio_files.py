"""Export of payloads to one file per row: staged by a data source writer, published by tasks.

The write job stages every file under a hidden folder of the export and lists what each task staged;
only the lists of committed tasks count, and an aborted job removes the whole folder, so a failed task
leaves nothing behind. A second job moves the listed files to their names. A move is atomic on file
systems with renames and may be repeated, so readers never see part of a file.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from corpusloom.functions.files import resolve
from corpusloom.session import broadcast_if_small

FORMAT = "corpusloom_files"
WRITTEN, NO_BYTES, DUPLICATE, BAD_NAME = "written", "no_bytes", "duplicate", "bad_name"
_OWN = ("_name", "_payload", "_own")


@dataclass
class _Staged(WriterCommitMessage):
    listing: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Staged:
        context = TaskContext.get()
        task = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        store, root = resolve(self.root)
        # Fails where the job was aborted meanwhile: a late task must not make the folder again.
        store.create_dir(f"{root}/files/{task}", recursive=False)
        listing, listed, count = f"{root}/lists/{task}.parquet", None, 0
        with store.open_output_stream(listing) as out:
            for batch in iterator:
                staged, status = [], []
                for name, payload, own in zip(*(batch.column(c) for c in _OWN)):
                    state = _state(name.as_py(), payload, own.as_py())
                    path = None
                    if state == WRITTEN:
                        path = f"{root}/files/{task}/{count}"
                        count += 1
                        with store.open_output_stream(path) as file:
                            file.write(payload.as_buffer())
                    staged.append(path)
                    status.append(state)
                kept = batch.drop_columns(["_payload", "_own"])
                kept = pa.Table.from_batches([kept]).append_column("_staged", pa.array(staged, pa.string()))
                kept = kept.append_column("status", pa.array(status, pa.string()))
                listed = listed or pq.ParquetWriter(out, kept.schema)
                listed.write_table(kept)
            if listed:
                listed.close()
        return _Staged(listing if listed else "")

    def commit(self, messages: list[_Staged | None]) -> None:
        store, root = resolve(self.root)
        with store.open_output_stream(f"{root}/committed.json") as out:
            out.write(json.dumps([m.listing for m in messages if m and m.listing]).encode())

    def abort(self, messages: list[_Staged | None]) -> None:
        _remove(self.root)


class FileExport(DataSource):
    """Write-only source: ``option("path", folder)`` names the folder of one export."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        store, root = resolve(self.options["path"])
        store.create_dir(f"{root}/files", recursive=True)
        store.create_dir(f"{root}/lists", recursive=True)
        return _Writer(self.options["path"])


def _state(name: str | None, payload: pa.Scalar, own: bool) -> str:
    if not payload.is_valid or not len(payload.as_buffer()):
        return NO_BYTES
    if not name or "\0" in name or any(p in ("", ".", "..") or len(p.encode()) > 255 for p in name.split("/")):
        return BAD_NAME
    return WRITTEN if own else DUPLICATE


def _remove(path: str) -> None:
    store, inner = resolve(path)
    for _ in range(20):  # tasks of an aborted job may still add to it
        if store.get_file_info(inner).type != fs.FileType.Directory:
            return
        try:
            store.delete_dir(inner)
        except OSError:
            time.sleep(0.1)


def _publish(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inner = resolve(folder)
        made: set[str] = set()
        for batch in batches:
            paths = []
            for name, staged, state in zip(*(batch.column(c).to_pylist() for c in ("_name", "_staged", "status"))):
                target = f"{inner}/{name}"
                if staged:
                    parent = target.rsplit("/", 1)[0]
                    if parent not in made:
                        store.create_dir(parent, recursive=True)
                        made.add(parent)
                    # A repeated task finds some of its files moved already.
                    if store.get_file_info(staged).type == fs.FileType.File:
                        store.move(staged, target)
                    elif store.get_file_info(target).type != fs.FileType.File:
                        raise FileNotFoundError(staged)
                paths.append(f"{folder}/{name}" if state in (WRITTEN, DUPLICATE) else name)
            kept = pa.Table.from_batches([batch.drop_columns(["_name", "_staged"])])
            yield from kept.append_column("audio_filepath", pa.array(paths, pa.string())).to_batches()

    return run


def export_audio(df: DataFrame, folder: str, name: Column, payload: Column, keep: Sequence[str]) -> DataFrame:
    """Write each row's bytes to ``folder/name`` and report ``(*keep, copies, status, audio_filepath)`` per row.

    ``status`` is ``written``; ``no_bytes`` for null or empty bytes and ``bad_name`` for names no file can
    have, both with the bare name as path; or ``duplicate`` where other bytes were written under the same
    name: those with the least digest, whatever the order of rows. ``copies`` counts the rows that give
    bytes for a name. Only names are shuffled to find duplicates, and only bytes of duplicates are hashed.
    Arrow batches are bounded by bytes. The report is stored under the folder and read from there.
    """
    spark = df.sparkSession
    spark.dataSource.register(FileExport)
    rows = df.select(*keep, name.alias("_name"), payload.alias("_payload"))
    given = rows.filter("octet_length(_payload) > 0")
    doubled = given.groupBy("_name").agg(F.count("*").alias("copies")).filter("copies > 1")
    count = doubled.count()
    digest = F.sha2("_payload", 256)
    if count:
        first = given.join(broadcast_if_small(doubled, count), "_name").groupBy("_name").agg(
            F.min(digest).alias("_first"), F.first("copies").alias("copies"))
        rows = rows.join(broadcast_if_small(first, count), "_name", "left")
        rows = rows.withColumn("_own", F.when(F.col("_first").isNull(), F.lit(True)).otherwise(F.coalesce(digest == F.col("_first"), F.lit(False))))
    else:
        rows = rows.select("*", F.lit(None).cast("long").alias("copies"), F.lit(True).alias("_own"))
    copies = F.when(F.octet_length("_payload") > 0, F.coalesce("copies", F.lit(1))).otherwise(F.lit(0))
    rows = rows.select(*keep, copies.cast("long").alias("copies"), *_OWN)

    root = f"{folder}/_export-{uuid.uuid4().hex[:12]}"
    rows.write.format(FORMAT).mode("append").option("path", root).save()
    store, inner = resolve(root)
    with store.open_input_stream(f"{inner}/committed.json") as stream:
        lists = json.loads(stream.read())
    schema = rows.drop("_payload", "_own").schema.add("_staged", "string").add("status", "string")
    prefix = root[: len(root) - len(inner)] if root.endswith(inner) else ""
    staged = spark.read.schema(schema).parquet(*[prefix + path for path in lists]) if lists else spark.createDataFrame([], schema)
    report = rows.drop(*_OWN).schema.add("status", "string").add("audio_filepath", "string")
    staged.mapInArrow(_publish(folder), report).write.parquet(f"{root}/report")
    _remove(f"{root}/files")
    _remove(f"{root}/lists")
    store.delete_file(f"{inner}/committed.json")
    return spark.read.schema(report).parquet(f"{root}/report")
