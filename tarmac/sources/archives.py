"""Zipped CSV archives (O1).

Work is split per archive *member*, not per archive: a listing step reads
only each ZIP's central directory (random access at the end of the file)
and emits one row per ``.csv`` member; the member rows are spread over
tasks.  Each task decompresses its members in bounded chunks, as bytes, to
one plain file each in the staging folder (shared storage).  A file gets its
final name only when the whole member has been read and its checksum agrees,
so a member is there whole or is a reject, and a retried task writes the same
file again.  Members with the same header line share a folder, so the staged
files are read as one folder per layout and the driver sees the distinct
headers, not the files.

Damage inside an archive (bad structure, checksum, compressed data, an
encrypted or unknown kind of member) makes a reject row.  Input and output
errors are not damage: they fail the task, and Spark retries it.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schema import CLEAN_COLUMNS, CLEAN_SCHEMA
from tarmac.session import qualified, scratch_path
from tarmac.sources.files import _local, read_first_line, records_by_layout, split_records

MEMBER_SCHEMA = "archive string, member string, size long, error string"
STAGED_SCHEMA = "archive string, member string, id string, header string, error string"
CHUNK_BYTES = 1 << 20
#: what a task unpacks where there are more members than a few for every core
TASK_BYTES = 64 << 20
TASKS_PER_CORE = 16
DAMAGE = (zipfile.BadZipFile, zipfile.LargeZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)


def open_random_access(path: str):
    """Seekable binary handle for a local path or any filesystem pyarrow can open."""
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs as pafs

    filesystem, p = pafs.FileSystem.from_uri(path)
    return filesystem.open_input_file(p)


def _list_members(batches):
    for pdf in batches:
        for archive in pdf["path"]:
            try:
                with open_random_access(archive) as fh, zipfile.ZipFile(fh) as zf:
                    found = [(archive, i.filename, i.file_size, None) for i in zf.infolist() if i.filename.endswith(".csv")]
                yield pd.DataFrame(found, columns=["archive", "member", "size", "error"])
            except DAMAGE as e:
                yield pd.DataFrame({"archive": [archive], "member": [None], "size": [0],
                                    "error": [f"{type(e).__name__}: {e}"]})


def member_id(archive: str, member: str) -> str:
    return hashlib.sha256(f"{archive}\0{member}".encode()).hexdigest()


def layout_folder(header: str) -> str:
    return "layout-" + hashlib.sha256(header.encode()).hexdigest()


def _copy_member(archive: str, member: str, staging: str, name: str) -> str:
    """Unpack a member to ``name.csv`` in its layout's folder; the file appears only when it is whole.  Its header line."""
    hidden = f"_{name}-{uuid.uuid4().hex}"  # readers skip names that begin so
    local = _local(staging)
    if local is not None:
        os.makedirs(local, exist_ok=True)
        folder, move, drop, out = lambda p: os.makedirs(p, exist_ok=True), os.replace, os.remove, lambda p: open(p, "wb")
        root = local
    else:
        from pyarrow import fs as pafs

        filesystem, root = pafs.FileSystem.from_uri(staging)
        filesystem.create_dir(root)
        folder, move, drop, out = filesystem.create_dir, filesystem.move, filesystem.delete_file, filesystem.open_output_stream
    try:
        with open_random_access(archive) as fh, zipfile.ZipFile(fh) as zf, zf.open(member) as raw, \
                out(f"{root}/{hidden}") as to:
            while chunk := raw.read(CHUNK_BYTES):  # the last read checks the checksum
                to.write(chunk)
    except DAMAGE:
        drop(f"{root}/{hidden}")
        raise
    header = read_first_line(f"{staging}/{hidden}")
    folder(f"{root}/{layout_folder(header)}")
    move(f"{root}/{hidden}", f"{root}/{layout_folder(header)}/{name}.csv")
    return header


def _stage(staging: str):
    def run(batches):
        for pdf in batches:
            out = []
            for archive, member, error in zip(pdf["archive"], pdf["member"], pdf["error"]):
                name, header = None if error is not None else member_id(archive, member), None
                if name is not None:
                    try:
                        header = _copy_member(archive, member, staging, name)
                    except DAMAGE as e:
                        error = f"{type(e).__name__}: {e}"
                out.append((archive, member, name, header, error))
            yield pd.DataFrame(out, columns=["archive", "member", "id", "header", "error"])

    return run


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``.csv`` member of every ``*.zip`` below ``path``; archive contents unread."""
    archives = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.zip")
        .load(path)
        .select("path")
    )
    return archives.mapInPandas(_list_members, MEMBER_SCHEMA)


def stage_archives(spark: SparkSession, path: str, staging: str | None = None,
                   members_per_task: int | None = None) -> tuple[str, DataFrame]:
    """Unpack every ``*.zip`` below ``path`` (any depth); (folder of plain files, manifest of members and rejects).

    By default a member has a task of its own until there are many: then a task unpacks about ``TASK_BYTES``.
    """
    staging = qualified(spark, staging or scratch_path(spark, "unpacked"))
    listed = scratch_path(spark, "members")
    list_members(spark, path).write.parquet(listed)
    members = spark.read.schema(MEMBER_SCHEMA).parquet(listed)
    found = members.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    tasks = max(1, -(-found["n"] // (members_per_task or 1)))
    if not members_per_task:
        tasks = min(tasks, max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, found["size"] // TASK_BYTES))
    manifest = f"{staging}/_manifest"
    (members.repartition(tasks, "archive", "member").mapInPandas(_stage(f"{staging}/files"), STAGED_SCHEMA)
     .write.mode("overwrite").parquet(manifest))
    return f"{staging}/files", spark.read.schema(STAGED_SCHEMA).parquet(manifest)


def read_archives(spark: SparkSession, path: str, staging: str | None = None, with_source: bool = True,
                  multi_line: bool = True, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """O1: (cleaned rows, rejects) from zipped CSV archives.

    Rows carry ``archive`` and ``member`` lineage (D13), so members with the
    same name in different archives never collide.  Members and archives that
    are damaged are rejects with their error; records with a wrong number of
    fields are rejects of their member.
    """
    files, manifest = stage_archives(spark, path, staging)
    whole = manifest.filter("error IS NULL").select("id", "archive", "member")
    damaged = manifest.filter("error IS NOT NULL").select("archive", "member", "error")
    if whole.limit(1).count() == 0:
        empty = spark.createDataFrame([], CLEAN_SCHEMA)
        for c in ["archive", "member"] * with_source:
            empty = empty.withColumn(c, F.lit(None).cast("string"))
        return empty, damaged

    def with_member(df: DataFrame) -> DataFrame:
        name = F.substring("source_file", -68, 64)  # <64 characters of hash>.csv
        return df.withColumn("id", name).join(whole, "id").drop("id", "source_file")

    layouts = (manifest.filter("error IS NULL").groupBy("header")
               .agg(F.min(F.concat_ws(":", "archive", "member")).alias("example")).orderBy("header").collect())
    records = records_by_layout(
        spark, [(r["header"], r["example"], [f"{files}/{layout_folder(r['header'])}"]) for r in layouts], strict, multi_line)
    rows, records = split_records(records, with_source)
    if with_source:
        rows = with_member(rows).select(*CLEAN_COLUMNS, "archive", "member")
    wrong = with_member(records).select(
        "archive", "member", F.concat("reason", F.lit(": "), "record").alias("error"))
    return rows, damaged.unionByName(wrong)
