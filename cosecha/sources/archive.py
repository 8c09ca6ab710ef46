"""Zip archives (S2, S3): a distributed unpack job.

Archives are listed on the driver (names only). A first job reads the central
directory of each archive, one task an archive; a second one unpacks, one task a
member, so an archive of 20 members keeps 20 tasks busy. A task opens the archive
at the member's place and streams it out to a shared folder (bounded memory:
copied in chunks, never held whole). The result is the list of unpacked files,
which the ordinary readers (CSV, XPORT) then scan in parallel."""

from __future__ import annotations

import uuid
import zipfile
import zlib
from typing import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from cosecha.sources.xport import _fs, list_files

CHUNK = 8 << 20


def _chosen(archive: str, members: Sequence[str] | None, xpt_first: bool) -> list[str]:
    """Names of the members wanted, from the archive's central directory."""
    fs, p = _fs(archive)
    with fs.open_input_file(p) as fh, zipfile.ZipFile(fh) as z:
        names = z.namelist()
    if xpt_first:
        found = [n for n in names if ".xpt" in n.lower()][:1]
        if not found:
            raise FileNotFoundError(f"{archive}: no .xpt member")
        return found
    if members is not None:
        return [n for m in members for n in names if n.rsplit("/", 1)[-1] == m]
    return [n for n in names if not n.endswith("/")]


def _unpack_one(archive: str, member: str, dest: str) -> tuple:
    # archives of one name from different folders keep apart
    stem = f"{archive.rstrip('/').rsplit('/', 1)[-1]}-{zlib.crc32(archive.encode()):08x}"
    # the member's own folders stay, so equal base names do too
    inside = "/".join(x for x in member.strip().split("/") if x not in ("", ".", ".."))
    target = f"{dest.rstrip('/')}/{stem}/{inside}"
    fs, p = _fs(archive)
    tfs, tp = _fs(target)
    aside = f"{tp.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    tfs.create_dir(tp.rsplit("/", 1)[0], recursive=True)
    size = 0
    with fs.open_input_file(p) as fh, zipfile.ZipFile(fh) as z, z.open(member) as src, \
            tfs.open_output_stream(aside) as dst:
        while chunk := src.read(CHUNK):
            dst.write(chunk)
            size += len(chunk)
    tfs.move(aside, tp)  # a repeated attempt never leaves half a file
    return archive, member.strip().rsplit("/", 1)[-1], target, size


def list_members(spark: SparkSession, archives: str | Sequence[str], members: Sequence[str] | None = None,
                 xpt_first: bool = False) -> DataFrame:
    """(archive, member) of the chosen members, one task an archive."""
    paths = list(archives) if not isinstance(archives, str) else list_files(archives, ".zip")
    src = spark.createDataFrame(pd.DataFrame({"archive": paths}), "archive string").repartition(max(1, len(paths)))
    mem = list(members) if members is not None else None

    def run(batches):
        for b in batches:
            rows = [(a, m) for a in b["archive"] for m in _chosen(a, mem, xpt_first)]
            yield pd.DataFrame(rows, columns=["archive", "member"])

    return src.mapInPandas(run, "archive string, member string")


def unpack(spark: SparkSession, archives: str | Sequence[str], dest: str,
           members: Sequence[str] | None = None, xpt_first: bool = False) -> DataFrame:
    """Unpack archives (a path/folder/glob of ``.zip`` files, or a list) into
    ``dest``; returns (archive, member, path, bytes) of what was written.

    ``members``: only these member file names (absent ones are skipped);
    ``xpt_first``: the first member whose lower-cased name contains ``.xpt``
    (error if there is none)."""
    found = list_members(spark, archives, members, xpt_first).collect()  # names only
    src = spark.createDataFrame([tuple(r) for r in found], "archive string, member string") \
        .repartition(max(1, len(found)))

    def run(batches):
        for b in batches:
            rows = [_unpack_one(a, m, dest) for a, m in zip(b["archive"], b["member"])]
            yield pd.DataFrame(rows, columns=["archive", "member", "path", "bytes"])

    return src.mapInPandas(run, "archive string, member string, path string, bytes long")


def zip_files(spark: SparkSession, files: Sequence[str], dest: str, member_name=None) -> list[str]:
    """One archive per file (one task each); fixture helper for round trips.
    ``member_name(file) -> str`` renames the member inside the archive."""
    src = spark.createDataFrame(pd.DataFrame({"file": list(files)}), "file string")
    src = src.repartition(max(1, len(files)), "file")
    namer = member_name or (lambda f: f.rsplit("/", 1)[-1])

    def run(batches):
        for b in batches:
            out = []
            for f in b["file"]:
                fs, p = _fs(f)
                stem = f.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                target = f"{dest.rstrip('/')}/{stem}.zip"
                tfs, tp = _fs(target)
                tfs.create_dir(tp.rsplit("/", 1)[0], recursive=True)
                with tfs.open_output_stream(tp) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z, \
                        fs.open_input_file(p) as src_fh, z.open(namer(f), "w") as dst:
                    while True:
                        chunk = src_fh.read(CHUNK)
                        if not chunk:
                            break
                        dst.write(chunk)
                out.append(target)
            yield pd.DataFrame({"archive": out})

    return [r.archive for r in src.mapInPandas(run, "archive string").collect()]
