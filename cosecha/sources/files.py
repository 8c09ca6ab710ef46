"""CSV scans (S4) and the ingest job with per-source failure isolation and
a shape report (S10, S11, A24)."""

from __future__ import annotations

import logging
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from cosecha.functions.text import table_name
from cosecha.operators.relational import select_existing
from cosecha.sources import archive
from cosecha.sources.tables import concurrently, write_replace
from cosecha.sources.xport import read_xport

log = logging.getLogger(__name__)

REPORT_SCHEMA = "table_name string, status string, n_rows long, n_cols int, error string"


def read_csv(spark: SparkSession, path, schema: StructType | str | None = None,
             encoding: str = "UTF-8", header: bool = True, **options) -> DataFrame:
    """S4 ``read_csv``: header row, UTF-8. A declared schema is preferred
    (no inference pass); without one the types are inferred from the whole
    file set, as ``low_memory=False`` does."""
    r = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True).option("samplingRatio", 1.0)
    return r.csv(path)


def _error_code(e: Exception) -> str:
    cond = getattr(e, "getCondition", None)
    if callable(cond):
        try:
            c = cond()
            if c:
                return c
        except Exception:  # noqa: BLE001
            pass
    return type(e).__name__


def _paths(path):
    """One archive, several, or a folder of them."""
    return path if isinstance(path, str) and not path.endswith(".zip") else [path] if isinstance(path, str) else list(path)


def _load(spark: SparkSession, entry: Mapping, scratch: str) -> DataFrame:
    fmt = entry["format"]
    path = entry["path"]
    if fmt == "csv":
        return read_csv(spark, path, entry.get("schema"))
    if fmt == "xport":
        return read_xport(spark, path, entry.get("columns"))
    if fmt == "zip_xport":
        archive.unpack(spark, _paths(path), f"{scratch}/{entry['name']}", xpt_first=True).collect()
        return read_xport(spark, f"{scratch}/{entry['name']}", entry.get("columns"))
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown format {fmt!r}")


def expand_manifest(spark: SparkSession, manifest: Sequence[Mapping], scratch: str) -> list[dict]:
    """Zipped CSV bundles become one CSV entry per listed member (unpacked
    by one distributed job); listed members absent from the archive become
    ``missing`` entries."""
    out = []
    for e in manifest:
        if e["format"] != "zip_csv":
            out.append(dict(e))
            continue
        members = list(e["members"])
        prefix = e.get("prefix", "")
        try:
            got: dict[str, list[str]] = {}
            for r in archive.unpack(spark, _paths(e["path"]), f"{scratch}/bundle", members=members).collect():
                got.setdefault(r.member, []).append(r.path)
        except Exception as err:  # noqa: BLE001
            out.extend({"name": table_name(m, prefix), "format": "error", "error": _error_code(err)} for m in members)
            continue
        for m in members:
            name = table_name(m, prefix)
            if m in got:
                out.append({"name": name, "format": "csv", "path": got[m], "columns": e.get("columns")})
            else:
                log.warning("%s not found in %s", m, e["path"])
                out.append({"name": name, "format": "missing"})
    return out


def ingest(spark: SparkSession, manifest: Sequence[Mapping], store: str, scratch: str) -> DataFrame:
    """Load every source of the manifest into ``store`` (replace), each in
    its own try: one failing source does not stop the others. Returns the
    report (table_name, status ok/missing/error, n_rows, n_cols, error). Rows are
    counted by the write itself; nothing is scanned twice.

    Entry keys: ``name``, ``format`` (csv, xport, zip_xport, zip_csv,
    parquet), ``path`` (a file or a folder; for archives also a list), optional
    ``columns`` (schema-tolerant selection), and for zip_csv ``members`` +
    ``prefix`` (a member found in several archives is one table)."""
    def load(e: Mapping) -> tuple:
        name = e["name"]
        if e["format"] == "missing":
            return name, "missing", None, None, None
        if e["format"] == "error":
            return name, "error", None, None, e["error"]
        try:
            df = _load(spark, e, scratch)
            if e.get("columns"):
                df = select_existing(df, e["columns"])
            rows = Observation()
            write_replace(df, store, name, observed=rows)
            return name, "ok", rows.get["n"], len(df.columns), None
        except Exception as err:  # noqa: BLE001 - isolation is the point
            log.warning("ingest of %s failed: %s", name, err)
            return name, "error", None, None, _error_code(err)

    return spark.createDataFrame(concurrently(load, expand_manifest(spark, manifest, scratch)), REPORT_SCHEMA)
