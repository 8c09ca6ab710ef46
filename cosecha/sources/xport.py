"""SAS XPORT (transport v5) as a Spark data source.

``spark.read.format("xport").load(path)`` - ``path`` is a file, a folder of
``.xpt`` files or a glob, on any file system pyarrow can open (local, HDFS,
S3, GCS). The header is parsed once on the driver for the schema; each
partition is a range of whole fixed-width records of one file, decoded with
numpy and emitted as Arrow record batches:

* numerics (IBM hexadecimal floats, 2-8 bytes) -> double; SAS missing codes
  (``.``, ``._``, ``.A``-``.Z``) -> NULL; extra mantissa bits beyond
  double precision are truncated (as pandas does);
* character fields -> string, decoded (option ``encoding``, default utf-8)
  and right-trimmed of blanks.

A user schema (``.schema("SEQN double, RIDAGEYR double")``) or the
``columns`` option decode only those variables (case-insensitive names).

A file may hold several members. ``member_index`` finds them by a distributed scan
of the files for member headers; ``read_xport(..., member="DEMO")`` reads that member
of every file that has it. Without a name, a file with several members is refused.

``read_xport(..., filters=[("RIDAGEYR", ">=", 18)])`` filters inside the scan: a
batch's filtered variables are decoded first, and the others only of the records
that pass. (Not by Spark's own push-down for Python sources: a reader keeps the
filters of a DataFrame's first query, so a later query without any would lose rows.)

``write_xport`` writes a DataFrame as transport files (one per partition);
it exists to build round-trip fixtures.
"""

from __future__ import annotations

import fnmatch
import json
import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

CARD = 80
NAMESTR = struct.Struct(">hhhh8s40s8shhh2s8shhl52s")
LIB_HEADER = b"HEADER RECORD*******LIBRARY HEADER RECORD!!!!!!!000000000000000000000000000000  "
MEMBER_HEADER = b"HEADER RECORD*******MEMBER  HEADER RECORD!!!!!!!000000000000000001600000000140  "
DSCRPTR_HEADER = b"HEADER RECORD*******DSCRPTR HEADER RECORD!!!!!!!000000000000000000000000000000  "
OBS_HEADER = b"HEADER RECORD*******OBS     HEADER RECORD!!!!!!!000000000000000000000000000000  "
DEFAULT_RECORDS_PER_PARTITION = 1 << 20
BATCH_RECORDS = 1 << 16
CHUNK = 8 << 20


@dataclass
class Var:
    name: str
    numeric: bool
    length: int
    position: int


@dataclass
class Layout:
    variables: list
    record_length: int
    data_start: int
    n_records: int


# ------------------------------------------------------------------ files

def _fs(path: str):
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def list_files(path: str, suffix: str = ".xpt") -> list[str]:
    """A file, the ``suffix`` files of a folder (case-insensitive), or a glob."""
    import pyarrow.fs as pafs
    fs, p = _fs(path)
    # what stands before the file system's own path: scheme and host
    scheme = path[: -len(p)] if p and path.endswith(p) and "://" in path else ""
    if any(ch in p for ch in "*?["):
        parent, pattern = p.rsplit("/", 1)
        infos = fs.get_file_info(pafs.FileSelector(parent))
        return sorted(scheme + i.path for i in infos
                      if i.type == pafs.FileType.File and fnmatch.fnmatch(i.base_name, pattern))
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type == pafs.FileType.Directory:
        infos = fs.get_file_info(pafs.FileSelector(p, recursive=True))
        return sorted(scheme + i.path for i in infos
                      if i.type == pafs.FileType.File and i.base_name.lower().endswith(suffix)
                      and not i.base_name.startswith(("_", ".")))
    raise FileNotFoundError(path)


def read_layout(path: str, member_at: int = 3 * CARD, end: int | None = None) -> Layout:
    """The member whose header stands at ``member_at`` and whose data end at ``end``
    (the file's end)."""
    fs, p = _fs(path)
    size = min(x for x in (fs.get_file_info(p).size, end) if x is not None)
    with fs.open_input_file(p) as f:
        if not f.read(48).startswith(LIB_HEADER[:48]):
            raise ValueError(f"{path}: not a SAS transport (XPORT) file")
        f.seek(member_at)
        head = f.read(5 * CARD)
        namestr_len = int(head[74:78])
        nvars = int(head[4 * CARD + 54: 4 * CARD + 58])
        raw = f.read(nvars * namestr_len)
        variables = []
        for i in range(nvars):
            rec = raw[i * namestr_len: i * namestr_len + 140].ljust(140, b"\0")
            t = NAMESTR.unpack(rec)
            variables.append(Var(t[4].decode("latin-1").strip(), t[0] == 1, t[2], t[14]))
        pos = member_at + 5 * CARD + nvars * namestr_len
        pos = -(-pos // CARD) * CARD
        f.seek(pos)
        obs = f.read(CARD)
        if not obs.startswith(OBS_HEADER[:20]) or b"OBS" not in obs[:30]:
            raise ValueError(f"{path}: observation header not found")
        data_start = pos + CARD
        reclen = sum(v.length for v in variables)
        data_bytes = size - data_start
        n = data_bytes // reclen if reclen else 0
        # trailing blank padding (the member is padded to whole 80-byte cards)
        if n:
            tail_from = max(data_start, size - CARD)
            f.seek(tail_from)
            tail = f.read(size - tail_from)
            while n and data_start + (n - 1) * reclen >= tail_from:
                s = data_start + (n - 1) * reclen - tail_from
                if tail[s: s + reclen].strip(b" ") == b"":
                    n -= 1
                else:
                    break
    return Layout(variables, reclen, data_start, n)


#: bytes of a file that one task of the member scan reads
SCAN_BYTES = 256 << 20


def member_index(spark, path: str, scan_bytes: int = SCAN_BYTES):
    """file, member, member_at, member_end, n_records of every member of the files:
    the files are scanned for member headers in ranges of ``scan_bytes``, so a large
    file with many members takes many tasks."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    ranges = []
    for f in list_files(path):
        fs, p = _fs(f)
        size = fs.get_file_info(p).size
        ranges += [(f, a, min(a + scan_bytes, size), size) for a in range(0, size, scan_bytes)]
    src = spark.createDataFrame(ranges, "file string, a long, b long, size long").repartition(max(1, len(ranges)))

    def find(batches):
        import pandas as pd
        for batch in batches:
            out = []
            for f, a, b, size in batch.itertuples(index=False):
                fs, p = _fs(f)
                with fs.open_input_file(p) as fh:
                    for at in range(a, b, CHUNK):
                        fh.seek(at)
                        # a header may begin in the chunk's last card; its name is two cards on
                        buf = fh.read(min(CHUNK, b - at) + 3 * CARD)
                        i = buf.find(MEMBER_HEADER[:48])
                        while 0 <= i < min(CHUNK, b - at):
                            if (at + i) % CARD == 0:
                                name = buf[i + 2 * CARD + 8: i + 2 * CARD + 16].decode("latin-1").strip()
                                out.append((f, name, at + i, size))
                            i = buf.find(MEMBER_HEADER[:48], i + 1)
            yield pd.DataFrame(out, columns=["file", "member", "member_at", "size"])

    def count(batches):
        for batch in batches:
            batch["n_records"] = [read_layout(f, a, e).n_records for f, a, e in
                                  zip(batch["file"], batch["member_at"], batch["member_end"])]
            yield batch

    found = src.mapInPandas(find, "file string, member string, member_at long, size long")
    nxt = F.lead("member_at").over(Window.partitionBy("file").orderBy("member_at"))
    found = found.select("file", "member", "member_at", F.coalesce(nxt, "size").alias("member_end"))
    return found.mapInPandas(count, "file string, member string, member_at long, member_end long, n_records long")


def schema_of(layout: Layout) -> StructType:
    return StructType([StructField(v.name, DoubleType() if v.numeric else StringType(), True)
                       for v in layout.variables])


# --------------------------------------------------------------- decoding

_MISSING_FIRST = np.zeros(256, dtype=bool)
_MISSING_FIRST[[ord("."), ord("_")] + list(range(ord("A"), ord("Z") + 1))] = True


def ibm_to_double(raw: np.ndarray) -> np.ndarray:
    """(n, L) uint8 big-endian IBM floats -> (values float64, missing mask)."""
    n, L = raw.shape
    buf = np.zeros((n, 8), dtype=np.uint8)
    buf[:, :L] = raw
    u = buf.view(">u8").reshape(n).astype(np.uint64)
    first = buf[:, 0]
    rest_zero = (u & np.uint64(0x00FFFFFFFFFFFFFF)) == 0
    missing = _MISSING_FIRST[first] & rest_zero
    mant = u & np.uint64(0x00FFFFFFFFFFFFFF)
    k = ((mant >= np.uint64(1 << 53)).astype(np.uint64) + (mant >= np.uint64(1 << 54)).astype(np.uint64)
         + (mant >= np.uint64(1 << 55)).astype(np.uint64))
    mant = (mant >> k) << k                      # keep 53 significant bits (truncate)
    exp = (first & 0x7F).astype(np.int64) - 64
    val = np.ldexp(mant.astype(np.float64), (4 * exp - 56).astype(np.int64))
    val = np.where(first & 0x80, -val, val)
    return val, missing


def double_to_ibm(x: np.ndarray, length: int = 8) -> np.ndarray:
    """float64 (NaN = missing) -> (n, length) uint8 IBM floats."""
    x = np.asarray(x, dtype=np.float64)
    n = len(x)
    out = np.zeros((n, 8), dtype=np.uint8)
    nan = np.isnan(x)
    zero = (x == 0) & ~nan
    ok = ~(nan | zero)
    f, p = np.frexp(np.abs(np.where(ok, x, 1.0)))          # |x| = f * 2^p, f in [0.5, 1)
    e = -(-p // 4)                                          # 16^e >= 2^p
    shift = (p - 4 * e + 3).astype(np.int64)               # in [0, 3]
    mant = (np.ldexp(f, 53).astype(np.uint64) << shift.astype(np.uint64))
    word = (((e + 64).astype(np.uint64) & np.uint64(0x7F)) << np.uint64(56)) | mant
    word = np.where(x < 0, word | np.uint64(1 << 63), word)
    word = np.where(ok, word, np.uint64(0))
    out[:] = word.astype(">u8").view(np.uint8).reshape(n, 8)
    out[nan, 0] = ord(".")
    return out[:, :length]


def _decode_chars(cell: np.ndarray, length: int, encoding: str) -> pa.Array:
    """(n, length) blank-padded bytes -> right-trimmed strings, vectorised in
    Arrow (fixed-size binary -> utf8 -> rtrim); other encodings or invalid
    UTF-8 fall back to Python decoding with replacement characters."""
    import pyarrow.compute as pc
    n = cell.shape[0]
    if encoding.lower().replace("-", "") in ("utf8", "ascii"):
        fsb = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), n, [None, pa.py_buffer(cell.tobytes())])
        try:
            return pc.utf8_rtrim(fsb.cast(pa.binary()).cast(pa.string()), characters=" ")
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
            pass
    s = np.char.rstrip(cell.view(f"S{length}").reshape(n), b" ")
    return pa.array([b.decode(encoding, errors="replace") for b in s.tolist()], type=pa.string())


def _decode_cell(cell: np.ndarray, v: Var, encoding: str) -> pa.Array:
    if v.numeric:
        vals, miss = ibm_to_double(cell)
        return pa.array(vals, type=pa.float64(), mask=miss)
    return _decode_chars(np.ascontiguousarray(cell), v.length, encoding)


#: comparisons of a filter (variable, comparison, value); rows with NULL pass none but
#: ``is null``
COMPARISONS = ("=", "<", "<=", ">", ">=", "in", "is null", "is not null")


def _passes(comparison: str, value, column: pa.Array) -> pa.Array:
    """Whether each value passes a filter."""
    import pyarrow.compute as pc
    if comparison == "is null":
        return pc.is_null(column)
    if comparison == "is not null":
        return pc.is_valid(column)
    if comparison == "in":
        return pc.fill_null(pc.is_in(column, pa.array([x for x in value if x is not None], column.type)), False)
    by = {"=": pc.equal, ">": pc.greater, ">=": pc.greater_equal, "<": pc.less, "<=": pc.less_equal}[comparison]
    return pc.fill_null(by(column, pa.scalar(value, column.type)), False)


def decode_records(buf: bytes, layout: Layout, wanted: list, encoding: str, filters: tuple = ()) -> pa.RecordBatch:
    """The wanted variables of the records that pass the filters."""
    import pyarrow.compute as pc
    reclen = layout.record_length
    n = len(buf) // reclen
    rec = np.frombuffer(buf, dtype=np.uint8, count=n * reclen).reshape(n, reclen)
    by_name = {v.name.lower(): v for v in layout.variables}
    kinds = {field.name.lower(): pa.float64() if isinstance(field.dataType, DoubleType) else pa.string()
             for _, field in wanted}
    done: dict[str, pa.Array] = {}

    def column(name: str) -> pa.Array:
        v = by_name.get(name)
        if v is None:  # another file of the folder has this variable
            return pa.nulls(len(rec), kinds[name])
        return _decode_cell(rec[:, v.position: v.position + v.length], v, encoding)

    for name, comparison, value in filters:
        name = name.lower()
        if name not in by_name:  # all NULL in this file
            keep = pa.repeat(comparison == "is null", len(rec))
        else:
            if name not in done:
                done[name] = column(name)
            keep = _passes(comparison, value, done[name])
        if not pc.all(keep).as_py():
            done = {k: c.filter(keep) for k, c in done.items()}
            rec = rec[keep.to_numpy(zero_copy_only=False)]
    names = [field.name for _, field in wanted]
    return pa.RecordBatch.from_arrays([done[x.lower()] if x.lower() in done else column(x.lower()) for x in names], names=names)


def _one_member(path: str, buf: bytes, offset: int) -> None:
    """Records end where a second member begins: reading on would decode its
    headers as values."""
    i = buf.find(MEMBER_HEADER[:48])
    while i >= 0:
        if (offset + i) % CARD == 0:
            raise ValueError(f"{path}: a transport file with several members; name one")
        i = buf.find(MEMBER_HEADER[:48], i + 1)


# ------------------------------------------------------------ data source

@dataclass
class XportPartition(InputPartition):
    path: str
    start: int
    count: int
    member_at: int = 3 * CARD
    member_end: int | None = None


def _places(options) -> list[tuple]:
    """(file, member header, end) of what is read: the places a named member was
    found at, else the whole of every file."""
    if "places" in options:
        return [tuple(x) for x in json.loads(options["places"])]
    return [(f, 3 * CARD, None) for f in list_files(options["path"])]


def _layouts(places: list[tuple]) -> list:
    """(place, layout) of every place; headers are read side by side."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(16) as pool:
        return list(zip(places, pool.map(lambda x: read_layout(*x), places)))


class XportReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.options = options
        self.schema = schema

        self.filters = [tuple(f) for f in json.loads(options.get("filters", "[]"))]

    def partitions(self):
        per = int(self.options.get("recordsPerPartition", DEFAULT_RECORDS_PER_PARTITION))
        parts = []
        for (f, member_at, end), layout in _layouts(_places(self.options)):
            n = layout.n_records
            for s in range(0, n, per):
                parts.append(XportPartition(f, s, min(per, n - s), member_at, end))
        return parts or [XportPartition("", 0, 0)]

    def read(self, partition: XportPartition):
        if not partition.count:
            return
        layout = read_layout(partition.path, partition.member_at, partition.member_end)
        by_name = {v.name.lower(): v for v in layout.variables}
        wanted = [(by_name.get(f.name.lower()), f) for f in self.schema.fields]
        enc = self.options.get("encoding", "utf-8")
        fs, p = _fs(partition.path)
        with fs.open_input_file(p) as fh:
            at = layout.data_start + partition.start * layout.record_length
            fh.seek(at - CARD)
            before = fh.read(CARD)
            left = partition.count
            while left:
                k = min(BATCH_RECORDS, left)
                buf = fh.read(k * layout.record_length)
                if partition.member_end is None:
                    _one_member(partition.path, before + buf, at - CARD)
                before, at = (before + buf)[-CARD:], at + len(buf)
                yield decode_records(buf, layout, wanted, enc, self.filters)
                left -= k


@dataclass
class XportWritten(WriterCommitMessage):
    written: str
    final: str


class XportWriter(DataSourceArrowWriter):
    """One transport file per task, streamed batch by batch (v5 files carry
    no row count, so the header does not wait for the data)."""

    def __init__(self, options, schema: StructType, overwrite: bool):
        self.options = options
        self.schema = schema
        self.overwrite = overwrite

    def write(self, iterator):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        widths = json.loads(self.options.get("charWidths", "{}"))
        enc = self.options.get("encoding", "utf-8")
        base = self.options["path"].rstrip("/")
        name = f"part-{ctx.partitionId():05d}.xpt"
        tmp = f"{base}/_tmp-{ctx.partitionId():05d}-{ctx.attemptNumber()}.xpt"
        fs, p = _fs(tmp)
        fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
        header, lengths = encode_header(self.schema, widths, self.options.get("member", "DATA"))
        written = 0
        with fs.open_output_stream(p) as out:
            out.write(header)
            for batch in iterator:
                body = encode_records(batch, self.schema, lengths, enc)
                out.write(body)
                written += len(body)
            out.write(b" " * ((-written) % CARD))
        return XportWritten(tmp, f"{base}/{name}" if self.overwrite else
                            f"{base}/{name[:-4]}-{uuid.uuid4().hex[:8]}.xpt")

    def commit(self, messages):
        """All tasks are done: their files take their names; what an overwrite
        replaces goes first."""
        base = self.options["path"].rstrip("/")
        fs, p = _fs(base)
        fs.create_dir(p, recursive=True)
        if self.overwrite:
            for f in list_files(base):
                fs.delete_file(_fs(f)[1])
        for m in messages:
            if m is not None:
                fs.move(_fs(m.written)[1], _fs(m.final)[1])

    def abort(self, messages):
        for m in messages:
            if m is not None:
                fs, p = _fs(m.written)
                fs.delete_file(p)


class XportDataSource(DataSource):
    @classmethod
    def name(cls):
        return "xport"

    def schema(self):
        places = _places(self.options)
        if not places:
            raise FileNotFoundError(self.options["path"])
        # the variables of all files, in the order in which they first appear
        fields: dict = {}
        for (path, *_), layout in _layouts(places):
            for f in schema_of(layout).fields:
                if fields.setdefault(f.name.lower(), f).dataType != f.dataType:
                    raise ValueError(f"{path}: {f.name} is numeric in one file and character in another")
        full = StructType(list(fields.values()))
        cols = self.options.get("columns")
        if cols:
            keep = {c.strip().lower() for c in cols.split(",")}
            return StructType([f for f in full.fields if f.name.lower() in keep])
        return full

    def reader(self, schema: StructType):
        return XportReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool):
        return XportWriter(self.options, schema, overwrite)


def register(spark) -> None:
    spark.dataSource.register(XportDataSource)


# -------------------------------------------------------------- encoding

def _card(b: bytes) -> bytes:
    return b.ljust(CARD, b" ")[:CARD]


def encode_header(schema: StructType, widths: dict, member: str):
    """Library, member, descriptor and NAMESTR records up to the OBS header;
    returns (bytes, field lengths)."""
    stamp = b"01JAN00:00:00:00"
    out = [LIB_HEADER,
           _card(b"SAS     SAS     SASLIB  9.4     cosecha " + b" " * 24 + stamp),
           _card(stamp),
           MEMBER_HEADER, DSCRPTR_HEADER,
           _card(b"SAS     " + member.encode()[:8].ljust(8) + b"SASDATA 9.4     cosecha " + b" " * 24 + stamp),
           _card(stamp)]
    fields = schema.fields
    out.append(_card(b"HEADER RECORD*******NAMESTR HEADER RECORD!!!!!!!000000"
                     + f"{len(fields):04d}".encode() + b"00000000000000000000  "))
    pos, names, lengths = 0, [], []
    for i, f in enumerate(fields):
        if len(f.name) > 8:
            raise ValueError(f"XPORT v5 names are at most 8 characters: {f.name}")
        numeric = not isinstance(f.dataType, StringType)
        length = 8 if numeric else max(1, int(widths.get(f.name, 8)))
        lengths.append(length)
        names.append(NAMESTR.pack(1 if numeric else 2, 0, length, i + 1, f.name.encode().ljust(8),
                                  b" " * 40, b" " * 8, 0, 0, 0, b"\0\0", b" " * 8, 0, 0, pos, b"\0" * 52))
        pos += length
    blob = b"".join(names)
    out.append(blob + b" " * ((-len(blob)) % CARD))
    out.append(OBS_HEADER)
    return b"".join(out), lengths


def encode_records(batch, schema: StructType, lengths: list, encoding: str) -> bytes:
    """One Arrow batch -> fixed-width records (numpy, column by column)."""
    n = batch.num_rows
    rec = np.full((n, sum(lengths)), ord(" "), dtype=np.uint8)
    off = 0
    for i, (f, length) in enumerate(zip(schema.fields, lengths)):
        if n:
            col = batch.column(i)
            if isinstance(f.dataType, StringType):
                vals = [("" if v is None else v).encode(encoding)[:length].ljust(length) for v in col.to_pylist()]
                rec[:, off: off + length] = np.frombuffer(b"".join(vals), dtype=np.uint8).reshape(n, length)
            else:
                x = col.cast(pa.float64()).to_numpy(zero_copy_only=False)
                rec[:, off: off + length] = double_to_ibm(np.asarray(x, dtype=np.float64), length)
        off += length
    return rec.tobytes()


def write_xport(df, path: str, member: str = "DATA") -> str:
    """Write ``df`` as transport files under ``path`` (one per partition).
    Character widths are the longest encoded value of each string column
    (one small aggregate)."""
    from pyspark.sql import functions as F
    register(df.sparkSession)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    widths = {}
    if strings:
        row = df.agg(*[F.max(F.octet_length(F.col(c))).alias(c) for c in strings]).first()
        widths = {c: int(row[c] or 1) for c in strings}
    (df.write.format("xport").mode("overwrite").option("charWidths", json.dumps(widths))
       .option("member", member).save(path))
    return path


def read_xport(spark, path: str, columns=None, member: str | None = None, filters=(), **options):
    """The records of transport files; ``member`` names the one to read of files
    that hold several (an error if none has it); ``filters``: (variable, one of
    COMPARISONS, value), of which a record must pass all."""
    if bad := [f for f in filters if f[1] not in COMPARISONS]:
        raise ValueError(f"unknown comparison: {bad}")
    register(spark)
    r = spark.read.format("xport")
    if columns:
        r = r.option("columns", ",".join(columns))
    if member is not None:
        # names and places only: a row per member
        found = [(m.file, m.member_at, m.member_end) for m in member_index(spark, path).collect()
                 if m.member.lower() == member.lower()]
        if not found:
            raise FileNotFoundError(f"{path}: no member {member}")
        r = r.option("places", json.dumps(sorted(found)))
    if filters:
        r = r.option("filters", json.dumps([(f[0], f[1], f[2] if len(f) > 2 else None) for f in filters]))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)
