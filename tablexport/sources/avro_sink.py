"""``tablexport_avro``: a Spark Python data source writing/reading Avro files.

Write (one Spark job, every task writes its own files)::

    df.write.format("tablexport_avro").mode("overwrite")
      .option("path", dest).option("chunk_col", "chunk_no")
      .option("table", "orders").option("schema", "dbo")
      .option("codec", "snappy").option("target_size", 0)
      .option("run_id", rid).save()

* rows are grouped by ``chunk_col`` inside each task; each chunk gets its own
  file(s) named by the pattern (``%{CATALOG} %{SCHEMA} %{TABLE} %{PART}``;
  ``%{TABLE}`` expands to ``table-<7-digit chunk id>``; ``%{PART}`` to
  ``<write>-<task>-<seq>`` and is appended before the extension when absent, so
  neither tasks nor writes collide; a ``/`` in the pattern makes folders);
* with ``sorted`` (rows arrive ordered by chunk inside each task) a task has
  one file open and one buffer; otherwise buffers are counted in bytes;
* ``target_size`` > 0 rolls to a new file once the *uncompressed* bytes of
  the current one reach it (block granularity);
* files are written under ``_tx_tmp/<write>/<task-attempt>/`` and renamed on
  the driver in ``commit`` — a failed or retried attempt publishes nothing;
* ``commit`` writes ``_manifest/files-<run>-<write>.json`` last (JSON lines, one per
  file: chunk, key, path, rows, bytes, plain bytes, start, end, task, plan; see ``commit_log``). Files that no
  commit names are not part of the destination: readers and statistics go by the log;
* mode ``overwrite`` replaces what earlier writes put there for the same
  catalog, schema and table, in the one move that makes the commit;
* ``staged`` writes a commit that ``commit_log.publish`` makes visible later; ``keys`` (JSON,
  chunk number to key) names the chunks of this write, those without a row included;
* ``hash_col`` names a column of 64-bit row hashes: it is not written, its sum modulo 2^64 is
  each file's ``content`` in the commit (see ``operators.content``).

Read: ``spark.read.format("tablexport_avro").load(dir)`` — one input
partition per file, schema from the first file's header; option ``glob``
(e.g. ``dbo.orders-*``) picks one table out of a shared destination, ``of_table`` (JSON:
catalog, schema, table) does so by the index; ``file_col`` adds each row's file name. A
folder without an index is read as it is listed.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from ..functions.columns import PLACEHOLDER_PART, chunk_id_text, expand_pattern
from . import avro_codec as ac
from . import commit_log
from .commit_log import MANIFEST_DIR

FORMAT = "tablexport_avro"
TMP_DIR = "_tx_tmp"
MAX_BLOCK_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20  # buffered per chunk before a block is encoded
MAX_PENDING_BYTES = 64 << 20  # buffered per task across chunks


def _fs(path: str):
    """pyarrow filesystem + path for a destination (local, s3, gs, hdfs, ...).

    Hadoop-style ``s3a://`` / ``s3n://`` URIs are read as ``s3://``."""
    from pyarrow import fs as pafs
    for alias in ("s3a://", "s3n://"):
        if path.startswith(alias):
            path = "s3://" + path[len(alias):]
    if "://" in path and not path.startswith("file://"):
        return pafs.FileSystem.from_uri(path)
    p = path[len("file://"):] if path.startswith("file://") else path
    p = p[len("file:"):] if p.startswith("file:") else p
    return pafs.LocalFileSystem(), os.path.abspath(p)


def ensure_destination(path: str) -> None:
    """Create the destination folder; refuse a path that is a file."""
    from pyarrow import fs as pafs
    fs, root = _fs(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        raise NotADirectoryError(f"destination {path} is a file")
    if info.type == pafs.FileType.NotFound:
        fs.create_dir(root, recursive=True)


def _now() -> str:
    return _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")


@dataclass
class FilesWritten(WriterCommitMessage):
    files: list = field(default_factory=list)
    tmp_dir: str = ""


@dataclass
class _Open:
    stream: object
    tmp_path: str
    name: str
    chunk: int
    sync: bytes
    rows: int = 0
    plain: int = 0
    start: str = ""
    content: int = 0  # sum of the row hashes modulo 2^64


class AvroWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.chunk_col = options.get("chunk_col") or None
        self.pattern = options.get("pattern", "%{SCHEMA}.%{TABLE}.avro")
        self.hash_col = options.get("hash_col") or None
        self.catalog = options.get("catalog") or None
        self.schema_name = options.get("schema") or None
        self.table = options.get("table", "table")
        self.codec = options.get("codec", "snappy")
        self.target = int(options.get("target_size", "0") or 0)
        self.tidy = str(options.get("tidy", "true")).lower() == "true"
        self.run_id = options.get("run_id") or uuid.uuid4().hex[:12]
        self.write_id = f"{self.run_id}-{uuid.uuid4().hex[:8]}"  # one per save(), shipped to the tasks
        self.sorted = str(options.get("sorted", "false")).lower() == "true"
        self.plan = options.get("plan") or None  # fingerprint of the plan the chunk numbers belong to
        self.keys = json.loads(options["keys"]) if options.get("keys") else {}
        self.staged = str(options.get("staged", "false")).lower() == "true"
        self.record_name = options.get("record_name") or self.table
        self.namespace = options.get("namespace") or self.schema_name
        self.overwrite = overwrite
        if self.codec not in ("null", "snappy", "deflate"):
            raise ValueError(f"codec must be null, snappy or deflate, got {self.codec!r}")

    # ------------------------------------------------------------ task side
    def _file_name(self, chunk: int, part: str) -> str:
        name = expand_pattern(self.pattern, self.catalog, self.schema_name, self.table,
                              chunk_id_text(chunk), part, tidy=self.tidy)
        if PLACEHOLDER_PART not in self.pattern:
            base, ext = os.path.splitext(name)
            name = f"{base}-{part}{ext}"
        return name

    def write(self, iterator):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = f"{pid:05d}-{ctx.attemptNumber() if ctx else 0}-{uuid.uuid4().hex[:6]}"
        fs, root = _fs(self.path)
        tmp_dir = f"{root}/{TMP_DIR}/{self.write_id}/{attempt}"
        fs.create_dir(tmp_dir, recursive=True)
        open_files: dict[int, _Open] = {}
        seq: dict[int, int] = {}
        done: list[dict] = []
        schema_json = None
        head_prefix: list[bytes] = []  # header up to the sync marker, built once per task

        def close(o: _Open):
            o.stream.close()
            info = fs.get_file_info(o.tmp_path)
            done.append({"chunk": int(o.chunk), "name": o.name, "tmp": o.tmp_path, "rows": o.rows,
                         "bytes": int(info.size), "plain_bytes": o.plain, "start": o.start, "end": _now(),
                         "task": pid} | ({"content": str(o.content)} if self.hash_col else {}))

        def open_new(chunk: int) -> _Open:
            seq[chunk] = seq.get(chunk, 0) + 1
            name = self._file_name(chunk, f"{self.write_id[-8:]}-{pid:05d}-{seq[chunk]:03d}")
            tmp_path = f"{tmp_dir}/{name}"
            if "/" in name:
                fs.create_dir(tmp_path.rsplit("/", 1)[0], recursive=True)
            sync = ac.new_sync()
            stream = fs.open_output_stream(tmp_path)
            if not head_prefix:
                head_prefix.append(ac.header(schema_json, self.codec, b""))  # sync appended per file
            stream.write(head_prefix[0] + sync)
            o = _Open(stream, tmp_path, name, chunk, sync, start=_now())
            open_files[chunk] = o
            return o

        limit = min(MAX_BLOCK_BYTES, self.target) if self.target else MAX_BLOCK_BYTES

        def emit(chunk: int, data: pa.RecordBatch):
            # cut by the bytes in memory first, so that rows are as a rule encoded once
            step = max(1, data.num_rows * limit // max(1, data.nbytes))
            if step < data.num_rows:
                for a in range(0, data.num_rows, step):
                    emit(chunk, _compact(data.slice(a, step)))
                return
            hashes, values = _split_off(data, self.hash_col)
            plain = ac.encode_rows(values)
            if len(plain) > limit and data.num_rows > 1:
                half = data.num_rows // 2
                emit(chunk, _compact(data.slice(0, half)))
                emit(chunk, _compact(data.slice(half)))
                return
            o = open_files.get(chunk)
            if o is not None and self.target and o.rows and o.plain + len(plain) > self.target:
                close(open_files.pop(chunk))
                o = None
            if o is None:
                o = open_new(chunk)
            o.stream.write(ac.block(data.num_rows, plain, self.codec, o.sync))
            o.rows += data.num_rows
            o.plain += len(plain)
            if hashes is not None:
                o.content = (o.content + int(hashes.to_numpy(zero_copy_only=False).view(np.uint64).sum(dtype=np.uint64))) % (1 << 64)

        # buffer per chunk and encode whole blocks (at most MAX_PENDING_BYTES buffered per task, largest first)
        pending: dict[int, list] = {}
        pending_bytes: dict[int, int] = {}
        total = [0]

        def flush(chunk: int):
            parts = pending.pop(chunk)
            total[0] -= pending_bytes.pop(chunk)
            merged = pa.Table.from_batches(parts).combine_chunks()
            for rb in merged.to_batches():
                emit(chunk, rb)

        def finish(chunk: int):
            if chunk in pending:
                flush(chunk)
            if chunk in open_files:
                close(open_files.pop(chunk))

        def buffer(chunk: int, rb: pa.RecordBatch):
            if self.sorted:  # a new chunk: the one before is complete
                for other in [c for c in {*pending, *open_files} if c != chunk]:
                    finish(other)
            pending.setdefault(chunk, []).append(rb)
            pending_bytes[chunk] = pending_bytes.get(chunk, 0) + rb.nbytes
            total[0] += rb.nbytes
            if pending_bytes[chunk] >= BLOCK_BYTES:
                flush(chunk)
            while total[0] > MAX_PENDING_BYTES:
                flush(max(pending_bytes, key=pending_bytes.get))

        for batch in iterator:
            if batch.num_rows == 0:
                continue
            if self.chunk_col:
                chunks, data = _split_off(batch, self.chunk_col)
                chunks = chunks.to_numpy(zero_copy_only=False)
            else:
                chunks, data = None, batch
            if schema_json is None:
                schema_json = ac.avro_schema(_split_off(data, self.hash_col)[1].schema, self.record_name, self.namespace)
            if chunks is None:
                emit(1, data)
                continue
            order = np.argsort(chunks, kind="stable")
            sc = chunks[order]
            cuts = np.flatnonzero(sc[1:] != sc[:-1]) + 1
            bounds = np.concatenate([[0], cuts, [len(sc)]])
            ordered = data.take(pa.array(order)) if len(bounds) > 2 else data  # one gather, then slices
            for a, b in zip(bounds[:-1], bounds[1:]):
                buffer(int(sc[a]), ordered.slice(int(a), int(b - a)))
        for ch in [*pending, *open_files]:
            finish(ch)
        return FilesWritten(files=done, tmp_dir=tmp_dir)

    # ------------------------------------------------------------ driver side
    def commit(self, messages):
        from concurrent.futures import ThreadPoolExecutor

        fs, root = _fs(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        for folder in {f["name"].rsplit("/", 1)[0] for f in files if "/" in f["name"]}:
            fs.create_dir(f"{root}/{folder}", recursive=True)
        with ThreadPoolExecutor(16) as pool:  # on object stores a move is a copy: many at a time
            list(pool.map(lambda f: fs.move(f["tmp"], f"{root}/{f['name']}"), files))
        mine = dict(catalog=self.catalog, schema=self.schema_name, table=self.table, run_id=self.run_id, plan=self.plan)
        key = lambda chunk: self.keys.get(str(chunk)) or f"{self.plan}-{chunk}"
        lines = [{k: v for k, v in f.items() if k != "tmp"} | {"path": f"{root}/{f['name']}", "key": key(f["chunk"])} | mine for f in files]
        there = {f["chunk"] for f in files}
        lines += [{"chunk": int(c), "key": k, "rows": 0, "id": f"{self.write_id}-{c}"} | mine for c, k in self.keys.items() if int(c) not in there]
        table = (self.catalog, self.schema_name, self.table)
        old = {commit_log.token(r) for r in commit_log.records(fs, root, table)} if self.overwrite and not self.staged else set()
        commit_log.append(fs, root, self.write_id, lines, old, commit_log.STAGED if self.staged else commit_log.VISIBLE, table)
        if old:
            commit_log.vacuum(fs, root, old)
        if fs.get_file_info(f"{root}/{TMP_DIR}/{self.write_id}").type.name == "Directory":
            fs.delete_dir(f"{root}/{TMP_DIR}/{self.write_id}")

    def abort(self, messages):
        fs, root = _fs(self.path)
        try:
            fs.delete_dir(f"{root}/{TMP_DIR}/{self.write_id}")
        except Exception:
            pass


def _split_off(batch: pa.RecordBatch, name: str | None):
    """(column ``name``, the others); (None, the batch) without a name."""
    if not name:
        return None, batch
    i = batch.schema.get_field_index(name)
    return batch.column(i), batch.select([k for k in range(batch.num_columns) if k != i])


def _compact(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A slice's own rows alone, so that its ``nbytes`` counts no others."""
    return batch.take(pa.array(np.arange(batch.num_rows)))


# ------------------------------------------------------------------ reading
_SPARK_TYPES = {"int": "int", "long": "bigint", "boolean": "boolean", "float": "float", "double": "double",
                "string": "string", "bytes": "binary"}


def _spark_type(t) -> str:
    if isinstance(t, list):
        t = [x for x in t if x != "null"][0]
    if isinstance(t, dict):
        lt = t.get("logicalType")
        if lt == "date":
            return "date"
        if lt == "timestamp-micros":
            return "timestamp"
        if lt == "local-timestamp-micros":
            return "timestamp_ntz"
        if lt == "decimal":
            return f"decimal({t['precision']},{t.get('scale', 0)})"
        t = t["type"]
    return _SPARK_TYPES[t]


def list_avro_files(path: str, pattern: str | None = None, table: tuple | None = None) -> list[str]:
    """The committed ``.avro`` files under ``path`` (optionally matching a glob on the name, or of one (catalog, schema, table)).

    Where there is an index it says which files those are; a folder without one is listed."""
    import fnmatch
    from pyarrow import fs as pafs
    fs, root = _fs(path)
    log = commit_log.read_log(fs, root)
    if log:
        names = {r["name"] for r in commit_log.in_force(log, table) if r.get("name")}
        return sorted(f"{root}/{n}" for n in names
                      if pattern is None or fnmatch.fnmatch(n, pattern) or fnmatch.fnmatch(os.path.basename(n), pattern))
    sel = pafs.FileSelector(root, recursive=False)
    out = [i.path for i in fs.get_file_info(sel)
           if i.type == pafs.FileType.File and i.path.endswith(".avro")
           and not os.path.basename(i.path).startswith(("_", "."))
           and (pattern is None or fnmatch.fnmatch(os.path.basename(i.path), pattern))]
    return sorted(out)


@dataclass
class _FilePart:
    """Byte range [start, end) of one file: the blocks that begin inside it."""

    path: str
    start: int = 0
    end: int | None = None


class _Split(InputPartition):
    """What one task reads: a byte range of a large file, or many small files."""

    def __init__(self, parts: list[_FilePart]):
        super().__init__(tuple((x.path, x.start, x.end) for x in parts))
        self.parts = parts


MIN_SPLIT = 1 << 20
MAX_SPLIT = 128 << 20
OPEN_COST = 64 << 10  # a file counts as so many bytes more


def plan_splits(files_sizes: list[tuple[str, int]], split_bytes: int | None = None) -> list[_Split]:
    """Cut files into byte ranges and put ranges together; by default about 64 tasks overall, of 1-128 MB each.

    The number of tasks goes by the bytes, not by the files: a table of many small chunks is read by few tasks."""
    total = sum(sz + OPEN_COST for _, sz in files_sizes)
    size = split_bytes or min(MAX_SPLIT, max(MIN_SPLIT, total // 64 + 1))
    splits, parts, held = [], [], 0
    for path, sz in files_sizes:
        start = 0
        while True:
            end = start + size
            cost = min(end, sz) - start + OPEN_COST
            if parts and held + cost > size:
                splits.append(_Split(parts))
                parts, held = [], 0
            parts.append(_FilePart(path, start, None if end >= sz else end))
            held += cost
            if end >= sz:
                break
            start = end
    return splits + [_Split(parts)] * bool(parts)


def _seek_block(f, start: int, header_end: int, sync: bytes) -> int | None:
    """Offset of the first block beginning at or after ``start`` (None: none in the file)."""
    if start <= header_end:
        return header_end
    pos = start - ac.SYNC_SIZE
    f.seek(pos)
    carry = b""
    while True:
        data = f.read(1 << 20)
        if not data:
            return None
        buf = carry + data
        i = buf.find(sync)
        if i >= 0:
            return pos - len(carry) + i + ac.SYNC_SIZE
        carry = buf[-(ac.SYNC_SIZE - 1):]
        pos += len(data)

def _arrow_column(values: list, avro_t):
    t = avro_t
    if isinstance(t, list):
        t = [x for x in t if x != "null"][0]
    lt = t.get("logicalType") if isinstance(t, dict) else None
    base = t["type"] if isinstance(t, dict) else t
    if lt == "date":
        return pa.array(values, pa.int32()).cast(pa.date32())
    if lt == "timestamp-micros":
        return pa.array(values, pa.int64()).cast(pa.timestamp("us", "UTC"))
    if lt == "local-timestamp-micros":
        return pa.array(values, pa.int64()).cast(pa.timestamp("us"))
    if lt == "decimal":
        import decimal
        sc = t.get("scale", 0)
        vals = [None if v is None else decimal.Decimal(v).scaleb(-sc) for v in values]
        return pa.array(vals, pa.decimal128(t["precision"], sc))
    return pa.array(values, {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "float": pa.float32(),
                             "double": pa.float64(), "string": pa.string(), "bytes": pa.binary()}[base])


def _committed(options: dict) -> list[str]:
    table = options.get("of_table")
    return list_avro_files(options["path"], options.get("glob"), tuple(json.loads(table)) if table else None)


class AvroReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.path = options["path"]
        self.file_col = options.get("file_col")
        self.split_bytes = options.get("split_bytes")

    def partitions(self):
        fs, _ = _fs(self.path)
        files = _committed(self.options)
        sizes = [(i.path, i.size) for i in fs.get_file_info(files)]
        sb = self.split_bytes
        return plan_splits(sizes, int(sb) if sb else None)

    def read(self, partition):
        fs, root = _fs(self.path)
        for part in partition.parts:
            yield from self._read_part(fs, root, part)

    def _read_part(self, fs, root, partition):
        with fs.open_input_file(partition.path) as f:
            schema, codec, sync, hlen = ac.read_header(f)
            first = _seek_block(f, partition.start, hlen, sync)
            if first is None or (partition.end is not None and first >= partition.end):
                return
            f.seek(first)
            names = [fd["name"] for fd in schema["fields"]]
            types = [fd["type"] for fd in schema["fields"]]
            for count, cols in ac.iter_columns(f, schema, codec, sync, stop=partition.end):
                if count:
                    arrays = [_arrow_column(c, t) for c, t in zip(cols, types)]
                    if self.file_col:
                        arrays.append(pa.array([partition.path[len(root) + 1:]] * count))
                    yield pa.RecordBatch.from_arrays(arrays, names=names + [self.file_col] * bool(self.file_col))


class AvroDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        files = _committed(self.options)
        if not files:
            raise FileNotFoundError(f"no .avro files under {self.options['path']}")
        fs, _ = _fs(self.options["path"])
        with fs.open_input_file(files[0]) as f:
            schema, _, _, _ = ac.read_header(f)
        columns = [f"`{fd['name']}` {_spark_type(fd['type'])}" for fd in schema["fields"]]
        return ", ".join(columns + [f"`{c}` string" for c in [self.options.get("file_col")] if c])

    def reader(self, schema):
        return AvroReader(self.options)

    def writer(self, schema, overwrite):
        return AvroWriter(self.options, overwrite)


_REGISTERED: set = set()
_LOCK = __import__("threading").Lock()


def register(spark) -> None:
    """Register the data source once per session (safe from several threads)."""
    from ..session import ship_package

    ship_package(spark)
    key = id(spark)
    with _LOCK:
        if key in _REGISTERED:
            return
        try:
            spark.dataSource.register(AvroDataSource)
        except Exception as e:  # noqa: BLE001 - registered by an earlier import of this module
            if "ALREADY_EXISTS" not in str(e):
                raise
        _REGISTERED.add(key)
