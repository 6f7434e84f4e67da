"""Avro object-container encoding of Arrow batches (vectorized with numpy).

Only what the sink needs: a record of nullable scalar fields, written as
the public Avro 1.x container layout (magic, metadata map, sync marker,
blocks of ``count, size, data, sync``). Each field value is encoded as a
byte *piece* per row for the whole batch at once (zig-zag varints, fixed
little-endian floats, length-prefixed bytes), and the pieces are then
interleaved into row order with one scatter per piece.

Block codecs: ``null``, ``snappy`` (raw snappy + big-endian CRC32 of the
plain data) and ``deflate`` (raw deflate).
"""

from __future__ import annotations

import functools
import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the container format.
MAGIC = b"Obj\x01"
SYNC_SIZE = 16

_SNAPPY = None


def _snappy():
    global _SNAPPY
    if _SNAPPY is None:
        _SNAPPY = pa.Codec("snappy")
    return _SNAPPY


# ---------------------------------------------------------------- scalars
def zigzag_varint(n: int) -> bytes:
    z = (n << 1) ^ (n >> 63)
    z &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = z & 0x7F
        z >>= 7
        if z:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _avro_bytes(b: bytes) -> bytes:
    return zigzag_varint(len(b)) + b


# ---------------------------------------------------------------- schema
def avro_name(name: str) -> str:
    """A valid Avro name: [A-Za-z_][A-Za-z0-9_]*."""
    out = "".join(ch if (ch.isascii() and (ch.isalnum() or ch == "_")) else "_" for ch in name)
    if not out or out[0].isdigit():
        out = "_" + out
    return out


def avro_type(t: pa.DataType):
    if pa.types.is_boolean(t):
        return "boolean"
    if pa.types.is_int8(t) or pa.types.is_int16(t) or pa.types.is_int32(t):
        return "int"
    if pa.types.is_int64(t):
        return "long"
    if pa.types.is_float32(t):
        return "float"
    if pa.types.is_float64(t):
        return "double"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_binary(t) or pa.types.is_large_binary(t):
        return "bytes"
    if pa.types.is_date32(t):
        return {"type": "int", "logicalType": "date"}
    if pa.types.is_timestamp(t):
        lt = "timestamp-micros" if t.tz is not None else "local-timestamp-micros"
        return {"type": "long", "logicalType": lt}
    if pa.types.is_decimal(t):
        return {"type": "bytes", "logicalType": "decimal", "precision": t.precision, "scale": t.scale}
    raise TypeError(f"type {t} cannot be written to Avro by this sink")


def avro_schema(schema: pa.Schema, name: str, namespace: str | None) -> dict:
    rec = {"type": "record", "name": avro_name(name or "record"), "fields": []}
    if namespace:
        rec["namespace"] = ".".join(avro_name(p) for p in namespace.split("."))
    for f in schema:
        rec["fields"].append({"name": avro_name(f.name), "type": ["null", avro_type(f.type)], "default": None})
    return rec


# ---------------------------------------------------------------- pieces
# A piece is (per-row byte counts, concatenated bytes in row order). Every
# field is a union ["null", T]: its branch byte (0x00 null, 0x02 value) is
# folded into the first piece of the field, so a field costs one scatter
# (two for strings/bytes: header, then the raw bytes).
def _varint_matrix(values: np.ndarray):
    """(byte counts, bytes matrix) of the zig-zag varints of int64 ``values``."""
    v = values.astype(np.int64, copy=False)
    zz = ((v << 1) ^ (v >> 63)).view(np.uint64)
    nb = np.ones(len(v), dtype=np.int64)
    for k in range(1, 10):
        nb += zz >= np.uint64(1 << (7 * k))
    width = int(nb.max()) if len(nb) else 1
    mat = np.empty((len(v), width), dtype=np.uint8)
    for k in range(width):
        byte = ((zz >> np.uint64(7 * k)) & np.uint64(0x7F)).astype(np.uint8)
        mat[:, k] = byte | ((k < nb - 1).astype(np.uint8) << 7)
    return nb, mat


def _varint_piece(values: np.ndarray, valid: np.ndarray | None):
    """Zig-zag varints of int64 ``values``; rows not ``valid`` get 0 bytes."""
    nb, mat = _varint_matrix(values)
    keep = np.arange(mat.shape[1])[None, :] < nb[:, None]
    if valid is not None:
        nb = np.where(valid, nb, 0)
        keep &= valid[:, None]
    return nb, mat[keep]


def _branch_piece_from(nb: np.ndarray, mat: np.ndarray, valid: np.ndarray | None):
    """Prefix each row's bytes with the union branch; a null row is the single byte 0x00."""
    n = len(nb)
    full = np.empty((n, mat.shape[1] + 1), dtype=np.uint8)
    full[:, 0] = 2
    full[:, 1:] = mat
    if valid is None:
        lens = nb + 1
    else:
        full[~valid, 0] = 0
        lens = np.where(valid, nb + 1, 1)
    if np.all(lens == full.shape[1]):
        return lens, full.ravel()
    keep = np.arange(full.shape[1])[None, :] < lens[:, None]
    return lens, full[keep]


def _fixed_matrix(values: np.ndarray, width: int):
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), width)
    return np.full(len(values), width, dtype=np.int64), raw


def _binary_pieces(arr: pa.Array, valid: np.ndarray | None):
    if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type):
        arr = pc.fill_null(arr, "")
    else:
        arr = pc.fill_null(arr, b"")
    off_type = np.int64 if (pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)) else np.int32
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], dtype=off_type)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    lens = np.diff(offs)
    data = np.frombuffer(bufs[2], dtype=np.uint8)[offs[0]: offs[-1]] if bufs[2] is not None else np.empty(0, np.uint8)
    # null slots were filled with empty values, so their data is already empty
    return [_branch_piece_from(*_varint_matrix(lens), valid), (lens, data)]


def _decimal_pieces(arr: pa.Array, valid: np.ndarray | None):
    n = len(arr)
    raw = np.frombuffer(arr.buffers()[1], dtype=np.uint8)[arr.offset * 16: (arr.offset + n) * 16].reshape(n, 16)
    be = raw[:, ::-1]
    neg = (be[:, 0] & 0x80) != 0
    sign_byte = np.where(neg, 0xFF, 0x00).astype(np.uint8)
    same = be == sign_byte[:, None]
    lead = np.where(same.all(axis=1), 16, np.argmin(same, axis=1))
    nxt = be[np.arange(n), np.minimum(lead, 15)]
    keep_one = ((nxt & 0x80) != 0) != neg
    start = np.clip(np.where(lead == 16, 15, lead - keep_one.astype(np.int64)), 0, 15)
    lens = (16 - start).astype(np.int64)
    mask = np.arange(16)[None, :] >= start[:, None]
    if valid is not None:
        lens = np.where(valid, lens, 0)
        mask &= valid[:, None]
    return [_branch_piece_from(*_varint_matrix(lens), valid), (lens, be[mask])]


def _column_pieces(arr: pa.Array):
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    t = arr.type
    valid = None if arr.null_count == 0 else arr.is_valid().to_numpy(zero_copy_only=False)
    if pa.types.is_boolean(t):
        vals = pc.fill_null(arr, False).to_numpy(zero_copy_only=False).astype(np.uint8)
        return [_branch_piece_from(*_fixed_matrix(vals, 1), valid)]
    if pa.types.is_integer(t) or pa.types.is_date32(t) or pa.types.is_timestamp(t):
        a = arr
        if pa.types.is_timestamp(t) and t.unit != "us":
            a = a.cast(pa.timestamp("us", t.tz))
        if pa.types.is_date32(t):
            a = a.cast(pa.int32())
        vals = pc.fill_null(a.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        return [_branch_piece_from(*_varint_matrix(vals), valid)]
    if pa.types.is_float32(t):
        vals = pc.fill_null(arr, 0.0).to_numpy(zero_copy_only=False).astype("<f4")
        return [_branch_piece_from(*_fixed_matrix(vals, 4), valid)]
    if pa.types.is_float64(t):
        vals = pc.fill_null(arr, 0.0).to_numpy(zero_copy_only=False).astype("<f8")
        return [_branch_piece_from(*_fixed_matrix(vals, 8), valid)]
    if pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_binary(t) or pa.types.is_large_binary(t):
        return _binary_pieces(arr, valid)
    if pa.types.is_decimal(t):
        return _decimal_pieces(arr, valid)
    raise TypeError(f"type {t} cannot be written to Avro by this sink")


def _interleave(pieces, n: int) -> bytes:
    if n == 0:
        return b""
    L = np.stack([p[0] for p in pieces], axis=1)
    flat = L.ravel()
    pos = (np.cumsum(flat) - flat).reshape(L.shape)
    out = np.empty(int(flat.sum()), dtype=np.uint8)
    for j, (lens, data) in enumerate(pieces):
        if data.size == 0:
            continue
        starts = pos[:, j]
        w = int(lens[0])
        if data.size == w * n and np.all(lens == w):
            dest = (starts[:, None] + np.arange(w)[None, :]).ravel()
        else:
            off = np.cumsum(lens) - lens
            dest = np.repeat(starts - off, lens) + np.arange(data.size)
        out[dest] = data
    return out.tobytes()


def encode_rows(batch: pa.RecordBatch | pa.Table) -> bytes:
    """Avro binary encoding of every row of ``batch`` (record of unions)."""
    pieces = []
    for col in batch.columns:
        pieces += _column_pieces(col)
    return _interleave(pieces, batch.num_rows)


# ---------------------------------------------------------------- container
def compress_block(data: bytes, codec: str) -> bytes:
    if codec == "null":
        return data
    if codec == "snappy":
        comp = _snappy().compress(data, asbytes=True)
        return comp + struct.pack(">I", zlib.crc32(data) & 0xFFFFFFFF)
    if codec == "deflate":
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        return c.compress(data) + c.flush()
    raise ValueError(f"unknown codec {codec!r}")


def decompress_block(data: bytes, codec: str) -> bytes:
    if codec == "null":
        return data
    if codec == "snappy":
        body, crc = data[:-4], struct.unpack(">I", data[-4:])[0]
        out = _snappy().decompress(body, decompressed_size=_snappy_len(body), asbytes=True)
        if zlib.crc32(out) & 0xFFFFFFFF != crc:
            raise IOError("snappy block CRC mismatch")
        return out
    if codec == "deflate":
        return zlib.decompress(data, -15)
    raise ValueError(f"unknown codec {codec!r}")


def _snappy_len(body: bytes) -> int:
    # raw snappy starts with the uncompressed length as an unsigned varint
    shift, n, i = 0, 0, 0
    while True:
        b = body[i]
        n |= (b & 0x7F) << shift
        i += 1
        if not b & 0x80:
            return n
        shift += 7


def header(schema_json: dict, codec: str, sync: bytes) -> bytes:
    meta = {"avro.schema": json.dumps(schema_json).encode(), "avro.codec": codec.encode()}
    out = bytearray(MAGIC)
    out += zigzag_varint(len(meta))
    for k, v in meta.items():
        out += _avro_bytes(k.encode()) + _avro_bytes(v)
    out += zigzag_varint(0)
    out += sync
    return bytes(out)


def block(rows: int, plain: bytes, codec: str, sync: bytes) -> bytes:
    comp = compress_block(plain, codec)
    return zigzag_varint(rows) + zigzag_varint(len(comp)) + comp + sync


def new_sync() -> bytes:
    return os.urandom(SYNC_SIZE)


# ---------------------------------------------------------------- decoding
class _Buf:
    __slots__ = ("b", "i")

    def __init__(self, b: bytes):
        self.b, self.i = b, 0

    def long(self) -> int:
        b, i, shift, z = self.b, self.i, 0, 0
        while True:
            x = b[i]
            i += 1
            z |= (x & 0x7F) << shift
            if not x & 0x80:
                break
            shift += 7
        self.i = i
        return (z >> 1) ^ -(z & 1)

    def take(self, n: int) -> bytes:
        s = self.b[self.i: self.i + n]
        self.i += n
        return s


def read_header(f) -> tuple[dict, str, bytes, int]:
    """Return (schema, codec, sync, header length) of a container file object."""
    head = f.read(4)
    if head != MAGIC:
        raise IOError("not an Avro container file")
    data = f.read(1 << 16)
    while True:  # a wide table's header is longer: read on until it is whole
        try:
            buf = _Buf(data)
            meta = {}
            while cnt := buf.long():
                if cnt < 0:
                    buf.long()
                    cnt = -cnt
                for _ in range(cnt):
                    k = _whole(buf, buf.long()).decode()
                    meta[k] = _whole(buf, buf.long())
            sync = _whole(buf, SYNC_SIZE)
            return json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null").decode(), sync, 4 + buf.i
        except IndexError:
            more = f.read(len(data))
            if not more:
                raise IOError("truncated Avro header") from None
            data += more


def _whole(buf, n: int) -> bytes:
    out = bytes(buf.take(n))
    if len(out) < n:
        raise IndexError(n)
    return out


def _read_long(f):
    shift, z = 0, 0
    while True:
        x = f.read(1)
        if not x:
            if shift == 0:
                return None
            raise IOError("truncated varint")
        x = x[0]
        z |= (x & 0x7F) << shift
        if not x & 0x80:
            return (z >> 1) ^ -(z & 1)
        shift += 7


# ---------------------------------------------------------------- column decoding
# One straight-line Python function per schema:
# every field of every record is decoded inline into its column list, with a
# one-byte fast path for varints. Used by the reader only (verification path).
_VARINT = """
{ind}x = buf[pos]; pos += 1
{ind}if x < 128:
{ind}    z = x
{ind}else:
{ind}    z = x & 0x7F; sh = 7
{ind}    while True:
{ind}        x = buf[pos]; pos += 1
{ind}        z |= (x & 0x7F) << sh
{ind}        if x < 128: break
{ind}        sh += 7
{ind}{target} = (z >> 1) ^ -(z & 1)
"""


def _field_code(i: int, t, ind: str) -> str:
    base = t["type"] if isinstance(t, dict) else t
    logical = t.get("logicalType") if isinstance(t, dict) else None
    col = f"c{i}[r]"
    if base in ("int", "long"):
        return _VARINT.format(ind=ind, target=col)
    if base == "boolean":
        return f"{ind}{col} = buf[pos] != 0; pos += 1\n"
    if base == "float":
        return f"{ind}{col} = unpack_f(buf, pos)[0]; pos += 4\n"
    if base == "double":
        return f"{ind}{col} = unpack_d(buf, pos)[0]; pos += 8\n"
    if base in ("string", "bytes"):
        code = _VARINT.format(ind=ind, target="n")
        if base == "string":
            return code + f"{ind}{col} = buf[pos:pos + n].decode('utf-8'); pos += n\n"
        if logical == "decimal":
            return code + f"{ind}{col} = int.from_bytes(buf[pos:pos + n], 'big', signed=True); pos += n\n"
        return code + f"{ind}{col} = bytes(buf[pos:pos + n]); pos += n\n"
    raise TypeError(f"cannot decode {t}")


def column_decoder(schema: dict):
    """Compile ``decode(buf: bytes, count) -> list of column lists`` for a record schema (once a worker: files of a table share it)."""
    return _compiled(json.dumps(schema))


@functools.lru_cache(maxsize=64)
def _compiled(schema_json: str):
    schema = json.loads(schema_json)
    lines = ["def decode(buf, count):", "    pos = 0"]
    fields = schema["fields"]
    for fd in fields:
        if isinstance(fd["type"], list) and len(fd["type"]) > 63:
            raise TypeError("unions of more than 63 branches are not read")
    for i in range(len(fields)):
        lines.append(f"    c{i} = [None] * count")
    lines.append("    for r in range(count):")
    for i, fd in enumerate(fields):
        t = fd["type"]
        if isinstance(t, list):
            null_idx = t.index("null") if "null" in t else -1
            inner = [x for x in t if x != "null"][0]
            # a union branch index below 64 is one zig-zag byte: 2 * index
            lines.append("        br = buf[pos]; pos += 1")
            lines.append(f"        if br != {2 * null_idx}:")
            lines.append(_field_code(i, inner, "            ").rstrip("\n"))
        else:
            lines.append(_field_code(i, t, "        ").rstrip("\n"))
    lines.append("    return [" + ", ".join(f"c{i}" for i in range(len(fields))) + "]")
    env = {"unpack_f": struct.Struct("<f").unpack_from, "unpack_d": struct.Struct("<d").unpack_from}
    exec("\n".join(lines), env)  # noqa: S102 - code built above from the schema only
    return env["decode"]


def iter_columns(f, schema: dict, codec: str, sync: bytes, stop: int | None = None):
    """Yield (count, column lists) per block; blocks starting at/after ``stop`` are left out."""
    decode = column_decoder(schema)
    while True:
        if stop is not None and f.tell() >= stop:
            return
        count = _read_long(f)
        if count is None:
            return
        size = _read_long(f)
        body = f.read(size)
        if f.read(SYNC_SIZE) != sync:
            raise IOError("sync marker mismatch")
        yield count, decode(decompress_block(body, codec), count)
