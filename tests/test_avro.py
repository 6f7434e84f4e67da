"""Avro sink: types, nulls, codecs, roll-over, naming; checked with our reader and the JVM's Avro reader."""

import datetime as dt
import decimal
import glob
import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablexport.sources import avro_codec as ac
from tablexport.sources import avro_sink
from tablexport.sources.avro_sink import FORMAT, register

ROWS = [
    (1, 7, 3, True, 1.5, 2.25, "héllo", b"\x00\xff", dt.date(2020, 2, 29), dt.datetime(2020, 1, 1, 12, 0, 0, 123456),
     decimal.Decimal("12345.6789"), 1),
    (2, -7, -300000, False, -0.0, -1e300, "", b"", dt.date(1969, 12, 31), dt.datetime(1969, 12, 31, 23, 59, 59),
     decimal.Decimal("-0.0001"), 1),
    (3, None, None, None, None, None, None, None, None, None, None, 2),
    (4, 127, 2 ** 31 - 1, True, float("inf"), 3.0, "O'Brien %_ ✓", b"abc" * 100, dt.date(9999, 12, 31),
     dt.datetime(2100, 6, 1), decimal.Decimal("-99999999.9999"), 2),
]
DDL = ("id bigint, s smallint, i int, b boolean, f float, d double, t string, bin binary, dte date, "
       "ts timestamp_ntz, dec decimal(12,4), chunk bigint")


def _write(spark, df, dest, **opts):
    register(spark)
    w = df.write.format(FORMAT).mode("append").option("path", dest).option("table", "things").option("schema", "dbo")
    for k, v in opts.items():
        w = w.option(k, str(v))
    w.save()


def _jvm_read(spark, path):
    jvm = spark._jvm
    r = jvm.org.apache.avro.file.DataFileReader(jvm.java.io.File(path), jvm.org.apache.avro.generic.GenericDatumReader())
    n = 0
    while r.hasNext():
        r.next()
        n += 1
    schema = json.loads(r.getSchema().toString())
    codec = r.getMetaString("avro.codec")
    r.close()
    return n, schema, codec


@pytest.mark.parametrize("codec", ["null", "snappy", "deflate"])
def test_roundtrip_all_types(spark, tmp_dest, codec):
    df = spark.createDataFrame(ROWS, DDL)
    _write(spark, df, tmp_dest, chunk_col="chunk", codec=codec)
    files = sorted(glob.glob(tmp_dest + "/*.avro"))
    assert sorted({os.path.basename(f).split("-")[1] for f in files}) == ["0000001", "0000002"]
    back = spark.read.format(FORMAT).load(tmp_dest)
    expect = df.drop("chunk")
    assert back.count() == 4
    # same values, types round-trip (smallint widens to int in Avro)
    b = {r["id"]: r for r in back.collect()}
    for r in expect.collect():
        got = b[r["id"]]
        for k in expect.columns:
            assert got[k] == r[k] or (isinstance(r[k], float) and got[k] == pytest.approx(r[k])), k
    total = 0
    for f in files:
        n, schema, c = _jvm_read(spark, f)
        total += n
        assert c == codec and schema["name"] == "things" and schema["namespace"] == "dbo"
        assert all(fd["type"][0] == "null" for fd in schema["fields"])
    assert total == 4


def test_rollover_respects_target(spark, tmp_dest):
    df = spark.range(20000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    _write(spark, df.coalesce(1), tmp_dest, target_size=100_000, codec="deflate")
    files = glob.glob(tmp_dest + "/*.avro")
    assert len(files) > 5
    idx = [json.loads(line) for f in glob.glob(tmp_dest + "/_manifest/*.json") for line in open(f)]
    assert sum(r["rows"] for r in idx) == 20000
    assert max(r["plain_bytes"] for r in idx) <= 100_000
    assert spark.read.format(FORMAT).load(tmp_dest).count() == 20000


def test_unsupported_type_rejected():
    with pytest.raises(TypeError):
        ac.avro_schema(pa.schema([("a", pa.list_(pa.float32()))]), "t", "s")


def test_names_are_valid_avro():
    assert ac.avro_name("9lives") == "_9lives"
    assert ac.avro_name("a-b c") == "a_b_c"


def test_varint_encoding_matches_spec():
    # zig-zag: 0->0, -1->1, 1->2, -64->127, 64->128 (two bytes)
    assert ac.zigzag_varint(0) == b"\x00"
    assert ac.zigzag_varint(-1) == b"\x01"
    assert ac.zigzag_varint(1) == b"\x02"
    assert ac.zigzag_varint(-64) == b"\x7f"
    assert ac.zigzag_varint(64) == b"\x80\x01"
    import numpy as np
    vals = np.array([0, -1, 1, -64, 64, 2 ** 62, -(2 ** 63)], dtype=np.int64)
    lens, data = ac._varint_piece(vals, None)
    expect = b"".join(ac.zigzag_varint(int(v)) for v in vals)
    assert bytes(data) == expect and list(lens) == [len(ac.zigzag_varint(int(v))) for v in vals]


def test_failed_attempt_publishes_nothing(spark, tmp_dest):
    from pyspark.sql.functions import udf

    @udf("bigint")
    def boom(x):
        if x == 5:
            raise ValueError("boom")
        return x

    df = spark.range(10).select(boom("id").alias("id"))
    with pytest.raises(Exception):
        _write(spark, df.repartition(2), tmp_dest)
    assert glob.glob(tmp_dest + "/*.avro") == []


def test_split_reading_covers_every_block_once(spark, tmp_dest):
    df = spark.range(50000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("h"))
    _write(spark, df.coalesce(1), tmp_dest, codec="snappy")
    for split in (20_000, 300_000, 10 << 20):
        back = spark.read.format(FORMAT).option("split_bytes", split).load(tmp_dest)
        assert back.count() == 50000 and back.select("id").distinct().count() == 50000


def test_zoned_timestamps_roundtrip(spark, tmp_dest):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2020, 6, 1, 12, 0, 0, 1)), (2, None)], "id bigint, t timestamp")
    _write(spark, df, tmp_dest)
    back = spark.read.format(FORMAT).load(tmp_dest)
    assert dict(back.dtypes)["t"] == "timestamp"
    assert sorted(back.collect()) == sorted(df.collect())
    f = sorted(glob.glob(tmp_dest + "/*.avro"))[0]
    _, schema, _ = _jvm_read(spark, f)
    assert schema["fields"][1]["type"][1] == {"type": "long", "logicalType": "timestamp-micros"}


def test_many_small_files_are_read_by_few_tasks(spark, tmp_dest):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 300).cast("int").alias("chunk"))
    register(spark)
    (df.coalesce(1).write.format(FORMAT).mode("append").option("path", tmp_dest).option("chunk_col", "chunk").option("table", "t").save())
    back = spark.read.format(FORMAT).option("file_col", "file").load(tmp_dest)
    assert back.select("file").distinct().count() == 300
    assert sorted(r["id"] for r in back.collect()) == list(range(3000))
    assert back.rdd.getNumPartitions() <= 64


def test_splits_go_by_bytes_and_cover_every_file_once():
    sizes = [("small%d" % i, 1000 + i) for i in range(2000)] + [("large", 700 << 20), ("empty", 0)]
    splits = avro_sink.plan_splits(sizes)
    assert len(splits) < 100
    ranges = {}
    for s in splits:
        assert sum((x.end or dict(sizes)[x.path]) - x.start for x in s.parts) <= avro_sink.MAX_SPLIT
        for x in s.parts:
            ranges.setdefault(x.path, []).append((x.start, x.end))
    assert set(ranges) == set(dict(sizes))
    for r in ranges.values():
        assert r[0][0] == 0 and r[-1][1] is None and all(a[1] == b[0] for a, b in zip(r, r[1:]))
