"""The content check: equal values in any order agree, one changed, lost or repeated value does not."""

import datetime
import decimal
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablexport.operators.content import check_content, hash_sum, row_hash
from tablexport.operators.stats import validate_row_counts
from tablexport.plans.job import ExportJob
from tablexport.run import export_database
from tablexport.sources import avro_codec, avro_sink
from tablexport.sources.catalog import DirectoryCatalog
from tablexport.sources.manifest import manifest_chunks

from .conftest import SF001

TYPES = ("b byte, s short, i int, l long, f float, d double, t string, x binary, o boolean, day date, at timestamp, "
         "local timestamp_ntz, p decimal(9,2), q decimal(30,5)")


def rows_of_all_types():
    at = datetime.datetime(2021, 3, 28, 2, 30, 0, 123456)
    one = (1, -2, 3, 2**62, 1.5, -0.0, "é\n", b"\x00\xff", True, at.date(), at, at, decimal.Decimal("-1.25"), decimal.Decimal("12345678901234567890.12345"))
    return [one, one, (None,) * len(one), (None, 1, *(None,) * 12), (1, None, *(None,) * 12), (0, 0, 0, 0, float("nan"), float("inf"), "", b"", False, *(None,) * 5)]


def export(spark, tmp_path, rows=None, **kw):
    src = tmp_path / "src"
    spark.createDataFrame(rows or rows_of_all_types(), TYPES).repartition(3).write.parquet(str(src / "v.parquet"))
    job = ExportJob(destination=str(tmp_path / "out"), content_check=True, retry_waits=(), **kw)
    return job, DirectoryCatalog(spark, str(src)), export_database(spark, job, DirectoryCatalog(spark, str(src)))


def test_every_type_comes_back_as_it_was_read(spark, tmp_path):
    job, _, res = export(spark, tmp_path, split_strategies=("v,between,l,number,1000000000000000000",))
    got = check_content(spark, job.destination, (None, "dbo", "v")).collect()
    assert sum(r["rows"] for r in got) == sum(r["read_rows"] for r in got) == 6 and len(got) > 1
    assert all(r["content_match"] for r in got) and res.tables[0].content_mismatch is False
    assert json.load(open(res.manifest_path))["outputList"][0]["contentMismatch"] is False


def test_the_sum_is_that_of_a_plain_one(spark):
    h = [r["h"] for r in spark.createDataFrame(rows_of_all_types(), TYPES).transform(lambda d: d.select(row_hash(d, d.columns).alias("h"))).collect()]
    assert len(set(h)) == 5  # the repeated row; nulls at different places differ
    got = spark.createDataFrame([(x,) for x in h * 1000], "h long").agg(hash_sum(F.col("h")).alias("s")).first()["s"]
    assert got == str(sum(x % 2**64 for x in h * 1000) % 2**64)


def rewrite(path, edit):
    with open(path, "rb") as f:
        schema, codec, sync, hlen = avro_codec.read_header(f)
        f.seek(hlen)
        names, types = [x["name"] for x in schema["fields"]], [x["type"] for x in schema["fields"]]
        batches = [pa.RecordBatch.from_arrays([avro_sink._arrow_column(c, t) for c, t in zip(cols, types)], names=names)
                   for n, cols in avro_codec.iter_columns(f, schema, codec, sync) if n]
    table = edit(pa.Table.from_batches(batches).combine_chunks())
    with open(path, "wb") as f:
        f.write(avro_codec.header(schema, codec, b"") + sync)
        for b in table.to_batches():
            f.write(avro_codec.block(b.num_rows, avro_codec.encode_rows(b), codec, sync))


def replaced(table, column, value):
    i = table.schema.get_field_index(column)
    values = table.column(i).to_pylist()
    values[0] = value
    return table.set_column(i, table.schema.field(i), pa.array(values, table.schema.field(i).type))


EDITS = {
    "nothing": lambda t: t,
    "order": lambda t: t.take(pa.array(range(t.num_rows - 1, -1, -1))),
    "a value": lambda t: replaced(t, "i", 4),
    "a null": lambda t: replaced(t, "t", None),
    "a row lost": lambda t: t.slice(1),
    "a row repeated": lambda t: pa.concat_tables([t, t.slice(0, 1)]),
    "a row in place of another": lambda t: pa.concat_tables([t.slice(0, 1), t.slice(0, t.num_rows - 1)]) if t.num_rows > 1 else t.slice(1),
}


@pytest.mark.parametrize("what", EDITS)
def test_one_changed_value_fails_its_chunk_alone(spark, tmp_path, what):
    rows = [(1, 1, i, i, 1.0, 1.0, f"t{i}", b"x", True, None, None, None, None, None) for i in range(40)]
    job, source, res = export(spark, tmp_path, rows, split_strategies=("v,between,l,number,10",))
    first = min(r["chunk"] for r in res.files.collect())
    path = next(r["path"] for r in res.files.collect() if r["chunk"] == first)
    rewrite(path, EDITS[what])
    got = {r["chunk"]: r["content_match"] for r in check_content(spark, job.destination, (None, "dbo", "v")).collect()}
    same = what in ("nothing", "order")
    assert got.pop(first) is same and got and all(got.values())
    contents = check_content(spark, job.destination, (None, "dbo", "v")).selectExpr("'dbo' AS schema", "'v' AS table", "content_match")
    v = validate_row_counts(res.rollup, source.row_counts([("dbo", "v")]), contents).first()
    assert not v["mismatch"] and v["content_mismatch"] is not same


def test_a_changed_file_fails_the_run_that_finds_it(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame(rows_of_all_types(), TYPES).coalesce(1).write.parquet(src + "/v.parquet")
    out = str(tmp_path / "out")
    export_database(spark, ExportJob(destination=out, content_check=True, retry_waits=()), DirectoryCatalog(spark, src))
    rewrite(str(sorted((tmp_path / "out").glob("*.avro"))[0]), EDITS["a value"])
    with pytest.raises(RuntimeError, match="other values"):
        export_database(spark, ExportJob(destination=out, content_check=True, retry_waits=()), DirectoryCatalog(spark, src), resume=True)
    res = export_database(spark, ExportJob(destination=out, content_check=True, retry_waits=(), continue_on_exception=True),
                          DirectoryCatalog(spark, src), resume=True)
    assert [c[0] for c in res.tables[0].failed_chunks] == [1] and json.load(open(res.manifest_path))["failedAvro"][0]["chunk"] == 1


def test_files_without_the_check_and_tables_without_files(spark, tmp_dest):
    job = ExportJob(destination=tmp_dest, tables=("dbo.region",), retry_waits=())
    res = export_database(spark, job, DirectoryCatalog(spark, SF001))
    assert res.tables[0].content_mismatch is None
    assert [r["content_match"] for r in check_content(spark, tmp_dest, (None, "dbo", "region")).collect()] == [None]
    assert check_content(spark, tmp_dest, (None, "dbo", "nation")).collect() == []


def test_many_chunks_are_in_the_dataset_alone(spark, tmp_dest):
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=("orders,between,o_orderkey,number,100",), retry_waits=(), manifest_chunks=5)
    res = export_database(spark, job, DirectoryCatalog(spark, SF001))
    doc = json.load(open(res.manifest_path))
    assert "queries" not in doc["outputList"][0] and doc["chunkStatistics"] == "_manifest/chunks"
    rows = manifest_chunks(spark, tmp_dest, doc["runId"]).collect()
    assert len(rows) == doc["outputList"][0]["table_query_count"] > 5
    assert sum(r["export_row_count"] for r in rows) == doc["outputList"][0]["export_row_count"]
