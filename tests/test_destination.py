"""What a destination holds after several writes, failed ones included, is what its index says."""

import glob
import json
import os
from dataclasses import replace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablexport.plans.job import ExportJob
from tablexport.run import export_database
from tablexport.sources import avro_sink, commit_log
from tablexport.sources.avro_sink import FORMAT, register
from tablexport.sources.catalog import DirectoryCatalog

from .conftest import SF001


def indexed(dest):
    return [json.loads(x) for f in glob.glob(dest + "/_manifest/files-*.json") for x in open(f)]


def save(df, dest, mode="append", **options):
    register(df.sparkSession)
    w = df.write.format(FORMAT).mode(mode).option("path", dest)
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def test_overwrite_replaces_the_table_and_no_other(spark, tmp_dest):
    save(spark.range(40), tmp_dest, table="a")
    save(spark.range(7), tmp_dest, table="b")
    save(spark.range(5), tmp_dest, "overwrite", table="a")
    rows = indexed(tmp_dest)
    assert {t: sum(r["rows"] for r in rows if r["table"] == t) for t in "ab"} == {"a": 5, "b": 7}
    assert sorted(r["path"] for r in rows) == sorted(glob.glob(tmp_dest + "/*.avro"))
    assert spark.read.format(FORMAT).load(tmp_dest).count() == 12


def test_a_second_write_and_files_no_index_names(spark, tmp_dest):
    save(spark.range(10), tmp_dest, table="t")
    save(spark.range(10), tmp_dest, table="t")
    path = indexed(tmp_dest)[0]["path"]
    with open(path, "rb") as f, open(os.path.join(tmp_dest, "left-over.avro"), "wb") as out:  # of a commit that failed half way
        out.write(f.read())
    assert spark.read.format(FORMAT).load(tmp_dest).count() == 20 == sum(r["rows"] for r in indexed(tmp_dest))


def test_a_wide_table_and_folders_in_the_pattern(spark, tmp_dest):
    wide = spark.range(3).select(*[(F.col("id") + i).alias(f"a_rather_long_column_name_{i:04d}") for i in range(1000)])
    save(wide, tmp_dest, table="wide", schema="s", pattern="%{SCHEMA}/%{TABLE}/x.avro")
    back = spark.read.format(FORMAT).load(tmp_dest)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))
    assert all("/s/wide-0000001/x-" in r["path"] for r in indexed(tmp_dest))


@pytest.mark.parametrize("ordered", ["true", "false"])
def test_many_chunks_in_a_task_are_a_file_each(spark, tmp_dest, ordered):
    df = spark.range(3_000).select("id", (F.col("id") % 150).alias("c")).coalesce(1)
    save(df.sortWithinPartitions("c") if ordered == "true" else df, tmp_dest, table="t", chunk_col="c", sorted=ordered)
    rows = indexed(tmp_dest)
    assert len(rows) == 150 and {r["rows"] for r in rows} == {20}


def test_roll_over_by_plain_size(spark, tmp_dest):
    df = spark.range(20_000).select("id", F.repeat(F.lit("x"), 50).alias("s")).coalesce(1)
    save(df, tmp_dest, table="t", target_size="100000", codec="deflate")
    sizes = [r["plain_bytes"] for r in indexed(tmp_dest)]
    assert len(sizes) >= 10 and max(sizes) <= 100_000 and sum(r["rows"] for r in indexed(tmp_dest)) == 20_000


def test_names_that_collide_are_refused_before_anything_is_written(spark, tmp_path):
    src = tmp_path / "in"
    for name, n in (("a b", 7), ("a_b", 3)):
        spark.range(n).write.parquet(str(src / f"{name}.parquet"))
    job = ExportJob(destination=str(tmp_path / "out"), retry_waits=())
    with pytest.raises(ValueError, match="would both be written as"):
        export_database(spark, job, DirectoryCatalog(spark, str(src)))
    assert not glob.glob(str(tmp_path / "out") + "/**/*.avro", recursive=True)
    export_database(spark, ExportJob(destination=str(tmp_path / "out"), retry_waits=(), tidy_tables=False), DirectoryCatalog(spark, str(src)))
    assert spark.read.format(FORMAT).load(str(tmp_path / "out")).count() == 10


def test_resume_when_the_bounds_have_moved_and_for_whole_tables(spark, tmp_path):
    src, dest = tmp_path / "in", str(tmp_path / "out")
    spark.range(0, 100).write.parquet(str(src / "t.parquet"))
    spark.range(5).write.parquet(str(src / "w.parquet"))
    job = ExportJob(destination=dest, split_strategies=("t,between,id,number,9",), retry_waits=())
    export_database(spark, job, DirectoryCatalog(spark, str(src)))
    spark.range(100, 150).write.mode("append").parquet(str(src / "t.parquet"))
    for _ in range(2):
        res = export_database(spark, job, DirectoryCatalog(spark, str(src)), resume=True)
        rows = {t: sum(r["rows"] for r in indexed(dest) if r["table"] == t) for t in "tw"}
        assert rows == {"t": 150, "w": 5}
        assert {r["table"]: r["export_row_count"] for r in res.rollup.collect()} == rows
    ids = sorted(r["id"] for r in spark.read.format(FORMAT).option("glob", "dbo.t-*").load(dest).collect())
    assert ids == list(range(150))


def test_the_manifest_names_unsupported_columns_and_mismatches(spark, tmp_dest):
    job = ExportJob(destination=tmp_dest, tables=("dbo.embeddings", "dbo.region"), retry_waits=())
    res = export_database(spark, job, DirectoryCatalog(spark, SF001))
    doc = {t["table"]: t for t in json.load(open(res.manifest_path))["outputList"]}
    assert "embedding" in doc["embeddings"]["unsupportedColumns"] and doc["region"]["unsupportedColumns"] is None
    assert doc["region"]["rowCountMismatch"] is False and len(doc["region"]["statisticsList"]) == len(doc["region"]["queries"]) == 1


class Stopping:
    """A file system that fails at its n-th change."""

    def __init__(self, fs, n):
        self.fs, self.left = fs, n

    def __getattr__(self, name):
        f = getattr(self.fs, name)
        if name not in ("move", "delete_file", "delete_dir", "create_dir", "open_output_stream"):
            return f

        def change(*a, **kw):
            if self.left == 0:
                raise OSError("stopped here")
            self.left -= 1
            return f(*a, **kw)
        return change


def batch(lo, hi):
    return pa.RecordBatch.from_pydict({"id": pa.array(range(lo, hi), pa.int64())})


def test_a_replacement_stopped_at_any_step_leaves_the_old_or_the_new_rows(tmp_path, monkeypatch):
    dest, whole = str(tmp_path / "out"), avro_sink._fs
    seen, n = set(), 0
    while True:
        root = f"{dest}{n}"
        avro_sink.ensure_destination(root)
        for table, rows in (("t", 10), ("other", 3)):
            w = avro_sink.AvroWriter({"path": root, "table": table}, False)
            w.commit([w.write(iter([batch(0, rows)]))])
        w = avro_sink.AvroWriter({"path": root, "table": "t"}, True)
        message = w.write(iter([batch(100, 125)]))
        monkeypatch.setattr(avro_sink, "_fs", lambda path: (Stopping(whole(path)[0], n), whole(path)[1]))
        try:
            w.commit([message])
            finished = True
        except OSError:
            finished = False
        monkeypatch.setattr(avro_sink, "_fs", whole)
        fs, at = whole(root)
        rows = {t: sum(r["rows"] for r in commit_log.records(fs, at, (None, None, t))) for t in ("t", "other")}
        assert rows["other"] == 3 and rows["t"] in (10, 25)
        assert all(os.path.exists(f"{root}/{r['name']}") for r in commit_log.records(fs, at))
        assert len(avro_sink.list_avro_files(root)) == 2
        seen.add(rows["t"])
        n += 1
        if finished:
            break
    assert seen == {10, 25} and n > 5 and rows["t"] == 25
    assert len(glob.glob(f"{root}/*.avro")) == 2 and len(glob.glob(f"{root}/_manifest/files-*.json")) == 2


def test_staged_files_are_seen_when_they_are_published(tmp_path):
    root = str(tmp_path)
    fs, at = avro_sink._fs(root)
    for options, rows in (({}, 4), ({"staged": "true", "plan": "p", "keys": '{"1": "new-1", "2": "new-2"}'}, 7)):
        w = avro_sink.AvroWriter({"path": root, "table": "t"} | options, False)
        w.commit([w.write(iter([batch(0, rows)]))])
    old = commit_log.records(fs, at)
    assert [r["rows"] for r in old] == [4] and sorted((r["key"], r["rows"]) for r in commit_log.records(fs, at, kind="staged")) == [("new-1", 7), ("new-2", 0)]
    commit_log.publish(fs, at, "x", (None, None, "t"), lambda k: k.startswith("new"), {r["name"] for r in old})
    assert sorted((r["key"], r["rows"]) for r in commit_log.records(fs, at)) == [("new-1", 7), ("new-2", 0)]
    assert len(glob.glob(f"{root}/*.avro")) == 1 and not commit_log.records(fs, at, kind="staged")


def test_commits_of_a_few_chunks_and_a_run_that_stops_between_them(spark, tmp_dest):
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), retry_waits=(), split_strategies=("orders,between,o_orderkey,number,299,0,1499",),
                    commit_chunks_files=2, max_commits=1)
    cat, n = DirectoryCatalog(spark, SF001), spark.read.parquet(f"{SF001}/orders.parquet").count()
    first = export_database(spark, job, cat)
    assert not first.tables[0].complete and {r["chunk"] for r in indexed(tmp_dest)} == {1, 2}
    stamps = {p: os.stat(p).st_mtime_ns for p in glob.glob(tmp_dest + "/*.avro")}
    res = export_database(spark, replace(job, max_commits=0), cat, resume=True)
    assert res.tables[0].complete and sum(r["rows"] for r in indexed(tmp_dest)) == n == spark.read.format(FORMAT).load(tmp_dest).count()
    assert all(os.stat(p).st_mtime_ns == t for p, t in stamps.items())
    runs = {r["chunk"]: r["run_id"] for r in indexed(tmp_dest)}
    assert runs[1] == runs[2] == first.tables[0].run_id and {runs[c] for c in (3, 4, 5)} == {res.tables[0].run_id}
