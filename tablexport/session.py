"""Session helpers: shared scratch space and recommended settings.

Scratch data (checkpoints, export output of the registered queries) lives
under the folder the cluster names in ``spark.checkpoint.dir``. Only when
that is unset (local runs, tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings worth having on a large cluster; applied by bench/tests, and
# listed in the README. Runtime-modifiable SQL confs only.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a remote session: the server's setting is used as is
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set on the cluster")
        return conf_dir
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tablexport-ckpt-")  # one process: its own folder is shared
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never reused)."""
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tablexport-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


def local_df(spark: SparkSession, rows, schema):
    """Small driver-side metadata (chunk lists, catalog rows) as a DataFrame.

    Built through Arrow (a local relation), not a pickled Python RDD, so
    using it starts no Python workers. Only for metadata-sized data."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    asch = to_arrow_schema(st)
    rows = list(rows)
    cols = list(zip(*rows)) if rows else [() for _ in st.fields]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(cols, asch)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=asch)).select(
        *[f"`{f.name}`" for f in st.fields]).to(st)


def session_wall_clock(spark: SparkSession, value, data_type):
    """A collected zoned timestamp as wall-clock time of the session time zone.

    ``collect()`` gives zoned (``TimestampType``) values in the Python process's
    zone, while Spark's ``year``/``month`` use ``spark.sql.session.timeZone``;
    zone-less values (``timestamp_ntz``) are returned unchanged."""
    import datetime as _dt
    from zoneinfo import ZoneInfo

    from pyspark.sql.types import TimestampType

    if value is None or not isinstance(data_type, TimestampType) or not isinstance(value, _dt.datetime):
        return value
    tz = spark.conf.get("spark.sql.session.timeZone", None)
    if not tz:
        return value
    aware = value if value.tzinfo else value.astimezone()  # naive = process-local zone
    return aware.astimezone(ZoneInfo(tz)).replace(tzinfo=None)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tablexport`` importable in Python workers (data source, mapInPandas).

    Workers do not see the driver's runtime ``sys.path``; the package is
    zipped once and added with ``addPyFile`` (Spark serves it to every
    executor), once per SparkContext. The zip on the driver is only the
    source Spark's file server hands out; executors get their own copy."""
    import zipfile

    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the package must be installed on the cluster
        return
    key = id(sc._jsc)
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="tablexport-pyfiles-"), "tablexport.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for dirpath, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        z.write(full, os.path.join("tablexport", os.path.relpath(full, pkg)))
        sc.addPyFile(out)
        _SHIPPED.add(key)


_SHIP_LOCK = __import__("threading").Lock()
