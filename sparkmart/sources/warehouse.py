"""Star-schema storage: catalog tables over Parquet under one warehouse folder.

Both loaders share the layout.  The tables that grow with the data are bucketed by
their primary key: ``fact_sales`` inside the partitions of ``sale_year``,
``dim_customer`` and ``dim_product``.  The number of buckets is fixed when the
warehouse is laid out (a folder name under the root keeps it).  Insert-if-absent
then deals the incoming rows by the same hash, and the stored keys are read where
they lie, without a shuffle.  Inside a file facts are sorted by date, so year
filters prune partitions and date ranges skip row groups.

A root has a database in the session's catalog, which any session of the
application (or of the metastore, where there is one) can use by name; see
``create_star``.  A table without rows reads as empty and loads append: nothing
decides by a separate marker whether stored rows count, and nothing is
overwritten unless the caller says so.  A root that was filled before there were
buckets is read and written as plain Parquet folders.
"""

from __future__ import annotations

import hashlib
import pathlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schema
from sparkmart.plans.etl import Star, with_partition_column
from sparkmart.session import checkpoint_root

DIMENSIONS = ["dim_customer", "dim_store", "dim_supplier", "dim_product", "dim_date"]


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; storage errors are raised."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a name that isn't taken, in one step."""
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder; 0 if it isn't there."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def empty_table(spark: SparkSession, rows: T.StructType) -> DataFrame:
    """No rows of this schema: a plan that Catalyst sees to be empty, where
    ``createDataFrame`` would start Python workers on the executors."""
    return spark.range(0).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.fields])


#: Bucketed tables: the keys, and the order inside a file.
BUCKETED = {"fact_sales": (schema.PRIMARY_KEYS["fact_sales"], "date_id"),
            "dim_customer": (schema.PRIMARY_KEYS["dim_customer"], "customer_id"),
            "dim_product": (schema.PRIMARY_KEYS["dim_product"], "product_id")}


def buckets(spark: SparkSession, root: str) -> int:
    """Buckets of the warehouse's keyed tables; a root without tables is laid
    out now, with as many as the session has shuffle partitions.  0: plain."""
    base = f"{root.rstrip('/')}/_layout"
    if path_exists(spark, base):
        fs, p = _fs(spark, base)
        return int(fs.listStatus(p)[0].getPath().getName().split("=")[1])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if any(path_exists(spark, table_path(root, t)) for t in schema.STAR_TABLES):
        return 0
    make_folder(spark, f"{base}/buckets={n}")
    return n


def _columns(name: str) -> list[T.StructField]:
    part = [T.StructField(schema.FACT_PARTITION, T.IntegerType())] if name == "fact_sales" else []
    return [*schema.STAR_TABLES[name].fields, *part]


def table_name(root: str, name: str, database: str | None = None) -> str:
    return f"{database or 'star_' + hashlib.sha1(root.rstrip('/').encode()).hexdigest()[:16]}.{name}"


def define_table(spark: SparkSession, root: str, name: str, database: str | None = None) -> str:
    """The catalog table of a stored table, made if it isn't there; its name."""
    full, n = table_name(root, name, database), buckets(spark, root)
    if not spark.catalog.tableExists(full):
        make_folder(spark, table_path(root, name))
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _columns(name))
        partition = f"PARTITIONED BY ({schema.FACT_PARTITION})" if name == "fact_sales" else ""
        keyed = ""
        if n and name in BUCKETED:
            keys, order = BUCKETED[name]
            keyed = f"CLUSTERED BY ({', '.join(keys)}) SORTED BY ({order}) INTO {n} BUCKETS"
        where = table_path(root, name).replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {full.split('.')[0]}")
        # Partitions are those that the folder has, whoever wrote them.
        tracked = "spark.sql.hive.manageFilesourcePartitions"
        before = spark.conf.get(tracked)
        spark.conf.set(tracked, "false")
        try:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet OPTIONS (compression 'zstd') "
                      f"{partition} {keyed} LOCATION '{where}'")
        finally:
            spark.conf.set(tracked, before)
    return full


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A star table as stored; empty while nothing was written."""
    if buckets(spark, root):
        full = define_table(spark, root, name)
        spark.catalog.refreshTable(full)                     # files that other sessions have added
        return spark.table(full)
    sch = T.StructType(_columns(name))
    if not path_exists(spark, table_path(root, name)):
        return empty_table(spark, sch)
    return spark.read.schema(sch).parquet(table_path(root, name))


def write_table(spark: SparkSession, root: str, name: str, rows: DataFrame, mode: str = "append") -> int:
    """Append (or write anew) rows of a star table; returns how many, counted as
    they are written."""
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.STAR_TABLES[name].fields])
    n, written = buckets(spark, root), Observation()
    if not n:
        if name == "fact_sales":
            rows = with_partition_column(rows)
        out = rows.observe(written, F.count(F.lit(1)).alias("n")).write.mode(mode)
        (out.partitionBy(schema.FACT_PARTITION) if name == "fact_sales" else out).parquet(table_path(root, name))
        return written.get["n"]
    full = define_table(spark, root, name)
    if name in BUCKETED:
        rows = rows.repartition(n, *BUCKETED[name][0])       # a task has one bucket
    if name == "fact_sales":
        rows = with_partition_column(rows)
    rows.observe(written, F.count(F.lit(1)).alias("n")).write.insertInto(full, overwrite=mode == "overwrite")
    return written.get["n"]


def write_star(star: Star, root: str, mode: str = "append") -> dict[str, int]:
    """Write the six tables (``append`` or, if asked for, ``overwrite``);
    returns the rows each table has gained or, overwritten, has."""
    spark = star.fact_sales.sparkSession
    return {name: write_table(spark, root, name, getattr(star, name), mode) for name in [*DIMENSIONS, "fact_sales"]}


def read_star(spark: SparkSession, root: str) -> Star:
    return Star(**{name: read_table(spark, root, name) for name in schema.STAR_TABLES}, buckets=buckets(spark, root))


def create_star(spark: SparkSession, root: str, database: str, replace: bool = False) -> None:
    """Tables of the warehouse under ``root`` and the view
    ``STORE_QUARTERLY_SALES``, by name in ``database``, for every session of the
    catalog.  With ``replace`` the stored tables are emptied first."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in schema.STAR_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")          # the definition; the files stay
        full = define_table(spark, root, name, database)
        if replace:
            write_table(spark, root, name, spark.createDataFrame([], schema.STAR_TABLES[name]), "overwrite")
            spark.catalog.refreshTable(full)
    spark.sql(f"""CREATE OR REPLACE VIEW {database}.STORE_QUARTERLY_SALES AS
        SELECT s.store_name, d.year, d.quarter, CAST(SUM(f.revenue) AS DECIMAL(22,2)) AS total_quarterly_sales
        FROM {database}.fact_sales f JOIN {database}.dim_date d ON d.date_id = f.date_id
             JOIN {database}.dim_store s ON s.store_id = f.store_id
        GROUP BY s.store_name, d.year, d.quarter""")


def exists(spark: SparkSession, root: str) -> bool:
    """Whether a derived copy under ``root`` was completed."""
    return path_exists(spark, f"{root.rstrip('/')}/_COMPLETE")


def complete(spark: SparkSession, root: str) -> None:
    """Mark a derived copy as completed."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/_COMPLETE")
    fs.create(p, True).close()


def _code_fingerprint() -> str:
    """Hash of the package sources: a code change gives a new warehouse."""
    h = hashlib.sha1()
    pkg = pathlib.Path(__file__).resolve().parent.parent
    for p in sorted(pkg.rglob("*.py")):
        h.update(p.relative_to(pkg).as_posix().encode())
        h.update(p.read_bytes())
    return h.hexdigest()[:12]


def _state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input files: changed inputs give a new copy."""
    fs, p = _fs(spark, sf_dir)
    found = []
    files = fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().toString()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(found))


def warehouse_root(spark: SparkSession, sf_dir: str, tag: str = "star") -> str:
    key = hashlib.sha1(f"{sf_dir.rstrip('/')}|{_code_fingerprint()}|{_state(spark, sf_dir)}".encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/{tag}_{key}"


def star_for(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> Star:
    """The star loaded from the test tables in ``sf_dir``: once into the shared
    folder, then read by every report.  A copy that isn't complete, left by a
    run that failed, is written anew."""
    from sparkmart.plans.inputs import testdata_inputs  # local: avoids a cycle
    from sparkmart.plans.etl import star_rows

    root = warehouse_root(spark, sf_dir)
    if rebuild or not exists(spark, root):
        write_star(star_rows(spark, testdata_inputs(spark, sf_dir)), root, mode="overwrite")
        complete(spark, root)
    return read_star(spark, root)
