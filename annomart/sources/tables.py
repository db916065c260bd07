"""S1 ``read_tables`` and the lazy catalog of adapter views.

``Catalog(spark, sf_dir)`` hands out DataFrames by table name.  Base tables
are parquet scans; annotation tables are the adapter views of
:mod:`annomart.sources.adapter`, staged once as parquet tables (see
``Catalog``) and memoised per catalog, so every query plans against small
physical tables with filters and column pruning pushed into the scans.
"""

from __future__ import annotations

import hashlib
import os
import re
import threading
import uuid

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..session import held, write_table
from . import adapter, schema

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def read_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """One parquet scan per base table (schema from the files)."""
    names = names or adapter.BASE_TABLES
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def read_annotation_tables(spark: SparkSession, path: str, names=None, jdbc: dict | None = None) -> dict[str, DataFrame]:
    """S1 over real annotation tables: ``{name: DataFrame}`` for a catalog
    (``Catalog(spark, path, tables=...)``), with explicit schemas.

    ``path`` is a folder of Parquet tables; with ``jdbc`` (reader options:
    ``url``, ``driver``, ``partitionColumn`` ...) the tables are read from a
    database schema of that name instead, partitioned by their first column
    when the options give its bounds."""
    out = {}
    for n in names or schema.COLUMNS:
        if jdbc is None:
            out[n] = _read_parquet_table(spark, f"{path.rstrip('/')}/{n}.parquet", n)
        else:
            out[n] = jdbc_reader(spark, jdbc, f"{path}.{n}", n).load()
    return out


def _read_parquet_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One table with its explicit schema.  A column that the files lack would
    read as null: it is left out where it is optional, else the table is refused."""
    have = set(spark.read.parquet(path).columns)
    lack = {c for c in schema.COLUMNS[name].split() if c not in have}
    if needed := sorted(c for c in lack if (name, c) not in schema.OPTIONAL):
        raise ValueError(f"{path} lacks the columns {needed}")
    return spark.read.schema(schema.table_schema(name, lack)).parquet(path)


def annotation_catalog(spark: SparkSession, path: str, jdbc: dict | None = None) -> "Catalog":
    """A catalog over real annotation tables (a folder of Parquet tables, or
    a database schema).  It is closed: a name is one of ``schema.COLUMNS`` and
    is read from there when first asked for; nothing is derived from test data."""
    def read(name: str) -> DataFrame:
        if name not in schema.COLUMNS:
            raise KeyError(f"{name} is no annotation table")
        return read_annotation_tables(spark, path, [name], jdbc)[name]

    return Catalog(spark, path, reader=read)


def jdbc_options(options: dict, table: str, name: str) -> dict[str, str]:
    """Reader options of one table."""
    opts = {k: str(v) for k, v in options.items()} | {"dbtable": table}
    if "lowerBound" in opts and "partitionColumn" not in opts:
        opts["partitionColumn"] = schema.COLUMNS[name].split()[0]
    types = {"bigint": "BIGINT", "boolean": "BOOLEAN", "string": "STRING"}
    opts["customSchema"] = ", ".join(f"{f.name} {types[f.dataType.simpleString()]}" for f in schema.table_schema(name))
    return opts


def jdbc_reader(spark: SparkSession, options: dict, table: str, name: str):
    return spark.read.format("jdbc").options(**jdbc_options(options, table, name))


def view_deps(name: str) -> list[str]:
    text = adapter.VIEWS[name]
    return [m for m in _PLACEHOLDER.findall(text) if m in adapter.VIEWS or m in adapter.BASE_TABLES]


def _spark_text(text: str) -> str:
    """Escape literal braces so ``spark.sql`` formats only the placeholders."""
    known = set(adapter.VIEWS) | set(adapter.BASE_TABLES)
    marks: list[str] = []

    def keep(m):
        if m.group(1) in known:
            marks.append(m.group(1))
            return f"\x00{len(marks) - 1}\x00"
        return m.group(0)

    t = _PLACEHOLDER.sub(keep, text)
    t = t.replace("{", "{{").replace("}", "}}")
    return re.sub("\x00(\\d+)\x00", lambda m: "{" + marks[int(m.group(1))] + "}", t)


# Production layout: typed tables partitioned by their type column.  Every
# lookup selects the type by joining a name-filtered, broadcast slice of
# ``cvterm`` on ``type_id``; with the table partitioned on that column Spark
# turns the join into dynamic partition pruning, so a hop over one
# relationship type reads that type's files only; named types are resolved
# to literal ids (``dims.resolve_terms``), which prunes statically.  On by
# default (``ANNOMART_PARTITION_TYPED=0`` or ``Catalog(partition_typed=False)``
# stages flat tables).
PARTITIONED = {
    "feature_relationship": "type_id",
    "featureprop": "type_id",
    "feature_cvtermprop": "type_id",
    "dbxrefprop": "type_id",
}


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``: the default file system
    for a path without a scheme, as Spark itself resolves it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _fingerprint(spark: SparkSession, sf_dir: str) -> list[str]:
    """Name, size and modification time of every file of the base tables."""
    out = []
    for name in adapter.BASE_TABLES:
        fs, p = _fs(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        if fs.exists(p):
            files = fs.listFiles(p, True)
            while files.hasNext():
                f = files.next()
                out.append(f"{name}/{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return sorted(out)


def _views_key(spark: SparkSession, sf_dir: str) -> str:
    """Key of the staged views: folder, the data files in it, the definitions."""
    h = hashlib.sha1(sf_dir.encode())
    for line in _fingerprint(spark, sf_dir):
        h.update(line.encode())
    for name in sorted(adapter.VIEWS):
        h.update(name.encode())
        h.update(adapter.VIEWS[name].encode())
    return h.hexdigest()[:16]


# a task keeps so many partitions' files open; rows of further ones it sorts
WRITERS = 32
_WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def _open_writers(spark: SparkSession):
    """Partitioned writes of the block keep their files open instead of sorting
    rows by partition; a session's own setting stays."""
    return held(spark, _WRITERS_CONF, str(WRITERS), unless=lambda now: int(now or 0) > 0)


class Catalog:
    """Lazy name -> DataFrame lookup over base tables and adapter views.

    With ``materialize=True`` (default) every adapter view is written once as
    parquet under ``<checkpoint dir>/annomart-views/<key>/`` and read back, so
    queries see it as a physical table: small plans, filters pushed into the
    scan, and lineage cut at the table (a lost executor recomputes from the
    staged files, not from the whole derivation).  The key hashes the source
    directory, its files (name, size, time) and the view definitions, so
    changed data or a changed definition is rebuilt.
    ``materialize=False`` keeps the views as inline plans (tests with
    fixtures, plan inspection).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, tables: dict[str, DataFrame] | None = None,
                 materialize: bool = True, partition_typed: bool | None = None, reader=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.reader = reader                # name -> DataFrame: the only source of tables where it is set
        self.materialize = materialize and not tables and reader is None
        if partition_typed is None:
            partition_typed = os.environ.get("ANNOMART_PARTITION_TYPED", "1") == "1"
        # type-partitioned staging (the production layout, see PARTITIONED)
        self.partitioned = PARTITIONED if partition_typed else {}
        self._cache: dict[str, DataFrame] = dict(tables or {})
        self._root = None
        self._own_locations = False
        self._locks: dict = {}
        self._guard = threading.Lock()

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def _stage_root(self) -> str:
        """``<spark.checkpoint.dir>/annomart-views/<key>`` when the cluster
        names a shared folder; otherwise (local runs, tests) a stable scratch
        folder, so separate sessions reuse what an earlier one staged."""
        if self._root is None:
            layout = "typed" if self.partitioned else "flat"
            sc = self.spark.sparkContext
            conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
            if not conf_dir and not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder: staged tables must not be "
                                   "written to machine-local paths on a cluster")
            base = conf_dir or os.environ.get("ANNOMART_STAGE_DIR") or "file:///tmp/annomart-views"
            self._root = f"{base.rstrip('/')}/annomart-views/{_views_key(self.spark, self.sf_dir)}-{layout}"
        return self._root

    def _staged(self, path: str) -> bool:
        """Whether a complete staged table exists at ``path``."""
        fs, p = _fs(self.spark, path + "/_SUCCESS")
        return fs.exists(p)

    def _write_staged(self, name: str, path: str) -> None:
        """Write a staged table to a path of its own and publish it by rename,
        so concurrent sessions never see or clobber a half-written table."""
        df = self._build(name)
        tmp = f"{path}.tmp-{uuid.uuid4().hex}"
        if name in self.partitioned:
            # a branch of these views holds few types: its tasks write them as
            # they come, and no row is shuffled or sorted by its type
            with _open_writers(self.spark):
                write_table(df, tmp, by=self.partitioned[name])
        else:
            write_table(df, tmp)
        publish(self.spark, tmp, path)

    def _build(self, name: str) -> DataFrame:
        deps = {d: self.table(d) for d in view_deps(name)}
        return self.spark.sql(_spark_text(adapter.VIEWS[name]), **deps)

    def _once(self, key: str):
        """Lock of one table: of several threads that ask for it one builds it."""
        with self._guard:
            return self._locks.setdefault(key, threading.RLock())

    def table(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        with self._once(name):
            return self._table(name)

    def _table(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if self.reader is not None:
            df = self.reader(name)
        elif name in adapter.VIEWS:
            if self.materialize:
                path = f"{self._stage_root()}/{name}.parquet"
                if not self._staged(path):
                    self._write_staged(name, path)
                if name in self.partitioned:
                    # the view's column types and order (partition columns are read last, their type guessed)
                    view = self._build(name)
                    df = self.spark.read.schema(view.schema).parquet(path).select(*view.columns)
                else:
                    df = self.spark.read.parquet(path)
            else:
                df = self._build(name)
        elif name in adapter.BASE_TABLES:
            df = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        else:
            raise KeyError(name)
        self._cache[name] = df
        return df

    def stage_all(self, names=None, workers: int = 4) -> None:
        """Stage views (default: all) ahead of use, independent views in
        parallel: views are grouped by dependency depth and each group is
        staged by a thread pool (Spark runs the jobs concurrently)."""
        from concurrent.futures import ThreadPoolExecutor
        depth: dict[str, int] = {}

        def level(n: str) -> int:
            if n not in depth:
                deps = [d for d in view_deps(n) if d in adapter.VIEWS]
                depth[n] = 1 + max((level(d) for d in deps), default=-1)
            return depth[n]

        for n in (names or adapter.VIEWS):
            level(n)
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for lvl in sorted(set(depth.values())):
                todo = [inheritable_thread_target(lambda n=n: self.table(n)) for n, d in depth.items() if d == lvl]
                for f in [pool.submit(t) for t in todo]:
                    f.result()

    def edges_by(self, key: str) -> DataFrame:
        """``feature_relationship`` for a join on ``key`` (``subject_id`` or
        ``object_id``): a catalog with copies by either end hands out that one."""
        return self["feature_relationship"]

    def location_table(self) -> str:
        """Path of ``featureloc`` laid out by range (``operators.locations``),
        staged beside the views, or in the session's scratch folder for a
        catalog over tables of its own."""
        from ..operators.locations import scratch_path, write_location_table
        key = "path:location_table"
        if key not in self._cache:
            loc = self.table("featureloc")
            if self.materialize and not self._own_locations:
                path = f"{self._stage_root()}/featureloc_ranges"
                if not self._staged(path):
                    tmp = write_location_table(loc, f"{path}.tmp-{uuid.uuid4().hex}")
                    fs, done = _fs(self.spark, tmp + "/_SUCCESS")
                    fs.create(done, True).close()
                    publish(self.spark, tmp, path)
            else:
                path = write_location_table(loc, scratch_path(self.spark))
            self._cache[key] = path
        return self._cache[key]

    def derived(self, name: str, build) -> DataFrame:
        """A table derived from the catalog by ``build()``, written once per
        catalog (Parquet) and shared by every query."""
        key = "derived:" + name
        with self._once(key):
            if key not in self._cache:
                from ..session import stage
                self._cache[key] = stage(build())
            return self._cache[key]

    def result(self, name: str, build) -> DataFrame:
        """``derived`` for the query that returns the table: what is written
        already is read, else it is not written beside the result."""
        with self._once("derived:" + name):
            found = self._cache.get("derived:" + name)
        return build() if found is None else found

    def derived_all(self, builders: dict, workers: int = 4) -> dict[str, DataFrame]:
        """``derived`` for every ``name -> build``, several at a time: the stages
        of one leave cores free that another uses.  A builder may read what
        another derives (by ``derived``), but not in a circle."""
        from concurrent.futures import ThreadPoolExecutor
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.spark)
        with ThreadPoolExecutor(max_workers=workers) as pool:
            found = {n: pool.submit(inheritable_thread_target(lambda n=n, b=b: self.derived(n, b))) for n, b in builders.items()}
            return {n: f.result() for n, f in found.items()}

    def override(self, name: str, df: DataFrame) -> "Catalog":
        """Use ``df`` for ``name`` (tests plug hand-written fixtures in)."""
        self._cache[name] = df
        if name == "featureloc":
            self._cache.pop("path:location_table", None)
            self._own_locations = True          # not the staged ones
        return self


def publish(spark: SparkSession, tmp: str, path: str) -> None:
    """Rename a finished table to its public path.  If another session has
    published a complete one first, that one stays; any other failure raises."""
    fs, source = _fs(spark, tmp)
    _, target = _fs(spark, path)
    if fs.exists(target):
        done = fs.exists(_fs(spark, path + "/_SUCCESS")[1])
    else:
        done = fs.exists(source) and fs.rename(source, target)
    if not done or not fs.exists(_fs(spark, path + "/_SUCCESS")[1]):
        raise OSError(f"could not publish {tmp} as {path}")
    if fs.exists(source):
        fs.delete(source, True)


def oracle_with(query: str) -> str:
    """Prefix ``query`` (DuckDB SQL over view names) with the adapter views it
    needs, as CTEs in dependency order."""
    needed: list[str] = []

    def visit(n):
        if n in needed or n not in adapter.VIEWS:
            return
        for d in view_deps(n):
            visit(d)
        needed.append(n)

    for word in set(re.findall(r"[A-Za-z_]+", query)):
        if word in adapter.VIEWS:
            visit(word)
    if not needed:
        return query
    ctes = ",\n".join(
        f"{n} AS (\n{_PLACEHOLDER.sub(lambda m: m.group(1) if m.group(1) in adapter.VIEWS or m.group(1) in adapter.BASE_TABLES else m.group(0), adapter.VIEWS[n])}\n)"
        for n in needed
    )
    q = query.strip()
    if q[:4].upper() == "WITH":
        return f"WITH {ctes},\n{q[4:].lstrip()}"
    return f"WITH {ctes}\n{q}"
