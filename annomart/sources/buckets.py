"""Co-partitioned storage: the tables that hops chain, bucketed by the key they are joined on.

``co_partitioned(cat)`` is a catalog over ``cat`` whose large tables are read from
copies written in buckets of the feature id (edges twice, by either end).  A
join on that key needs no exchange of the table, and a hop's result, once it
is joined with its far features, is already placed for the next hop: one
exchange a hop, of the hop's own rows, instead of three.  Within a bucket rows
are sorted by type, so a type test still skips row groups.

The number of buckets should be that of the shuffle partitions at the size the
tables are used at (a hundred to some thousands on a cluster); each copy costs
one shuffle when it is written and the size of the table on disk.  Worth it for
tables that many mart builds read; one-off lookups do without.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame

from .tables import Catalog, _fs, publish
from ..session import ensure_checkpoint_dir

#: table -> the key of its buckets
BUCKETS = {
    "feature": "feature_id",
    "feature_synonym": "feature_id",
    "feature_cvterm": "feature_id",
    "feature_dbxref": "feature_id",
    "feature_pub": "feature_id",
    "featureprop": "feature_id",
    "feature_relationship": "object_id",
    "synonym": "synonym_id",
}


class CoPartitioned(Catalog):
    """Tables of ``base``; those in ``BUCKETS`` from bucketed copies, written once."""

    def __init__(self, base: Catalog, buckets: int | None = None, root: str | None = None):
        super().__init__(base.spark, base.sf_dir, reader=base.table)
        self.base = base
        self.buckets = buckets or int(base.spark.conf.get("spark.sql.shuffle.partitions"))
        if root is None and base.materialize:
            root = f"{base._stage_root()}-buckets{self.buckets}"
        self.root = (root or f"{ensure_checkpoint_dir(base.spark)}/annomart-stage/buckets-{uuid.uuid4().hex}").rstrip("/")

    def table(self, name: str) -> DataFrame:
        if name in BUCKETS and name not in self._cache:
            with self._once(name):
                if name not in self._cache:
                    self._cache[name] = self._copy(name, BUCKETS[name])
        return super().table(name)

    def edges_by(self, key: str) -> DataFrame:
        if key == BUCKETS["feature_relationship"]:
            return self["feature_relationship"]
        name = f"feature_relationship by {key}"
        with self._once(name):
            if name not in self._cache:
                self._cache[name] = self._copy("feature_relationship", key)
            return self._cache[name]

    def location_table(self) -> str:
        return self.base.location_table()

    def _copy(self, name: str, key: str) -> DataFrame:
        df = self.base[name]
        order = [c for c in ("type_id",) if c in df.columns] + [key]
        path = f"{self.root}/{name}-{key}"
        fs, done = _fs(self.spark, f"{path}/_SUCCESS")
        if not fs.exists(done):
            tmp, work = f"{path}.tmp-{uuid.uuid4().hex}", f"annomart_tmp_{uuid.uuid4().hex}"
            # one task a bucket, so a bucket is one file
            (df.repartition(self.buckets, key).write.format("parquet").bucketBy(self.buckets, key).sortBy(*order)
             .option("path", tmp).saveAsTable(work))
            self.spark.sql(f"DROP TABLE {work}")                         # external: its files stay
            publish(self.spark, tmp, path)
        table = "annomart_" + hashlib.sha1(path.encode()).hexdigest()[:24]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet OPTIONS (path '{path}') "
                       f"CLUSTERED BY (`{key}`) SORTED BY ({', '.join(f'`{c}`' for c in order)}) INTO {self.buckets} BUCKETS")
        return self.spark.table(table)


def co_partitioned(cat: Catalog, buckets: int | None = None, root: str | None = None) -> CoPartitioned:
    """``cat`` with bucketed copies of its large tables, written below ``root``
    (by default beside the staged tables) when they are first read."""
    return CoPartitioned(cat, buckets, root)
