"""A keyed table kept in parts by key hash, whose edits rewrite only the parts they touch.

A version is a manifest: the table's schema, keys and number of parts, and for each part the folder with its rows. An
edit writes new folders for the parts that hold changed keys and a manifest that names these and the old folders of
the others. The version whose manifest has the largest number is the table, so one rename is the commit; a reader
sees one version or the next. Of two edits of one version the later rename finds its name taken and fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from logweir.operators.snapshots import delete_where, update_where, upsert

_PART = "_part"


class PartTable:
    """The table under ``path``; ``create`` makes the first version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- files, by Hadoop's file systems ----

    def _fs(self):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def versions(self) -> list[int]:
        files, Path = self._fs()
        folder = Path(f"{self.path}/manifests")
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """Manifest of a version, the newest unless given."""
        versions = self.versions()
        version = version if version is not None else versions[-1] if versions else None
        if version not in versions:
            raise ValueError(f"{self.path} has no version {version}")
        text = self.spark.read.text(f"{self.path}/manifests/{version:010d}.json", wholetext=True).first().value
        return {"version": version, **json.loads(text)}

    def _commit(self, version: int, manifest: dict) -> None:
        files, Path = self._fs()
        made = Path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = files.create(made)
        out.write(json.dumps(manifest, sort_keys=True).encode())
        out.close()
        name = Path(f"{self.path}/manifests/{version:010d}.json")
        if files.exists(name) or not files.rename(made, name):
            files.delete(made, False)
            raise RuntimeError(f"another edit made version {version}")

    # ---- reading ----

    def _part(self, n: int, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias(_PART)

    def read(self, parts: Sequence[int] | None = None, version: int | None = None) -> DataFrame:
        """Rows of the table, or of some parts only."""
        m = self.manifest(version)
        schema = StructType.fromJson(m["schema"])
        folders = [folder for part, folder in m["parts"].items() if parts is None or int(part) in set(parts)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows with one of the given keys; only the parts that may hold them are read."""
        m = self.manifest()
        keys = self._typed_keys(keys, m)
        return self.read(self._touched(keys, m)).join(keys.distinct(), m["keys"], "left_semi")

    # ---- editing ----

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: Sequence[str], parts: int = 64) -> PartTable:
        """Version 0 from ``df``. ``parts`` is fixed for good: choose it for parts of some hundred MB."""
        table = cls(df.sparkSession, path)
        if table.versions():
            raise ValueError(f"{path} is a table already")
        schema = json.loads(df.schema.json())
        folders = table._write(df, parts, list(keys))
        table._commit(0, {"schema": schema, "keys": list(keys), "n": parts, "parts": folders})
        return table

    def _write(self, df: DataFrame, n: int, keys: Sequence[str]) -> dict[str, str]:
        """Folders of the written parts; a part without rows has none."""
        out = f"{self.path}/data/{uuid.uuid4().hex}"
        df.withColumn(_PART, self._part(n, keys)).repartition(n, _PART).write.partitionBy(_PART).parquet(out)
        files, Path = self._fs()
        names = [s.getPath().getName() for s in files.listStatus(Path(out)) if s.isDirectory()]
        return {name.removeprefix(f"{_PART}="): f"{out}/{name}" for name in names if name.startswith(f"{_PART}=")}

    def _typed_keys(self, rows: DataFrame, m: dict) -> DataFrame:
        """The keys with the table's types: other types would hash to other parts."""
        schema = StructType.fromJson(m["schema"])
        return rows.select(*(F.col(k).cast(schema[k].dataType).alias(k) for k in m["keys"]))

    def _touched(self, keys: DataFrame, m: dict) -> list[int]:
        """Parts of some keys; at most as many numbers as the table has parts."""
        return [r[0] for r in keys.select(self._part(m["n"], m["keys"])).distinct().collect()]

    def _swap(self, m: dict, touched: Sequence[int], rows: DataFrame) -> int:
        """Commit ``rows`` as all of the ``touched`` parts."""
        new = self._write(rows, m["n"], m["keys"])
        parts = {p: folder for p, folder in m["parts"].items() if int(p) not in set(touched)} | new
        self._commit(m["version"] + 1, {"schema": m["schema"], "keys": m["keys"], "n": m["n"], "parts": parts})
        return m["version"] + 1

    def merge(self, changes: DataFrame, order: str | None = None) -> int:
        """Put rows in place of those with the same keys and add the others, as ``upsert`` does; the new version."""
        m = self.manifest()
        schema = StructType.fromJson(m["schema"])
        changes = changes.withColumns({k: F.col(k).cast(schema[k].dataType) for k in m["keys"]})
        touched = self._touched(changes, m)
        if not touched:
            return m["version"]
        merged = upsert(self.read(touched, m["version"]), changes, m["keys"], order)
        return self._swap(m, touched, merged.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema)))

    def delete(self, keys: DataFrame) -> int:
        """Remove the rows with the given keys; the new version."""
        m = self.manifest()
        keys = self._typed_keys(keys, m)
        touched = self._touched(keys, m)
        if not touched:
            return m["version"]
        return self._swap(m, touched, self.read(touched, m["version"]).join(keys.distinct(), m["keys"], "left_anti"))

    def _where(self, cond: Column, edit) -> int:
        """Edit the parts that hold a row for which ``cond`` is true."""
        m = self.manifest()
        hit = self.read(version=m["version"]).where(F.coalesce(cond, F.lit(False)))
        touched = self._touched(hit, m)
        if not touched:
            return m["version"]
        return self._swap(m, touched, edit(self.read(touched, m["version"])))

    def update_where(self, cond: Column, sets: Mapping[str, Column]) -> int:
        """Set columns, not keys, on the rows for which ``cond`` is true; the new version."""
        if set(sets) & set(self.manifest()["keys"]):
            raise ValueError("keys decide where a row lies: delete it and merge the new one")
        return self._where(cond, lambda df: update_where(df, cond, sets).select(*df.columns))

    def delete_where(self, cond: Column) -> int:
        """Remove the rows for which ``cond`` is true; the new version."""
        return self._where(cond, lambda df: delete_where(df, cond))

    def vacuum(self, keep: int = 1) -> int:
        """Drop all but the last ``keep`` versions and the folders that none of these names; how many folders.

        Not while a reader uses an older version or an edit is under way.
        """
        files, Path = self._fs()
        versions = self.versions()
        held = {folder for v in versions[-keep:] for folder in self.manifest(v)["parts"].values()}
        for v in versions[:-keep]:
            files.delete(Path(f"{self.path}/manifests/{v:010d}.json"), False)
        gone = 0
        for batch in files.listStatus(Path(f"{self.path}/data")):
            folders = [s.getPath() for s in files.listStatus(batch.getPath()) if s.isDirectory()]
            names = {f"{self.path}/data/{batch.getPath().getName()}/{f.getName()}": f for f in folders}
            drop = [f for name, f in names.items() if name not in held]
            gone += len(drop)
            if len(drop) == len(names):
                files.delete(batch.getPath(), True)
            else:
                for f in drop:
                    files.delete(f, True)
        return gone
