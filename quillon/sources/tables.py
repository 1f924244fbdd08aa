"""Stored tables: hash buckets of rows by key, and a manifest that names each bucket's files.

    path/data/<load>/bucket=<n>/   the rows of a bucket, as a load left them
    path/manifest/<version>.json   schema, keys, and the folder of each bucket
    path/rejected/<load>/          rows that a load's checks turned down, with the reasons

A load rewrites the buckets that its rows fall into and then adds a manifest, by one rename: readers see the
table before it or after it, never none and never half of it. Files of replaced buckets stay while one of the
last `retain` manifests names them, so running reads go on. Only one writer may load at a time; a second one that
commits first makes the other's load fail and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, WHY = "__bucket", "__why"
REJECTED = -1


class Conflict(RuntimeError):
    """Another writer committed first."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a stored table that still have a manifest, oldest first; none where there is no table."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/manifest") if n.endswith(".json") and n[:-5].isdigit()]


def manifest(spark: SparkSession, path: str, version: int) -> dict:
    p, fs = _fs(spark, f"{path}/manifest/{version:09d}.json")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, version: int, told: dict) -> None:
    """Make `told` the table's manifest `version`: written aside, then renamed."""
    aside, fs = _fs(spark, f"{path}/manifest/.{uuid.uuid4().hex}")
    target = _fs(spark, f"{path}/manifest/{version:09d}.json")[0]
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(told).encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise Conflict(f"version {version} of {path} is there already")


def _observed(seen: Observation, names: Iterable[str]) -> dict[str, int]:
    """The counts of a job that has run; zeros where its input was empty and Spark left the counting out."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return {n: int(found.get(n) or 0) for n in names}


class Table:
    """A table stored below `path`, opened or (with a schema and keys) created when first loaded."""

    def __init__(self, spark: SparkSession, path: str, keys: Iterable[str] = (), buckets: int = 16, retain: int = 2):
        self.spark, self.path, self.retain = spark, path.rstrip("/"), max(1, retain)
        found = versions(spark, self.path)
        self.version = found[-1] if found else 0
        self._told = manifest(spark, self.path, self.version) if found else {"keys": list(keys), "buckets": buckets, "folders": {}, "schema": None}
        if keys and list(keys) != self._told["keys"]:
            raise ValueError(f"{path} has the keys {self._told['keys']}")

    @property
    def keys(self) -> list[str]:
        return self._told["keys"]

    @property
    def schema(self) -> T.StructType | None:
        return T.StructType.fromJson(self._told["schema"]) if self._told["schema"] else None

    def folders(self) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        return {int(k): f"{self.path}/{v}" for k, v in self._told["folders"].items()}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the table as opened, or of one of its retained versions."""
        told = self._told if version is None else manifest(self.spark, self.path, version)
        if not told["schema"]:
            raise ValueError(f"{self.path} was never loaded")
        return self._rows([f"{self.path}/{v}" for v in told["folders"].values()], T.StructType.fromJson(told["schema"]))

    def _rows(self, folders: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _bucket(self, keys: list[str] | None = None) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys or self.keys]), F.lit(self._told["buckets"])).cast("int")

    def load(self, new: DataFrame, order: str | None = None, update: bool = True, checks: dict[str, Column] | None = None) -> dict[str, int]:
        """Upsert `new` (or insert where absent); what was done: read, rejected, inserted, updated, and rejected rows by check.

        Of rows of one key the last in `order` counts (the first, if nothing is updated), without an order one of
        them by its content; a stored row that is later in `order` stays; null keys are equal. A row for which a check is not true is kept from the table and
        stored below rejected/ with the names of its checks. All counts come from the jobs that write. Loading
        the same rows again changes nothing.
        """
        spark, load = self.spark, uuid.uuid4().hex
        schema = self.schema or new.schema
        why = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in (checks or {}).items()]), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
        rows = new.select(*[F.col(f"`{c}`") for c in schema.names], why.alias(WHY), *([F.col(f"`{order}`").alias("__order")] if order else []))
        first = F.col("__order").asc() if not update else F.col("__order").desc()
        by_content = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in schema.names])
        turn = Window.partitionBy(F.size(WHY) > 0, *[F.col(f"`{k}`") for k in self.keys]).orderBy(*([first] if order else []), by_content)
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("read"), F.count_if(F.size(WHY) > 0).alias("rejected"), *[F.count_if(F.array_contains(WHY, n)).alias(f"check_{n}") for n in checks or {}]]
        staged = f"{self.path}/data/.staged-{load}"
        kept = rows.observe(seen, *counts).withColumn("__turn", F.row_number().over(turn)).filter((F.col("__turn") == 1) | (F.size(WHY) > 0))
        kept = kept.withColumn(BUCKET, F.when(F.size(WHY) > 0, F.lit(REJECTED)).otherwise(self._bucket()))
        kept.select(*[F.col(f"`{c}`") for c in schema.names], WHY, BUCKET).repartition(BUCKET).write.partitionBy(BUCKET).parquet(staged)
        done = _observed(seen, ["read", "rejected", *[f"check_{n}" for n in checks or {}]]) | {"inserted": 0, "updated": 0}

        touched = sorted(int(n.split("=")[1]) for n in _names(spark, staged) if n.startswith(f"{BUCKET}="))
        told = self._told | {"schema": json.loads(schema.json()), "folders": dict(self._told["folders"]), "load": load}
        if REJECTED in touched:
            touched.remove(REJECTED)
            kinds = T.StructType([*schema.fields, T.StructField(WHY, T.ArrayType(T.StringType()))])
            self._rows([f"{staged}/{BUCKET}={REJECTED}"], kinds).withColumnRenamed(WHY, "why").write.parquet(f"{self.path}/rejected/{load}")
        if touched:
            written = Observation()
            fresh = self._rows([f"{staged}/{BUCKET}={b}" for b in touched], schema)
            held = self.folders()
            merged = self._merged(self._rows([held[b] for b in touched if b in held], schema), fresh, schema, update, order)
            merged = merged.observe(written, F.count_if("__in").alias("inserted"), F.count_if("__up").alias("updated")).drop("__in", "__up").withColumn("bucket", self._bucket())
            n = min(len(touched), int(spark.conf.get("spark.sql.shuffle.partitions")))
            merged.repartition(n, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{load}")
            done |= _observed(written, ["inserted", "updated"])
            told["folders"] |= {str(b): f"data/{load}/bucket={b}" for b in touched}
        p, fs = _fs(spark, staged)
        fs.delete(p, True)
        if touched or not self.version:
            commit(spark, self.path, self.version + 1, told)
            self.version, self._told = self.version + 1, told
            self._vacuum()
        return done

    def _merged(self, old: DataFrame, new: DataFrame, schema: T.StructType, update: bool, order: str | None) -> DataFrame:
        """Rows of both, with __in and __up: whether a row is new, or another than before."""
        o, n = old.select(F.struct(*[F.col(f"`{c}`") for c in schema.names]).alias("o")), new.select(F.struct(*[F.col(f"`{c}`") for c in schema.names]).alias("n"))
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col("o")[k].eqNullSafe(F.col("n")[k])
        both = o.join(n, same, "full")
        other = F.to_json("o") != F.to_json("n")
        changes = F.col("o").isNotNull() & F.col("n").isNotNull() & other & F.lit(update)
        if order in schema.names:  # what comes late replaces nothing newer
            changes = changes & F.coalesce(F.col("n")[order] >= F.col("o")[order], F.col("o")[order].isNull())
        row = F.when(F.col("o").isNull() | changes, F.col("n")).otherwise(F.col("o"))
        return both.select(row.alias("r"), F.col("o").isNull().alias("__in"), changes.alias("__up")).select("r.*", "__in", "__up")

    def rejected(self) -> DataFrame:
        """All rows that checks turned down, with `why`."""
        loads = _names(self.spark, f"{self.path}/rejected")
        kinds = T.StructType([*(self.schema or T.StructType()).fields, T.StructField("why", T.ArrayType(T.StringType()))])
        return self._rows([f"{self.path}/rejected/{x}" for x in loads], kinds)

    def _vacuum(self) -> None:
        """Delete what no retained manifest names: old manifests and bucket folders."""
        found = versions(self.spark, self.path)
        for v in found[: -self.retain]:
            p, fs = _fs(self.spark, f"{self.path}/manifest/{v:09d}.json")
            fs.delete(p, False)
        named = {f for v in found[-self.retain :] for f in manifest(self.spark, self.path, v)["folders"].values()}
        for load in _names(self.spark, f"{self.path}/data"):
            if load.startswith("."):
                continue
            for bucket in _names(self.spark, f"{self.path}/data/{load}"):
                if bucket.startswith("bucket=") and f"data/{load}/{bucket}" not in named:
                    p, fs = _fs(self.spark, f"{self.path}/data/{load}/{bucket}")
                    fs.delete(p, True)
            if not any(n.startswith("bucket=") for n in _names(self.spark, f"{self.path}/data/{load}")):
                p, fs = _fs(self.spark, f"{self.path}/data/{load}")
                fs.delete(p, True)

    def rewritten(self, change: Callable[[DataFrame], DataFrame], note: str = "", keys: list[str] | None = None) -> None:
        """Put change(rows) in the place of all rows, in one step; the schema is that of the result, the keys are the old ones or `keys`."""
        load, rows, keys = uuid.uuid4().hex, change(self.read()), keys or self.keys
        missing = [k for k in keys if k not in rows.columns]
        if missing:
            raise ValueError(f"a key goes: {missing}")
        rows.withColumn("__b", self._bucket(keys)).repartition("__b").withColumnRenamed("__b", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{load}")
        held = sorted(int(n.split("=")[1]) for n in _names(self.spark, f"{self.path}/data/{load}") if n.startswith("bucket="))
        told = self._told | {"schema": json.loads(rows.schema.json()), "keys": keys, "folders": {str(b): f"data/{load}/bucket={b}" for b in held}, "load": load, "note": note}
        commit(self.spark, self.path, self.version + 1, told)
        self.version, self._told = self.version + 1, told
        self._vacuum()
