"""Tables as plain Parquet folders, written with Spark's own writers: appends, merges and keyed replacement.

``rows`` holds the files, partitioned by the table's folder column, if it has one, and by load; with ``schema.json`` an empty
table can be read.  The folder column is a column of the table (a day), or is derived from its columns by SQL and not part of
what is read: the day of an event's own time, or a bucket of a key.  What follows from a key alone never changes folders.

An append is a load of its own, and ``loads`` lists the finished ones, each with its folders.  A numbered load that is finished
isn't written again, so a batch that is delivered again changes nothing, even after some of its rows were replaced; one that
was cut off is written anew in its own folders.  Who reads a table in steps remembers which loads it has had (``LoadSet``).

A replacement rewrites the folders that hold its keys, or the whole of a table without any, as a load of its own; rows that a cut-off append left
there go, since it comes again.  Rewrites are written aside first, since they may read the table itself; a note then says which folders to move and which are empty now, and
``finish`` completes a move that was cut off, however often.  One writer a table is assumed, and no reader during a rewrite:
who needs snapshots puts a table format in this place.  All access is through Hadoop file systems, so a table can live on any
store that Spark reaches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators.scope import exclude, restrict, union

LOAD = "load"
#: Spark's folder name for a partition without a value.
NULL = "__HIVE_DEFAULT_PARTITION__"
#: The note that what is written aside is whole, and where it belongs.
READY = "_ready.json"


class TableError(RuntimeError):
    pass


class LoadSet:
    """Names of loads; numbered ones of a stream are kept as ranges, so a long history stays short."""

    def __init__(self, stored: dict | None = None) -> None:
        stored = stored or {}
        self.ranges: dict[str, list[list[int]]] = {k: [list(r) for r in v] for k, v in stored.get("ranges", {}).items()}
        self.others = set(stored.get("others", []))

    @staticmethod
    def _split(load: str) -> tuple[str, int] | None:
        stream, _, n = load.rpartition("-")
        return (stream, int(n)) if stream and n.isdigit() and str(int(n)) == n else None

    def __contains__(self, load: str) -> bool:
        if at := self._split(load):
            return any(low <= at[1] <= high for low, high in self.ranges.get(at[0], []))
        return load in self.others

    def add(self, load: str) -> None:
        if load in self:
            return
        if not (at := self._split(load)):
            self.others.add(load)
            return
        merged: list[list[int]] = []
        for low, high in sorted([*self.ranges.get(at[0], []), [at[1], at[1]]]):
            if merged and low <= merged[-1][1] + 1:
                merged[-1][1] = max(high, merged[-1][1])
            else:
                merged.append([low, high])
        self.ranges[at[0]] = merged

    def stored(self) -> dict:
        return {"ranges": self.ranges, "others": sorted(self.others)}


class Table:
    """``partition_by`` is the name of the folder column, or {name: SQL of the table's columns} for a derived one."""

    def __init__(self, spark: SparkSession, root: str, name: str, partition_by: Sequence[str] | Mapping[str, str] = ()) -> None:
        self.spark, self.path, self.name, self.partition_by = spark, f"{root.rstrip('/')}/{name}", name, list(partition_by)
        self.derived = dict(partition_by) if isinstance(partition_by, Mapping) else {}
        self.fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *below]))

    def exists(self) -> bool:
        return self.fs.exists(self._at("schema.json"))

    def _load_json(self, *at: str):
        stream = self.fs.open(self._at(*at))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _store_json(self, value, *at: str) -> None:
        """Written aside and moved, so that it is there whole or not at all."""
        part = self._at(*at[:-1], f".{at[-1]}.part")
        stream = self.fs.create(part, True)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()
        self.fs.delete(self._at(*at), False)
        if not self.fs.rename(part, self._at(*at)):
            raise TableError(f"{self.path}/{'/'.join(at)} could not be written")

    def schema(self) -> T.StructType:
        if not self.exists():
            raise TableError(f"there is no table {self.name}")
        return T.StructType.fromJson(self._load_json("schema.json"))

    def create(self, schema: T.StructType) -> None:
        """An empty table; a no-op if there is one."""
        if not self.exists():
            self._store_json(schema.jsonValue(), "schema.json")

    def foldered(self, df: DataFrame) -> DataFrame:
        """``df`` with the folder column, if the table derives one."""
        return df.withColumns({c: F.expr(sql) for c, sql in self.derived.items()})

    def _stored(self) -> DataFrame:
        """All rows with their folder column and load."""
        schema = self.schema()
        extra = [f for f in self.foldered(self.spark.createDataFrame([], schema)).schema.fields if f.name in self.derived]
        if not self.fs.exists(self._at("rows")):
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *extra, T.StructField(LOAD, T.StringType())]))
        return self.spark.read.schema(T.StructType([*schema.fields, *extra, T.StructField(LOAD, T.StringType())])).parquet(f"{self.path}/rows")

    def read(self) -> DataFrame:
        return self._stored().select(*self.schema().fieldNames())

    def _within(self, rows: DataFrame, folders: Sequence) -> DataFrame:
        (c,) = self.partition_by
        known = F.col(c).isin([f for f in folders if f is not None])
        return rows.where(known | F.col(c).isNull() if None in folders else known)

    def folders_of(self, df: DataFrame) -> list:
        """The folder values of rows that have the columns these are derived from: at most one a folder reaches the driver."""
        return [r[0] for r in self.foldered(df).select(*self.partition_by).distinct().collect()]

    def read_beside(self, df: DataFrame) -> DataFrame:
        """The rows in the folders that rows of ``df`` are in; the rest isn't scanned."""
        return self._within(self._stored(), self.folders_of(df)).select(*self.schema().fieldNames()) if self.partition_by else self.read()

    def _write(self, df: DataFrame, folder: str, mode: str = "static") -> None:
        """``df`` has a load column."""
        writer = self.foldered(df).write.partitionBy(*self.partition_by, LOAD)
        writer.mode("overwrite").option("partitionOverwriteMode", mode).parquet(f"{self.path}/{folder}")

    # loads

    def loads(self) -> list[str]:
        """The finished loads."""
        folder = self._at("loads")
        return sorted(s.getPath().getName().removesuffix(".json") for s in self.fs.listStatus(folder) if not s.getPath().getName().startswith(".")) if self.fs.exists(folder) else []

    def _done(self, load: str) -> None:
        """Lists ``load``, with the folders it is in."""
        there = self.fs.globStatus(self._at("rows", *["*"] * len(self.partition_by), f"{LOAD}={load}")) or []
        self._store_json([s.getPath().getParent().getName() for s in there] if self.partition_by else [], "loads", f"{load}.json")

    def read_loads(self, loads: Sequence[str]) -> DataFrame:
        """The rows of these loads; only their folders are scanned."""
        rows = self._stored().where(F.col(LOAD).isin(list(loads)))
        if self.partition_by:
            (c,) = self.partition_by
            names = {name for load in loads for name in self._load_json("loads", f"{load}.json")}
            kind = rows.schema[c].dataType
            values = [None if v == NULL else v for v in (unquote(n.removeprefix(f"{c}=")) for n in sorted(names))]
            known = F.col(c).isin([F.lit(v).cast(kind) for v in values if v is not None])
            rows = rows.where(known | F.col(c).isNull() if None in values else known)
        return rows.select(*self.schema().fieldNames())

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> None:
        """These rows besides the present ones; ``batch`` is the stream and number of a micro-batch, which counts once however often it is delivered."""
        self.finish()
        self.create(df.schema)
        load = f"{batch[0]}-{batch[1]}" if batch else uuid.uuid4().hex
        if batch and self.fs.exists(self._at("loads", f"{load}.json")):
            return
        self._write(df.select(*self.schema().fieldNames()).withColumn(LOAD, F.lit(load)), "rows", "dynamic")
        self._done(load)

    def overwrite(self, df: DataFrame) -> None:
        """These rows alone, as one new load; ``df`` may read the table itself."""
        self.finish()
        load = uuid.uuid4().hex
        self._write(df.withColumn(LOAD, F.lit(load)), "whole")
        self._store_json({"schema": df.schema.jsonValue(), "load": load}, "whole", READY)
        self.finish()

    def merge(self, df: DataFrame, keys: Sequence[str]) -> None:
        """Rows of ``df`` replace those with the same keys; others are added.

        Where the folder doesn't follow from the keys, the folders of the old rows are looked up in the columns of keys and folder.
        """
        old = df
        if self.exists() and self.partition_by and not self.derived and not set(self.partition_by) <= set(keys):
            columns = [*keys, *self.partition_by]
            old = restrict(self.read().select(*columns), df, keys, null_safe=True).unionByName(df.select(*columns))
        self.replace(old, df, keys)

    def replace(self, keys_df: DataFrame, df: DataFrame, keys: Sequence[str]) -> None:
        """Rows with keys in ``keys_df`` go, rows of ``df`` come: keys without new rows just go.  Null is a key like others.

        In a partitioned table ``keys_df`` also has the columns that tell the folder of these rows, and only those folders and the ones of
        ``df`` are read and written.  Folder values are all that reaches the driver.
        """
        if not self.exists():
            return self.overwrite(df)
        self.finish()
        names = self.schema().fieldNames()
        new = df.select(*names)
        if not self.partition_by:
            return self.overwrite(exclude(self.read(), keys_df, keys, null_safe=True).unionByName(new))
        folders = sorted({*self.folders_of(keys_df), *self.folders_of(new)}, key=str)
        load = uuid.uuid4().hex
        (c,) = self.partition_by
        touched = [f"{c}={NULL if v is None else v}" for v in folders]
        there = {s.getPath().getName().removeprefix(f"{LOAD}=") for f in touched for s in self.fs.globStatus(self._at("rows", f, f"{LOAD}=*")) or []}
        cut_off = [x for x in sorted(there) if not self.fs.exists(self._at("loads", f"{x}.json"))]
        stay = exclude(self._within(self._stored(), folders).where(~F.col(LOAD).isin(cut_off)).select(*names), keys_df, keys, null_safe=True)
        self._write(stay.unionByName(new).withColumn(LOAD, F.lit(load)), "days")
        here = [s.getPath().getName() for s in self.fs.listStatus(self._at("days")) if s.isDirectory()]
        self._store_json({"move": here, "empty": [f for f in touched if f not in here], "load": load}, "days", READY)
        self.finish()

    def finish(self) -> None:
        """Move what was written aside into its place; does nothing unless it was written to its end.  Each step can be done again."""
        if self.fs.exists(self._at("whole", READY)):
            note = self._load_json("whole", READY)
            self._store_json(note["schema"], "schema.json")
            self.fs.delete(self._at("rows"), True)
            self.fs.delete(self._at("days"), True)
            self._move("whole", "rows")
        if self.fs.exists(self._at("rows", READY)):
            self._done(self._load_json("rows", READY)["load"])
            self.fs.delete(self._at("rows", READY), False)
        if self.fs.exists(self._at("days", READY)):
            note = self._load_json("days", READY)
            for folder in note["empty"]:
                self.fs.delete(self._at("rows", folder), True)
            for folder in note["move"]:
                if self.fs.exists(self._at("days", folder)):  # else it was moved before the cut-off
                    self.fs.delete(self._at("rows", folder), True)
                    self._move(f"days/{folder}", f"rows/{folder}")
            self._done(note["load"])
            self.fs.delete(self._at("days"), True)

    def _move(self, old: str, new: str) -> None:
        self.fs.mkdirs(self._at(new).getParent())
        if not self.fs.rename(self._at(old), self._at(new)):
            raise TableError(f"{self.path}/{old} could not be moved to {new}")

    def drop(self) -> None:
        self.fs.delete(self._at(), True)


class Catalog:
    """Tables below one root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def table(self, name: str, partition_by: Sequence[str] | Mapping[str, str] = ()) -> Table:
        return Table(self.spark, self.root, name, partition_by)

    def list(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []

    def views(self, *names: str) -> None:
        """Register tables for SQL."""
        for name in names or self.list():
            self.table(name).read().createOrReplaceTempView(name)

    def counts(self) -> DataFrame:
        return union([self.table(n).read().agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in self.list()])
