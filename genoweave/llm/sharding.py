"""Operator 1: size-tiered compaction of immutable shards under a versioned manifest, with DataFrame functions only.

A store is a folder. `append` writes each arrival as a run of small Parquet files and commits a manifest that lists
it. `compact` groups runs of similar size (a tier spans a factor of `fanout`), rewrites each group of at least `fanout`
runs as files of about `target` bytes, and commits a manifest in which the new run stands for the old ones. A manifest
is a Parquet table of its files and one small file that names it and the rows' schema; making that file is the commit,
which fails if another writer has made it before.

Rows are kept as they are: nulls (keys and texts too), empty and very long texts, repeated rows and ties stay, each as
often as it came. An empty table is an arrival without files: the store then has its schema and no rows. Columns may
have any names, those of bookkeeping included: that is kept in the paths and in columns named so that none clashes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRIES = "run string, tier int, folder string, path string, rows long, bytes long, size long"


class Conflict(RuntimeError):
    """Another writer has committed this version."""


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Store:
    def __init__(self, spark: SparkSession, root: str, target: int = 64 << 20, fanout: int = 4, base: int = 1 << 20):
        self.spark, self.root, self.target, self.fanout, self.base = spark, root.rstrip("/"), target, fanout, base
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- manifest

    def version(self) -> int:
        """The last committed version; 0 for a new store."""
        folder = self._path(f"{self.root}/manifests")
        if not self._fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max([0, *(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())])

    def _manifest(self, version: int) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/manifests/v{version}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def schema(self, version: int | None = None) -> T.StructType | None:
        """The schema of the rows; None for a new store."""
        version = self.version() if version is None else version
        return T.StructType.fromJson(self._manifest(version)["schema"]) if version else None

    def entries(self, version: int | None = None) -> DataFrame:
        """The files of a version: run, tier, the run's folder, path, rows, bytes (of the rows' texts) and size on disk."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).parquet(f"{self.root}/manifests/{self._manifest(version)['entries']}")

    def commit(self, entries: DataFrame, after: int, schema: T.StructType | None = None) -> int:
        """Publish entries as the version that follows `after`; Conflict if there is one already."""
        schema = schema or self.schema(after)
        if schema is None:
            raise ValueError("the first version needs a schema")
        name = f"entries-{uuid.uuid4().hex}"
        entries.coalesce(1).write.option("compression", "zstd").parquet(f"{self.root}/manifests/{name}")
        target = self._path(f"{self.root}/manifests/v{after + 1}")
        draft = self._path(f"{self.root}/manifests/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps({"entries": name, "schema": schema.jsonValue()}).encode()))
        out.close()
        try:  # a rename that never overwrites: the whole file appears at once or not at all
            jvm = self.spark._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
            none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(context.makeQualified(draft), context.makeQualified(target), none)
        except Exception as e:
            self._fs.delete(draft, False)
            if self._fs.exists(target):
                raise Conflict(f"version {after + 1} exists") from e
            raise  # not a matter of versions: no space, no permission, ...
        return after + 1

    # ---- writing

    def _rows(self, folders: list[str], schema: T.StructType) -> DataFrame:
        """The rows of the files below some folders, without columns from their paths."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*folders)

    def _measure(self, folder: str, schema: T.StructType, size: Column) -> DataFrame:
        """Entries of the files under a folder whose folders are named run=..."""
        rows = self._rows([folder], schema)
        meta = rows.metadataColumn("_metadata")
        found = rows.select(meta["file_path"].alias("path"), meta["file_size"].alias("size"), size.alias("b"))
        found = found.groupBy("path", "size").agg(F.count("*").alias("rows"), F.sum("b").alias("bytes"))
        of = F.regexp_extract("path", "/[^/=]+=([^/=]+)/", 1)
        return found.withColumn("run", of).withColumn("folder", F.regexp_extract("path", "^(.*/[^/=]+=[^/=]+)/", 1))

    def _tiers(self, entries: DataFrame) -> DataFrame:
        """Entries with the tier of their run: how many times its bytes hold the base, as a power of the fanout."""
        total = F.sum("bytes").over(Window.partitionBy("run"))
        tier = F.greatest(F.lit(0), F.floor(F.log(F.greatest(total, F.lit(1)) / F.lit(float(self.base))) / F.log(F.lit(float(self.fanout)))))
        return entries.withColumn("tier", tier.cast("int")).select("run", "tier", "folder", "path", "rows", "bytes", "size")

    def append(self, rows: DataFrame, arrival: Column, size: Column) -> int:
        """Write the arrivals (one run for each value of `arrival`, null among them) and commit them together. No exchange
        of rows. ValueError if the columns are not those of the store."""
        after = self.version()
        schema = self.schema(after) or T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        if [(f.name, f.dataType) for f in rows.schema.fields] != [(f.name, f.dataType) for f in schema.fields]:
            raise ValueError(f"the store has other columns: {schema.simpleString()}")
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        run = unused(rows, "run")
        # letters and digits only: any value makes a folder name that no reader escapes or takes for a number or a date
        raw = F.encode(arrival.cast("string"), "utf-8")
        of = F.when(F.octet_length(raw) <= 40, F.hex(raw)).otherwise(F.concat(F.lit("h"), F.sha2(raw, 256)))
        name = F.concat(F.lit(f"r{after + 1:06d}-"), F.coalesce(of, F.lit("null")))
        rows.withColumn(run, name).write.partitionBy(run).option("compression", "zstd").parquet(folder)
        new = self._tiers(self._measure(folder, schema, size)) if self._has_files(folder) else self.spark.createDataFrame([], ENTRIES)
        return self.commit(self.entries(after).unionByName(new), after, schema)

    def _has_files(self, folder: str) -> bool:
        return any(not s.getPath().getName().startswith(("_", ".")) for s in self._fs.listStatus(self._path(folder)))

    def plan(self, version: int | None = None) -> DataFrame:
        """(run, merged): the runs to merge and the run that will stand for them: `fanout` or more runs of a tier."""
        runs = self.entries(version).groupBy("run", "tier").agg(F.sum("bytes").alias("bytes"))
        n = F.count("*").over(Window.partitionBy("tier"))
        return runs.withColumn("n", n).where(F.col("n") >= self.fanout).select("run", "tier", F.concat(F.lit("merged-"), F.format_string("%02d", "tier")).alias("merged"))

    def compact(self, size: Column) -> int | None:
        """Merge each full tier into files of about `target` bytes and commit; None if no tier is full.

        One task may write several files, each to its own folder. A row's file is known from the bytes of the files before
        its own and its place in it, so rows go to their file in one exchange and files are even whatever their keys are.
        The driver holds the folders of the merged runs, not their files."""
        after = self.version()
        entries, schema = self.entries(after), self.schema(after)
        plan = self.plan(after)
        members = entries.join(plan.select("run", "merged"), "run")
        before = F.sum("bytes").over(Window.partitionBy("merged").orderBy("run", "path")) - F.col("bytes")
        members = members.withColumn("before", before).select("folder", "path", "merged", "rows", "bytes", "before").cache()
        try:
            totals = members.groupBy("merged").agg(F.sum("bytes").alias("b")).collect()
            if not totals:
                return None
            files = sum(max(1, -(-r["b"] // self.target)) for r in totals)
            rows = self._rows([r["folder"] for r in members.select("folder").distinct().toLocalIterator()], schema)
            own, run, part = (unused(rows, x) for x in ("own", "run", "file"))  # all that is added to the rows
            meta = rows.metadataColumn("_metadata")
            placed = rows.withColumn(own, F.struct(meta["file_path"].alias("path"), meta["row_index"].alias("row")))
            places = members.select(F.struct("*").alias(unused(placed, "place")))
            at, o = F.col(places.columns[0]), F.col(own)
            placed = placed.join(places, o["path"] == at["path"])
            place = F.floor((at["before"] + o["row"] * at["bytes"] / at["rows"]) / F.lit(self.target)).cast("int")
            name = F.concat(F.lit(f"r{after + 1:06d}-"), at["merged"])
            placed = placed.withColumn(run, name).withColumn(part, place)
            placed = placed.repartition(int(files), run, part).sortWithinPartitions(F.col(run), F.col(part), o["path"], o["row"]).drop(own, places.columns[0])
            folder = f"{self.root}/data/{uuid.uuid4().hex}"
            placed.write.partitionBy(run, part).option("compression", "zstd").parquet(folder)
            kept = entries.join(plan.select("run"), "run", "left_anti")
            new = self._tiers(self._measure(folder, schema, size))
            done = self.commit(kept.unionByName(new), after, schema)
            return done
        finally:
            members.unpersist()

    def read(self, version: int | None = None, run: str | None = None) -> DataFrame:
        """All rows of a version with the columns that they came with, at any number of files; with `run`, a column of that
        name tells the run a row is in. ValueError for a new store, or if the rows have a column of that name."""
        schema = self.schema(version)
        if schema is None:
            raise ValueError("the store has no version")
        rows = self._rows([r["folder"] for r in self.entries(version).select("folder").distinct().toLocalIterator()], schema)
        if run is None:
            return rows
        if unused(rows, run) != run:
            raise ValueError(f"the rows have a column {run}")
        path = rows.metadataColumn("_metadata")["file_path"] if rows.inputFiles() else F.lit("")
        return rows.withColumn(run, F.regexp_extract(path, "/[^/=]+=([^/=]+)/", 1))
