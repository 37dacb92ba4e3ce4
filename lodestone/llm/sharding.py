"""Size-tiered compaction of a table of immutable shards, by DataFrame operations and file-system calls only.

append() writes arriving rows as small Parquet shards, where they are, without a shuffle. compact() plans on one row
for each shard: shards of a size tier merge, `fanout` neighbours at a time, tier after tier, until files near the
target; the rows of all tiers move once, each run of shards into one file by one task of its own. A shard's weight is
its size in the file or, if that is more, the share of its size unpacked, so that no task holds more than RAW times the
target. Both end with commit(): the list of shards is a Parquet table of its own, and a small version file that can be
made once only makes it current, so that a reader sees the old version or the new one and of two writers one fails: a
hard link on a local file system, elsewhere a rename that doesn't overwrite, which the file system must make atomic (as
HDFS does). Rows are never altered, and names and members of shards are the same on every run over the same arrivals.

Defined cases: any columns, nulls and repeated rows pass through as they are, also columns named like this module's own;
an empty arrival adds no shard; a shard already beyond the target is left alone; a very long text is one row of one
shard; a table with no version has no rows to read."""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestone.llm.scratch import hadoop_path, scratch_path

#: The list of shards is planned in parts of about so many; shards of different parts don't merge.
EPOCH = 4096
#: Unpacked bytes for each byte of the target that a merged shard may have.
RAW = 4
#: Shards in folders that a version lists in part are read by path up to so many, beyond by a join with their folder.
PATHS = 20_000
_SHARDS = "shard string, name string, n_rows long, n_bytes long, raw_bytes long, arrival long, level int, folder string, folder_shards long"
_AT = "__shard_of_row"


class CommitConflict(RuntimeError):
    """Another writer made this version first."""


class ShardTable:
    def __init__(self, spark: SparkSession, path: str, target_bytes: int = 64 << 20, fanout: int = 4, small_rows: int = 2000, smallest_bytes: int = 1 << 20):
        self.spark, self.path = spark, path.rstrip("/")
        self.target, self.fanout, self.small_rows, self.smallest = target_bytes, fanout, small_rows, smallest_bytes

    # Versions

    def versions(self) -> list[int]:
        fs, p = hadoop_path(self.spark, f"{self.path}/versions")
        return sorted(int(s.getPath().getName()[1:-5]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v")) if fs.exists(p) else []

    def _info(self, version: int) -> dict:
        fs, p = hadoop_path(self.spark, f"{self.path}/versions/v{version:08d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def manifest(self, version: int | None = None) -> DataFrame:
        """One row for each shard of a version, the last one if none is given."""
        version = max(self.versions(), default=0) if version is None else version
        if not version:
            return self.spark.createDataFrame([], _SHARDS)
        return self.spark.read.schema(_SHARDS).parquet(f"{self.path}/{self._info(version)['manifest']}")

    def commit(self, shards: DataFrame, base: int, schema: str) -> int:
        """Make shards version base + 1, or raise CommitConflict if that exists."""
        name = f"manifests/{uuid.uuid4().hex}"
        shards.select(*StructType.fromDDL(_SHARDS).names).write.parquet(f"{self.path}/{name}")
        body = json.dumps({"version": base + 1, "manifest": name, "schema": schema}).encode()
        fs, made = hadoop_path(self.spark, f"{self.path}/versions/.{uuid.uuid4().hex}")
        out = fs.create(made, False)
        out.write(body)
        out.close()
        _, final = hadoop_path(self.spark, f"{self.path}/versions/v{base + 1:08d}.json")
        try:
            self._publish(fs, made, final)
        finally:
            fs.delete(made, False)
        return base + 1

    def _publish(self, fs, made, final) -> None:
        """Give a whole file its name, unless another has it: the name exists with all of its content or not at all."""
        uri = urlparse(fs.makeQualified(made).toString())
        taken = CommitConflict(f"{final.getName()} exists")
        if uri.scheme == "file":
            try:
                os.link(unquote(uri.path), unquote(urlparse(fs.makeQualified(final).toString()).path))
            except FileExistsError as e:
                raise taken from e
            return
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(made, final, options)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                raise taken from e
            raise

    # Rows

    def _files(self, folder: str, schema: StructType, name: Column, arrival: int, level: int) -> DataFrame:
        """Shards in a folder just written: a row for each file that has rows."""
        raw = F.lit(8 * len(schema.fields)).cast("long")
        for f in schema.fields:
            if f.dataType.simpleString() in ("string", "binary"):
                raw = raw + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        files = self.spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(folder)
        # _metadata is the file's own even where the rows have a column of that name.
        path, size = files.metadataColumn("_metadata")["file_path"], files.metadataColumn("_metadata")["file_size"]
        found = files.select(path.alias("shard"), size.alias("n_bytes"), raw.alias("raw")).groupBy("shard", "n_bytes").agg(F.count("*").alias("n_rows"), F.sum("raw").alias("raw_bytes"))
        every = F.count("*").over(W.partitionBy("folder"))
        found = found.withColumns({"name": name, "arrival": F.lit(arrival).cast("long"), "level": F.lit(level), "folder": F.lit(folder)})
        return found.withColumn("folder_shards", every).select(*StructType.fromDDL(_SHARDS).names)

    def append(self, rows: DataFrame) -> int:
        base = max(self.versions(), default=0)
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").option("maxRecordsPerFile", self.small_rows).parquet(folder)
        place = F.concat_ws("-", F.regexp_extract("shard", r"/part-(\d+)-", 1), F.regexp_extract("shard", r"-c(\d+)\.", 1))
        came = self._files(folder, rows.schema, F.concat_ws("/", F.lit(str(base)), place), base, 0)
        return self.commit(self.manifest(base).unionByName(came), base, rows.schema.json())

    def plan(self, shards: DataFrame, parts: int = 1) -> DataFrame:
        """shards with the run each ends in: rows of equal `run` become one shard. Each round merges, within a size
        tier, up to fanout neighbours whose weights add up to the target at most. Every window and group is within a
        part, so that the list is shuffled once, by part, for all rounds."""
        columns = shards.columns
        place = F.row_number().over(W.partitionBy("part").orderBy("arrival", "name"))
        plan = shards.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts))).withColumn("place", F.lpad(place.cast("string"), 9, "0"))
        weight = F.greatest(F.col("n_bytes"), F.ceil(F.col("raw_bytes") / RAW))
        plan = plan.select("part", F.concat_ws("-", "part", "place").alias("run"), weight.alias("run_bytes"), F.array(F.struct(*columns)).alias("members"))
        for _ in range(self.rounds()):
            tier = F.greatest(F.lit(0), F.ceil(F.log(float(self.fanout), F.col("run_bytes") / F.lit(float(self.smallest))) - 0.5))
            runs = plan.withColumn("tier", F.when(F.col("run_bytes") * 2 <= self.target, tier))
            line = W.partitionBy("part", "tier").orderBy("run")
            most = F.least(F.lit(self.fanout), F.greatest(F.lit(1), F.floor(F.lit(self.target) / F.max("run_bytes").over(W.partitionBy("part", "tier"))))).cast("int")
            runs = runs.withColumn("batch", F.when(F.col("tier").isNull(), F.row_number().over(line)).otherwise(F.floor((F.row_number().over(line) - 1) / most)))
            plan = runs.groupBy("part", "tier", "batch").agg(
                F.min("run").alias("run"), F.sum("run_bytes").alias("run_bytes"), F.flatten(F.collect_list("members")).alias("members")
            ).select("part", "run", "run_bytes", "members")
        return plan.select("run", "run_bytes", F.size("members").alias("run_shards"), F.inline("members"))

    def rounds(self) -> int:
        n, size = 1, self.smallest
        while size < self.target:
            n, size = n + 1, size * self.fanout
        return n

    def compact(self) -> int:
        base = max(self.versions(), default=0)
        if not base:
            return 0
        shards = self.manifest(base)
        count = shards.count()
        folder = f"{self.path}/plans/{uuid.uuid4().hex}"
        self.plan(shards, max(1, count // EPOCH)).write.parquet(folder)
        plan = self.spark.read.parquet(folder)
        plan = plan.withColumn("merging", F.col("run_shards") > 1)
        runs = plan.filter("merging").select("run").distinct()
        n = runs.count()
        if not n:
            return base
        # A number for each run, given by parts of the list: 0 to n - 1, one task each.
        by_part = runs.withColumn("part", F.substring_index("run", "-", 1))
        before = by_part.groupBy("part").agg(F.count("*").alias("m")).withColumn("before", F.sum("m").over(W.orderBy("part")) - F.col("m"))
        numbers = by_part.withColumn("k", F.row_number().over(W.partitionBy("part").orderBy("run")) - 1).join(F.broadcast(before), "part").select("run", (F.col("before") + F.col("k")).cast("int").alias("number"))
        moved = plan.filter("merging").join(numbers, "run").select(F.col("shard").alias("__of"), F.col("run").alias("__run"), F.col("number").alias("__number"))
        merged = f"{self.path}/data/{uuid.uuid4().hex}"
        rows = self._rows(plan.filter("merging"), base).select(F.struct("row").alias("row"), F.col(_AT))
        rows = rows.join(F.broadcast(moved) if count <= 100_000 else moved, F.col(_AT) == F.col("__of"))
        dealt = rows.repartitionById(n, F.col("__number")).select(F.col("row.row").alias("row"), "__run")
        schema = self._schema(base)
        # The run is in the folder's name only where the rows have no such column; else the rows keep a struct.
        dealt.select("row.*", F.col("__run").alias(self._run_column(schema))).write.option("compression", "zstd").partitionBy(self._run_column(schema)).parquet(merged)
        run = F.regexp_extract("shard", rf"/{self._run_column(schema)}=([^/]+)/", 1)
        came = self._files(merged, schema, F.concat(F.lit(f"{base}/run-"), run), base, 1)
        kept = plan.filter("NOT merging").select(*StructType.fromDDL(_SHARDS).names)
        return self.commit(kept.unionByName(came), base, self._schema_json(base))

    @staticmethod
    def _run_column(schema: StructType) -> str:
        name, taken = "__run", {f.name.lower() for f in schema.fields}
        while name in taken:
            name += "_"
        return name

    def _schema_json(self, version: int) -> str:
        return self._info(version)["schema"]

    def _schema(self, version: int) -> StructType:
        return StructType.fromJson(json.loads(self._schema_json(version)))

    def _rows(self, shards: DataFrame, version: int) -> DataFrame:
        """(row, _AT): the rows of some of a version's shards as structs, and the file of each. Folders listed whole are
        one scan; of the others just the listed files are read, if they aren't more than PATHS."""
        schema = self._schema(version)
        listed = shards.groupBy("folder").agg(F.count("*").alias("n"), F.first("folder_shards").alias("all")).collect()
        whole, part = [r["folder"] for r in listed if r["n"] == r["all"]], [r for r in listed if r["n"] != r["all"]]

        def scan(paths: list[str]) -> DataFrame:
            df = self.spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(*paths)
            return df.select(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]).alias("row"), df.metadataColumn("_metadata")["file_path"].alias(_AT))

        out = [scan(whole)] if whole else []
        if part:
            names = [r["folder"] for r in part]
            mine = shards.filter(F.col("folder").isin(names)).select(F.col("shard").alias("__of"))
            if sum(r["n"] for r in part) <= PATHS:
                out.append(scan([r[0] for r in mine.collect()]))
            else:
                out.append(scan(names).join(mine, F.col(_AT) == F.col("__of"), "left_semi"))
        if not out:
            return self.spark.createDataFrame([], StructType().add("row", schema).add(_AT, "string"))
        return out[0] if len(out) == 1 else out[0].unionByName(out[1])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        version = max(self.versions(), default=0) if version is None else version
        return self._rows(self.manifest(version), version).select("row.*")

    def expire(self, keep: int = 2) -> int:
        """Delete the data that only versions before the last `keep` list; gives the number of folders that went."""
        all_ = self.versions()
        used = set()
        for v in all_[-keep:]:
            used |= {r[0].rsplit("/", 1)[1] for r in self.manifest(v).select("folder").distinct().collect()}
        fs, p = hadoop_path(self.spark, f"{self.path}/data")
        gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in used]
        for v in all_[:-keep]:
            fs.delete(hadoop_path(self.spark, f"{self.path}/versions/v{v:08d}.json")[1], False)
        for g in gone:
            fs.delete(g, True)
        return len(gone)


def shard(docs: DataFrame, path: str | None = None, **options) -> ShardTable:
    """Append docs to the table at path (a scratch one if none is given), compact it and drop what was merged away."""
    spark = docs.sparkSession
    table = ShardTable(spark, path or scratch_path(spark, "shards"), **options)
    table.append(docs)
    table.compact()
    table.expire(keep=1)
    if path is None:
        fs, p = hadoop_path(spark, table.path)
        fs.deleteOnExit(p)
    return table


PLACE = ("shard", "shard_rows", "shard_bytes", "version")


def located(table: ShardTable, columns: list[str]) -> DataFrame:
    """The table's rows with the shard that holds each: shard (its name), shard_rows, shard_bytes, version. Columns of
    the rows with such a name, in any case, get an underscore after it."""
    version = max(table.versions(), default=0)
    shards = table.manifest(version)
    numbered = shards.select(F.col("shard").alias("__of"), F.struct(F.col("name").alias("shard"), F.col("n_rows").alias("shard_rows"), F.col("n_bytes").alias("shard_bytes")).alias("place"))
    few = shards.count() <= 100_000
    joined = table._rows(shards, version).join(F.broadcast(numbered) if few else numbered, F.col(_AT) == F.col("__of"))
    taken = {c.lower() for c in (*columns, *PLACE)}

    def named(c: str) -> str:
        new = c
        while new.lower() in PLACE or new != c and new.lower() in taken:
            new += "_"
        return new

    mine = [F.col("row")[c].alias(named(c)) for c in columns]
    return joined.select(*mine, "place.*", F.lit(version).cast("long").alias("version"))


def op5_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return located(shard(docs), ["doc_id"])
