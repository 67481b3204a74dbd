"""Silver and quarantine as versions that are published at once.

A run writes all its rows, valid or not, in one go to a folder of its own, partitioned by
reason and day. Nobody reads it until a version file says so: it lists, for every partition
of the table, the run that holds it and its rows per reason. A version is written under a
temporary name and renamed, which either happens or doesn't; a run that is stopped at any
point before leaves the version before in force, with all its files. Two runs that start
from the same version can't both publish the next one.

Version files have an entry per partition and reason, which is what the driver holds.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import REJECT_REASON, VALID, ContractError
from tripmill.sources.lake import CODEC, Lake, exists, partition_folder, subfolders
from tripmill.sources.staging import delete, file_system

#: Versions that stay readable, the one in force included.
KEPT = 2
RUN = "_run"


class ConflictError(RuntimeError):
    """Another run has published a version meanwhile."""


@dataclass
class Version:
    """``runs``: rows by partition (as in its folder's name) and reason of each run that holds
    partitions. ``written``: how many partitions each of them wrote, so that one whose
    partitions all count is read as a whole."""

    number: int = 0
    runs: dict[str, dict[str, dict[str, int]]] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)

    def folders(self, valid: bool) -> list[str]:
        """Folders below those of the runs that hold the valid or the rejected rows."""
        found = []
        for run, partitions in self.runs.items():
            reasons = sorted({r for counts in partitions.values() for r in counts if (r == VALID) == valid})
            for reason in reasons:
                folder = f"{RUN}={run}/{REJECT_REASON}={reason}"
                if len(partitions) == self.written[run]:
                    found.append(folder)
                else:
                    found += [f"{folder}/{p}" for p, counts in sorted(partitions.items()) if reason in counts]
        return found

    def replaced(self, run: str, counts: dict[str, dict[str, int]], scope: set[str] | None) -> Version:
        """The next version: ``run`` holds the partitions of ``counts``, and nobody the others in
        ``scope`` (None: all there are)."""
        gone = set(counts) | (scope or set())
        kept = {} if scope is None else {r: {p: c for p, c in parts.items() if p not in gone} for r, parts in self.runs.items()}
        runs = {r: parts for r, parts in {**kept, run: counts}.items() if parts}
        return Version(self.number + 1, runs, {r: {**self.written, run: len(counts)}[r] for r in runs})


def _runs(lake: Lake) -> str:
    return f"{lake.silver}/runs"


def _file(lake: Lake, number: int) -> str:
    return f"{lake.silver}/versions/{number:012d}.json"


def numbers(spark: SparkSession, lake: Lake) -> list[int]:
    """Versions there are, ascending; reads no file."""
    folder = f"{lake.silver}/versions"
    if not exists(spark, folder):
        return []
    fs, path = file_system(spark, folder)
    names = [entry.getPath().getName() for entry in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def load(spark: SparkSession, lake: Lake, number: int) -> Version:
    fs, path = file_system(spark, _file(lake, number))
    stream = fs.open(path)
    try:
        return Version(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def current(spark: SparkSession, lake: Lake) -> Version:
    """The version in force; one without partitions where nothing was published."""
    found = numbers(spark, lake)
    return load(spark, lake, found[-1]) if found else Version()


def read(spark: SparkSession, lake: Lake, schema: T.StructType, valid: bool, version: Version | None = None) -> DataFrame:
    """Valid or rejected rows of a version, by default the one in force."""
    folders = (version or current(spark, lake)).folders(valid)
    if not folders:
        return spark.createDataFrame([], schema)
    stored = T.StructType([f for f in schema if f.name != REJECT_REASON])
    partitions = T.StructType().add(RUN, T.StringType()).add(REJECT_REASON, T.StringType())
    reader = spark.read.schema(T.StructType(stored.fields + partitions.fields)).format(lake.format)
    return reader.option("basePath", _runs(lake)).load([f"{_runs(lake)}/{f}" for f in folders]).select(schema.names)


@dataclass(frozen=True)
class Written:
    run: str
    counts: dict[str, dict[str, int]]  # by folder name of the partition and reason

    @property
    def rows(self) -> int:
        return sum(n for counts in self.counts.values() for n in counts.values())


def write(tagged: DataFrame, lake: Lake) -> Written:
    """Write tagged rows as a new run that no version names yet, and count them as read back.

    One shuffle gathers the rows of a partition and reason and spreads large ones, unless
    partitions are years (see ``Lake.gathers``). The rows are counted while they are written;
    what the files say is held against that.
    """
    spark, run, seen = tagged.sparkSession, uuid.uuid4().hex, Observation()
    by = [REJECT_REASON, lake.partition]
    rows = lake.gathered(tagged, *by).observe(seen, F.count(F.lit(1)).alias("rows"))
    folder = f"{_runs(lake)}/{RUN}={run}"
    try:
        rows.write.partitionBy(*by).format(lake.format).option("compression", CODEC).save(folder)
        found = Written(run, _counted(spark, lake, tagged.schema, folder))
        if found.rows != seen.get["rows"]:
            raise ContractError(f"row counts differ after writing {folder}: {found.rows} read, {seen.get['rows']} expected")
        return found
    except BaseException:
        discard(spark, lake, run)
        raise


def _counted(spark: SparkSession, lake: Lake, schema: T.StructType, folder: str) -> dict[str, dict[str, int]]:
    """Rows by partition and reason, from the files' footers."""
    counts: dict[str, dict[str, int]] = {}
    if subfolders(spark, folder):
        stored = spark.read.schema(schema).format(lake.format).load(folder)
        for value, reason, n in stored.groupBy(lake.partition, REJECT_REASON).count().collect():
            counts.setdefault(partition_folder(lake.partition, value), {})[reason] = n
    return counts


def discard(spark: SparkSession, lake: Lake, run: str) -> None:
    """Delete a run that no version names, and the folders above if that leaves them empty."""
    delete(spark, f"{_runs(lake)}/{RUN}={run}")
    for folder in (_runs(lake), lake.silver):
        fs, path = file_system(spark, folder)
        if fs.exists(path) and not fs.listStatus(path):
            fs.delete(path, False)


def publish(spark: SparkSession, lake: Lake, version: Version) -> None:
    """Put ``version`` in force by one rename. An error if its number is taken."""
    jvm, target = spark._jvm, _file(lake, version.number)
    temporary = f"{lake.silver}/versions/_{version.number}-{uuid.uuid4().hex}"
    fs, path = file_system(spark, temporary)
    out = fs.create(path)
    try:
        out.write(json.dumps(vars(version)).encode())
    finally:
        out.close()
    never = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE  # an existing file stays
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = never
    whole = fs.makeQualified(path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(whole, fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), options)
    except Exception as error:
        fs.delete(path, False)
        if "FileAlreadyExists" in str(error):
            raise ConflictError(f"version {version.number} of {lake.silver} is there already") from error
        raise


def vacuum(spark: SparkSession, lake: Lake, keep: int = KEPT) -> None:
    """Delete all versions but the last ``keep``, and the partitions of published runs that
    none of those names. Runs that no version has named yet are left alone: they may be
    under way."""
    found = numbers(spark, lake)
    kept = [load(spark, lake, n) for n in found[-keep:]]
    for number in found[:-keep]:
        old = load(spark, lake, number)
        for run, partitions in old.runs.items():
            used = {p for v in kept for p in v.runs.get(run, ())}
            if not used:
                delete(spark, f"{_runs(lake)}/{RUN}={run}")
                continue
            for partition in set(partitions) - used:
                for reason in partitions[partition]:
                    delete(spark, f"{_runs(lake)}/{RUN}={run}/{REJECT_REASON}={reason}/{partition}")
        delete(spark, _file(lake, number))


def partition_of(value: date | None, lake: Lake) -> str:
    return partition_folder(lake.partition, value)
