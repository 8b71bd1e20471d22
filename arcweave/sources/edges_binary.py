"""Binary edge lists: 16-byte records of two little-endian 64-bit integers.

``read_edges`` scans a file or a folder as fixed-length records and
``write_edges`` writes a folder of such files. Both run in the JVM, without
Python workers, and resolve paths as ``spark.read`` does: any Hadoop file
system, and a path without a scheme on the default one.

A folder keeps a manifest: each write goes to a subfolder of its own, and is
published by one small file that lists the subfolders which belong to the
table from then on. Readers look at the newest manifest first, so a write that
fails anywhere changes nothing, and an overwrite that ends between publishing
and deleting the old files leaves the new rows only. Folders without a manifest,
as other programs write them, are read as they are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# The record format.
RECORD_BYTES = 16
SCHEMA = "src bigint, dst bigint"

# Bytes per read task.
PARTITION_BYTES = 128 << 20

MANIFESTS = "_manifest"
# Tries to publish an append next to others that do the same.
ATTEMPTS = 20


def read_edges(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """``(src, dst)`` of the records below ``path``.

    Raises FileNotFoundError if nothing is there, and ValueError if a file's
    size is no multiple of 16 bytes.
    """
    folder = _Folder(spark, path)
    files = folder.files()
    for name, size in files:
        if size % RECORD_BYTES:
            raise ValueError(
                f"{name} is no edge file: {size} bytes leave "
                f"{size % RECORD_BYTES} after whole {RECORD_BYTES}-byte records"
            )
    some = folder.inputs() if any(size for _, size in files) else []
    if not some:
        return spark.createDataFrame([], SCHEMA)
    settings = spark._jvm.org.apache.hadoop.conf.Configuration(folder.settings)
    settings.set("mapreduce.input.fileinputformat.input.dir.recursive", "true")
    settings.set("mapreduce.input.fileinputformat.split.maxsize", str(partition_bytes))
    records = spark._jsc.sc().binaryRecords(",".join(some), RECORD_BYTES, settings)
    binary = spark._jvm.org.apache.spark.sql.Encoders.BINARY()
    rows = DataFrame(spark._jsparkSession.createDataset(records, binary).toDF(), spark)
    return rows.select(
        _decoded(F.substring("value", 1, 8)).alias("src"),
        _decoded(F.substring("value", 9, 8)).alias("dst"),
    )


def write_edges(edges: DataFrame, path: str, mode: str = "error") -> None:
    """Write the columns ``src bigint, dst bigint`` below the folder ``path``.

    ``mode`` is error (if the folder has records), append or overwrite.
    """
    if [(n, t) for n, t in edges.dtypes] != [("src", "bigint"), ("dst", "bigint")]:
        raise ValueError("binary edge files have the columns src bigint, dst bigint")
    if mode not in ("error", "append", "overwrite"):
        raise ValueError(f"mode {mode} is not error, append or overwrite")
    folder = _Folder(edges.sparkSession, path)
    if mode == "error" and folder.exists() and folder.files(may_be_empty=True):
        raise FileExistsError(f"{path} has edge files")
    batch = f"batch-{uuid.uuid4().hex}"
    _write_records(edges, f"{folder.root}/{batch}")
    old = folder.publish(batch, keep=mode != "overwrite")
    folder.forget(old)


def _write_records(edges: DataFrame, path: str) -> None:
    """Text files whose line end is the last byte of each record.

    That byte is the highest of ``dst``: 0 for ids below 2^56, so there is one
    pass over the rows, which also tells what other values occur. Each of these
    (255 for negative ids) is one more pass.
    """
    problem = F.raise_error(F.lit("an edge has no id at one end")).cast("bigint")
    whole = edges.select(F.coalesce("src", problem).alias("src"), F.coalesce("dst", problem).alias("dst"))
    highest = F.shiftrightunsigned("dst", 56).cast("int")
    encoded = F.concat(_encoded(F.col("src")), _encoded(F.col("dst")))
    seen = Observation()

    def write(rows: DataFrame, last: int) -> None:
        line = F.substring(encoded, 1, RECORD_BYTES - 1).cast("string").alias("value")
        writer = rows.where(highest == last).select(line).write
        writer.option("encoding", "ISO-8859-1").option("lineSep", chr(last)).text(f"{path}/{last:03d}")

    write(whole.observe(seen, F.collect_set(highest).alias("highest")), 0)
    for last in sorted(set(seen.get["highest"]) - {0}):
        write(whole, last)


def _swapped(number: Column) -> Column:
    """A 64-bit number with its bytes in the opposite order."""
    for bits, mask in ((8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        kept = F.lit(mask)
        number = F.shiftleft(number.bitwiseAND(kept), bits).bitwiseOR(
            F.shiftrightunsigned(number, bits).bitwiseAND(kept)
        )
    return F.shiftleft(number, 32).bitwiseOR(F.shiftrightunsigned(number, 32))


def _decoded(octets: Column) -> Column:
    return _swapped(F.conv(F.hex(octets), 16, -10).cast("bigint"))


def _encoded(number: Column) -> Column:
    return F.unhex(F.lpad(F.hex(_swapped(number)), 16, "0"))


class _Folder:
    """A file or folder of edge files, and the manifest in it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.settings = spark._jsc.hadoopConfiguration()
        given = self._path(path)
        self.system = given.getFileSystem(self.settings)
        self.root = self.system.makeQualified(given).toString().rstrip("/")

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self) -> bool:
        return self.system.exists(self._path(self.root))

    def _names(self, path: str) -> list[str]:
        """Entries of a folder that are not hidden; none if it does not exist."""
        where = self._path(path)
        if not self.system.exists(where):
            return []
        names = [status.getPath().getName() for status in self.system.listStatus(where)]
        return sorted(n for n in names if not n.startswith(("_", ".")))

    def _newest(self) -> tuple[int, list[str] | None]:
        """The number and entries of the newest manifest; entries are None without one."""
        numbers = [int(n) for n in self._names(f"{self.root}/{MANIFESTS}") if n.isdigit()]
        if not numbers:
            return 0, None
        newest = max(numbers)
        stream = self.system.open(self._path(f"{self.root}/{MANIFESTS}/{newest:020d}"))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return newest, json.loads(text)["entries"]

    def entries(self) -> list[str] | None:
        """What is committed below the root; None for a single file or a folder without a manifest."""
        return self._newest()[1]

    def inputs(self) -> list[str]:
        """Paths whose files are the table's."""
        entries = self.entries()
        return [self.root] if entries is None else [f"{self.root}/{e}" for e in entries]

    def files(self, may_be_empty: bool = False) -> list[tuple[str, int]]:
        """Names and sizes of the committed files."""
        if not self.exists():
            raise FileNotFoundError(f"no edge file at {self.root}")
        found = []
        for top in self.inputs():
            walk = self.system.listFiles(self._path(top), True)
            while walk.hasNext():
                status = walk.next()
                name = status.getPath().toString()
                below = name[len(self.root) :].split("/")
                if not any(part.startswith(("_", ".")) for part in below):
                    found.append((name, status.getLen()))
        if not found and not may_be_empty:
            raise FileNotFoundError(f"no edge file below {self.root}")
        return sorted(found)

    def publish(self, batch: str, keep: bool) -> list[str]:
        """Make ``batch`` part of the table, or all of it; returns the entries that are no longer."""
        for _ in range(ATTEMPTS):
            number, entries = self._newest()
            if entries is None:
                entries = [n for n in self._names(self.root) if not n.startswith("batch-")]
            text = json.dumps({"entries": [*(entries if keep else []), batch]})
            name = f"{self.root}/{MANIFESTS}/{number + 1:020d}"
            draft = f"{self.root}/{MANIFESTS}/.{batch}"
            stream = self.system.create(self._path(draft), True)
            stream.write(bytearray(text.encode()))
            stream.close()
            if not self.system.exists(self._path(name)) and self.system.rename(self._path(draft), self._path(name)):
                return [] if keep else entries
            self.system.delete(self._path(draft), False)
        raise RuntimeError(f"other writes to {self.root} were published first {ATTEMPTS} times")

    def forget(self, entries: list[str]) -> None:
        """Delete what a published overwrite has replaced."""
        for entry in entries:
            self.system.delete(self._path(f"{self.root}/{entry}"), True)
