"""Durable working tables.

Iterative operators cut their lineage by writing tables. The tables live in a
database of their own below the folder the cluster names in
``spark.checkpoint.dir``, so they survive the loss of any executor. ``close()``
drops them all, at the latest when Python exits with the session still open.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this cluster; a temporary one only for local masters."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder all executors share: working "
            "tables must not be kept on one machine"
        )
    return tempfile.mkdtemp(prefix="arcweave-")


class Scratch:
    """A database of working tables and folders, dropped by ``close()``."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self._tables: dict[int, tuple[str, DataFrame, str | None, int]] = {}
        self.name = f"arcweave_{uuid.uuid4().hex[:12]}"
        location = f"{root.rstrip('/') if root else scratch_root(spark)}/{self.name}"
        quoted = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{quoted}'")
        # As the catalog states it: with the scheme of the file system it is on.
        self.location = spark.catalog.getDatabase(self.name).locationUri.rstrip("/")
        atexit.register(self._close_at_exit)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def folder(self, label: str) -> str:
        """A path below the scratch location that nothing else uses."""
        return f"{self.location}/{label}-{uuid.uuid4().hex[:8]}"

    def save(
        self,
        df: DataFrame,
        label: str,
        bucket_by: str | None = None,
        buckets: int = 0,
        replaces: DataFrame | None = None,
    ) -> DataFrame:
        """Write ``df`` as a managed Parquet table and return the table.

        With ``bucket_by`` the rows are laid out in ``buckets`` hash buckets,
        sorted on that column; a caller that has already repartitioned on it
        gets exactly one file per bucket. ``replaces`` names a table saved
        before, possibly read by ``df``, that is dropped afterwards.
        """
        table = f"{self.name}.{label}_{uuid.uuid4().hex[:8]}"
        self._write(df, table, bucket_by, buckets)
        if replaces is not None:
            self.spark.sql(f"DROP TABLE {self._tables.pop(id(replaces))[0]}")
        return self._known(table, bucket_by, buckets)

    def append(self, saved: DataFrame, df: DataFrame) -> DataFrame:
        """Add the rows of ``df`` to a table saved before, in its own layout, and return it anew."""
        table, _, bucket_by, buckets = self._tables.pop(id(saved))
        self._write(df, table, bucket_by, buckets)
        return self._known(table, bucket_by, buckets)

    def _write(self, df: DataFrame, table: str, bucket_by: str | None, buckets: int) -> None:
        writer = df.write.format("parquet").mode("append")
        if bucket_by is not None:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        writer.saveAsTable(table)

    def _known(self, table: str, bucket_by: str | None, buckets: int) -> DataFrame:
        saved = self.spark.table(table)
        self._tables[id(saved)] = (table, saved, bucket_by, buckets)
        return saved

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")
        atexit.unregister(self._close_at_exit)

    def _close_at_exit(self) -> None:
        try:
            if SparkSession.getActiveSession() is not None:
                self.close()
        except Exception:  # the session is gone; nothing is left to talk to
            pass
