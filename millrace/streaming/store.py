"""Replica files: versioned, so that a batch is visible as a whole or not at all.

Every batch that changes something gets the next version number and writes only
under it; the progress row comes last and makes the version count. A batch that
died half way leaves files nobody refers to, and its successor overwrites them.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from ..shared import local_frame

PROGRESS = (
    "version bigint, confirmed_seq bigint, confirmed_lsn string, snapshot_lsn string, "
    "pending array<string>, pending_seq bigint, pending_twice boolean, state bigint, tables map<string,bigint>, logs array<string>, "
    "digits map<string,array<int>>, polls array<struct<seq:bigint,lsn:string>>"
)
MANIFEST = "table string, bucket int, version bigint, layout string"
_BUCKET = re.compile(r"/bucket=(\d+)/")
SNAPSHOT = "snapshot"


@dataclass(frozen=True)
class Progress:
    """How far the replica has come.

    ``pending`` names the row files that hold open transactions, up to the place ``pending_seq``, where some place may
    stand twice if ``pending_twice``; ``state`` is the newest version
    of table contents; ``tables`` maps a table to its manifest; ``logs`` names the row files of this version that count;
    ``digits`` tells what the values of numerics without a modifier have needed so far, by ``table/column``; ``polls`` names
    the ends of the earlier polls that were merged together with this one, whose versions come before it.
    """

    version: int = 0
    confirmed_seq: int = -1
    confirmed_lsn: str | None = None
    snapshot_lsn: str | None = None
    pending: list[str] = field(default_factory=list)
    pending_seq: int = -1
    pending_twice: bool = False
    state: int = 0
    tables: dict[str, int] = field(default_factory=dict)
    logs: list[str] = field(default_factory=list)
    digits: dict[str, list[int]] = field(default_factory=dict)
    polls: list[dict] = field(default_factory=list)


class Store:
    """Files of one replication job under ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._last: Progress | None = None
        self._manifests: dict[int, dict[str, list[tuple[int, int, str]]]] = {}

    def path(self, kind: str, version: int | None = None, table: str | None = None) -> str:
        parts = [self.root, kind] + ([table] if table else [])
        return "/".join(parts + ([f"version={version}"] if version is not None else []))

    # Progress

    def _rounds(self) -> DataFrame:
        """Progress rows as they were written: one per merge."""
        return self.spark.read.schema(PROGRESS).parquet(self.path("progress"))

    def progress(self) -> DataFrame:
        """All progress rows, one per version. Polls that were merged together count at once, by the one row of their
        last poll, which lists the row files of all."""
        rows = self._rounds()
        none = F.array().cast("array<struct<seq:bigint,lsn:string>>")
        ends = F.concat(F.coalesce("polls", none), F.array(F.struct(F.col("confirmed_seq").alias("seq"), F.col("confirmed_lsn").alias("lsn"))))
        each = rows.withColumn("_size", F.size(ends)).select("*", F.posexplode(ends).alias("_at", "_end"))
        last = F.col("_at") + 1 == F.col("_size")
        told = {
            "version": F.col("version") - F.col("_size") + 1 + F.col("_at"), "confirmed_seq": F.col("_end.seq"),
            "confirmed_lsn": F.col("_end.lsn"), "logs": F.when(last, F.col("logs")).otherwise(F.array().cast("array<string>")),
        }
        return each.select(*[told.get(c, F.col(c)).alias(c) for c in rows.columns if c != "polls"])

    def last(self) -> Progress:
        if self._last is None:
            try:
                rows = self._rounds().orderBy(F.desc("version")).limit(1).collect()
            except AnalysisException:
                rows = []
            self._last = Progress(**rows[0].asDict(recursive=True)) if rows else Progress()  # maps and arrays come as dicts and lists
        return self._last

    def commit(self, progress: Progress) -> None:
        row = {k: v for k, v in vars(progress).items() if k != "version"}
        row["tables"], row["digits"] = list(progress.tables.items()), list(progress.digits.items())
        fields = T.StructType([f for f in self._schema(PROGRESS).fields if f.name != "version"])
        frame = local_frame(self.spark, [row], fields).coalesce(1)
        frame.write.mode("overwrite").parquet(self.path("progress", progress.version))
        self._last = progress

    @staticmethod
    def _schema(text: str) -> T.StructType:
        return T.StructType.fromDDL(text)

    # Rows written once per version and read back

    def write(self, frame: DataFrame, kind: str, version: int, table: str | None = None, by=()) -> None:
        writer = frame.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(self.path(kind, version, table))

    def read(
        self, kind: str, schema: T.StructType | str, versions: list[int] | None = None,
        table: str | None = None,
    ) -> DataFrame:
        """Rows of some versions, or of all whose progress row lists them; ``version`` is the last column.

        Files that a died poll left are not listed, whatever took its version number afterwards.
        """
        whole = self.path(kind, table=table)
        fields = self._schema(schema) if isinstance(schema, str) else schema
        fields = T.StructType([*fields.fields, T.StructField("version", T.LongType())])
        reader = self.spark.read.schema(fields).option("basePath", whole)
        if versions is None:
            listed = self._rounds().where(F.array_contains("logs", self.log_name(kind, table)))
            rows = reader.parquet(whole)
            return rows.join(listed.select("version"), "version", "left_semi").select(*rows.columns)
        return reader.parquet(*[self.path(kind, v, table) for v in versions])

    def tables_with(self, kind: str) -> list[str]:
        """Tables that some progress row lists row files of a kind for."""
        names = self._rounds().select(F.explode("logs").alias("name")).where(F.col("name").startswith(f"{kind}/"))
        return sorted(r.name.split("/", 1)[1] for r in names.distinct().collect())

    @staticmethod
    def log_name(kind: str, table: str | None = None) -> str:
        return f"{kind}/{table}" if table else kind

    # Table contents

    def manifest(self, table: str, version: int | None) -> list[tuple[int, int, str]]:
        """(bucket, version, layout) of a table's buckets, as written by a poll; read once."""
        if version is None:
            return []
        if version not in self._manifests:
            rows = self.spark.read.schema(MANIFEST).parquet(self.path("manifest", version)).collect()
            found: dict[str, list[tuple[int, int, str]]] = {}
            for r in rows:
                found.setdefault(r.table, []).append((r.bucket, r.version, r.layout))
            self._manifests[version] = found
        return self._manifests[version].get(table, [])

    def write_manifests(self, version: int, tables: dict[str, list[tuple[int, int, str]]]) -> None:
        """One small file per poll for all tables that it changed."""
        rows = [
            {"table": t, "bucket": b, "version": v, "layout": layout} for t, held in tables.items() for b, v, layout in held
        ]
        frame = local_frame(self.spark, rows, MANIFEST).coalesce(1)
        frame.write.mode("overwrite").parquet(self.path("manifest", version))
        self._manifests[version] = tables

    def contents(
        self, table: str, rows: list[tuple[int, int, str]], schema: T.StructType | None
    ) -> DataFrame | None:
        """Stored rows of the given manifest entries; None when there are none.

        Without ``schema`` the files tell it; the entries must then be of one layout.
        """
        paths = [f"{self.path('state', v, table)}/bucket={b}" for b, v, layout in rows]
        if not paths:
            return None
        if schema is None or rows[0][2] == SNAPSHOT:
            return self.spark.read.parquet(*paths)
        return self.spark.read.schema(schema).parquet(*paths)

    def write_contents(
        self, frame: DataFrame, table: str, version: int, layout: str
    ) -> list[tuple[int, int, str]]:
        """Write bucketed rows and list the buckets that hold any."""
        self.write(frame, "state", version, table, by=["bucket"])
        return [(b, version, layout) for b in self.buckets_in("state", version, table)]

    def buckets_in(self, kind: str, version: int, table: str) -> list[int]:
        """Buckets that a written version has files of: told by the names of the files, without a job."""
        path = self.path(kind, version, table)
        plain = T.StructType([T.StructField("bucket", T.IntegerType())])
        files = self.spark.read.schema(plain).option("basePath", path).parquet(path).inputFiles()
        return sorted({int(m.group(1)) for m in map(_BUCKET.search, files) if m})

    def bucket_of(self, columns: list[Column]) -> Column:
        """Bucket number by the hash Spark shuffles with.

        When the number of shuffle partitions is a multiple of the number of
        buckets, every task of a shuffle on the same columns holds rows of one bucket.
        """
        return F.pmod(F.hash(*columns), F.lit(self.buckets))
