"""Parquet tables whose current content is a list of directories.

Plain Parquet has no MERGE. A write here goes to directories of its own and becomes visible when a
small listing of the directories in force is renamed into place, so readers and retried jobs never
see half a write, and an upsert rewrites only the files that hold a matched row.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.operators.dedup import refuse_duplicates
from tradewind.operators.upsert import is_newer, upsert
from tradewind.functions.casts import quoted
from tradewind.session import stage, unstage

WHOLE = "whole"
BUCKET, FILE = "_bucket", "_file"


class ConcurrentWrite(RuntimeError):
    """Another writer published the same version first."""


class StoredTable:
    """A table under ``root``, optionally split by one low-cardinality column.

    ``partition_by`` names a column of bounded cardinality (a month, a date, a state);
    ``cluster_by`` names columns to range-partition and sort files by. ``bucket_by`` names the key that
    upserts match on: rows are split by its hash and sorted by it, so that a merge looks only into the
    buckets and key ranges of its rows. The number of buckets is fixed by the first write. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, root: str, partition_by: str | None = None,
        cluster_by: list[str] | None = None, bucket_by: str | None = None, buckets: int = 16,
    ):
        if bucket_by and (partition_by or cluster_by):
            raise ValueError("a table is split by a column or by buckets of its key")
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = BUCKET if bucket_by else partition_by
        self.cluster_by = cluster_by or []
        self.bucket_by, self._buckets = bucket_by, buckets
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- listing of directories in force ---------------------------------------------------------

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.root}/listings")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def listing(self) -> dict | None:
        versions = self._versions()
        if not versions:
            return None
        stream = self._fs.open(self._path(f"{self.root}/listings/{versions[-1]}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _store_listing(self, listing: dict) -> None:
        draft = self._path(f"{self.root}/listings/.{uuid.uuid4().hex}")
        final = self._path(f"{self.root}/listings/{listing['version']}.json")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(listing).encode("utf-8")))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise ConcurrentWrite(f"{self.root}: version {listing['version']} already exists")

    # --- reads -----------------------------------------------------------------------------------

    def exists(self) -> bool:
        return self.listing() is not None

    def schema(self) -> T.StructType | None:
        listing = self.listing()
        return T.StructType.fromJson(listing["schema"]) if listing else None

    def has_batch(self, batch_id: str) -> bool:
        listing = self.listing()
        return bool(listing) and batch_id in listing["batches"]

    def read(self, only: list[str] | None = None) -> DataFrame:
        """Current rows; ``only`` limits the read to some partition labels."""
        listing = self.listing()
        if listing is None:
            raise FileNotFoundError(f"no table under {self.root}")
        return self._rows(listing, only)

    def _rows(self, listing: dict, only: list[str] | None = None) -> DataFrame:
        parts = listing["parts"]
        return self._files(listing, [p for label in parts if only is None or label in only for p in parts[label]])

    def _files(self, listing: dict, paths: list[str], with_file: bool = False) -> DataFrame:
        """Rows of some directories or files in force, with the file each stands in if asked for."""
        schema = T.StructType.fromJson(listing["schema"])
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(FILE, F.lit("")) if with_file else empty
        # Older directories may lack newer columns: the stored schema reads those as null.
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        rows = reader.parquet(*[f"{self.root}/data/{p}" for p in paths])
        extra = [F.col("_metadata.file_path").alias(FILE)] if with_file else []
        return rows.select(*map(quoted, schema.fieldNames()), *extra)

    def file_count(self) -> int:
        """Files in force."""
        listing = self.listing() or {"parts": {}}
        return sum(len(self._expanded(p)) for paths in listing["parts"].values() for p in paths)

    def _expanded(self, path: str) -> list[str]:
        """A file as it is, a directory as the data files in it."""
        if path.endswith(".parquet"):
            return [path]
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/data/{path}"))]
        return [f"{path}/{n}" for n in sorted(names) if n.endswith(".parquet")]

    def as_view(self, name: str) -> None:
        self.read().createOrReplaceTempView(name)

    # --- writes ----------------------------------------------------------------------------------

    def _write(self, df: DataFrame) -> dict[str, list[str]]:
        """Write rows to directories of their own; returns the directories per partition label."""
        folder = f"_write={uuid.uuid4().hex}"
        order = [c for c in [self.partition_by, *self.cluster_by] if c]
        if self.cluster_by:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        elif self.bucket_by:
            rows = df.withColumn(BUCKET, self._bucket(self.bucket_by)).hint("rebalance", BUCKET)
            df = rows.sortWithinPartitions(BUCKET, quoted(self.bucket_by))
        elif self.partition_by:
            # Adaptive execution joins small partitions and splits large ones towards the advised file size.
            df = df.hint("rebalance", self.partition_by)
        writer = df.write.mode("errorifexists")
        if self.partition_by is None:
            writer.parquet(f"{self.root}/data/{folder}")
            return {WHOLE: [folder]}
        writer.partitionBy(self.partition_by).parquet(f"{self.root}/data/{folder}")
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/data/{folder}"))]
        return {n: [f"{folder}/{n}"] for n in names if n.startswith(f"{self.partition_by}=")}

    def _bucket(self, key: str) -> F.Column:
        count = (self.listing() or {}).get("buckets") or self._buckets
        return F.pmod(F.xxhash64(quoted(key)), F.lit(count)).cast("int")

    def _publish(
        self, df: DataFrame, drop: set[str] | None, batch_id: str | None, comment: str | None = None,
        files: dict[str, set[str]] | None = None,
    ) -> dict:
        """Write ``df`` and put it in force in place of the labels in ``drop`` (None: all) and of ``files`` by label."""
        held = self.listing() or {"version": 0, "parts": {}, "batches": [], "comment": None}
        parts = {} if drop is None else {k: v for k, v in held["parts"].items() if k not in drop}
        for label, gone in (files or {}).items():
            parts[label] = [
                f for p in parts[label] for f in (self._expanded(p) if any(g.startswith(p) for g in gone) else [p])
                if f not in gone
            ]
        parts = {k: v for k, v in parts.items() if v}
        for label, paths in self._write(df).items():
            parts[label] = parts.get(label, []) + paths
        listing = {
            "version": held["version"] + 1,
            "schema": json.loads(df.schema.json()),
            "parts": parts,
            "batches": held["batches"] + ([batch_id] if batch_id else []),
            "comment": comment or held["comment"],
        }
        if self.bucket_by:
            listing["buckets"] = held.get("buckets") or self._buckets
        self._store_listing(listing)
        return listing

    def append_accepted(self, df: DataFrame, flag: str) -> DataFrame:
        """Write all rows in one pass, put in force only those whose boolean ``flag`` is false.

        Returns every written row, flag included; the flagged ones stay beside the table for review.
        The table must have a partition column.
        """
        folder = f"_write={uuid.uuid4().hex}"
        root = f"{self.root}/data/{folder}"
        conformed = self._conform(df.drop(flag))
        rows = self._conform(df).withColumn(flag, F.coalesce(flag, F.lit(False)))
        rows.write.mode("errorifexists").partitionBy(flag, self.partition_by).parquet(root)
        held = self.listing() or {"version": 0, "parts": {}, "batches": [], "comment": None}
        parts = dict(held["parts"])
        good = self._path(f"{root}/{flag}=false")
        for status in self._fs.listStatus(good) if self._fs.exists(good) else []:
            label = status.getPath().getName()
            parts[label] = parts.get(label, []) + [f"{folder}/{flag}=false/{label}"]
        self._store_listing({
            **held, "version": held["version"] + 1, "parts": parts,
            "schema": json.loads(conformed.schema.json()),
        })
        schema = rows.schema
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(root)

    def overwrite(self, df: DataFrame, comment: str | None = None) -> dict:
        return self._publish(df, None, None, comment)

    def append(self, df: DataFrame, batch_id: str | None = None) -> dict | None:
        """Add rows, and columns the table lacks; a batch that is already in is left out."""
        if batch_id and self.has_batch(batch_id):
            return None
        return self._publish(self._conform(df), set(), batch_id)

    def replace(self, df: DataFrame, labels: list[str]) -> dict:
        """Put ``df`` in place of some partitions; its rows in other partitions are added."""
        return self._publish(self._conform(df), self._labels(self.listing() or {"parts": {}}, labels), None)

    def _labels(self, listing: dict, values: list) -> set[str]:
        """Labels in force of some partition values; directories carry them escaped."""
        wanted = {"__HIVE_DEFAULT_PARTITION__" if v is None else str(v) for v in values}
        return {label for label in listing["parts"] if unquote(label.partition("=")[2]) in wanted}

    def _conform(self, df: DataFrame) -> DataFrame:
        """The table's columns in their order, then the ones only ``df`` has."""
        schema = self.schema()
        if schema is None:
            return df
        held = [
            F.col(quoted(f.name)) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        return df.select(*held, *[quoted(c) for c in df.columns if c not in schema.fieldNames()])

    def upsert(
        self, delta: DataFrame, key: str, version: str | None = None, batch_id: str | None = None
    ) -> dict | None:
        """Merge rows by key; with ``version`` an older re-delivery does not displace a later row.

        Only files that hold an old row that is displaced are rewritten; other rows are added beside them.
        """
        if batch_id and self.has_batch(batch_id):
            return None
        delta = stage(delta, "delta")
        staged = [delta.staged_at]
        try:
            refuse_duplicates(delta, key, self.root)
            held = self.listing()
            if held is None:
                return self._publish(delta, None, batch_id)
            won = delta
            if version:
                # Versions are compared on narrow rows; what an older re-delivery fails to displace is neither moved nor rewritten.
                older = self._near(held, delta, key)[0].select(quoted(key), F.col(quoted(version)).alias("_held"), F.lit(True).alias("_known"))
                met = delta.select(quoted(key), quoted(version)).join(older, key, "left")
                judged = stage(met.select(quoted(key), F.col("_known").isNotNull().alias("_met"), (F.col("_known").isNull() | is_newer(version)).alias("_wins")), "judged")
                staged.append(judged.staged_at)
                won = judged.filter("_met and _wins").select(quoted(key))
                lost = judged.filter("not _wins").select(quoted(key))
                if judged.filter("_wins").isEmpty():
                    delta = delta.limit(0)
                elif not lost.isEmpty():
                    delta = delta.join(lost.join(won, key, "left_anti"), key, "left_anti")
            files = self._touched(held, won, key)
            return self._publish(upsert(self._listed(held, files), delta, key), set(), batch_id, files=files)
        finally:
            unstage(self.spark, *staged)

    def _listed(self, held: dict, files: dict[str, set[str]]) -> DataFrame:
        return self._files(held, [f for found in files.values() for f in sorted(found)])

    def _near(self, held: dict, delta: DataFrame, key: str) -> tuple[DataFrame, dict[str, str]]:
        """Rows in force, with their file, in the buckets and key range of ``delta``; the labels of the directories and files looked into."""
        bucketed = self.bucket_by == key and "buckets" in held
        found = [F.min(quoted(key)).alias("low"), F.max(quoted(key)).alias("high")]
        if bucketed:
            found.append(F.collect_set(self._bucket(key)).alias("buckets"))  # at most as many as the table has
        seen = delta.filter(F.col(quoted(key)).isNotNull()).agg(*found).first()
        labels = self._labels(held, seen.buckets) if bucketed else set(held["parts"])
        label_of = {p: label for label in labels for p in held["parts"][label]}
        kind = delta.schema[key].dataType
        within = F.col(quoted(key)).between(F.lit(seen.low).cast(kind), F.lit(seen.high).cast(kind))
        return self._files(held, list(label_of), with_file=True).filter(within), label_of

    def _touched(self, held: dict, delta: DataFrame, key: str) -> dict[str, set[str]]:
        """By label, the files in force with a key of ``delta``; reads the key column of its buckets and key range."""
        rows, label_of = self._near(held, delta, key)
        hit = rows.select(quoted(key), FILE).join(delta.select(quoted(key)), key, "left_semi").select(FILE).distinct().collect()
        inside = self._path(f"{self.root}/data").toUri().getPath().rstrip("/") + "/"
        files: dict[str, set[str]] = {}
        for row in hit:
            # Spark gives an escaped address; the path below ``data`` is what listings hold.
            path = self.spark._jvm.java.net.URI(row[0]).getPath()
            name = path[path.index(inside) + len(inside):]
            label = label_of.get(name) or label_of[name.rpartition("/")[0]]
            files.setdefault(label, set()).add(name)
        return files

    def compact(self, most: int = 8) -> int:
        """Rewrite the partitions listed as more than ``most`` directories or files; returns their number."""
        held = self.listing()
        labels = {k for k, paths in held["parts"].items() if len(paths) > most}
        if labels:
            self._publish(self._rows(held, list(labels)), labels, None)
        return len(labels)

    def expire(self, keep: int = 5) -> int:
        """Forget all but the last ``keep`` versions; returns the number of directories removed."""
        versions = self._versions()
        kept, dropped = versions[-keep:], versions[:-keep]
        in_force = set()
        for number in kept:
            stream = self._fs.open(self._path(f"{self.root}/listings/{number}.json"))
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            in_force |= {p.split("/")[0] for paths in json.loads(text)["parts"].values() for p in paths}
        removed = 0
        folder = self._path(f"{self.root}/data")
        for status in self._fs.listStatus(folder) if dropped else []:
            if status.getPath().getName() not in in_force:
                removed += bool(self._fs.delete(status.getPath(), True))
        for number in dropped:
            self._fs.delete(self._path(f"{self.root}/listings/{number}.json"), False)
        return removed
