"""Keyed tables in hash buckets under a manifest: folds rewrite touched buckets, commits are atomic and happen once.

A table is a folder.  ``data/<commit>/_bucket=<n>`` holds the rows of a bucket as one commit wrote
them; ``manifest/<version>.json`` lists, for one version, the folders of every bucket, the last batch
of every writer (the ledger) and the positions that the rows stand for.  Rows are staged first; the
version exists once its manifest does, and of two commits of one version only one can create it.  So
data, ledger and positions change together or not at all, and a batch that is run again finds itself
in the ledger.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcflow.operators.apply import compact_changes, fold_unchanged, live_images, unchanged_delta

BUCKET = "_bucket"
DEFAULT_BUCKETS = 64


class CommitConflict(RuntimeError):
    """Another commit made this version first; read the table again and repeat the fold."""


@dataclass(frozen=True)
class Manifest:
    """One version of a table, small enough to be written whole: it grows with buckets and writers, not with rows."""

    version: int
    schema: str
    keys: tuple[str, ...]
    buckets: int
    files: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    ledger: Mapping[str, int] = field(default_factory=dict)
    positions: Mapping[str, int] = field(default_factory=dict)

    def holds(self, writer: str | None, batch: int | None) -> bool:
        """Whether this batch of this writer is in the table already."""
        return writer is not None and batch is not None and self.ledger.get(writer, -1) >= batch

    def text(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True, indent=1)

    @classmethod
    def parse(cls, text: str) -> Manifest:
        raw = json.loads(text)
        return cls(**{**raw, "keys": tuple(raw["keys"]), "files": {b: tuple(f) for b, f in raw["files"].items()}})


class BucketTable:
    """A keyed table at a path that every executor reaches, on a file system that renames at once.

    ``base`` gives the rows before the first version, ``keys`` (all columns without them) and ``buckets``
    how these are dealt; an existing table knows its own.  Choose buckets so that one is a task's work.
    """

    def __init__(self, spark: SparkSession, path: str, base: DataFrame | None = None, keys: Sequence[str] = (), buckets: int = DEFAULT_BUCKETS):
        self.spark, self.path, self.base = spark, path.rstrip("/"), base
        self._first = None if base is None else Manifest(-1, base.schema.toDDL(), tuple(keys), buckets)
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, *parts: str):
        path = self._hadoop.fs.Path("/".join([self.path, *parts]))
        return path, path.getFileSystem(self._conf)

    # ---- manifests ----------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        folder, fs = self._at("manifest")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0] != "_")

    def manifest(self, version: int | None = None) -> Manifest | None:
        """A version's manifest, the last one's unless named, or None before the first."""
        known = self.versions() if version is None else [version]
        if not known:
            return None
        path, fs = self._at("manifest", f"{known[-1]:020d}.json")
        stream = fs.open(path)
        try:
            return Manifest.parse(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, manifest: Manifest) -> None:
        """Make a version exist: its manifest is written under another name and takes its own only if that is free."""
        text = manifest.text()
        draft, fs = self._at("manifest", f"_{manifest.version}-{uuid.uuid4().hex}")
        final, _ = self._at("manifest", f"{manifest.version:020d}.json")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            if fs.exists(final):
                raise CommitConflict(f"version {manifest.version} of {self.path} exists")
            context.rename(draft, final, none)
        except Exception as e:
            fs.delete(draft, False)
            if isinstance(e, CommitConflict) or "FileAlreadyExists" in str(e):
                raise CommitConflict(f"version {manifest.version} of {self.path} exists") from e
            raise

    # ---- rows ---------------------------------------------------------------------------------

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of a version, or of some of its buckets; None before the first version."""
        manifest = self.manifest(version)
        return None if manifest is None else self._rows(manifest, buckets)

    def _rows(self, manifest: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        if manifest.version < 0:
            return self.base
        schema = StructType.fromDDL(manifest.schema)
        wanted = manifest.files if buckets is None else {str(b): manifest.files.get(str(b), ()) for b in buckets}
        folders = [f"{self.path}/{f}" for files in wanted.values() for f in files]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def bucket_of(self, manifest: Manifest) -> Column:
        """The bucket of a row, from its key columns as the table types them."""
        schema = StructType.fromDDL(manifest.schema)
        keys = [F.col(f"`{k}`").cast(schema[k].dataType) for k in manifest.keys or schema.names]
        return F.pmod(F.xxhash64(*keys), F.lit(manifest.buckets)).cast("int")

    def _stage(self, rows: DataFrame, manifest: Manifest) -> dict[str, tuple[str, ...]]:
        """Write rows by bucket; they belong to no version yet.  Returns the folder of every bucket that got rows."""
        name = f"data/{manifest.version:020d}-{uuid.uuid4().hex}"
        staged = rows.withColumn(BUCKET, self.bucket_of(manifest)).repartition(BUCKET)
        staged.write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        folder, fs = self._at(name)
        made = [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()]
        return {m.split("=")[1]: (f"{name}/{m}",) for m in made if m.startswith(f"{BUCKET}=")}

    def before(self) -> Manifest:
        """The last version, or the one before the first, whose rows are ``base``."""
        found = self.manifest() or self._first
        if found is None:
            raise ValueError(f"{self.path} holds no table, and no base was given")
        return found

    def commit(
        self, change: Callable[[DataFrame, Manifest], DataFrame] | None = None, *, touched: DataFrame | None = None, added: DataFrame | None = None,
        writer: str | None = None, batch: int | None = None, positions: Mapping[str, int] | Callable[[], Mapping[str, int]] | None = None,
        check: Callable[[], None] | None = None,
    ) -> Manifest:
        """The next version.

        ``change`` makes the new rows of the touched buckets from the old ones; ``touched`` holds the keys
        that decide which buckets these are (all without it).  ``added`` rows are put beside what is there.
        A batch that the ledger has is passed over.  When the rows are staged, ``check`` may refuse them by
        raising, and no version is made; ``positions`` may be a function, asked then.  Positions never go back.
        """
        before = self.before()
        if before.holds(writer, batch):
            return before
        new = before.version < 0
        after = replace(before, version=before.version + 1)
        files = dict(before.files)
        if change is not None or new:
            hit = range(before.buckets) if touched is None or new else self._touched(touched, before)
            if len(hit):
                held = self._rows(before, list(hit))
                made = self._stage(held if change is None else change(held, before), after)
                files = {b: f for b, f in files.items() if int(b) not in hit} | made
        if added is not None:
            for bucket, folders in self._stage(added, after).items():
                files[bucket] = (*files.get(bucket, ()), *folders)
        if check is not None:
            check()
        ledger = dict(before.ledger) | ({writer: batch} if writer is not None and batch is not None else {})
        reached = dict(before.positions)
        for source, position in (positions() if callable(positions) else positions or {}).items():
            reached[source] = max(position, reached.get(source, position))
        after = replace(after, files=files, ledger=ledger, positions=reached)
        self._publish(after)
        return after

    def _touched(self, keys: DataFrame, manifest: Manifest) -> set[int]:
        """Buckets of some keys: at most as many numbers as the table has buckets reach the driver."""
        return {r[0] for r in keys.select(self.bucket_of(manifest).alias(BUCKET)).distinct().collect()}

    # ---- folds --------------------------------------------------------------------------------

    def fold(self, delta: DataFrame, **commit) -> Manifest:
        """Fold compacted changes (keys, live, image) into the touched buckets.

        ``delta`` is read twice, so it should be stored; see ``compact_changes``.
        """

        def change(held: DataFrame, manifest: Manifest) -> DataFrame:
            kept = held.join(delta.select(*manifest.keys), list(manifest.keys), "left_anti").select(*held.columns)
            return kept.unionByName(live_images(delta, held.columns))

        return self.commit(change, touched=delta, **commit)

    def fold_changes(self, changes: DataFrame, order: Sequence[str] | None = None, *, store: Callable[[DataFrame], DataFrame], **commit) -> Manifest:
        """Fold a change log (``before``, ``after`` structs; with ``unchanged`` lists, values not resent are kept).

        ``store`` keeps the compacted changes where both of their readers find them.  A batch that the
        ledger has is not even read.
        """
        before = self.before()
        if before.holds(commit.get("writer"), commit.get("batch")):
            return before
        keys = list(before.keys)
        if "unchanged" not in changes.columns:
            return self.fold(store(compact_changes(changes, keys, order)), **commit)
        delta = store(unchanged_delta(changes, StructType.fromDDL(before.schema).names, keys, order))
        return self.commit(lambda held, m: fold_unchanged(held, delta, keys), touched=delta, **commit)

    # ---- upkeep -------------------------------------------------------------------------------

    def vacuum(self, keep: int = 2) -> int:
        """Drop manifests before the last ``keep`` versions and data that none of these lists; returns the folders dropped.

        Run it beside no commit: what is staged but not committed yet looks unlisted.
        """
        known = self.versions()
        kept = known[-max(keep, 1) :]
        listed = {f for v in kept for files in self.manifest(v).files.values() for f in files}
        dropped = 0
        data, fs = self._at("data")
        for commit in fs.listStatus(data) if fs.exists(data) else []:
            name = commit.getPath().getName()
            for bucket in fs.listStatus(commit.getPath()):
                if bucket.isDirectory() and f"data/{name}/{bucket.getPath().getName()}" not in listed:
                    fs.delete(bucket.getPath(), True)
                    dropped += 1
            if not any(f.isDirectory() for f in fs.listStatus(commit.getPath())):
                fs.delete(commit.getPath(), True)
        for version in set(known) - set(kept):
            path, _ = self._at("manifest", f"{version:020d}.json")
            fs.delete(path, False)
        return dropped
