"""A captured log as a data source whose offsets are positions: one per slot or database, not file names.

The log lies in folders ``<key>=<value>`` (slot, source), as ``write_position_log`` leaves it, and grows by
files; positions of one key only grow.  Everything about a file comes from its footer: the range of
positions of each row group.  An offset maps each key to the last position read, so a query that starts
again from its checkpoint reads on behind it, whatever files hold the rows by then.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cdcflow.session import RELEASED, settings

FORMAT = "positionlog"
#: Rows that one task reads, about; row groups are never cut.
PARTITION_ROWS = 1_000_000
#: Keys whose files a task writes side by side; rows of further ones are sorted first, on disk if they are many.
OPEN_FILES = 8
# Fixed value: the folder name of rows whose key is NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class RowGroup:
    """A row group and what its footer says of it."""

    path: str
    number: int
    key: str
    low: int
    high: int
    rows: int


@dataclass
class Slice(InputPartition):
    """What one task reads: row groups of a key, and the positions wanted from them (``after`` not included)."""

    key: str
    groups: tuple[tuple[str, int], ...]
    after: int | None
    upto: int


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it; plain paths are local."""
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parsed.path
    return pafs.FileSystem.from_uri(path)


class _Log:
    """The files of a log, looked at once each."""

    def __init__(self, path: str, key: str, position: str):
        self.key, self.position = key, position
        self.files, self.root = _folder(path)
        self.groups: list[RowGroup] = []
        self.seen: set[str] = set()

    def _key_of(self, path: str) -> str | None:
        inside = path[len(self.root) :].strip("/").split("/")
        if any(p.startswith(("_", ".")) for p in inside) or not path.endswith(".parquet"):
            return None
        named = [p[len(self.key) + 1 :] for p in inside[:-1] if p.startswith(f"{self.key}=")]
        return named[0] if named else ""

    def refresh(self) -> None:
        found = self.files.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True))
        for info in sorted(found, key=lambda f: f.path):
            key = self._key_of(info.path) if info.is_file and info.path not in self.seen else None
            if key is None:
                continue
            self.seen.add(info.path)
            with self.files.open_input_file(info.path) as f:
                footer = pq.ParquetFile(f).metadata
            place = footer.schema.to_arrow_schema().names.index(self.position)
            for i in range(footer.num_row_groups):
                group = footer.row_group(i)
                facts = group.column(place).statistics
                if group.num_rows and facts is not None and facts.has_min_max:
                    self.groups.append(RowGroup(info.path, i, key, facts.min, facts.max, group.num_rows))
                elif group.num_rows:
                    raise ValueError(f"{info.path} does not say which positions it holds")

    def reached(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for g in self.groups:
            out[g.key] = max(g.high, out.get(g.key, g.high))
        return out

    def slices(self, start: dict[str, int], end: dict[str, int], rows: int) -> list[Slice]:
        """Row groups that hold positions after ``start`` up to ``end``, in runs of about ``rows`` rows of one key."""
        out: list[Slice] = []
        for key in sorted(end):
            after, upto = start.get(key), end[key]
            taken, size = [], 0
            for g in sorted((g for g in self.groups if g.key == key), key=lambda g: (g.low, g.path, g.number)):
                if g.low > upto or (after is not None and g.high <= after):
                    continue
                taken.append((g.path, g.number))
                size += g.rows
                if size >= rows:
                    out.append(Slice(key, tuple(taken), after, upto))
                    taken, size = [], 0
            if taken:
                out.append(Slice(key, tuple(taken), after, upto))
        return out


class _Reading:
    """What batch and stream reading share."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.key, self.position = options["path"], options.get("key", "slot"), options.get("position", "pos")
        self.rows = int(options.get("partitionRows", PARTITION_ROWS))
        self.since = int(options["since"]) if options.get("since") else None
        self.schema = to_arrow_schema(schema)
        self.log = _Log(self.path, self.key, self.position)

    def _read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        files, _ = _folder(self.path)
        key = None if part.key == NULL_FOLDER else unquote(part.key)
        stored = [n for n in self.schema.names if n != self.key]
        for path, number in part.groups:
            with files.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(row_groups=[number], columns=stored):
                    at = batch.column(self.position)
                    wanted = pc.less_equal(at, part.upto)
                    if part.after is not None:
                        wanted = pc.and_(wanted, pc.greater(at, part.after))
                    batch = batch.filter(wanted)
                    columns = [
                        pa.array([key] * batch.num_rows, f.type) if f.name == self.key else batch.column(f.name).cast(f.type) for f in self.schema
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=self.schema)

    def _after_since(self, ends: dict[str, int]) -> dict[str, int]:
        return {} if self.since is None else {key: self.since for key in ends}


class PositionReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Slice]:
        self.log.refresh()
        ends = self.log.reached()
        return self.log.slices(self._after_since(ends), ends, self.rows)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return self._read(partition)


class PositionStream(_Reading, DataSourceStreamReader):
    """Offsets are {key: last position read}; an empty one stands before everything (or ``since``)."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self.log.refresh()
        return self.log.reached()

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        if not set(end) <= {g.key for g in self.log.groups}:
            self.log.refresh()  # a batch planned again after a restart
        return self.log.slices(self._after_since(end) | start, end, self.rows)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return self._read(partition)


class PositionLog(DataSource):
    """``spark.readStream.format("positionlog")``.

    Options: ``path``, ``key`` (folder name, default ``slot``), ``position`` (column, default ``pos``),
    ``since`` (start behind this position), ``partitionRows``.  A schema must be given.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> PositionReader:
        return PositionReader(self.options, schema)

    def streamReader(self, schema: StructType) -> PositionStream:
        return PositionStream(self.options, schema)


def write_position_log(rows: DataFrame, path: str, key: str = "slot") -> None:
    """Append rows to a log in the layout that the source reads."""
    with settings(rows.sparkSession, RELEASED | {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        rows.write.mode("append").partitionBy(key).parquet(path, compression="zstd")


def position_log(
    spark: SparkSession, path: str, schema: str | StructType, *, key: str = "slot", position: str = "pos", since: int | None = None, streaming: bool = True,
    partition_rows: int = PARTITION_ROWS,
) -> DataFrame:
    """The rows of a log, as a stream or as they are now."""
    spark.dataSource.register(PositionLog)
    reader = (spark.readStream if streaming else spark.read).format(FORMAT).schema(schema)
    options = {"path": path, "key": key, "position": position, "partitionRows": str(partition_rows)} | ({} if since is None else {"since": str(since)})
    return reader.options(**options).load()
