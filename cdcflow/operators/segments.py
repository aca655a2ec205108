"""Which log segments to read: tables of archived and online segments of many sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cdcflow.operators.positions import WHOLE, Slices, row_index

SEGMENT_COLUMNS = (
    "source", "kind", "thread", "sequence", "first_change", "next_change", "last_redo_change", "name",
)


def _covers(scn: Column) -> Column:
    first, nxt = F.col("first_change"), F.col("next_change")
    return (first >= scn) | ((first <= scn) & (scn < nxt))


def segments_since(
    archived: DataFrame, online: DataFrame, members: DataFrame, threads: DataFrame, positions: DataFrame
) -> DataFrame:
    """Segments each source still has to read from its position; position 0 means only the current one.

    ``positions`` has one ``scn`` per ``source``, so the join by source never multiplies segments,
    and the range test runs as a filter on its output.
    """
    scn = F.col("scn")
    at = positions.groupBy("source").agg(F.min("scn").alias("scn"))
    own = archived.where("dest_id = 1")
    arch = own.join(at, "source").where((scn > 0) & _covers(scn)).select(
        "source", F.lit("ARCH").alias("kind"), "thread", "sequence", "first_change", "next_change",
        F.col("next_change").alias("last_redo_change"), "name",
    )
    nth = Window.partitionBy("source", "group_no").orderBy("member")
    files = members.withColumn("_nth", F.row_number().over(nth))
    copies = own.select("source", "thread", "sequence", F.col("archived").alias("_archived"), F.col("name").alias("_name"))
    redo = (
        online.where("status = 'CURRENT'")
        .join(at, "source")
        .where((scn == 0) | _covers(scn))
        .join(copies, ["source", "thread", "sequence"], "left")
        .join(files, ["source", "group_no"])
        .where(F.col("_nth") == F.col("members"))
        .join(threads, ["source", "thread"])
        .select(
            "source", F.lit("REDO").alias("kind"), "thread", "sequence", "first_change", "next_change",
            F.when(F.col("_archived") == "YES", F.col("next_change"))
            .otherwise(F.col("thread_last_change")).alias("last_redo_change"),
            F.coalesce("_name", "member").alias("name"),
        )
    )
    return arch.unionByName(redo)


def unregistered(segments: DataFrame, registered: DataFrame) -> DataFrame:
    """Segment names not handed to the reader yet; each name once."""
    return segments.select("source", "name").subtract(registered.select("source", "name"))


def segment_list(segments: DataFrame, per_line: int = 100, sep: str = " ", *, slices: Slices = WHOLE) -> DataFrame:
    """Names in order, joined by ``sep``: lines of at most ``per_line`` names per source and thread.

    Lines bound what one row gathers; all names are listed.
    """
    numbered = row_index(segments, "sequence", "_i", keys=["source", "thread"], ties=["name"], slices=slices)
    line = F.expr(f"_i div {per_line}")
    entry = F.struct("sequence", "name")
    names = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["name"])
    return numbered.groupBy("source", "thread", line.alias("line")).agg(F.array_join(names, sep).alias("names"))


def first_change_for(positions: DataFrame, *segments: DataFrame) -> DataFrame:
    """Lowest first change of the segments that hold each source's position."""
    at = positions.groupBy("source").agg(F.min("scn").alias("scn"))
    spans = None
    for s in segments:
        part = s.select("source", "first_change", "next_change")
        spans = part if spans is None else spans.unionByName(part)
    held = spans.join(at, "source").where(F.col("scn").between(F.col("first_change"), F.col("next_change")))
    return held.groupBy("source").agg(F.min("first_change").alias("first_change"))


def low_scn(instances: DataFrame) -> DataFrame:
    """Lowest current position over the instances of each source."""
    return instances.groupBy("source").agg(F.min("current_scn").alias("current_scn"))


def _level(length: Column) -> Column:
    """The smallest k with 2**k >= length."""
    return F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int")


def locate(rows: DataFrame, spans: DataFrame, keys: Sequence[str], pos: str, low: str = "first_change", high: str = "next_change") -> DataFrame:
    """Each row beside every span of its key that holds its position: ``low`` <= ``pos`` < ``high``.

    Positions are cut into bins of powers of two.  A span goes to the one or two bins of its own size
    class that it lies in, a row to its bin of every size class there is, so the join is on equal keys
    and bins: spans are never compared with rows far away, long and short spans alike, and a key with
    most of the rows is spread over its bins.  Rows without a span, and with a null position, are left
    out; empty spans hold nothing.
    """
    level = _level(F.col(high) - F.col(low))
    bins = F.expr("array_distinct(array(shiftright(_low, _level), shiftright(_high - 1, _level)))")
    binned = spans.where(F.col(low) < F.col(high)).withColumns({"_low": F.col(low).cast("long"), "_high": F.col(high).cast("long"), "_level": level})
    binned = binned.select("*", F.explode(bins).alias("_bin")).drop("_low", "_high")
    levels = sorted(r[0] for r in binned.select("_level").distinct().collect())  # 64 numbers at most
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("_level"), F.call_function("shiftright", F.col(pos).cast("long"), F.lit(k)).alias("_bin")) for k in levels] or [F.lit(None).cast("struct<_level: int, _bin: bigint>")]))
    probes = rows.select("*", at.alias("_at")).select(*rows.columns, "_at._level", "_at._bin")
    found = probes.join(binned, [*keys, "_level", "_bin"])
    return found.where((F.col(pos) >= F.col(low)) & (F.col(pos) < F.col(high))).select(*rows.columns, *[c for c in spans.columns if c not in keys])
