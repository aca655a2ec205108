"""Benchmark passages in documents: exact pieces by the pigeonhole rule, edits by Myers' bit-parallel distance."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Items are searched in blocks of at most this many characters, each sent to the executors at once.
BLOCK_CHARS = 500_000
ERROR_PERCENT = 8
#: Shorter items are phrases rather than passages: they count where they stand as they are, between word borders.
LEAST_CHARS = 24
MATCHES = "array<struct<item_id:bigint,start:bigint,end:bigint,distance:int>>"


def normal(text: str) -> str:
    """Lower case, one space for any white space, none at the ends."""
    return " ".join(_lower(text).split())


def _lower(text: str) -> str:
    """Lower case that keeps the number of characters."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def budget(length: int, percent: int = ERROR_PERCENT) -> int:
    """Edits that an item of so many normalised characters may have."""
    return length * percent // 100 if length >= LEAST_CHARS else 0


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit goes on over either end."""
    before = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    after = end < len(text) and text[end].isalnum() and text[end - 1].isalnum()
    return not before and not after


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into errors + 1 parts of nearly equal length: whoever makes ``errors`` edits leaves one whole."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _places(item: str) -> dict[str, int]:
    """For each character, the bits of its places in the item."""
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        out[c] |= 1 << i
    return dict(out)


def myers(places: dict[str, int], size: int, text: str, errors: int) -> tuple[int, int] | None:
    """(distance, end) of the best place in ``text`` that is within ``errors`` edits of the item; the first of equal ones.

    A column of the edit matrix is two integers, the places where it rises and where it falls, and
    one character of text advances all rows of it in a few operations.
    """
    full, top = (1 << size) - 1, 1 << (size - 1)
    rises, falls, score, best = full, 0, size, None
    for end, c in enumerate(text, 1):
        at = places.get(c, 0)
        diagonal = (((at & rises) + rises) ^ rises) | at | falls
        up, down = falls | ~(diagonal | rises) & full, rises & diagonal
        score += 1 if up & top else -1 if down & top else 0
        up, down = up << 1 & full, down << 1 & full
        rises, falls = down | ~(diagonal | up) & full, up & diagonal
        if score <= errors and (best is None or score < best[0]):
            best = score, end
    return best


class Searcher:
    """The items of one block, ready to be found."""

    def __init__(self, items: list[tuple[int, str]], percent: int):
        self.items = [(i, t, budget(len(t), percent)) for i, t in items]
        self.places = [_places(t) for _, t, _ in self.items]
        self.backward = [_places(t[::-1]) for _, t, _ in self.items]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, text, errors) in enumerate(self.items):
            for at, piece in pieces(text, errors):
                where[piece].append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, found in where.items():
            self.automaton.add_word(piece, (len(piece), found))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) in the normalised text: the best match of each stretch where pieces of an item were hit."""
        near: dict[int, list[int]] = defaultdict(list)
        for end, (size, found) in self.automaton.iter(text):
            for n, at in found:
                near[n].append(end + 1 - size - at)
        out = []
        for n, starts in near.items():
            item_id, item, errors = self.items[n]
            stretch: list[list[int]] = []
            for s in sorted(set(starts)):
                if stretch and s - errors <= stretch[-1][1] + errors:
                    stretch[-1][1] = s
                else:
                    stretch.append([s, s])
            for low, high in stretch:
                begin, stop = max(0, low - errors), high + len(item) + errors
                if len(item) < LEAST_CHARS:
                    if stands_alone(text, begin, stop):
                        out.append((item_id, begin, stop, 0))
                    continue
                hit = myers(self.places[n], len(item), text[begin:stop], errors)
                if hit:
                    end = begin + hit[1]
                    back = myers(self.backward[n], len(item), text[max(0, end - len(item) - hit[0]) : end][::-1], hit[0])
                    out.append((item_id, end - back[1], end, hit[0]))
        return sorted(out, key=lambda m: (m[0] is None, m[0] or 0, *m[1:]))


_OPEN: dict[str, Searcher] = {}


def _searcher(name: str, block: Broadcast, percent: int) -> Searcher:
    if name not in _OPEN:
        if len(_OPEN) >= 4:
            _OPEN.clear()
        _OPEN[name] = Searcher(block.value, percent)
    return _OPEN[name]


def _original(text: str) -> list[int]:
    """Place in the text of each character of its normal form, and of its end."""
    out, space = [], False
    for i, c in enumerate(text):
        if c.isspace():
            space = bool(out)
        else:
            if space:
                out.append(i - 1)
                space = False
            out.append(i)
    return out


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of bounded size; the driver holds one block at a time."""
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    block, chars = [], 0
    for r in rows.dropDuplicates().orderBy("item_id", "text").toLocalIterator():
        item = normal(r["text"])
        if not item:
            continue
        if block and chars + len(item) > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append((r["item_id"], item))
        chars += len(item)
    if block:
        yield block


def with_matches(documents: DataFrame, benchmark: DataFrame, name: str = "matches", percent: int = ERROR_PERCENT) -> DataFrame:
    """Adds an array of (item_id, start, end, distance): the items that ``text`` holds within their error budget.

    An item of n characters may differ by n * ``percent`` / 100 insertions, deletions and changes, on
    lower-cased text with white space made even; start and end are places in the text as it is.  Each
    stretch of text where pieces of an item are found gives its best match.  Items of fewer than
    ``LEAST_CHARS`` characters must stand as they are between word borders.  Null and empty texts have
    no match; null and empty items are in no text; an item without id is reported with a null id, one
    text under two ids with both; all columns and rows are kept, equal ids or not.  Every text is read
    whole, once, by a chain of one scan per block of items.
    """
    sc = documents.sparkSession.sparkContext
    out = documents.withColumn(name, F.array().cast(MATCHES))
    kind = out.schema[name].dataType
    for items in blocks(benchmark):
        block, block_name = sc.broadcast(items), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], block: Broadcast = block, block_name: str = block_name) -> Iterator[pa.RecordBatch]:
            searcher = _searcher(block_name, block, percent)
            for batch in batches:
                column, before = [], batch.column(name).to_pylist()
                for text, had in zip(batch.column("text").to_pylist(), before, strict=True):
                    found = searcher.find(normal(text)) if text else []
                    if found:
                        at = _original(text)
                        had = had + [{"item_id": i, "start": at[a], "end": at[b - 1] + 1, "distance": d} for i, a, b, d in found]
                    column.append(had)
                i = batch.schema.get_field_index(name)
                yield batch.set_column(i, batch.schema.field(i), pa.array(column, batch.schema.field(i).type))

        out = out.mapInArrow(search, StructType(out.schema.fields[:-1]).add(name, kind))
    return out


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, distance), one row per match; odd rows as in ``with_matches``."""
    found = with_matches(documents.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.inline("matches"))


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item, with all their columns.

    Decided row by row, whatever the ids of documents and items; null and empty texts hold none and stay.
    """
    name = "_benchmark_matches"
    return with_matches(documents, benchmark, name).where(F.size(name) == 0).drop(name)
