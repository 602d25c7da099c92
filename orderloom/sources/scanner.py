"""Elements of the ``data`` list of JSON feeds, cut out of the text without parsing all of it.

A feed of any size is read in the byte ranges that Spark deals out, as text parted at ``}``. Where a range
lies in the document is not known to its task, so a first pass gives each range its transition: how many
unescaped quotes it has, and how many brackets it opens beyond those it closes if it begins outside of a
string, and if it begins inside of one. Transitions add up, so sums over the earlier ranges give every range
the state that it begins in. The second pass cuts the ranges at the commas between elements; only elements
that reach from one range into the next are put together by their number. Bytes are looked at as arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, share_library

#: Text of a body that is looked at at a time.
CHUNK = 1 << 20
NO_FEED = "the feed is not a JSON object with a data list"

_ESCAPE = re.compile(rb"\\.", re.S)
_KEY = re.compile(rb'"data"\s*:\s*$')
_TURN = np.zeros(256, np.int8)
_TURN[list(b"{[")], _TURN[list(b"}]")] = 1, -1
_BLANK = np.isin(np.arange(256), list(b" \t\r\n"))
QUOTE, COMMA, OPEN_LIST, OPEN_OBJECT = b'"'[0], b","[0], b"["[0], b"{"[0]


def _plain(data: bytes) -> np.ndarray:
    """The bytes with every escaped pair made harmless."""
    return np.frombuffer(_ESCAPE.sub(b"__", data) if b"\\" in data else data, np.uint8)


@dataclass
class Transition:
    """What a range does to the state: quotes, and turns outside of strings for either state at its begin."""

    quotes: int = 0
    if_outside: int = 0
    if_inside: int = 0

    def add(self, data: bytes) -> None:
        raw = _plain(data)
        odd = (np.cumsum(raw == QUOTE, dtype=np.int32) + self.quotes) & 1 == 1
        turns = _TURN[raw]
        inside = int(turns[odd].sum())
        self.quotes += int((raw == QUOTE).sum())
        self.if_outside += int(turns.sum()) - inside
        self.if_inside += inside


@dataclass
class Cutter:
    """Cuts a range into elements, from the state it begins in.

    A range that begins inside of a list does not know whose list it is: what comes before that list's end
    is ``early``, and counts if the ranges before say so. Rows are ``(early, nth, open, text)``; an open
    element goes on in the next range, and the first early one has begun in an earlier range.
    """

    inside: bool = False
    depth: int = 0
    in_data: bool | None = None
    pending: list[bytes] = field(default_factory=list)
    counts: list[int] = field(default_factory=lambda: [0, 0])  # known, early
    last_region: bool | None = None
    lists: int = 0
    roots: int = 0
    strays: int = 0
    tail: bytes = b""
    in_list: int = 0

    def __post_init__(self) -> None:
        if self.depth < 2:
            self.in_data = False

    def cut(self, data: bytes) -> Iterator[tuple[bool, int, bool, bytes]]:
        """The elements that end in the next bytes."""
        raw = _plain(data)
        quotes = raw == QUOTE
        parity = np.cumsum(quotes, dtype=np.int32) + self.inside
        outside = parity & 1 == 0
        turns = np.where(outside, _TURN[raw], 0)
        depth = np.cumsum(turns, dtype=np.int32) + self.depth
        top = (depth == 0) & (turns == 0) & (outside | quotes) & ~_BLANK[raw]
        opened = (turns == 1) & (depth == 1)
        self.strays += int(top.sum()) + int((opened & (raw != OPEN_OBJECT)).sum())
        self.roots += int((opened & (raw == OPEN_OBJECT)).sum())
        commas = np.flatnonzero(outside & (raw == COMMA) & (depth == 2))
        borders = np.flatnonzero(((turns == 1) & (depth == 2)) | ((turns == -1) & (depth == 1)))
        start = 0
        for at in [*borders.tolist(), len(data)]:
            if self.in_data is not False:
                a, b = np.searchsorted(commas, [start, at])
                for comma in commas[a:b].tolist():
                    yield self._element(data[start:comma])
                    start = comma + 1
                self.pending.append(data[start:at])
            if at < len(data):
                if turns[at] == 1:
                    before = (self.tail + raw[max(0, at - 64) : at].tobytes())[-64:] if at < 64 else raw[at - 64 : at].tobytes()
                    self.in_data = bool(raw[at] == OPEN_LIST and _KEY.search(before))
                    self.lists += self.in_data
                    self.in_list, self.pending = 0, []
                else:
                    text = b"".join(self.pending)
                    # An empty list has no element; one that began in an earlier range is settled there.
                    if self.in_data is None or self.in_data and (self.in_list or text.strip()):
                        yield self._element(b"")
                    self.in_data, self.pending = False, []
                self.last_region = self.in_data
                start = at + 1
        if len(data):
            self.inside, self.depth = bool(parity[-1] & 1), int(depth[-1])
            self.tail = (self.tail + raw[-64:].tobytes())[-64:]

    def _element(self, rest: bytes) -> tuple[bool, int, bool, bytes]:
        early = self.in_data is None
        nth = self.counts[early]
        self.counts[early] += 1
        self.in_list += 1
        text = b"".join([*self.pending, rest])
        self.pending = []
        return early, nth, False, text

    def rest(self) -> Iterator[tuple[bool, int, bool, bytes]]:
        """What is left open at the end of the range."""
        if self.in_data is not False and self.depth >= 2:
            early = self.in_data is None
            yield early, self.counts[early], True, b"".join(self.pending)

    @property
    def whole(self) -> bool:
        """Whether what was cut is one object with a ``data`` list."""
        return not self.inside and self.depth == 0 and self.roots == 1 and not self.strays and self.lists > 0


def _chunks(text: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(text):
        comma = text.find(b",", start + CHUNK)
        stop = comma + 1 if comma >= 0 else len(text)
        yield text[start:stop]
        start = stop


def elements(text: str | None) -> list[bytes] | None:
    """The elements of one feed, as written; None where it is none."""
    cutter, found = Cutter(), []
    for chunk in _chunks((text or "").encode()):
        found += [row[3].strip() for row in cutter.cut(chunk)]
    return found if cutter.whole else None


def elements_of_bodies(df: DataFrame, body: str = "body") -> DataFrame:
    """One row an element: the other columns, ``pos`` and ``element``; a body that is no feed gives a row with nulls there."""
    share_library(df.sparkSession)
    others = [c for c in df.columns if c != body]
    kept = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    rows = df.select(kept.alias("kept"), F.col(body).alias("body"))
    schema = T.StructType([rows.schema["kept"], T.StructField("pos", T.IntegerType()), T.StructField("element", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, body in enumerate(batch.column("body")):
                found = elements(body.as_py())
                n = 1 if found is None else len(found)
                for start in range(0, n, 10_000):
                    part = [None] if found is None else found[start : start + 10_000]
                    places = [None] if found is None else range(start, start + len(part))
                    kept = batch.column("kept").take(pa.array([i] * len(part), pa.int64()))
                    texts = pa.array(part, pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([kept, pa.array(places, pa.int32()), texts], names=["kept", "pos", "element"])

    cut = rows.mapInArrow(run, schema)
    return cut.select(*[F.col("kept").getField(c).alias(c) for c in others], "pos", "element")


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, bytes]]:
    """A batch's runs of rows of one range: its name, its first row and its text."""
    file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
    edges = np.flatnonzero(np.concatenate([[True], (file[1:] != file[:-1]) | (block[1:] != block[:-1]), [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        parts = batch.column("value").slice(a, b - a).cast(pa.binary()).to_pylist()
        yield (int(file[a]), int(block[a])), a, b"}".join([*parts, b""])


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[int, int], Transition] = {}
    for batch in batches:
        for name, _, data in _ranges(batch):
            found.setdefault(name, Transition()).add(data)
    rows = [(*name, t.quotes, t.if_outside, t.if_inside) for name, t in found.items()]
    yield _table(rows, _TRANSITIONS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, cutter = None, Cutter()

    def end() -> pa.RecordBatch:
        rows = [(*now, "element", *row, None, None, None, None, None) for row in cutter.rest()]
        known, early = cutter.counts
        rows.append((*now, "range", None, None, None, None, known, early, cutter.last_region, cutter.lists, cutter.roots * 2 + min(1, cutter.strays)))
        return _table(rows, _CUT)

    for batch in batches:
        for name, row, data in _ranges(batch):
            if name != now:
                if now is not None:
                    yield end()
                now = name
                cutter = Cutter(batch.column("inside")[row].as_py(), batch.column("depth")[row].as_py())
            yield _table([(*name, "element", *r, None, None, None, None, None) for r in cutter.cut(data)], _CUT)
    if now is not None:
        yield end()


_TRANSITIONS = "file long, block long, quotes long, if_outside long, if_inside long"
_CUT = (
    "file long, block long, kind string, early boolean, nth long, open boolean, text binary, "
    "known long, n_early long, last_region boolean, lists long, roots long"
)
_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split(" ") for c in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, names)], names=[n for n, _ in names])


def elements_of_files(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """``(elements, files that are no feeds)``: ``file, pos, element`` and ``file``.

    One feed a file, of any size, in as many tasks as it has ranges; a compressed file is one range. The cut
    elements are written once. There is one row a range in what is broadcast.
    """
    share_library(spark)
    meta = F.col("_metadata")
    pieces = spark.read.option("lineSep", "}").text(path).select(
        "value", meta.file_path.alias("path"), meta.file_size.alias("size"), meta.file_block_start.alias("block")
    )
    # A last row without a } behind it is told by the file's size: each row counts as its bytes and one more.
    bytes_ = F.sum(F.octet_length("value").cast("long") + 1)
    files = pieces.groupBy("path", "size").agg(bytes_.alias("n"), F.max(F.when(F.trim("value") != "", 1)).alias("full"))
    files = materialize(files.withColumn("file", F.xxhash64("path")), "feed-files")
    rows = pieces.select("value", F.xxhash64("path").alias("file"), "block")

    transitions = materialize(rows.mapInArrow(_transitions, _TRANSITIONS), "feed-ranges")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(earlier) % 2, F.lit(0)) == 1
    turned = transitions.withColumn("inside", inside).withColumn("turns", F.when(inside, F.col("if_inside")).otherwise(F.col("if_outside")))
    begins = turned.withColumn("depth", F.coalesce(F.sum("turns").over(earlier), F.lit(0)))
    cut = materialize(
        rows.join(F.broadcast(begins.select("file", "block", "inside", "depth")), ["file", "block"])
        .select("file", "block", "value", "inside", "depth").mapInArrow(_cut, _CUT),
        "feed-cut",
    )

    ranges = cut.filter("kind = 'range'").select("file", "block", "known", "n_early", "last_region", "lists", "roots")
    ranges = ranges.withColumn("in_data", F.coalesce(F.last("last_region", ignorenulls=True).over(earlier), F.lit(False)))
    ranges = ranges.withColumn("n", F.col("known") + F.when(F.col("in_data"), F.col("n_early")).otherwise(0))
    ranges = ranges.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    ends = turned.groupBy("file").agg(F.sum("quotes").alias("quotes"), F.sum("turns").alias("depth"))
    shapes = ranges.groupBy("file").agg(F.sum("lists").alias("lists"), F.sum(F.expr("roots div 2")).alias("roots"), F.max(F.col("roots") % 2).alias("strays"))
    # The last row had no } of its own where the sizes say so; where they say nothing (compressed) either may be.
    missing = F.when(F.col("n") == F.col("size"), F.array(F.lit(0))).when(F.col("n") == F.col("size") + 1, F.array(F.lit(-1))).otherwise(F.array(F.lit(0), F.lit(-1)))
    sound = (F.col("quotes") % 2 == 0) & F.array_contains(missing, F.col("depth").cast("int")) & (F.col("lists") > 0) & (F.col("roots") == 1) & (F.col("strays") == 0)
    judged = files.join(ends, "file", "left").join(shapes, "file", "left").withColumn("sound", F.coalesce(sound, F.lit(False)))
    judged = materialize(judged.select("file", "path", "sound"), "feed-judged")

    found = cut.filter("kind = 'element'").select("file", "block", "early", "nth", "open", "text")
    placed = found.join(F.broadcast(ranges.select("file", "block", "in_data", "first", "n_early")), ["file", "block"])
    placed = placed.filter("not early or in_data").withColumn(
        "pos", F.col("first") + F.col("nth") + F.when(~F.col("early") & F.col("in_data"), F.col("n_early")).otherwise(0)
    )
    edge = F.col("open") | (F.col("early") & (F.col("nth") == 0))
    text = F.col("text").cast("string")
    alone = placed.filter(~edge).select("file", "pos", text.alias("element"))
    parts = F.sort_array(F.collect_list(F.struct("block", text.alias("text"))))
    joined = placed.filter(edge).groupBy("file", "pos").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("element"))
    joined = joined.filter("pos > 0 or trim(element) != ''")
    found = alone.unionByName(joined).join(F.broadcast(judged.filter("sound").select("file", "path")), "file")
    blanks = " \t\r\n"
    return (
        found.select(F.col("path").alias("file"), "pos", F.trim("element", F.lit(blanks)).alias("element")),
        judged.filter("not sound").select(F.col("path").alias("file")),
    )
