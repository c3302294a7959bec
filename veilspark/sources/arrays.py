"""JSON arrays of objects read by many tasks.

``[{...}, {...}, ...]`` has no line ends that Spark could cut at, so its own
reader takes such a file whole in one task.  Here the file is read as text cut
at every ``}``, which Spark does by byte ranges, and what a piece of text means
is found from the state it begins in:

1. each byte range maps each of the lexer's three states at its begin (plain,
   in a string, after a backslash in a string) to the state at its end and
   the change of depth: one small row per range;
2. those maps compose, so a pass over a file's rows, in order, gives the state
   and depth that each range begins with;
3. each range, now knowing these, cuts itself into elements; an element that
   crosses ranges is put together from its parts.

No task holds more than a range's piece and one element.  A file whose top
level is no array, an array that isn't closed, and an entry that is no object
fail the job.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspark.session import materialize

PLAIN, STRING, ESCAPE = 0, 1, 2
#: Ranges of the input whose table is broadcast (about 100 bytes each).
FEW_RANGES = 100_000

_STRING = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
_REST = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+', re.S)
_BEGIN = re.compile(r"\ufeff?[ \t\r\n]*\[")
_BETWEEN = re.compile(r"[ \t\r\n]*(,?)[ \t\r\n]*")
_END = re.compile(r"[ \t\r\n]*\][ \t\r\n]*")


def step(state: int, text: str) -> tuple[int, int]:
    """(state, change of depth) after ``text`` that begins in ``state``."""
    if state == ESCAPE:
        if not text:
            return ESCAPE, 0
        text, state = text[1:], STRING
    if state == STRING:
        end = _REST.match(text).end()
        if end == len(text):
            return STRING, 0
        if text[end] == "\\":  # the last character
            return ESCAPE, 0
        text = text[end + 1 :]
    bare = _STRING.sub("", text)
    open_ = bare.find('"')
    if open_ >= 0:
        rest, bare = bare[open_ + 1 :], bare[:open_]
        state = STRING if _REST.match(rest).end() == len(rest) else ESCAPE
    else:
        state = PLAIN
    return state, bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")


def _runs(batches):
    """(file, block, text, last of its run) of every piece; a run is the pieces of one byte range."""
    held = None
    for batch in batches:
        for file, block, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if held:
                yield *held, held[:2] != (file, block)
            held = file, block, text
    if held:
        yield *held, True


_MAPS = "file string, block long, pieces long, s0 int, d0 long, s1 int, d1 long, s2 int, d2 long"
_ENTRY = "file string, block long, state int, depth long, pieces long"


def _maps(batches):
    """The map of each run, without the ``}`` that its last piece may end with."""
    now, pieces, rows = None, 0, []
    for file, block, text, last in _runs(batches):
        now = now or [(s, 0) for s in (PLAIN, STRING, ESCAPE)]
        piece = text if last else text + "}"
        known = {s: step(s, piece) for s in {s for s, _ in now}}
        now = [(known[s][0], d + known[s][1]) for s, d in now]
        pieces += 1
        if last:
            rows.append((file, block, pieces, *[x for pair in now for x in pair]))
            now, pieces = None, 0
    yield pa.RecordBatch.from_pylist([dict(zip([c.split()[0] for c in _MAPS.split(", ")], r, strict=True)) for r in rows], schema=_MAPS_ARROW)


_MAPS_ARROW = pa.schema([("file", pa.string()), ("block", pa.int64()), ("pieces", pa.int64()), ("s0", pa.int32()), ("d0", pa.int64()),
                         ("s1", pa.int32()), ("d1", pa.int64()), ("s2", pa.int32()), ("d2", pa.int64())])


def _compose(table: pa.Table) -> pa.Table:
    """The state and depth that each range of one file begins with, from the maps of those before it; ``pieces`` for its last range."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    state, depth, out = PLAIN, 0, []
    for i, r in enumerate(rows):
        final = i + 1 == len(rows)
        out.append({"file": r["file"], "block": r["block"], "state": state, "depth": depth, "pieces": r["pieces"] if final else None})
        state, depth = r[f"s{state}"], depth + r[f"d{state}"]
        if not final:
            state, change = step(state, "}")
            depth += change
    if (state, depth) != (PLAIN, 0):
        raise ValueError(f"{rows[0]['file']}: the JSON array is not closed")
    return pa.Table.from_pylist(out, schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("state", pa.int32()),
                                                       ("depth", pa.int64()), ("pieces", pa.int64())]))


def _element(text: str, first: bool) -> str:
    """An element's text without what separates it from the one before."""
    gap = _BETWEEN.match(text)
    if text[gap.end() : gap.end() + 1] != "{" or bool(gap[1]) == first:
        raise ValueError("entries of the JSON array must be objects, separated by commas")
    return text[gap.end() :]


_PARTS = "file string, block long, place long, text string, begins boolean, ends boolean"


def _elements(batches):
    """Elements and parts of elements of each range: text, and whether it has the element's begin and its end."""
    names = [c.split()[0] for c in _PARTS.split(", ")]
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("text", pa.string()),
                        ("begins", pa.bool_()), ("ends", pa.bool_())])
    current, held, rows = None, [], []
    first = begins = False
    state = depth = place = seen = 0

    def part(ends: bool) -> None:
        nonlocal held, place, begins, first
        text = "".join(held)
        rows.append((*current, place, _element(text, first) if begins else text, begins, ends))
        held, place, begins, first = [], place + 1, True, False

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for file, block, text, s, d, pieces in zip(*columns, strict=True):
            if current != (file, block):
                if held:
                    part(False)
                current, state, depth, place, held, seen = (file, block), s, d, 0, [], 0
                first, begins = d == 0, d <= 1
                if d == 0:
                    begin = _BEGIN.match(text)
                    if not begin:
                        raise ValueError(f"{file}: the top level must be a JSON array")
                    text, depth = text[begin.end() :], 1
            seen += 1
            last = seen == pieces  # of the file: no ``}`` follows
            state, change = step(state, text if last else text + "}")
            depth += change
            held.append(text if last else text + "}")
            if last:
                if not _END.fullmatch("".join(held)):
                    raise ValueError(f"{file}: only white space may follow the JSON array's last object but its end")
                held = []
            elif (state, depth) == (PLAIN, 1):
                part(True)
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)
            rows = []
    if held:
        part(False)
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, text): the text of every object of the JSON arrays at ``path``; (block, place) is its order in the file.

    Byte ranges follow ``spark.sql.files.maxPartitionBytes``.  The text is read
    twice, once for the maps and once for the elements.  An empty file is no array.
    """
    raw = spark.read.option("lineSep", "}").text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    maps = materialize(pieces.mapInArrow(_maps, _MAPS), "array-ranges")
    entry = materialize(maps.groupBy("file").applyInArrow(_compose, _ENTRY), "array-entries")  # one small row per range
    ranges = maps.count()
    if ranges <= FEW_RANGES:
        joined = pieces.join(F.broadcast(entry), ["file", "block"])
    else:  # rows of a range are read in order, by one task
        joined = pieces.withColumn("at", F.monotonically_increasing_id()).join(entry, ["file", "block"])
        joined = joined.repartition("file", "block").sortWithinPartitions("file", "block", "at")
    joined = joined.select("file", "block", "value", "state", "depth", "pieces")
    parts = materialize(joined.mapInArrow(_elements, _PARTS), "array-elements")
    whole = parts.filter("begins AND ends").select("file", "block", "place", "text")
    crossing = parts.filter("NOT (begins AND ends)")  # at most two for each range
    order = Window.partitionBy("file").orderBy("block", "place")
    crossing = crossing.withColumn("element", F.sum(F.col("begins").cast("long")).over(order))
    parts_of = F.sort_array(F.collect_list(F.struct("block", "place", "text")))
    crossing = crossing.groupBy("file", "element").agg(parts_of.alias("parts"))
    crossing = crossing.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["place"].alias("place"),
                               F.array_join("parts.text", "").alias("text"))
    return whole.unionByName(crossing)
