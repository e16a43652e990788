"""Records of delimited files whose quoted fields hold line breaks, read in blocks rather than a file per task.

Whether a line begins a record depends on all lines before it, but only through one bit: is a quote open. So each line, and
each block of lines, is a map of that bit to itself. One pass over the files gives the map of each block, a window over the
blocks of a file the bit each block begins with, and a second pass joins the lines of each record where they lie. Only the
records that cross from one block into the next are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinlake.session import stored

_BLOCK = ["path", "start"]
_SUMMARY = "path string, start long, from_closed long, from_open long, broken boolean, content boolean, returns boolean"
#: Blocks of lines, at most some 150 bytes each, that are broadcast to the lines.
BROADCAST_BLOCKS = 200_000

_PIECE = "path string, start long, side int, first boolean, record string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, path and start: each line with the file and the place of the block it was read with."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


def _patterns(delimiter: str) -> tuple[str, str]:
    """What matches a line that ends inside quotes, if it begins outside them and if it begins inside them.

    A field is quoted if it begins with a quote. A doubled quote stands for one; behind any other quote the field goes on
    to the next delimiter without a meaning for quotes, as Spark's own reader has it.
    """
    if len(delimiter) != 1 or delimiter in '"\r\n':
        raise ValueError(f"the delimiter {delimiter!r} is not one character other than a quote or line break: read with multi_line=True")
    sep = re.escape(delimiter)
    inside = '[^"]*(?:""[^"]*)*'
    rest = f'(?:[^"{sep}][^{sep}]*)?'
    field = f'(?:"{inside}"{rest}|{rest})'
    opened = f'(?:{field}{sep})*"{inside}'
    return f"^(?:{opened})$", f'^(?:{inside}|{inside}"{rest}{sep}{opened})$'


def _moves(lines: pa.Array, delimiter: str) -> np.ndarray:
    """For each line the bit after it, if it was 0 and if it was 1, as two columns."""
    moves = np.zeros((len(lines), 2), np.int64)
    moves[:, 1] = 1
    quoting = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(quoting):
        some = lines.take(pa.array(quoting))
        for bit, pattern in enumerate(_patterns(delimiter)):
            moves[quoting, bit] = pc.match_substring_regex(some, pattern).to_numpy(zero_copy_only=False)
    return moves


def _bits_after(moves: np.ndarray, bit: int) -> np.ndarray:
    """The bit after each line of a run that begins with ``bit``."""
    places = np.arange(1, len(moves) + 1)
    settled = np.maximum.accumulate(np.where(moves[:, 0] == moves[:, 1], places, 0))  # the last line that gives one bit
    known = np.concatenate([[bit], moves[:, 0]])[settled]
    turns = np.concatenate([[0], np.cumsum(moves[:, 0] > moves[:, 1])])
    return known ^ (turns[places] - turns[settled]) & 1


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The parts of a batch that come from one block, each with its key: all columns but the line."""
    if not batch.num_rows:
        return
    keys = [batch.column(i) for i in range(1, batch.num_columns)]
    changed = np.zeros(batch.num_rows - 1, bool)
    for key in keys:
        changed |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:], strict=False):
        yield tuple(key[low].as_py() for key in keys), batch.slice(low, high - low)


def _summaries(delimiter: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines (value, path, start) to one row for each block.

    It has the map of the block, whether a line of it leaves a quote open if it begins closed, whether a line is not empty,
    and whether the first one ends with a carriage return.
    """
    names = [f.split()[0] for f in _SUMMARY.split(", ")]

    def row(*values: object) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, values, strict=True))])

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bits, broken, content, returns = None, (0, 1), False, False, False
        for batch in batches:
            for own, run in _runs(batch):
                if own != key:
                    if key is not None:
                        yield row(*key, *bits, broken, content, returns)
                    key, bits, broken, content = own, (0, 1), False, False
                    returns = run.column(0)[0].as_py().endswith("\r")
                lines = run.column(0)
                moves = _moves(lines, delimiter)
                closed, opened = (_bits_after(moves, bit) for bit in bits)
                bits, broken = (int(closed[-1]), int(opened[-1])), broken or bool(closed.any())
                content = content or pc.any(pc.not_equal(pc.utf8_rtrim(lines, "\r"), "")).as_py()
        if key is not None:
            yield row(*key, *bits, broken, content, returns)

    return summed


def _blocks(lines: DataFrame, delimiter: str) -> DataFrame:
    """The states of every block, stored.

    path, start, bit, bit_after, broken, heads (does the file's first record begin here), ends (is it the last) and returns (do the file's lines
    end with a carriage return; its first line tells, as for Spark's own reader).
    """
    each = lines.select("value", *_BLOCK).mapInArrow(_summaries(delimiter), _SUMMARY)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    turned = each.withColumn("turns", F.sum(F.when(F.expr("from_closed > from_open"), 1).otherwise(0)).over(here))
    settled = F.when(F.expr("from_closed = from_open"), F.struct("from_closed", "turns"))
    known = turned.withColumn("last", F.last(settled, ignorenulls=True).over(before)).withColumn("past", F.max("turns").over(before))
    bit = F.expr("coalesce(last.from_closed, 0) ^ ((coalesce(past, 0) - coalesce(last.turns, 0)) & 1)")
    first = F.min(F.when(F.col("content"), F.col("start"))).over(Window.partitionBy("path"))
    returns = F.first("returns").over(here).alias("returns")
    ends = F.lead("start").over(Window.partitionBy("path").orderBy("start")).isNull().alias("ends")
    found = known.withColumn("first", first).withColumn("bit", bit).withColumn("bit_after", F.expr("if(bit = 0, from_closed, from_open)"))
    return stored(found.select(*_BLOCK, "bit", "bit_after", "broken", F.expr("start <=> first").alias("heads"), ends, returns), "csv-states")


def _records(delimiter: str, crossing: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines (value, path, start, bit, heads) to records.

    The records that lie in one block, with side 0; or, ``crossing``, the pieces of the others: what ends or goes on with
    a record of an earlier block (side 1) and what begins one that a later block ends (side 2). ``first`` marks the first
    record of a file that is not empty.
    """

    def table(key: tuple, side: int, texts: pa.Array, first: list[bool] | np.ndarray) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.array([key[0]] * n, pa.string()), pa.array(np.full(n, key[1])), pa.array(np.full(n, side, np.int32))]
        names = [f.split()[0] for f in _PIECE.split(", ")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(first, pa.bool_()), texts.cast(pa.string())], names)

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bit, side, held, waiting = None, 0, 0, [], False

        def whole(texts: pa.Array) -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            full = pc.not_equal(pc.utf8_rtrim(texts, "\r"), "").to_numpy(zero_copy_only=False)
            first = np.zeros(len(texts), bool)
            if waiting and full.any():
                first[full.argmax()], waiting = True, False
            if not crossing and full.any():
                yield table(key, 0, texts.filter(pa.array(full)), first[full])

        def finished() -> Iterator[pa.RecordBatch]:
            """What is held at the end of a block, where a record is open or the block lies within one."""
            nonlocal waiting
            if held and (side == 1 or bit == 1):
                if crossing:
                    yield table(key, side or 2, pa.array(["\n".join(held)]), [waiting and side == 0])
            elif held:
                yield from whole(pa.array(["\n".join(held)]))

        for batch in batches:
            for own, run in _runs(batch):
                if own != key:
                    if key is not None:
                        yield from finished()
                    key, bit, held = own, own[2], []
                    side, waiting = (1 if bit else 0), own[3]
                lines = run.column(0)
                after = _bits_after(_moves(lines, delimiter), bit)
                begins = np.flatnonzero(np.concatenate([[bit], after[:-1]]) == 0)
                bit = int(after[-1])
                if not len(begins):
                    held.extend(lines.to_pylist())
                    continue
                held.extend(lines[: begins[0]].to_pylist())
                if held:
                    if side == 0:
                        yield from whole(pa.array(["\n".join(held)]))
                    elif crossing:
                        yield table(key, 1, pa.array(["\n".join(held)]), [False])
                side, held = 0, lines[begins[-1] :].to_pylist()
                if len(begins) > 1:
                    ends = pa.array(begins - begins[0], pa.int32())
                    lists = pa.ListArray.from_arrays(ends, lines[begins[0] : begins[-1]])
                    yield from whole(pc.binary_join(lists, "\n"))
        if key is not None:
            yield from finished()

    return joined


def has_quotes(spark: SparkSession, path: str | list[str]) -> bool:
    return bool(_lines(spark, path).select("value").filter(F.col("value").contains('"')).head(1))


def _placed(lines: DataFrame, blocks: DataFrame, how: str, broadcast: bool) -> DataFrame:
    """Lines with the columns of their block, the lines of a block together and in order."""
    if broadcast:
        return lines.join(F.broadcast(blocks), _BLOCK, how)
    numbered = lines.withColumn("line", F.monotonically_increasing_id())
    return numbered.join(blocks, _BLOCK, how).sortWithinPartitions(*_BLOCK, "line")


def broken_records(
    spark: SparkSession, path: str | list[str], delimiter: str, broadcast_blocks: int = BROADCAST_BLOCKS
) -> DataFrame | None:
    """Column ``record``: the text of every record but the first of each file, if any record holds a line break; or None.

    Records without any character are left out. A quote that a file leaves open is an error, as everything behind it would
    be one field. Lines end with ``\\n``, or with ``\\r\\n`` where a file's first one does, which within fields becomes ``\\n``,
    as for Spark's own reader; a ``\\r`` elsewhere is text. The table of blocks (some 150 bytes for each 128 MB, by Spark's
    settings) is broadcast up to ``broadcast_blocks`` rows; beyond that lines are shuffled to it by block.
    """
    _patterns(delimiter)
    lines = _lines(spark, path)
    blocks = _blocks(lines, delimiter)
    state = blocks.agg(
        F.count(F.lit(1)).alias("blocks"),
        F.bool_or(F.expr("broken or bit = 1")).alias("broken"),
        F.bool_or(F.expr("bit = 1 or bit_after = 1")).alias("across"),
        F.min(F.expr("if(ends and bit_after = 1, path, null)")).alias("unclosed"),
    ).first()
    if state.unclosed:
        raise ValueError(f"{state.unclosed} ends inside quotes: a quote of it is never closed")
    if not state.broken:
        return None
    broadcast = state.blocks <= broadcast_blocks
    known = F.coalesce("bit", F.raise_error(F.lit("a file changed while it was read")).cast("long"))
    line = F.when(F.col("returns"), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value")).alias("value")
    placed = _placed(lines, blocks, "left", broadcast).select(line, *_BLOCK, known.alias("bit"), "heads")
    found = placed.mapInArrow(_records(delimiter, crossing=False), _PIECE).filter("not first").select("record")
    if state.across:
        across = blocks.filter("bit = 1 or bit_after = 1")
        some = _placed(lines, across, "inner", broadcast).select(line, *_BLOCK, "bit", "heads")
        pieces = some.mapInArrow(_records(delimiter, crossing=True), _PIECE)
        in_file = Window.partitionBy("path").orderBy("start", "side")
        numbered = pieces.withColumn("number", F.count_if(F.col("side") == 2).over(in_file))
        parts = F.array_sort(F.collect_list(F.struct("start", "side", "record")))
        again = numbered.groupBy("path", "number").agg(parts.alias("parts"), F.bool_or("first").alias("first"))
        found = found.unionByName(again.filter("not first").select(F.expr("array_join(parts.record, '\\n') as record")))
    return found.filter("record != ''")
