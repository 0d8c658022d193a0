"""Quoted CSV in parallel: one large file is read by many tasks, also if fields hold line breaks.

A line can only be understood once it is known whether it begins inside a quoted field.
A first pass reads every split of the file on its own and says, for both possible beginnings,
how the split ends and which records begin in it. Chaining these answers along a file - a
few numbers per split - gives every split its true beginning. A second pass then puts the
lines of each split together; the few records that run over the end of a split are fetched
by line number and joined. Fields are split by Spark's own CSV parser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import materialize, small_batches

CUT = ["_file", "_start"]
PARSER = {"escape": '"', "multiLine": "true"}

_SIDES = [f"{name}_{side}" for side in ("out", "in") for name in ("ends", "begun", "lead", "last")]
SUMMARY = "_file string, _start long, first long, header string, " + ", ".join(f"{c} long" for c in _SIDES)
CHAIN = (
    "_file string, _start long, first long, header string, inside boolean, lead long, "
    "owner_start long, owner_pos long, before long, records long, tail long"
)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line, given whether one is at its start.

    A quote opens a field only as its first character. After the closing quote everything up
    to the next comma belongs to the field.
    """
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('""', at):
                at = line.find('"', at + 2)
            if at < 0:
                return True
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at) + 1
        if not at:
            return False
        inside = False


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Pieces of the batches that lie in one split each, in order."""
    for batch in batches:
        if not len(batch):
            continue
        file = batch.column("_file").dictionary_encode()
        key = np.stack([file.indices.to_numpy(), batch.column("_start").to_numpy()])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            yield (batch.column("_file")[a].as_py(), batch.column("_start")[a].as_py()), batch.slice(a, b - a)


def _states(lines: pa.Array, inside: bool) -> tuple[np.ndarray, bool]:
    """For each line whether it begins inside a quoted field, and so for the line after the last."""
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    out, done = np.empty(len(lines), bool), 0
    for i, line in zip(quoted.tolist(), lines.take(pa.array(quoted)).to_pylist()):
        out[done : i + 1] = inside
        inside, done = ends_inside(line, inside), i + 1
    out[done:] = inside
    return out, inside


def _begins(lines: pa.Array, inside: np.ndarray) -> np.ndarray:
    """Lines on which a record begins; blank lines between records are none."""
    full = pc.and_(pc.not_equal(lines, ""), pc.not_equal(lines, "\r"))
    return ~inside & full.to_numpy(zero_copy_only=False)


class _Side:
    """What a split looks like if it begins outside (or inside) a quoted field."""

    def __init__(self, inside: bool):
        self.inside, self.lines, self.begun, self.lead, self.last = inside, 0, 0, -1, -1
        self.first: list[str] = []  # lines of the first record that begins here

    def add(self, lines: pa.Array) -> None:
        states, self.inside = _states(lines, self.inside)
        flags = _begins(lines, states)
        begins, outside = np.flatnonzero(flags), np.flatnonzero(~states)
        if self.begun < 2:
            record = self.begun + np.cumsum(flags) == 1
            self.first += lines.filter(pa.array(record & (flags | states))).to_pylist()
        if self.lead < 0 and len(outside):
            self.lead = self.lines + int(outside[0])
        if len(begins):
            self.last = self.lines + int(begins[-1])
        self.begun += len(begins)
        self.lines += len(lines)

    def values(self) -> list[int]:
        return [int(self.inside), self.begun, self.lead if self.lead >= 0 else self.lines, self.last]


def _summary(lines: DataFrame) -> DataFrame:
    """A row for each split, with both answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides, first = None, (), 0

        def row() -> pa.RecordBatch:
            whole = sides[0]
            header = "\n".join(whole.first) if now[1] == 0 else None
            if header is not None and whole.begun == 1 and whole.inside:
                raise ValueError(f"the header of {now[0]} does not end in its first split")
            values = [*sides[0].values(), *sides[1].values()]
            columns = [pa.array([now[0]]), pa.array([now[1]]), pa.array([first]), pa.array([header], pa.string())]
            return pa.RecordBatch.from_arrays(
                [*columns, *(pa.array([v]) for v in values)], names=[*CUT, "first", "header", *_SIDES]
            )

        for split, piece in _runs(batches):
            if split != now:
                if now:
                    yield row()
                now, sides, first = split, (_Side(False), _Side(True)), piece.column("_id")[0].as_py()
            for side in sides:
                side.add(piece.column("value"))
        if now:
            yield row()

    return lines.mapInArrow(run, SUMMARY)


def _chain(summary: DataFrame) -> DataFrame:
    """Every split's true beginning, its first and last partial record, and records before it.

    ``lead`` lines of a split continue the record ``owner_pos`` that began in the split
    ``owner_start``; from line ``tail`` on its last record runs over its end (-1: none does).
    """

    def run(splits: pa.Table) -> pa.Table:
        inside, owner, before, out = 0, (-1, -1), 0, []
        for s in sorted(splits.to_pylist(), key=lambda r: r["_start"]):
            ends, begun, lead, last = (s[f"{n}_{'in' if inside else 'out'}"] for n in ("ends", "begun", "lead", "last"))
            row = {c: s[c] for c in ("_file", "_start", "first", "header")}
            row |= {"inside": bool(inside), "lead": lead if inside else 0}
            row |= {"owner_start": owner[0], "owner_pos": owner[1], "before": before, "records": begun}
            if begun:
                owner = (s["_start"], begun - 1)
            row |= {"tail": last if ends and begun else -1}
            out.append(row)
            inside, before = ends, before + begun
        kinds = {"_file": pa.string(), "inside": pa.bool_(), "header": pa.string()}
        names = [c.split()[0] for c in CHAIN.split(", ")]
        return pa.Table.from_pylist(out, pa.schema([(c, kinds.get(c, pa.int64())) for c in names]))

    return summary.groupBy("_file").applyInArrow(run, CHAIN)


def _records(lines: DataFrame) -> DataFrame:
    """``record, _file, _start, _pos`` of all records that begin and end in one split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, pos, held = None, False, 0, []

        def table(values: pa.Array, first: int) -> pa.RecordBatch:
            n = len(values)
            columns = [values, pa.repeat(pa.scalar(now[0]), n), pa.repeat(pa.scalar(now[1], pa.int64()), n)]
            at = pa.array(np.arange(first, first + n))
            return pa.RecordBatch.from_arrays([*columns, at], names=["record", *CUT, "_pos"])

        for split, piece in _runs(batches):
            if split != now:
                # What is held at the end of a split runs on, unless no quote is open.
                if held and not inside:
                    yield table(pa.array(["\n".join(held)], pa.string()), pos - 1)
                now, inside, pos, held = split, piece.column("inside")[0].as_py(), 0, []
            values = piece.column("value")
            states, inside = _states(values, inside)
            begins = np.flatnonzero(_begins(values, states))
            cuts = np.append(begins, len(values))
            inner = np.flatnonzero(states)
            # Lines that continue a record begun before this piece.
            early = inner[: np.searchsorted(inner, cuts[0])]
            if held:
                held += values.take(pa.array(early)).to_pylist()
            if not len(begins):
                continue
            if held:
                yield table(pa.array(["\n".join(held)], pa.string()), pos - 1)
            # Records of one line are taken as they are, the others are put together.
            size = np.searchsorted(inner, cuts[1:]) - np.searchsorted(inner, cuts[:-1]) + 1
            held = values.take(pa.array(np.append(begins[-1], inner[np.searchsorted(inner, begins[-1]) :]))).to_pylist()
            done = values.take(pa.array(begins[:-1]))
            long = np.flatnonzero(size[:-1] > 1)
            if len(long):
                whole = done.to_pylist()
                for i in long.tolist():
                    more = inner[np.searchsorted(inner, cuts[i]) : np.searchsorted(inner, cuts[i + 1])]
                    whole[i] = "\n".join([whole[i], *values.take(pa.array(more)).to_pylist()])
                done = pa.array(whole, pa.string())
            yield table(done.cast(pa.string()), pos)
            pos += len(begins)
        if held and not inside:
            yield table(pa.array(["\n".join(held)], pa.string()), pos - 1)

    return lines.mapInArrow(run, "record string, _file string, _start long, _pos long")


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """All records of CSV files, and the first record of each file.

    Records are ``record, _file, _start, _pos, row_index``: ``_start`` is where the split
    begins in which the record begins, ``_pos`` counts the split's records, and ``row_index``
    all rows after the headers, files in path order. Headers are ``_file, header``; they are
    no records.

    The text is UTF-8. Lines end with a line feed; one carriage return before it is left out
    at the end of a record and kept inside a field. Blank lines between records are skipped.
    A field that is never closed runs to the end of its file.
    """
    small_batches(spark)
    # The line feed is named, or a carriage return inside a field would end a line.
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    chain = materialize(_chain(_summary(lines)), "csv-splits")
    files = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    totals = chain.groupBy("_file").agg((F.sum("records") - 1).alias("rows"))
    earlier = totals.select("_file", F.coalesce(F.sum("rows").over(files), F.lit(0)).alias("earlier"))
    # One row for each split: the driver holds that list anyway to plan the scan.
    known = F.broadcast(chain.drop("header").join(earlier, "_file"))
    placed = lines.join(known, CUT)
    whole = _records(placed.select("value", *CUT, "inside"))
    # The pieces of records that run over the end of a split, by line number.
    at = F.col("_id") - F.col("first")
    lead, tail = at < F.col("lead"), (F.col("tail") >= 0) & (at >= F.col("tail"))
    piece = F.struct(F.col("_start").alias("at"), "_id", "value")
    pieces = placed.where(lead | tail).select(
        "_file",
        F.when(lead, F.col("owner_start")).otherwise(F.col("_start")).alias("_start"),
        F.when(lead, F.col("owner_pos")).otherwise(F.col("records") - 1).alias("_pos"),
        piece.alias("piece"),
    )
    joined = pieces.groupBy(*CUT, "_pos").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("record")
    records = whole.unionByName(joined.select(text, *CUT, "_pos"))
    number = F.col("earlier") + F.col("before") + F.col("_pos") - 1
    records = records.join(F.broadcast(known.select(*CUT, "before", "earlier")), CUT)
    records = records.where(F.col("before") + F.col("_pos") > 0).select(
        _trimmed(F.col("record")).alias("record"), *CUT, "_pos", number.alias("row_index")
    )
    headers = chain.where("header is not null").select("_file", _trimmed(F.col("header")).alias("header"))
    return records, headers


def _trimmed(record: Column) -> Column:
    return F.regexp_replace(record, r"\r\z", "")


def read_named(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``columns`` as strings, found by the names in each file's header, and the rows' places.

    A column that a file does not have is NULL. See :func:`read_records` for the places.
    """
    records, headers = read_records(spark, path)
    widest = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    schema = ", ".join(f"c{i} string" for i in range(widest))

    def fields(record: Column) -> Column:
        parsed = F.from_csv(record, schema, PARSER)
        return F.array(*[parsed[f"c{i}"] for i in range(widest)])

    # One row for each file.
    names = F.broadcast(headers.select("_file", fields(F.col("header")).alias("_names")))
    rows = records.join(names, "_file").withColumn("_fields", fields(F.col("record")))
    found = [F.get("_fields", F.array_position("_names", c).cast("int") - 1).alias(c) for c in columns]
    return rows.select(*found, *CUT, "_pos", "row_index")
