"""Delimited files whose quoted values hold line breaks, read by many tasks.

A line break ends a record if the quotes before it in the file are even in number. So the quotes of every split
are counted first (one small row per split), and summed up along each file: then every split knows whether it
begins within a value. In a second pass each task cuts its lines into records at true ends. What a split holds
of a record that began earlier, or that ends later, is a piece; pieces, at most two a split, are put together
by file. Nothing but them is shuffled.

The encoding of each file is found in the first pass too, and records are decoded by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortbench.sources.delimited import LATIN1, UTF8
from cohortbench.sources.headers import clean_columns, clean_name

_CSV = {"escape": '"', "multiLine": "true"}


class UnbalancedQuotes(ValueError):
    """The quotes of a file are odd in number, so that its last record never ends."""


#: Names that the reader gives to columns without one, or to the later ones of equal names.
_AROUND = r"(?U)^\s+|\s+$"
_UNNAMED = re.compile(r"_c\d+|.*\d+")


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Bytes of each line with its file and split, in the order of the file within a split."""
    text = spark.read.option("lineSep", "\n").text(paths)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    return text.select(F.col("value").cast("binary").alias("line"), "value", *place)


def split_states(lines: DataFrame) -> DataFrame:
    """Of each split: the quotes before it in its file, its own, whether its bytes are UTF-8, and how its first line ends."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    own = lines.withColumn("place", F.monotonically_increasing_id()).groupBy("file", "start").agg(
        F.sum(quotes.cast("long")).alias("quotes"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.min_by(F.endswith("value", F.lit("\r")), "place").alias("returns"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return own.select("*", F.xxhash64("file").alias("number"), F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before"))


_PIECES = "file long, start long, kind string, record binary"


def _cutter(inside: dict[tuple[int, int], bool]):
    """Cuts the lines of splits into whole records, and the pieces at the ends of a split.

    Kinds: whole, or first for a file's header; head, middle and tail of records that lie in several
    splits, or opening for the tail that holds the header.
    """
    shape = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("kind", pa.string()), ("record", pa.binary())])

    def out(key: tuple[int, int], kind: str, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])),
                                           pa.array([kind] * n, pa.string()), records], schema=shape)

    def one(key: tuple[int, int], kind: str, record: bytes) -> pa.RecordBatch:
        return out(key, kind, pa.array([record], pa.binary()))

    def whole(lines: pa.Array, ends: np.ndarray) -> pa.Array:
        """The records that end with these lines, put together all at once; empty ones are left out."""
        offsets = np.concatenate([[0], ends + 1]).astype(np.int32)
        records = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), b"\n")
        # The carriage return of a line's own end is no part of the record.
        if pc.any(pc.ends_with(records, b"\r")).as_py():
            records = pa.array([r.removesuffix(b"\r") for r in records.to_pylist()], pa.binary())
        return records.filter(pc.greater(pc.binary_length(records), 0))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_, odd, head, first = None, [], 0, False, True

        def left() -> pa.RecordBatch:
            # A split that lies within one value as a whole is a middle piece.
            return one(key, "middle" if head else "opening" if first else "tail", b"\n".join(open_))

        for batch in batches:
            # Runs of lines of one split.
            starts, files = batch.column("start").to_numpy(), batch.column("file").to_numpy()
            cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)], strict=True):
                if a == b:
                    continue
                now = (int(files[a]), int(starts[a]))
                if now != key:
                    if open_:
                        yield left()
                    key, open_, first = now, [], now[1] == 0
                    odd = int(inside[now])
                    head = bool(odd)
                lines = batch.column("line").slice(a, b - a)
                after = (odd + np.cumsum(pc.count_substring(lines, '"').to_numpy())) % 2
                odd = int(after[-1])
                ends = np.flatnonzero(after == 0)
                at = 0
                # The record that is open, and a file's first one, by themselves.
                while len(ends) and (open_ or head or first):
                    end = int(ends[0])
                    record = b"\n".join([*open_, *lines.slice(at, end + 1 - at).to_pylist()]).removesuffix(b"\r")
                    if record or head:
                        yield one(key, "head" if head else "first" if first else "whole", record)
                        first = False
                    open_, head, at, ends = [], False, end + 1, ends[1:]
                if len(ends):
                    yield out(key, "whole", whole(lines.slice(at, int(ends[-1]) + 1 - at), ends - at))
                    at = int(ends[-1]) + 1
                open_ += lines.slice(at).to_pylist()
        if open_:
            yield left()

    return cut


def _joined(pieces: DataFrame) -> DataFrame:
    """Records put together from a tail, the middles and the head that follow it in the file."""
    begins = F.col("kind").isin("tail", "opening")
    along = Window.partitionBy("file").orderBy("start", begins)
    numbered = pieces.withColumn("number", F.sum(begins.cast("int")).over(along))
    parts = F.array_sort(F.collect_list(F.struct("start", (~begins).alias("later"), "record", "kind")))
    records = numbered.groupBy("file", "number").agg(parts.alias("parts"))
    return records.select(
        "file", F.when(F.element_at("parts", 1)["kind"] == "opening", "first").otherwise("whole").alias("kind"),
        F.aggregate(F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), F.element_at("parts", 1)["record"],
                    lambda s, p: F.concat(s, F.encode(F.lit("\n"), "UTF-8"), p["record"])).alias("record"))


def raw_records(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, dict[int, str], set[int]]:
    """file (a hash of its path), kind ("first" for a file's header) and bytes of every record.

    Beside them the encoding of each file, and the files whose first line ends with a carriage return
    and a line feed. To the driver comes a row per split of the files.
    """
    lines = _lines(spark, paths)
    totals: dict[str, int] = {}
    known: dict[int, str] = {}
    returns: set[int] = set()
    inside: dict[tuple[int, int], bool] = {}
    paths_of: dict[int, str] = {}
    for s in split_states(lines).collect():
        if paths_of.setdefault(s.number, s.file) != s.file:
            raise AssertionError(f"{s.file} and {paths_of[s.number]} have one hash")
        totals[s.file] = totals.get(s.file, 0) + s.quotes
        known[s.number] = known.get(s.number, UTF8) if s.utf8 else LATIN1
        inside[s.number, s.start] = bool(s.before % 2)
        if s.returns and not s.start:
            returns.add(s.number)
    odd = sorted(f for f, n in totals.items() if n % 2)
    if odd:
        raise UnbalancedQuotes(f"quotes are odd in number: {', '.join(odd[:5])}")
    cut = lines.select("line", F.xxhash64("file").alias("file"), "start").mapInArrow(_cutter(inside), _PIECES)
    split = F.col("kind").isin("head", "middle", "tail", "opening")
    records = cut.where(~split).select("file", "kind", "record").unionByName(_joined(cut.where(split)))
    return records, known, returns


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Header row read, names cleaned, every value still text, like the reading of each file by one task.

    A quote stands only around a value, and doubled within one, as writers of such files put them. Lines end with
    a line feed, or a carriage return and a line feed. Breaks within values stay as they are; in a file whose first
    line ends with both, both are read as a line feed there too. Empty lines between records are skipped. Files read together must share a header; one that differs stops the job. A file whose
    quotes are odd in number is an error. Files are UTF-8 if all their bytes are, else latin-1, each for itself.
    """
    records, known, returns = raw_records(spark, paths)
    header = spark.read.options(header=True, **_CSV)
    names = header.option("encoding", next(iter(known.values()), UTF8)).csv(paths).columns
    latin = sorted(f for f, e in known.items() if e == LATIN1)
    text = F.col("record").cast("string")
    if latin and len(latin) == len(known):
        text = F.decode("record", LATIN1)
    elif latin:
        text = F.when(F.col("file").isin(latin), F.decode("record", LATIN1)).otherwise(text)
    if returns:
        text = F.when(F.col("file").isin(sorted(returns)), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    # One column more than there are, to see a header that is too long.
    fields = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    cells = records.select("kind", F.from_csv(text, fields, _CSV).alias("r"))
    shown = [F.coalesce(F.upper(F.regexp_replace(F.col("r")[f"c{i}"], _AROUND, "")), F.lit("")) for i in range(len(names))]
    wanted = [F.lit(clean_name(n)) for n in names]
    same = F.col("r")[f"c{len(names)}"].isNull()
    for found, want, name in zip(shown, wanted, names, strict=True):
        if not _UNNAMED.fullmatch(name):
            same = same & (found == want)
    stop = F.raise_error(F.lit("files read together begin with different headers")).cast("boolean")
    body = cells.where(F.when(F.col("kind") == "first", F.when(same, F.lit(False)).otherwise(stop)).otherwise(F.lit(True)))
    return clean_columns(body.select(*[F.col("r")[f"c{i}"].alias(n) for i, n in enumerate(names)]))
