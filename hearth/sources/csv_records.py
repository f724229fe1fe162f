"""CSV files with quoted newlines, read by many tasks a file.

A reader that starts inside a file cannot tell whether it stands inside quotes: a newline there may end a
record or belong to a field.  It can tell how the state *changes*, though: a physical line with an odd number of quotes
flips it (a doubled quote is two), whichever state it began with.  So

1. each byte range (a split of Spark's text reader) counts its quotes: one bit a range;
2. a running sum of these bits over a file's ranges says in which state each range begins (one row a range);
3. each range then puts its physical lines together to records; what a range begins with (the end of a record
   from before) and ends with (the start of one that goes on) are fragments, at most two a range, and the
   fragments of a record are joined across ranges;
4. whole records go to Spark's own ``from_csv``.

Results equal those of the ``multiLine`` reader, which takes a whole file in one task.  Lines end in ``\\n`` or ``\\r\\n``; a quote that is
never closed makes the rest of its file one record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD = "file string, at long, part string, first boolean, text string"
NAMES = ["file", "at", "part", "first", "text"]


def physical_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value file at``: lines up to ``\\n``, the file, and where the line's split of it begins; in order within a split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")
    )


def open_ranges(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Whether each byte range (file, at) begins inside quotes.  One entry for each split of the scan."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "at").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begins = ranges.select("file", "at", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("open"))
    return {(r["file"], r["at"]): r["open"] for r in begins.collect()}


def records(lines: DataFrame) -> DataFrame:
    """``file at first text`` of every record of ``physical_lines`` that is not blank, newlines inside quotes kept; ``at``: where the
    split that it starts in begins; ``first``: it is its file's first."""
    begins = lines.sparkSession.sparkContext.broadcast(open_ranges(lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None  # the range being read
        inside, head = False, False  # state at its next line; whether what is held began in an earlier range
        held: list[str] = []  # lines of the record that is not complete
        early = False  # the file's first record is still to come

        def rows(part: str, texts: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal early
            if part == "whole":
                texts = [t for t in texts if t.strip("\r")]
            if n := len(texts):
                first = [early, *[False] * (n - 1)]
                early = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array([now[0]] * n), pa.array([now[1]] * n, pa.int64()), pa.array([part] * n), pa.array(first), pa.array(texts, pa.string())], NAMES
                )

        def left() -> Iterator[pa.RecordBatch]:
            if held:
                yield from rows("middle" if head else "start", ["\n".join(held)])

        for b in batches:
            files, ats = b.column("file"), b.column("at").to_numpy()
            cut = np.flatnonzero((ats[1:] != ats[:-1]) | pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)) + 1
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
                if s == e:
                    continue
                here = (files[s].as_py(), int(ats[s]))
                if here != now:
                    yield from left()
                    now, held, early = here, [], here[1] == 0
                    inside = head = begins.value[here]
                values = b.column("value").slice(s, e - s)
                odd = pc.count_substring(values, '"').to_numpy() % 2
                after = (np.cumsum(odd) + inside) % 2 == 1  # state behind each line
                ends = np.flatnonzero(~after) + 1  # records end behind these lines
                if not len(ends):
                    held += values.to_pylist()
                    inside = bool(after[-1])
                    continue
                first = int(ends[0])
                opening = "\n".join([*held, *values.slice(0, first).to_pylist()])
                yield from rows("end" if head else "whole", [opening])
                sizes = np.diff(ends)
                whole = np.flatnonzero(sizes == 1)
                texts = [""] * len(sizes)
                single = values.take(pa.array(ends[1:][whole] - 1)).to_pylist()
                for k, t in zip(whole.tolist(), single):
                    texts[k] = t
                for k in np.flatnonzero(sizes > 1).tolist():
                    texts[k] = "\n".join(values.slice(int(ends[k]), int(sizes[k])).to_pylist())
                yield from rows("whole", texts)
                held = values.slice(int(ends[-1])).to_pylist()
                head = False
                inside = bool(after[-1])
        if now is not None:
            yield from left()

    found = lines.select("file", "at", "value").mapInArrow(run, RECORD)
    pieces = found.where("part <> 'whole'").withColumn("late", F.col("part") == "start")
    order = Window.partitionBy("file").orderBy("at", "late")
    pieces = pieces.withColumn("of", F.last(F.when(F.col("late"), F.col("at")), True).over(order))
    together = pieces.groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("at", "late", "text"))).alias("p"), F.max("first").alias("first"))
    joined = together.select("file", F.col("of").alias("at"), "first", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    return found.where("part = 'whole'").select("file", "at", "first", "text").unionByName(joined)
