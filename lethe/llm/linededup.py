"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

Each document is the sequence of its lines that are not blank. Suffixes get ranks by their
first line, then by pairs of ranks that double the compared length, until the order is final.
A class is final when it has one suffix or all its suffixes have ended; only documents with
other classes go into the next round, and only suffixes of those classes are sorted again.

Suffixes that share a class after ``h`` lines are compared form an interval of the suffix array with a common
prefix of ``h`` lines, or of all lines they have left. The first suffix of an interval, in the order of the documents, stays; each
later one marks its common prefix as a copy, the longest one of all rounds. A common prefix between two powers of two is covered by the marks of
the suffixes within it, so the union of the marks is exact: runs that overlap or touch make one maximal run, and its lines are deleted.
Runs of ``min_lines`` lines count, and with ``min_words`` a run of one line too if the line has more words than that.

Ranks come from counts: equal keys are counted before they are sorted by range, so a
line in a third of all documents is one row there. The driver sees one sum per partition.

Nulls and ties: a null text has no lines; a null ``doc_id`` comes first; rows alike in id
and text count as one document, rows alike in id alone are ordered by a hash of the text.
Blank lines are never compared and never deleted. An empty table gives no rows. Further
columns pass through ``dedup``, result columns replace their namesakes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lethe.llm.common import bounded, drop_stored, fresh, key_map, split_by_map, stored, without

MIN_LINES = 2
#: A repeated line of more words is deleted by itself, in the query and in the pipeline.
MIN_WORDS = 50
_DOC = ("doc_id", "_th")
RESULT = {"n_lines": "long", "n_deleted": "long", "n_runs": "long"}


def _text_hash():
    return F.xxhash64(F.lit(7), "text")


def _lines(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    """A row for each line that is not blank: document key, line number, line id (a, b), whether long, and its place.

    Places ``o`` are numbered in the order of the documents; a document has those from ``d`` up to ``end``, exclusive.
    """
    if min_words is None:
        long = F.lit(False)
    else:  # more words than min_words need at least so many characters
        words = F.size(F.filter(F.split("line", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
        long = F.when(F.length("line") > 2 * min_words, words > min_words).otherwise(False)
    exploded = docs.select("doc_id", _text_hash().alias("_th"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    hashed = exploded.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(
        *_DOC, "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"), long.alias("long"))
    # Repeated rows meet line by line, after each task has thrown out its own, so no row of the table is a hot key.
    once = hashed.groupBy(*_DOC, "pos").agg(F.min("a").alias("a"), F.min("b").alias("b"), F.max("long").alias("long"))
    ordered = once.repartitionByRange(*_DOC).sortWithinPartitions(*_DOC, "pos").withColumn("o", F.monotonically_increasing_id())
    document = Window.partitionBy(*_DOC)
    return ordered.withColumn("d", F.min("o").over(document)).withColumn("end", F.max("o").over(document) + 1)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        ends = before + np.cumsum(n)
        before = int(ends[-1]) if len(ends) else before
        arrays = [batch.column(k) for k in ("a", "b", "n", "first")] + [pa.array(np.full(len(n), part)), pa.array(ends - n)]
        yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "n", "first", "part", "before"])


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of each key (a, b): the size n of its class, the place of its first suffix, the number of suffixes with lesser keys. And the stored table."""
    groups = rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("o").alias("first"))
    ordered = groups.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    local = stored(bounded(ordered).mapInArrow(_running, "a long, b long, n long, first long, part long, before long"), "ranks")
    sums = local.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each partition.
    offsets = sums.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    placed = local.join(F.broadcast(offsets), "part").select("a", "b", "n", "first", (F.col("offset") + F.col("before")).alias("lesser"))
    return placed, local


def _ahead(rows: DataFrame, distance: int, further: int) -> DataFrame:
    """Look ``distance`` lines ahead: go (the document has classes that are not final), live (the suffix is in one), a and b (its next key).

    ``c`` is the rank of the suffix ``further`` lines on. Keys of suffixes that are not live match nothing and spread evenly over a join.
    """
    document = Window.partitionBy("d")
    apart = -2 - F.col("o")
    live = (F.col("n") > 1) & (F.col("end") - F.col("o") >= distance)
    looked = rows.withColumn("live", live).withColumns({
        "go": F.max("live").over(document), "then": F.lead("rank", distance).over(document.orderBy("o")),
        "c": F.lead("rank", further).over(document.orderBy("o")) if further else F.lit(None).cast("long")})
    return looked.select(
        "d", "o", "end", "n", "reach", "go", "live", F.col("rank").alias("a"),
        F.when(F.col("live"), F.coalesce("then", F.lit(-1).cast("long"))).otherwise(apart).alias("b"),
        F.when(F.col("live"), F.coalesce("c", apart)).otherwise(apart).alias("c"))


def _suffixes(docs: DataFrame, until: int | None, min_lines: int, min_words: int | None) -> tuple[DataFrame, DataFrame, int, list[DataFrame]]:
    """The lines, all suffixes (d, o, rank, reach), the length that is compared, and the tables that hold them.

    ``reach`` is the end of the longest prefix of ``min_lines`` lines or more that an earlier suffix shares, ``o`` if there is none.
    """
    lines = stored(_lines(docs, min_words), "lines")
    ranks, table = _classes(lines.select("a", "b", "o"))
    again = F.col("first") < F.col("o")
    alone = again if min_lines == 1 else again & F.col("long")
    rows = lines.join(ranks, ["a", "b"]).select(
        "d", "o", "end", F.col("lesser").alias("rank"), "n", F.when(alone, F.col("o") + 1).otherwise(F.col("o")).alias("reach"))
    h, final, tables = 1, [], [lines]
    while until is None or 2 * h <= until:
        # Lengths between two powers of two are compared by two prefixes that overlap.
        further = min_lines - h if h < min_lines < 2 * h else 0
        looked = stored(_ahead(rows, h, further), "suffixes")
        drop_stored(table)
        tables.append(looked)
        final.append(looked.where("NOT go").select("d", "o", F.col("a").alias("rank"), "reach"))
        moving = looked.where("go")
        if moving.isEmpty():
            return lines, reduce(DataFrame.unionByName, final), h, tables
        ranks, table = _classes(moving.where("live").select("a", "b", "o"))
        starts = ranks.groupBy("a").agg(F.min("lesser").alias("start"))
        refined = ranks.join(starts, "a").select("a", "b", F.col("n").alias("m"), "first", (F.col("a") + F.col("lesser") - F.col("start")).alias("rank"))
        shared = F.least(F.lit(2 * h), F.col("end") - F.col("o"))
        reach = F.when((F.col("first") < F.col("o")) & (shared >= min_lines), F.col("o") + shared)
        rows = moving.join(refined, ["a", "b"], "left")
        if further:
            whole = F.col("end") - F.col("o") >= min_lines
            earliest = moving.where(F.col("live") & whole).groupBy("a", "c").agg(F.min("o").alias("earliest"))
            rows = rows.join(earliest, ["a", "c"], "left")
            reach = F.greatest(reach, F.when(whole & (F.col("earliest") < F.col("o")), F.col("o") + min_lines))
        rows = rows.select(
            "d", "o", "end", F.coalesce("rank", "a").alias("rank"), F.coalesce("m", "n").alias("n"), F.greatest("reach", reach).alias("reach"))
        h *= 2
    last = stored(rows, "suffixes")
    drop_stored(table)
    return lines, reduce(DataFrame.unionByName, [*final, last.select("d", "o", "rank", "reach")]), h, [*tables, last]


def suffix_ranks(docs: DataFrame, *, until: int | None = None) -> tuple[DataFrame, int]:
    """Ranks (doc_id, _th, pos, rank) of all suffixes by their first h lines, and h, which ``until`` bounds; without it the final order."""
    lines, suffixes, h, _ = _suffixes(docs, until, MIN_LINES, None)
    return suffixes.join(lines.select(*_DOC, "pos", "o"), "o").select(*_DOC, "pos", "rank"), h


def deletions(docs: DataFrame, *, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """Of each document with repeated runs: its key, the line numbers to delete and the number of maximal runs."""
    lines, suffixes, _, tables = _suffixes(docs, None, min_lines, min_words)
    document = Window.partitionBy("d")
    place = document.orderBy("o")
    # Documents without copies are left out as soon as they meet.
    touched = suffixes.select("d", "o", "reach").withColumn("some", F.max(F.col("reach") > F.col("o")).over(document)).where("some")
    covered = touched.withColumn("gone", F.max("reach").over(place) > F.col("o"))
    begins = F.col("gone") & ~F.coalesce(F.lag("gone").over(place), F.lit(False))
    gone = covered.withColumn("begins", begins).where("gone").select("o", "begins")
    found = gone.join(lines.select(*_DOC, "pos", "o"), "o").groupBy(*_DOC).agg(
        F.collect_list("pos").alias("_gone"), F.sum(F.col("begins").cast("long")).alias("_runs"))
    found = stored(found, "deletions")
    drop_stored(*tables)
    return found


def dedup(docs: DataFrame, *, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``docs`` with the later copies cut out of ``text``, and n_lines, n_deleted, n_runs."""
    found = deletions(docs, min_lines=min_lines, min_words=min_words)
    docs = without(docs, *RESULT)
    th, id_, h, gone_, runs = fresh(docs, "_th", "_id", "_h", "_gone", "_runs")
    found = found.withColumnsRenamed({"doc_id": id_, "_th": h, "_gone": gone_, "_runs": runs})
    # Texts without deletions stay where they are: the map of those with some tells nearly all of them.
    held = key_map(found, F.col(h))
    perhaps, surely = split_by_map(docs.withColumn(th, _text_hash()), F.col(th), None if held is None else stored(held, "deletion-map"))
    joined = perhaps.join(found, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(th) == F.col(h)), "left").drop(th, h, id_)
    if surely is not None:
        nothing = {gone_: F.lit(None).cast("array<int>"), runs: F.lit(None).cast("long")}
        joined = joined.unionByName(surely.drop(th).withColumns(nothing))
    kept = list(docs.schema.fields)
    schema = T.StructType(kept + [T.StructField(k, T.LongType()) for k in RESULT])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column("text").to_pylist(), batch.column(gone_).to_pylist()
            counts = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(texts):
                lines = [] if text is None else text.split("\n")
                counts[0, i] = len(lines)
                if gone[i]:
                    out = set(gone[i])
                    texts[i] = "\n".join(x for k, x in enumerate(lines) if k not in out)
                    counts[1:, i] = len(out), batch.column(runs)[i].as_py()
            columns = [pa.array(texts, pa.string()) if f.name == "text" else batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, counts)], schema.fieldNames())

    return bounded(joined).mapInArrow(cut, schema)


def digests(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", *RESULT, F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
