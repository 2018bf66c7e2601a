"""Line dedup: range-partitioned hashes, first occurrences streamed in order, compressed keep bitmaps per document.

Column expressions only.  A line travels as two hashes and its place; texts stay
where they are until :func:`apply` reads the bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._work import Work

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = 64  # lines in one word of a bitmap
SAMPLE_ROWS = 500_000  # lines read to find hot keys
HOT_SHARE = 1 / 5000  # a key with this share of the sample is hot, so at most 5,000 keys are


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    # ``lower`` changes letters outside A-Z too, so it serves pure ASCII only
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2): the place and 128-bit hash of every line long enough to count."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    lines = rows.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = line_key(F.col("line"))
    return lines.where(F.length(F.btrim("line", F.lit(BLANKS))) >= min_chars).select(
        "doc_id", "text_hash", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def _hot_keys(lines: DataFrame, sample_rows: int, hot_share: float) -> DataFrame:
    """Keys that hold ``hot_share`` of a sample or more, which bounds their number by 1 / ``hot_share``."""
    every = max(1, lines.count() // sample_rows)
    sample = lines.where(F.pmod(F.xxhash64("doc_id", "text_hash", "pos"), F.lit(every)) == 0)
    least = max(2, int(hot_share * sample.count()))
    return sample.groupBy("h1", "h2").count().where(F.col("count") >= least).select("h1", "h2")


def keep_bitmaps(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text",
                 sample_rows: int = SAMPLE_ROWS, hot_share: float = HOT_SHARE) -> DataFrame:
    """Which lines a document keeps: (doc_id, text_hash, n_dropped, bitmap), for documents that lose some.

    A line's key is :func:`line_key`; keys of at least ``min_chars`` code points
    that occur under two ids or more stay only under the smallest of them.
    ``bitmap`` lists (word, keep) for the words of 64 lines that lose a line,
    bit i of ``keep`` standing for line 64 * word + i; words left out are kept whole.

    The hashes are range-partitioned and sorted by document and position, so
    the first row of a key names the document that keeps it.  A key of many
    rows would fill one partition; such keys (found on a sample, at most
    1 / ``hot_share`` of them) get their first document from a grouped minimum
    and are looked up where they stand.  Both ways give the same result.

    NULL and empty texts are one empty line.  Rows that share an id are one
    document: they keep or lose a key together.  Rows without an id are one
    document that comes last.  No rows give no bitmaps; other columns are ignored.
    """
    work = Work(docs.sparkSession, "lines")
    lines = work.table(_lines(docs, min_chars, id_col, text_col), "lines")
    hot = work.table(_hot_keys(lines, sample_rows, hot_share), "hot")
    first = work.table(lines.join(F.broadcast(hot), ["h1", "h2"]).groupBy("h1", "h2").agg(F.min("doc_id").alias("first")), "first")
    in_order = Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash", "pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cold = lines.join(F.broadcast(hot), ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    placed = cold.withColumn("first", F.first("doc_id").over(in_order)).unionByName(
        lines.join(F.broadcast(first), ["h1", "h2"]))
    gone = placed.where(F.col("first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first")))
    words = gone.groupBy("doc_id", "text_hash", F.expr(f"cast(pos div {WORD} as int)").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, pos % {WORD}))").alias("drop"))
    maps = work.table(words.groupBy("doc_id", "text_hash").agg(
        F.sum(F.bit_count("drop")).alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("drop").alias("keep")))).alias("bitmap")), "bitmaps")
    work.drop("lines", "hot", "first")
    return maps


def _kept(lines: Column, words: Column) -> Column:
    """The kept lines, in time linear in their number: words between those of the bitmap are copied whole."""
    def piece(x: Column, i: Column) -> Column:
        at = F.coalesce(F.get(words, i - 1)["word"] + 1, F.lit(0))
        own = F.filter(F.slice(lines, x["word"] * WORD + 1, WORD), lambda _, j: F.getbit(x["keep"], j) == 1)
        return F.concat(F.slice(lines, at * WORD + 1, (x["word"] - at) * WORD), own)
    end = (F.element_at(words, -1)["word"] + 1) * WORD
    return F.concat(F.flatten(F.transform(words, piece)), F.slice(lines, end + 1, F.greatest(F.size(lines) - end, F.lit(0))))


def apply(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines (before), n_dropped and the text reduced to the lines that :func:`keep_bitmaps` keeps.

    A document that loses nothing keeps its text as it is, NULL included; one
    that loses every line gets ''.  Repeated rows all stay.  Input columns named
    n_lines or n_dropped are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    maps = bitmaps.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "n_dropped", F.col("bitmap").alias("__map"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(maps, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash")), "left")
    lines = F.transform(F.array(F.split(text, "\n", -1)), lambda ls: F.array_join(_kept(ls, F.col("__map")), "\n"))
    return joined.select(
        *[F.when(F.col("__map").isNull(), F.col(c)).otherwise(lines[0]).alias(c) if c == text_col else F.col(c) for c in docs.columns],
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))


def dedup(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without repeated lines: :func:`keep_bitmaps`, then :func:`apply`."""
    return apply(docs, keep_bitmaps(docs, min_chars, id_col, text_col), id_col, text_col)


def report(done: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: line counts and a digest of what is left."""
    return done.select(F.col(id_col).alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("kept_sha256"))
