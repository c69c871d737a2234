"""Line dedup over the whole corpus, as per-document keep bitmaps.

Rule: a line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and
with A-Z lower-cased.  Keys of at least ``min_chars`` code points that occur in
at least ``min_docs`` documents keep their lines only in the largest doc_id
that holds them.

Method, with DataFrame operations only:

1. every text is split once into rows of hashes, ``(h1, h2, doc_id, row, pos)``;
   two 64-bit hashes name a key, no text is moved;
2. the rows are range-partitioned by (h1, h2, doc_id).  The range holds
   the document too: a key that a third of all documents share is spread over
   many tasks;
3. inside its range every key's rows are sorted by document and position, and the first
   occurrence of each (key, document) streams by (a window that needs no further shuffle: the
   ranges hold each (key, document) together).  Its documents are counted with the
   largest one kept, per range, and the ranges' edges are merged: one row per key and range;
4. keys to drop meet their occurrences in a join on the hashes (both sides come
   straight from a shuffle, so adaptive execution splits a hot key), and the
   dropped positions are gathered per row into a run-length keep bitmap (where it
   changes between kept and dropped).

Text is read again only where a caller wants it: :func:`apply_keep` joins the
bitmaps to the documents.

Edge cases: a null or empty text is one empty line and is kept; repeated rows
(same doc_id and text) are treated alike and count as one document; rows that
share a doc_id count as one document; a null doc_id is one document, smaller
than every other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenecast.llm.common import SPACE_CHARS, ascii_lower, let, require, row_keys, stored

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    """The line stripped of white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def lines_of(text: Column) -> Column:
    """The text's lines (a null text is one empty line)."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per long enough line: key hashes, document, row key and position."""
    line = F.posexplode(lines_of(F.col("_text"))).alias("pos", "_line")
    key = line_key(F.col("_line"))
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
            .select("doc_id", *row_keys("doc_id", "_text"), line)
            .filter(F.char_length("_line") >= min_chars)
            .select("doc_id", "_k1", "_k2", "pos", key.alias("_key"))
            .filter(F.char_length("_key") >= min_chars)
            .select(F.xxhash64("_key").alias("h1"),
                    F.xxhash64(F.lit("second"), "_key").alias("h2"),
                    "doc_id", "_k1", "_k2", "pos"))


def surviving_docs(lines: DataFrame, min_docs: int) -> DataFrame:
    """Per key held by ``min_docs`` documents or more: the document that keeps its lines.

    ``lines`` are range-partitioned by (h1, h2, doc_id), so the window only sorts.
    """
    place = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos")
    first = lines.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") == 1)
    return (first.groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
            .filter(F.col("n_docs") >= min_docs))


def flips(dropped: Column) -> Column:
    """Where the keep bitmap changes: start and end of every run of dropped positions.

    ``dropped`` holds the sorted dropped positions; none give an empty array.
    """
    def ends(d: Column) -> Column:
        first = F.filter(d, lambda p, i: (i == 0) | (F.get(d, i - 1) < p - 1))
        last = F.filter(d, lambda p, i: (i == F.size(d) - 1) | (F.get(d, i + 1) > p + 1))
        return F.flatten(F.zip_with(first, last, lambda a, b: F.array(a, b + 1)))

    return let(dropped, ends)


def _bounds(n_lines: Column, flipped: Column) -> Column:
    """0, the flips, and the number of lines: kept, dropped, kept, ... between neighbours."""
    return F.concat(F.array(F.lit(0)), flipped, F.array(n_lines.cast("int")))


def keep_runs(n_lines: Column, flipped: Column) -> Column:
    """Run lengths of the keep bitmap: kept, dropped, kept, ... over all lines."""
    return let(_bounds(n_lines, flipped), lambda b: F.transform(
        F.sequence(F.lit(0), F.size(b) - 2), lambda i: F.get(b, i + 1) - F.get(b, i)))


def kept_lines(lines: Column, flipped: Column) -> Column:
    """The lines that the keep bitmap keeps."""
    def cut(parts: Column) -> Column:
        b = parts["bounds"]
        return F.flatten(F.transform(
            F.sequence(F.lit(0), F.size(b) - 2, F.lit(2)), lambda i: F.slice(
                parts["lines"], F.get(b, i) + 1, F.get(b, i + 1) - F.get(b, i))))

    return let(lines, lambda x: let(F.struct(
        x.alias("lines"), _bounds(F.size(x), flipped).alias("bounds")), cut))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  partitions: int | None = None) -> DataFrame:
    """Per row that loses lines: row key (_k1, _k2), bitmap ``flips`` and ``n_dropped``."""
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = stored(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    ranged = lines.repartitionByRange(n, "h1", "h2", "doc_id")
    shared = stored(surviving_docs(ranged, min_docs), "shared-lines")
    lost = (lines.join(shared, ["h1", "h2"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))))
    dropped = F.array_sort(F.collect_set("pos"))
    return (lost.groupBy("_k1", "_k2").agg(dropped.alias("dropped"))
            .select("_k1", "_k2", flips(F.col("dropped")).alias("_flips"),
                    F.size("dropped").alias("_n_dropped")))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               partitions: int | None = None) -> DataFrame:
    """Keep bitmaps of every row: id, n_lines, n_dropped, keep_runs (run lengths).

    ``keep_runs`` starts with the number of kept lines and alternates.
    """
    out = _with_bitmaps(docs, id_col, text_col, min_chars, min_docs, partitions)
    n_lines = F.size(lines_of(F.col(text_col)))
    return out.select(
        F.col(id_col), n_lines.cast("long").alias("n_lines"),
        F.col("_n_dropped").cast("long").alias("n_dropped"),
        keep_runs(n_lines, F.col("_flips")).alias("keep_runs"))


def _with_bitmaps(docs, id_col, text_col, min_chars, min_docs, partitions) -> DataFrame:
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs, partitions)
    keyed = docs.select("*", *row_keys(id_col, text_col))
    return (keyed.join(bitmaps, ["_k1", "_k2"], "left")
            .withColumns({"_flips": F.coalesce("_flips", F.array().cast("array<int>")),
                          "_n_dropped": F.coalesce("_n_dropped", F.lit(0))})
            .drop("_k1", "_k2"))


def apply_keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               partitions: int | None = None) -> DataFrame:
    """The documents cut by their keep bitmaps, plus ``n_lines`` and ``n_dropped``."""
    out = _with_bitmaps(docs, id_col, text_col, min_chars, min_docs, partitions)
    lines = lines_of(F.col(text_col))
    # a row without drops keeps its text as it is
    text = F.when(F.col("_n_dropped") == 0, F.coalesce(F.col(text_col), F.lit(""))).otherwise(
        F.array_join(kept_lines(F.col("_lines"), F.col("_flips")), "\n"))
    return (out.withColumn("_lines", lines)
            .withColumns({text_col: text,
                          "n_lines": F.size("_lines").cast("long"),
                          "n_dropped": F.col("_n_dropped").cast("long")})
            .drop("_lines", "_flips", "_n_dropped"))
