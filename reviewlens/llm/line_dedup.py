"""Line dedup by content-defined chunks.

A text is cut into lines, and lines into chunks. A line is a boundary if a rolling hash over the
hashes of that line and the ``WINDOW - 1`` before it is divisible by ``lines``, which happens
every ``lines`` lines on average. A chunk ends at the first boundary from its second line on, or
after ``LONGEST * lines`` lines without one; a single last line joins the chunk before it. Boundaries
depend on nearby lines only, so a passage that moves within or between texts is cut the same way, but
for its first chunk. A periodic passage, with a boundary in each period or without any, becomes equal chunks.

Chunks of at least two lines, one of them not blank, that occur more than once are removed
everywhere but at their first occurrence, the one in the smallest document. Candidates are found
by hash, on narrow rows; those with a hash that repeats are then compared byte by byte, and only
equal chunks count as repeated. Only the one chunk of a text of a single line has fewer than two.

The chunks of each document are settled as a narrow index; texts are read again only for the bytes of
chunks whose hash may repeat, and at the end. All of it is built-in functions. Minima are aggregated before they are shuffled; the joins are
plain joins by hash or document that adaptive execution can split.

Cases: a null text stays null and has no lines; an empty text is one empty line; rows equal in id
and text are one document given twice, get equal results and do not repeat each other; null ids
come after all others; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import settle

WINDOW = (1, 3, 5)  # factors of the newest line's hash and of the ones before it
FILTER_BITS = 27
LONGEST = 4  # chunks that have the usual length between boundaries, in one without


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("bigint")


def chunk_pattern(lines: int) -> str:
    """Of a text's marks, 1 for a boundary, those of a chunk: up to the first boundary from the second
    line on, or of the greatest length, each with a single last line; or what is left."""
    most = LONGEST * lines
    return f"[01]0{{0,{most - 2}}}1(?:[01]$)?|[01]0{{{most - 1}}}(?:[01]$)?|[01]0*$"


def chunked(docs: DataFrame, lines: int, id: str, text: str) -> DataFrame:
    """``id, h, text_lines, firsts, lasts``: the lines, and the first and last line of each chunk."""
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.split(F.col(f"`{text}`"), "\n").alias("text_lines")
    )
    hashed = rows.withColumn("hashes", F.transform("text_lines", _line_hash))

    def rolling(i: Column) -> Column:
        terms = [F.coalesce(F.get("hashes", i - k), F.lit(0)) * factor for k, factor in enumerate(WINDOW)]
        return sum(terms[1:], terms[0])

    numbers = F.sequence(F.lit(0), F.size("text_lines") - 1)
    marks = F.transform(numbers, lambda i: F.when(rolling(i) % lines == 0, "1").otherwise("0"))
    flagged = hashed.withColumn("marks", F.when(F.col("text_lines").isNotNull(), F.array_join(marks, ""))).drop("hashes")
    chunks = F.regexp_extract_all("marks", F.lit(chunk_pattern(lines)), F.lit(0))
    ended = F.split(F.array_join(F.transform(chunks, lambda c: F.lpad(F.lit("E"), F.length(c), F.lit("0"))), ""), "")
    ends = F.array_compact(F.transform(ended, lambda mark, i: F.when(mark == "E", i)))
    placed = flagged.withColumn("lasts", ends).drop("marks")
    before = F.concat(F.array(F.lit(0)), F.transform(F.slice("lasts", F.lit(1), F.size("lasts") - 1), lambda e: e + 1))
    return placed.withColumn("firsts", F.when(F.col("lasts").isNotNull(), before))


def _chunk(first: Column, last: Column) -> Column:
    return F.array_join(F.slice("text_lines", first + 1, last - first + 1), "\n")


def _spans() -> Column:
    return F.zip_with("firsts", "lasts", lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def _chunks(rows: DataFrame) -> DataFrame:
    """``id, h, number, chunk, chunk_hash`` of the chunks that may be removed."""
    cut = rows.select("id", "h", "text_lines", F.posexplode(_spans()).alias("number", "span")).where("span.last > span.first")
    chunks = cut.select("id", "h", "number", _chunk(F.col("span.first"), F.col("span.last")).alias("chunk"))
    return chunks.where(F.col("chunk").rlike(r"[^\x20\x09-\x0D]")).withColumn("chunk_hash", F.xxhash64("chunk"))


def _index(docs: DataFrame, lines: int, id: str, text: str) -> DataFrame:
    """``id, h, lasts, hashes``: of each document the chunks' last lines, and the hashes of those that
    may be removed, null for others. Settled, so that lines are hashed for it once."""
    def hashed(span: Column) -> Column:
        chunk = _chunk(span["first"], span["last"])
        return F.when((span["last"] > span["first"]) & chunk.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(chunk))

    rows = chunked(docs, lines, id, text)
    return settle(rows.select("id", "h", "lasts", F.transform(_spans(), hashed).alias("hashes")).dropDuplicates(["id", "h"]), "chunk-index")


def _slot(value: Column) -> Column:
    return F.pmod(value, F.lit(1 << FILTER_BITS)) + 1


def _maybe(chunks: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows of ``chunks`` whose hash may be among ``hashes``: a bitmap of ``2^FILTER_BITS`` bits,
    one for each slot, tells where they are; 16 MB at most, whatever the data, so it is sent to all tasks.
    The join that follows is exact; this saves it the texts that have nothing to meet."""
    bits = hashes.groupBy(F.bitmap_bucket_number(_slot(F.col("chunk_hash"))).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_slot(F.col("chunk_hash")))).alias("bits")
    )
    at = F.bitmap_bit_position(_slot(F.col("chunk_hash")))
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    placed = chunks.withColumn("bucket", F.bitmap_bucket_number(_slot(F.col("chunk_hash"))))
    met = placed.join(F.broadcast(settle(bits, "chunk-bits")), "bucket")
    return met.where(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1).select(*chunks.columns)


def removals(docs: DataFrame, index: DataFrame, lines: int, id: str, text: str) -> DataFrame:
    """``id, h, gone`` of the documents that lose chunks: the numbers of the chunks."""
    where = F.struct(F.col("id").isNull().alias("none"), "id", "h", "number")
    narrow = index.select("id", "h", F.posexplode("hashes").alias("number", "chunk_hash")).where("chunk_hash IS NOT NULL")
    hashes = narrow.groupBy("chunk_hash").agg(F.min(where).alias("a"), F.max(where).alias("b")).where("a <> b")
    repeated = settle(hashes.select("chunk_hash"), "chunk-hashes")
    chunks = _maybe(_chunks(chunked(docs, lines, id, text)), repeated)
    # both sides grow with the data, so this is a shuffle join at every size
    candidates = settle(chunks.join(repeated.hint("merge"), "chunk_hash"), "chunks")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "h", "number")
    firsts = candidates.groupBy("chunk_hash", "chunk").agg(F.min(place).alias("first"))
    firsts = settle(firsts, "chunk-firsts")  # a join of two stored tables can be split at a hot chunk
    spare = candidates.join(firsts, ["chunk_hash", "chunk"]).where(place != F.col("first"))
    return settle(spare.groupBy("id", "h").agg(F.collect_set("number").alias("gone")), "chunks-gone")


def without_repeats(docs: DataFrame, lines: int = 4, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id>, n_lines, n_chunks, n_removed, n_lines_removed, <text>`` per row, the text as it is left."""
    index = _index(docs, lines, id, text)
    gone = removals(docs, index, lines, id, text).withColumnsRenamed({"id": "of", "h": "of_h"})
    cuts = index.join(gone, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left").select(
        F.col("id").alias("of"), F.col("h").alias("of_h"), "lasts", "gone"
    )
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.split(F.col(f"`{text}`"), "\n").alias("text_lines")
    )
    # the texts move by document, however small the other side is: the same plan at every size
    joined = rows.join(settle(cuts, "chunk-cuts").hint("merge"), F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")))
    numbers = F.sequence(F.lit(0), F.size("lasts") - 1)
    kept = F.filter(numbers, lambda i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    first = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("lasts", i - 1) + 1)
    left = F.transform(kept, lambda i: F.slice("text_lines", first(i) + 1, F.get("lasts", i) - first(i) + 1))
    count = F.coalesce(F.size("text_lines"), F.lit(0))
    # most documents lose nothing, and stay as they are
    lines_left = F.when(F.col("gone").isNull(), F.col("text_lines")).otherwise(F.flatten(left))
    lost = joined.withColumn("lines_left", F.when(F.col("text_lines").isNotNull(), lines_left))
    return lost.select(
        F.col("id").alias(id),
        F.when(F.col("text_lines").isNull(), 0).otherwise(count).cast("bigint").alias("n_lines"),
        F.when(F.col("text_lines").isNull(), 0).otherwise(F.size("lasts")).cast("bigint").alias("n_chunks"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_removed"),
        F.when(F.col("text_lines").isNull(), 0).otherwise(count - F.size("lines_left")).cast("bigint").alias("n_lines_removed"),
        F.array_join("lines_left", "\n").alias(text),
    )


def op3_line_dedup(spark, sf: str) -> DataFrame:
    """Every document without the multi-line chunks that an earlier one has."""
    return without_repeats(spark.read.parquet(f"{sf}/documents.parquet"))


SQL = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l),
r AS (SELECT *, (h + 3 * coalesce(lag(h) OVER w, 0) + 5 * coalesce(lag(h, 2) OVER w, 0)) % 4 = 0 AS ends
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT doc_id, regexp_extract_all(string_agg(CASE WHEN ends THEN '1' ELSE '0' END, '' ORDER BY i), '{chunk_pattern(4)}') AS marks
  FROM r GROUP BY doc_id),
s AS (SELECT doc_id, unnest(marks) AS mark, unnest(range(len(marks))) AS number FROM m),
n AS (SELECT doc_id, number, sum(length(mark)) OVER (PARTITION BY doc_id ORDER BY number) AS upto, length(mark) AS n_lines FROM s),
c AS (SELECT n.doc_id, n.number, n.n_lines, string_agg(l.line, chr(10) ORDER BY l.i) AS chunk
  FROM n JOIN l ON l.doc_id = n.doc_id AND l.i >= n.upto - n.n_lines AND l.i < n.upto GROUP BY ALL),
d AS (SELECT *, n_lines > 1 AND regexp_matches(chunk, '[^\x20\x09-\x0D]')
    AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, number) > 1 AS gone FROM c)
SELECT t.doc_id, coalesce(CAST(sum(n_lines) AS BIGINT), 0) AS n_lines, count(d.doc_id) AS n_chunks,
  count(*) FILTER (gone) AS n_removed, CAST(coalesce(sum(n_lines) FILTER (gone), 0) AS BIGINT) AS n_lines_removed,
  CASE WHEN max(t.text) IS NOT NULL THEN coalesce(string_agg(chunk, chr(10) ORDER BY number) FILTER (NOT gone), '') END AS text
FROM documents t LEFT JOIN d USING (doc_id) GROUP BY t.doc_id
"""
