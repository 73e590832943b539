"""Mixing sources to target weights, by hash-random order and prefix sums of word counts.

Every row gets a hash-random key: digits from its id, then from its text, then from the row, so
that only rows equal throughout tie. A source's rows are ranged by the key's first digits; sums of
words per range, and prefix sums over the ranges, find the one range in which the source's budget
ends. The same over more and more digits of the keys in that range finds the key at which it ends,
however many rows share an id. So a source's decision is a handful of numbers: the whole epochs to
take, the key of the cut, and the words to take there. Only sums are shuffled, aggregated before
they move, and one row for those of the key at the cut: these are equal, and given by number.

A budget above the source's size repeats it: ``floor(target / size)`` whole epochs, and the
remainder from the front of the order. Equal rows at the cut are taken whole, as many as fit, and
one more gives only as many words as are left, so each source's sum is its target, rounded to a
word.

Targets: each source's weight share of all words, at most ``limit`` times its own; what is cut
off goes to the others by weight. Sources by code point, null last, take the weights in turn. The
table of sources, one row each, is ordered in one task.

Cases: a null or empty text has size 0 and takes nothing; rows that share an id, null included,
follow each other in an order by text, and one row of a source at most is cut; no words at all
give targets of 0; an empty table gives no rows. ``mixed`` keeps all columns, under any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.columns import WORD, free_name
from reviewlens.session import settle

#: Digits, of 16 values each, after which sums are formed: 4096 ranges in a source, the ids of a
#: range, 4096 ranges of an id's texts, its texts in a range, 4096 ranges of a text's rows, its rows.
DIGITS = (3, 16, 19, 48, 51, 64)
COPIES = 64  # of a row that one row stands for until they are dealt out


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def random_key(id: str) -> Column:
    """16 hexadecimal digits that depend on the id alone."""
    return F.substring(F.md5(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")).cast("binary")), 1, 16)


def row_key(docs: DataFrame, id: str, text: str, also: list[str]) -> Column:
    """64 hexadecimal digits: those of the id, 32 of the text and 16 of the columns ``also``."""
    kinds = {c: docs.schema[c].dataType.simpleString() for c in also}
    values = [F.col(f"`{c}`").cast("string") if "map<" in kinds[c] else F.col(f"`{c}`") for c in also]  # maps have no hash
    digest = F.lpad(F.hex(F.xxhash64(*(F.struct(v.isNull(), v) for v in values))), 16, "0")
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return F.concat(random_key(id), F.md5(body), F.lower(digest))


def targets(sizes: DataFrame, weights: tuple[int, ...], limit: int) -> DataFrame:
    """``none, s, source_size, target`` for sources ``none, s, source_size``.

    Sources stop at the limit in the order of limit per weight. ``level`` is the words per weight
    that would be left if exactly those before a source had stopped; the first source that this
    level does not lift above its limit sets the level of all that have not stopped.
    """
    rank = F.row_number().over(Window.orderBy("none", "s")) - 1
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))
    weighted = weighted.withColumn("most", F.col("source_size") * limit)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "none", "s")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(total) - F.coalesce(F.sum("most").over(before), F.lit(0))
    shares = F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = weighted.select("*", (left / shares).alias("level"), F.row_number().over(by_ratio).alias("place"))
    fits = F.col("level") * F.col("weight") <= F.col("most")
    level = F.min_by("level", F.when(fits, F.col("place"))).over(total)
    return levelled.select(
        "none", "s", "source_size", F.least(F.col("most").cast("double"), level * F.col("weight")).alias("target")
    )


def cuts(rows: DataFrame, weights: tuple[int, ...], limit: int) -> DataFrame:
    """Per source ``none, s``: ``source_size, target, epochs, cut, n, one, fit, part``.

    ``rows`` has ``none, s, key, size``. ``cut`` is the key at which the last, partial epoch ends;
    of its ``n`` equal rows of ``one`` words each, ``fit`` are taken whole and one with ``part``.
    """
    source = ["none", "s"]
    sums = [F.sum("size").alias("size"), F.count("*").alias("n")]
    ranges = settle(rows.groupBy(*source, F.substring("key", 1, DIGITS[0]).alias("step")).agg(*sums), "mix-ranges")
    aimed = targets(ranges.groupBy(*source).agg(F.sum("size").alias("source_size")), weights, limit)
    whole = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("bigint")
    aimed = aimed.withColumn("epochs", epochs).withColumn("rest", whole - F.col("epochs") * F.col("source_size"))
    aimed = settle(aimed, "mix-targets")

    def end(sums: DataFrame) -> DataFrame:
        """The step of each source in which its rest ends, with the rest as it is at its start."""
        upto = F.sum("size").over(Window.partitionBy(*source).orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
        found = sums.withColumn("upto", upto).withColumn("rest", F.col("rest") - F.col("upto") + F.col("size"))
        return settle(found.where((F.col("rest") > 0) & (F.col("rest") <= F.col("size"))).drop("upto"), "mix-step")

    last, inside = end(ranges.join(aimed.select(*source, "rest"), source)), rows
    for digits, more in zip(DIGITS, DIGITS[1:]):
        inside = inside.withColumn("step", F.substring("key", 1, digits)).join(last.drop("size", "n"), [*source, "step"])
        if digits == DIGITS[0]:
            inside = settle(inside, "mix-inside")
        last = end(inside.groupBy(*source, "rest", F.substring("key", 1, more).alias("step")).agg(*sums))
        inside = inside.drop("step", "rest")
    one = (F.col("size") / F.col("n")).cast("bigint")
    last_key = last.select(*source, F.col("step").alias("cut"), "n", "rest", one.alias("one"))
    last_key = last_key.withColumn("fit", F.floor(F.col("rest") / F.col("one"))).withColumn("part", F.col("rest") % F.col("one"))
    return settle(aimed.drop("rest").join(last_key.drop("rest"), source, "left"), "mix-cuts")


def _dealt(rows: DataFrame, count: Column, number: str) -> DataFrame:
    """Each of a few rows ``count`` times, under ``number`` which time it is; dealt out on the way."""
    some = rows.withColumn(f"{number}c", count).where(F.col(f"{number}c") > 0)
    groups = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(f"{number}c") - 1) / COPIES))
    dealt = some.withColumn(f"{number}g", F.explode(groups)).repartition(f"{number}g")
    first = F.col(f"{number}g") * COPIES
    times = F.sequence(first, F.least(first + COPIES, F.col(f"{number}c")) - 1)
    return dealt.withColumn(number, F.explode(times)).drop(f"{number}c", f"{number}g")


def _rows(docs: DataFrame, id: str, source: str, text: str, also: list[str]) -> list[Column]:
    return [
        F.col(f"`{source}`").isNull().alias("none"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("s"),
        row_key(docs, id, text, also).alias("key"),
        word_count(text).alias("size"),
    ]


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3,
    id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """``<id>, size, source_size, target, taken`` per row of ``docs``."""
    rows = settle(docs.select(F.col(f"`{id}`").alias("id"), *_rows(docs, id, source, text, [id])), "mix-rows")
    joined = rows.join(cuts(rows.drop("id"), weights, limit), ["none", "s"])
    at_cut = F.col("key").eqNullSafe(F.col("cut"))
    epochs = F.col("epochs") * F.col("size")
    before = F.when(F.col("key") < F.col("cut"), F.col("size")).otherwise(0)
    plain = joined.where(~at_cut).withColumn("taken", epochs + before)
    equal = joined.where(at_cut).groupBy("none", "s").agg(F.first(F.struct(*joined.columns)).alias("row")).select("row.*")
    last = F.when(F.col("copy") < F.col("fit"), F.col("size")).when(F.col("copy") == F.col("fit"), F.col("part")).otherwise(0)
    tied = _dealt(equal, F.col("n"), "copy").withColumn("taken", epochs + last)
    out = [F.col("id").alias(id), "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken")]
    return plain.select(*out).union(tied.select(*out))


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3,
    id: str = "doc_id", source: str = "source", text: str = "text", length: str = "n_chars",
) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken.

    One row at a cut comes once more with its first words only, and ``length`` follows. A row
    without words comes as often as its source's whole epochs, and once more before the cut.
    """
    box = free_name(docs, "llm_mix")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    given = _rows(docs, id, source, text, docs.columns)
    rows = settle(docs.select(*given), "mix-rows")
    plan = cuts(rows, weights, limit)
    joined = docs.select("*", F.struct(*given[:3]).alias(box)).join(
        plan.select(F.struct("*").alias(f"{box}p")),
        (F.col(f"{box}.none") == F.col(f"{box}p.none")) & (F.col(f"{box}.s") == F.col(f"{box}p.s")),
    )
    key, cut, fit, part = (F.col(c) for c in (f"{box}.key", f"{box}p.cut", f"{box}p.fit", f"{box}p.part"))
    whole = (F.col(f"{box}p.epochs") + F.when(key < cut, 1).otherwise(0)).cast("int")
    plain = joined.withColumn(f"{box}n", F.explode(F.array_repeat(F.lit(0), whole))).select(*columns)

    # the rows at a source's cut are equal: one of them stands for those that are taken
    equal = joined.where(key == cut).groupBy(f"{box}p").agg(F.first(F.struct(*columns)).alias(box))
    tied = _dealt(equal, fit + F.signum(part).cast("bigint"), f"{box}n")
    tied = tied.select(*(F.col(f"{box}.`{c}`").alias(c) for c in docs.columns), f"{box}p", f"{box}n")
    pieces = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut_here = F.col(f"{box}n") == fit
    front = F.when(cut_here, F.array_join(F.slice(pieces, F.lit(1), part.cast("int")), "")).otherwise(F.col(f"`{text}`"))
    tied = tied.withColumn(text, front)
    if length in docs.columns:
        chars = F.when(cut_here, F.length(F.col(f"`{text}`"))).otherwise(F.col(f"`{length}`"))
        tied = tied.withColumn(length, chars.cast(docs.schema[length].dataType))
    return plain.union(tied.select(*columns))


def op7_mixing(spark, sf: str) -> DataFrame:
    """What the mix of all documents takes of each, at the contract's weights and limit."""
    return mix(spark.read.parquet(f"{sf}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) || md5(coalesce(text, '')) AS key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
p AS (SELECT *, row_number() OVER o AS place,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM w WINDOW o AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST)),
l AS (SELECT min_by(level, place) AS level FROM p WHERE level * weight <= 3 * source_size),
t AS (SELECT source, source_size, least(3.0 * source_size, l.level * weight)::DOUBLE AS target FROM p, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
k AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before FROM d)
SELECT k.doc_id, k.size, e.source_size, e.target,
  CAST(e.epochs * k.size + greatest(0, least(k.size, round(e.target) - e.epochs * e.source_size - k.before)) AS BIGINT) AS taken
FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
"""
