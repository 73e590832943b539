"""Exact removal of repeated long substrings, through a collection's suffix order.

A byte goes if it lies in a string of ``length`` bytes that starts anywhere else as well, in the
same text or another one. Which strings repeat is read from the Burrows-Wheeler transform and the
common prefixes of a collection (``bwt.py``), built by inserting one symbol per string and round.
The corpus is not one collection: it is dealt into many small ones that share no string.

1. *Anchors.* Among the ``GRAM``-byte substrings of a string of ``length`` bytes, the one with the
   least hash is its anchor; equal strings have equal anchors at equal offsets. Consecutive starts
   with the same anchor are a *piece*, about ``length + 70`` bytes; every start is in exactly one.
   Anchors that occur once are dropped: none of their strings repeats.
2. *Pieces* are aggregated by anchor and digest, and only one of equal pieces goes on. A
   piece that occurs twice repeats as a whole. Anchors with several different pieces, or one that
   repeats inside itself, go on to step 3, with the bytes of one occurrence of each piece.
3. *Collections.* Pieces meet by anchor, about ``bucket`` pieces to a collection. Starts whose
   offsets to their anchors lie in the same block of ``BLOCK`` have ``length - BLOCK + 1`` bytes in
   common, their core. Parts of pieces with a core of their own repeat nowhere, and equal parts
   repeat as they are; the others, with the same core and different surroundings, form the
   collection whose transform decides.
4. Repeated starts go back to all occurrences of a piece, and by text to the documents.

An anchor with more than ``crowd`` different pieces would be too much for one collection. Its strings are
dealt one by one instead, by a hash of the whole string; those whose hash occurs twice, and those of
pieces that occur twice, form collections of their own, a different string in each place, and the same
transform decides them. Equal strings meet before they are shuffled, byte by byte, so no collection grows with the copies.

Texts are known by 128 bits of hash. Equal texts are processed once: their pieces are counted by
text before pieces are compared. Intermediate tables are settled.

Cases: null and empty texts have no bytes and lose none; texts under ``length`` bytes lose none;
repeated rows repeat each other's strings; very long texts are cut where windows allow, losing no
start; an empty table gives no rows; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import bwt
from reviewlens.session import settle

GRAM = 64
BLOCK = 16
SLICE_BITS = 15  # texts are scanned in slices of at most 2 to this many bytes, which caches hold
LONGEST = 200  # starts in a piece


def _hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``GRAM`` bytes, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    width, power = 1, 0x100000001B3
    while width < GRAM:
        grown = h[:-width] * np.uint64(power)
        grown += h[width:]
        h = grown
        width, power = 2 * width, power * power % (1 << 64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    out, k = values, 1
    while 2 * k <= width:
        out, k = np.minimum(out[:-k], out[k:]), 2 * k
    return np.minimum(out[: len(out) - width + k], out[width - k :]) if k < width else out


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all grams, and for each start of ``length`` bytes the first place of its least."""
    h, low = _hashes(data), np.uint64((1 << SLICE_BITS) - 1)
    tagged = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    return h, (_least(tagged, length - GRAM + 1) & low).astype(np.int64)


def slices(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, first byte, bytes) that fit a slice; long texts are cut so that
    every start of ``length`` bytes is in exactly one part."""
    room, most = [], (1 << SLICE_BITS) - 1
    used = 0
    for number, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), most - length + 1):
            part = text[at : at + most]
            if used + len(part) > most and room:
                yield room
                room, used = [], 0
            room.append((number, at, part))
            used += len(part)
    if room:
        yield room


def _starts(sizes: np.ndarray, length: int) -> np.ndarray:
    """Places of all valid starts in texts laid end to end."""
    n = np.maximum(0, sizes - length + 1)
    first = np.cumsum(sizes) - sizes
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def pieces(parts: list[tuple[int, int, bytes]], length: int, digest: bool):
    """Arrays over the pieces of a slice: text number, first byte, bytes, anchor, how often the
    anchor was chosen, and the digest if asked for."""
    raw = b"".join(p for _, _, p in parts)
    sizes = np.array([len(p) for _, _, p in parts])
    h, place = anchors(np.frombuffer(raw, np.uint8), length)
    starts = _starts(sizes, length)
    place = place[starts]
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))  # a text ends an anchor's run
    value = h[place[new]]
    follows = np.concatenate(([False], (value[1:] == value[:-1]) & (starts[new[1:]] == starts[new[1:] - 1] + 1)))
    run = np.cumsum(~follows) - 1
    head = new[~follows]
    chosen = np.bincount(run)
    count = np.diff(np.append(head, len(starts)))
    cut = -(-count // LONGEST)  # long runs, of periodic texts, become several pieces
    of = np.repeat(np.arange(len(head)), cut)
    step = np.arange(len(of)) - np.repeat(np.cumsum(cut) - cut, cut)
    first = starts[head[of] + step * LONGEST]
    size = np.minimum(LONGEST, count[of] - step * LONGEST) + length - 1
    text = np.searchsorted(np.cumsum(sizes), first, side="right")
    number = np.array([n for n, _, _ in parts])[text]
    at = first - (np.cumsum(sizes) - sizes)[text] + np.array([a for _, a, _ in parts])[text]
    anchor = value[~follows][of].view(np.int64)
    times = np.maximum(chosen[of], np.where(cut[of] > 1, 2, 1))
    if not digest:
        return number, at, size, anchor, times, None
    spans = map(slice, first.tolist(), (first + size).tolist())
    digests = np.fromiter(map(xxhash.xxh3_64_intdigest, map(raw.__getitem__, spans)), np.uint64, len(first))
    return number, at, size, anchor, times, digests.view(np.int64)


def repeated_starts(strings: list[bytes], often: list[bool], length: int) -> list[np.ndarray]:
    """For each of the different ``strings``, which of its starts of ``length`` bytes repeat.

    ``often`` marks strings that occur more than once. The strings' shared cores pick those that
    the transform must decide.
    """
    flags = [np.full(len(s) - length + 1, o) for s, o in zip(strings, often)]
    cores: dict[bytes, dict[bytes, list[tuple[int, int]]]] = {}
    for parts in slices(strings, length):
        raw = b"".join(p for _, _, p in parts)
        sizes = np.array([len(p) for _, _, p in parts])
        starts = _starts(sizes, length)
        place = anchors(np.frombuffer(raw, np.uint8), length)[1][starts]
        block = (place - starts) // BLOCK  # the anchor's offset in the string, in blocks
        new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (block[1:] != block[:-1]))))
        text = np.searchsorted(np.cumsum(sizes), starts[new], side="right")
        base = (np.cumsum(sizes) - sizes)[text]
        last = starts[np.append(new[1:], len(starts)) - 1]
        # offsets of a block run from BLOCK * b to BLOCK * b + BLOCK - 1: all starts share these bytes
        core = place[new] - BLOCK * block[new]
        for t, b, i, j, c in zip(text.tolist(), base.tolist(), starts[new].tolist(), last.tolist(), core.tolist()):
            number, at, _ = parts[t]
            group = cores.setdefault(raw[c : c + length - BLOCK + 1], {})
            group.setdefault(raw[i : j + length], []).append((number, i - b + at))
    undecided: list[tuple[bytes, list[tuple[int, int]]]] = []
    for group in cores.values():
        if len(group) > 1:
            undecided += group.items()
        else:
            ((part, spots),) = group.items()
            if len(spots) > 1:
                for number, at in spots:
                    flags[number][at : at + len(part) - length + 1] = True
    if undecided:
        for (part, spots), found in zip(undecided, bwt.repeated([p for p, _ in undecided], length)):
            for number, at in spots:
                flags[number][at : at + len(part) - length + 1] |= found | (len(spots) > 1)
    return flags


def covers(flags: np.ndarray, length: int) -> list[int]:
    """First byte and end of each run of bytes that the flagged starts cover."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    out: list[int] = []
    for first, end in zip(edges[::2].tolist(), (edges[1::2] + length - 1).tolist()):
        if out and first <= out[-1]:
            out[-1] = end
        else:
            out += [first, end]
    return out


def _texts(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """``t1, t2, raw`` per row: 128 bits that name the text, and its bytes; and the columns ``keep``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return docs.select(*keep, F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(7), body).alias("t2"), body.alias("raw"))


def _distinct(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A batch's different texts, the row of each, and how many rows have it."""
    found: dict[bytes, list[int]] = {}
    for i, raw in enumerate(batch.column("raw").to_pylist()):
        found.setdefault(raw, [i, 0])[1] += 1
    rows = np.array(list(found.values()))
    return list(found), rows[:, 0], rows[:, 1]


def _scan(texts: DataFrame, length: int) -> DataFrame:
    """``anchor, times`` of every piece; equal texts of a batch are scanned once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            different, _, copies = _distinct(batch)
            for parts in slices(different, length):
                number, _, _, anchor, times, _ = pieces(parts, length, False)
                yield pa.RecordBatch.from_pydict({"anchor": anchor, "times": times * copies[number]})

    long = texts.where(F.octet_length("raw") >= length).select("raw")
    return long.mapInArrow(run, "anchor bigint, times bigint")


def _occurrences(texts: DataFrame, length: int) -> DataFrame:
    """``t1, t2, first, size, anchor, digest, times, n`` of every piece; ``n`` rows of a batch have it."""
    schema = "t1 bigint, t2 bigint, first bigint, size bigint, anchor bigint, digest bigint, times bigint, n bigint"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            different, rows, copies = _distinct(batch)
            t1, t2 = (np.asarray(batch.column(c))[rows] for c in ("t1", "t2"))
            for parts in slices(different, length):
                number, at, size, anchor, times, digest = pieces(parts, length, True)
                columns = {"t1": t1[number], "t2": t2[number], "first": at, "size": size, "anchor": anchor}
                yield pa.RecordBatch.from_pydict(columns | {"digest": digest, "times": times, "n": copies[number]})

    return texts.where(F.octet_length("raw") >= length).mapInArrow(run, schema)


def _fetch(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``t1, t2, first, size, anchor, digest, often, kinds``) with the bytes, as ``raw``."""
    keys = ["anchor", "digest", "first", "size", "often", "kinds"]
    by_text = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct(*keys)).alias("spots"))
    one = texts.dropDuplicates(["t1", "t2"])  # equal texts meet before the shuffle
    spots = one.join(by_text, ["t1", "t2"]).select("raw", F.explode("spots").alias("s"))
    part = F.substring("raw", F.col("s.first").cast("int") + 1, F.col("s.size").cast("int"))
    return spots.select("s.anchor", "s.digest", "s.often", "s.kinds", part.alias("raw"))


def _collections(found: DataFrame, length: int, buckets: int) -> DataFrame:
    """``anchor, digest, cover`` of the pieces with repeated starts, a bucket of anchors at a time."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor", "ascending"), ("digest", "ascending")])
        flags = repeated_starts(table["raw"].to_pylist(), table["often"].to_pylist(), length)
        made = pa.array([covers(f, length) for f in flags], pa.list_(pa.int64()))
        table = table.select(["anchor", "digest", "often"]).append_column("cover", made)
        return table.filter(pc.invert(table["often"])).drop_columns(["often"])

    return _by_bucket(found, "anchor", buckets).applyInArrow(run, "anchor bigint, digest bigint, cover array<bigint>")


def _by_bucket(rows: DataFrame, key: str, buckets: int):
    """Rows grouped into buckets by a hash of ``key``; a task has a few buckets, whatever they weigh."""
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    return dealt.repartition(max(1, buckets // 8), "bucket").groupBy("bucket")


def _crowded(found: DataFrame, length: int, bucket: int) -> DataFrame:
    """The same for anchors of many pieces, a string at a time."""

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in enumerate(batch.column("raw").to_pylist()):
                n = len(raw) - length + 1
                strings = list(map(raw.__getitem__, map(slice, range(n), range(length, n + length))))
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, strings), np.uint64, n).view(np.int64)
                columns = {c: np.full(n, batch.column(c)[i].as_py()) for c in ("anchor", "digest", "often")}
                yield pa.RecordBatch.from_pydict(columns | {"at": np.arange(n), "w": hashes, "raw": strings})

    schema = "anchor bigint, digest bigint, often boolean, at bigint, w bigint, raw binary"
    strings = settle(found.mapInArrow(explode, schema), "crowded-strings")
    shared = strings.groupBy("w").agg(F.count("*").alias("n"), F.max("often").alias("o")).where("n > 1 OR o")
    met = strings.join(settle(shared.select("w"), "crowded-hashes"), "w")
    different = settle(met.groupBy("w", "raw").agg(((F.count("*") > 1) | F.max("often")).alias("twice")), "crowded-different")

    def run(table: pa.Table) -> pa.Table:
        given, twice = table["raw"].to_pylist(), table["twice"].to_pylist()
        flags = bwt.repeated([*given, *(raw for raw, more in zip(given, twice) if more)], length)[: len(given)]
        return table.select(["w", "raw"]).filter(pa.array([bool(f[0]) for f in flags]))

    buckets = max(1, different.count() // bucket)
    repeated = settle(_by_bucket(different, "w", buckets).applyInArrow(run, "w bigint, raw binary"), "crowded-repeated")
    starts = strings.join(repeated, ["w", "raw"]).groupBy("anchor", "digest").agg(F.collect_set("at").alias("at"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for at in batch.column("at").to_pylist():
                flags = np.zeros(max(at) + 1, bool)
                flags[at] = True
                made.append(covers(flags, length))
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor"), batch.column("digest"), pa.array(made, pa.list_(pa.int64()))],
                names=["anchor", "digest", "cover"],
            )

    return starts.mapInArrow(merge, "anchor bigint, digest bigint, cover array<bigint>")


def repeated_spans(texts: DataFrame, length: int, bucket: int = 2000, crowd: int = 16000) -> DataFrame:
    """``t1, t2, spots`` of the texts that lose bytes: first bytes of pieces, and what is covered there."""
    shared = _scan(texts, length).groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    rows = _occurrences(texts, length).join(settle(shared, "anchors"), "anchor")
    # by place only, not by anchor: a join by a hot anchor can then be split, as no sum relies on it
    same = [F.first(c).alias(c) for c in ("size", "anchor", "digest", "times")]
    spots = settle(rows.groupBy("t1", "t2", "first").agg(F.sum("n").alias("n"), *same), "pieces")

    own = ["t1", "t2", "first", "size"]
    kinds = settle(
        spots.groupBy("anchor", "digest").agg(
            (F.sum("n") > 1).alias("often"), F.max("times").alias("times"), F.min(F.struct(*own)).alias("spot")
        ),
        "piece-kinds",
    )
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("times").alias("times"))
    mixed = settle(groups.where("kinds > 1 OR times > 1").select("anchor", "kinds"), "mixed-anchors")
    whole = kinds.where("often").select("anchor", "digest", F.array(F.lit(0).cast("bigint"), F.col("spot.size")).alias("cover"))
    wanted = kinds.join(mixed, "anchor").select("anchor", "digest", "often", "spot.*", "kinds")
    found = settle(_fetch(texts, wanted), "piece-bytes")  # the texts move once, for both ways
    few, many = found.where(F.col("kinds") <= crowd), found.where(F.col("kinds") > crowd)
    n = mixed.where(F.col("kinds") <= crowd).agg(F.sum("kinds")).first()[0] or 0
    parts = [whole, _collections(few.drop("kinds"), length, max(1, n // bucket))]
    if not mixed.where(F.col("kinds") > crowd).isEmpty():
        parts.append(_crowded(many.drop("kinds"), length, bucket))
    cover = parts[0]
    for part in parts[1:]:
        cover = cover.union(part.where(F.size("cover") > 0))
    cover = settle(cover, "covers")
    covered = spots.select("t1", "t2", "first", "anchor", "digest").join(cover, ["anchor", "digest"])
    return covered.groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "cover")).alias("spots"))


def merged(spots: list[dict]) -> list[list[int]]:
    """Maximal runs of removed bytes of a text, in order."""
    every = sorted((s["first"] + a, s["first"] + b) for s in spots for a, b in zip(s["cover"][::2], s["cover"][1::2]))
    out: list[list[int]] = []
    for first, end in every:
        if out and first <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([first, end])
    return out


def without_repeats(docs: DataFrame, length: int = 200, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id>, n_bytes, spans, kept`` per row: removed runs of bytes, and the bytes that are left."""
    spans = settle(repeated_spans(_texts(docs, text), length), "repeats")
    rows = _texts(docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")), "text", "id")
    joined = rows.join(spans, ["t1", "t2"], "left").select("id", "raw", "spots")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("raw").to_pylist()
            runs = [merged(s or []) for s in batch.column("spots").to_pylist()]
            kept = []
            for raw, gone in zip(texts, runs):
                edges = [0, *(x for run in gone for x in run), len(raw)]
                kept.append(b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2])) if gone else raw)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array(runs, pa.list_(pa.list_(pa.int64()))),
                    pa.array(kept, pa.binary()),
                ],
                names=[id, "n_bytes", "spans", "kept"],
            )

    kind = joined.schema["id"].dataType.simpleString()
    return joined.mapInArrow(run, f"`{id}` {kind}, n_bytes bigint, spans array<array<bigint>>, kept binary")


def op9_suffix_dedup(spark, sf: str) -> DataFrame:
    """What every document loses to repeated strings of 200 bytes."""
    made = without_repeats(spark.read.parquet(f"{sf}/documents.parquet"))
    return made.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
