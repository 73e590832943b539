"""Fill-in-the-middle transformation by secondary-sort assembly.

A text is cut into units, each a run of white space with the word after it. A hash of the document's id
chooses two cuts and one of three forms: ``plain``, the text as it is; ``psm``, prefix, suffix,
middle, each after its mark; ``spm``, suffix, prefix, middle. A text that holds a mark stays plain.

The output is emitted as pieces, whole units of at most ``piece_bytes`` together (a longer unit is cut),
keyed by document and output position. The pieces are repartitioned by document and sorted within
partitions by document and position, the DataFrame form of repartitionAndSortWithinPartitions. A
task then streams a document's pieces through one incremental digest, whatever its length; no
document is ever whole in a task once it is cut. For the restoration the same stream is read
as a stranger would, by its marks alone: the sections become pieces keyed by their place in the
text, sorted again within the partition, with no second shuffle, and streamed through a second digest.

A document is a row: its key is the row's number in the scan, which a retried task gives again, as long
as the table is a stored one. So rows with equal ids, null included, are documents of their own,
dealt out evenly.

Cases: a null text is empty, and plain; a null id is hashed as an empty string; a text without words is
one unit; equal rows get equal results; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The marks of each form, in the order of its output.
MARKS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Where a mark's section stands in the text.
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
BATCH = 4 << 20  # bytes of pieces that leave a task at once


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    fim_percent: int = 50
    spm_percent: int = 80
    piece_bytes: int = 8192


def unit_ends(raw: bytes) -> np.ndarray:
    """Offsets at which the units of a text in UTF-8 end."""
    data = np.frombuffer(raw, np.uint8)
    word = (data != 32) & ((data < 9) | (data > 13))
    ends = np.flatnonzero(word & ~np.append(word[1:], False)) + 1
    return np.append(ends, len(raw)) if len(raw) and not word[-1] else ends


def characters(raw: bytes) -> int:
    return int((np.frombuffer(raw, np.uint8) & 0xC0 != 0x80).sum())


def plan(id: object, raw: bytes, settings: Settings) -> tuple[str, np.ndarray, int, int]:
    """Form, unit ends, and the offsets of the two cuts."""
    ends = unit_ends(raw)
    digest = hashlib.sha256(f"{settings.seed}:{'' if id is None else id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    first, last = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    first, last = (int(ends[k - 1]) if k else 0 for k in (first, last))
    if not raw or h3 % 100 >= settings.fim_percent or any(mark in raw for mark in PLACE):
        return "plain", ends, first, last
    return "spm" if h4 % 100 < settings.spm_percent else "psm", ends, first, last


def cut(raw: bytes, ends: np.ndarray, first: int, last: int, most: int) -> Iterator[bytes]:
    """The bytes from ``first`` to ``last``, whole units of at most ``most`` bytes together."""
    while last - first > most:
        stop = np.searchsorted(ends, first + most, "right") - 1
        end = int(ends[stop]) if stop >= 0 and ends[stop] > first else first + most
        yield raw[first:end]
        first = end
    if last > first:
        yield raw[first:last]


def output_pieces(raw: bytes, form: str, ends: np.ndarray, first: int, last: int, most: int) -> Iterator[bytes]:
    """The output, piece by piece; at least one, which may be empty."""
    if form == "plain":
        spans = [(b"", 0, len(raw))]
    else:
        place = {PREFIX: (0, first), MIDDLE: (first, last), SUFFIX: (last, len(raw))}
        spans = [(mark, *place[mark]) for mark in MARKS[form]]
    for mark, a, b in spans:
        parts = list(cut(raw, ends, a, b, most)) or [b""]
        yield mark + parts[0]
        yield from parts[1:]


class Sections:
    """Reads an output as it streams by: bytes in, (place in the text, bytes) out."""

    def __init__(self, form: str):
        self.marks, self.held, self.place = list(MARKS.get(form, ())), b"", 0

    def feed(self, body: bytes, ended: bool = False) -> Iterator[tuple[int, bytes]]:
        self.held += body
        while self.marks:
            at = self.held.find(self.marks[0])
            if at < 0:
                break
            if at:
                yield self.place, self.held[:at]
            self.place = PLACE[self.marks.pop(0)]
            self.held = self.held[at + 3 :]
        keep = 2 if self.marks and not ended else 0  # a mark may have begun
        out, self.held = self.held[: len(self.held) - keep], self.held[len(self.held) - keep :]
        if out:
            yield self.place, out


def _batches(rows: Iterable[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows, whose last value is bytes or None, as batches of bounded size."""
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=schema.names)

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[-1] or b"")
        if size >= BATCH:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns))


def _schema(id_type: T.DataType) -> T.StructType:
    head = T.StructType.fromDDL("row bigint, place int, seq bigint")
    facts = T.StructType.fromDDL("n bigint, form string, prefix_chars bigint, middle_chars bigint, body binary")
    return T.StructType([*head, T.StructField("id", id_type), *facts])


def pieces(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, place, seq, id, n, form, prefix_chars, middle_chars, body``: the output of each row
    of ``docs`` in pieces of bytes, by document and ``seq``; the facts stand in the first piece."""
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary"))
    schema = _schema(docs.schema[id].dataType)

    def one(row: int, id: object, raw: bytes | None) -> Iterator[tuple]:
        raw = raw or b""
        form, ends, first, last = plan(id, raw, settings)
        plain = form == "plain"
        facts = (id, len(ends), form, None if plain else characters(raw[:first]), None if plain else characters(raw[first:last]))
        for seq, body in enumerate(output_pieces(raw, form, ends, first, last, settings.piece_bytes)):
            yield row, 0, seq, *(facts if seq == 0 else (None,) * 5), body

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((piece for doc in _rows(batches) for piece in one(*doc)), schema)

    return given.mapInArrow(run, schema)


def in_order(pieces: DataFrame) -> DataFrame:
    """The pieces of a document in one partition, in output order: the shuffle and the secondary sort."""
    return pieces.repartition("row").sortWithinPartitions("row", "place", "seq")


def sections(ordered: DataFrame) -> DataFrame:
    """From pieces in output order: a row of each document's facts with the digest of its output
    (``place`` -1, ``body`` the digest), and its text's sections, read back from the output."""
    schema = ordered.schema

    def read(rows: Iterable[tuple]) -> Iterator[tuple]:
        none, facts = (None,) * 5, None

        def end() -> Iterator[tuple]:
            for place, part in reader.feed(b"", ended=True):
                yield row, place, seq, *none, part
            yield row, -1, 0, *facts, digest.digest()

        for number, _, first, *own, body in rows:
            if first == 0:
                if facts:
                    yield from end()
                row, facts, digest, reader, seq = number, own, hashlib.sha256(), Sections(own[2]), 0
            digest.update(body)
            for place, part in reader.feed(body):
                yield row, place, seq, *none, part
                seq += 1
        if facts:
            yield from end()

    return ordered.mapInArrow(lambda batches: _batches(read(_rows(batches)), schema), schema)


def restored(sections: DataFrame, id: str = "doc_id") -> DataFrame:
    """``<id>, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of each document;
    the sections are sorted again where they are."""
    result = T.StructType.fromDDL(
        "n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    )
    schema = T.StructType([T.StructField(id, sections.schema["id"].dataType), *result])

    def read(rows: Iterable[tuple]) -> Iterator[tuple]:
        facts = None
        for _, place, _, *own, body in rows:
            if place < 0:
                if facts:
                    yield *facts, digest.hexdigest()
                facts, digest = (*own, body.hex()), hashlib.sha256()
            else:
                digest.update(body)
        if facts:
            yield *facts, digest.hexdigest()

    again = sections.sortWithinPartitions("row", "place", "seq")
    return again.mapInArrow(lambda batches: _batches(read(_rows(batches)), schema), schema)


def outputs(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id>, form, output``: the transformed texts themselves, one document at a time."""
    ordered = in_order(pieces(docs, settings, id, text))
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), *T.StructType.fromDDL("form string, output binary")])

    def read(rows: Iterable[tuple]) -> Iterator[tuple]:
        own, held = None, []
        for _, _, seq, id, _, form, _, _, body in rows:
            if seq == 0:
                if own:
                    yield *own, b"".join(held)
                own, held = (id, form), []
            held.append(body)
        if own:
            yield *own, b"".join(held)

    made = ordered.mapInArrow(lambda batches: _batches(read(_rows(batches)), schema), schema)
    return made.withColumn("output", F.col("output").cast("string"))


def op12_fill_middle(spark, sf: str) -> DataFrame:
    """Every document's form and cuts, and the digests of its output and of what is read back from it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return restored(sections(in_order(pieces(docs))))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
k AS (SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS h2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
           OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
         WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(u[:least(h1, h2)], '') AS pre, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS mid,
    array_to_string(u[greatest(h1, h2) + 1:], '') AS suf FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
