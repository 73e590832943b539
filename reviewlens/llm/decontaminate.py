"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Words are runs of ASCII digits, ASCII letters (lower-cased) and all other characters beyond
ASCII. A window is ``words`` consecutive words of an item; an item of fewer, but not none, is one
window. A word is spelled by a few letters of its number, so the automaton has few nodes, and a match
ends at a word's number. All windows go into one automaton, and each text
is normalised and scanned once. Through the words' offsets, hits are mapped back to characters of
the original text.

The items are a stated query set. They are gathered in blocks of about ``block_bytes`` of text, whose
number is measured first; one block is the usual case. With more, the documents are still read in
one pass: a task builds one block's automaton after another for each of its batches, and
merges their hits in place, so that it holds the items' text and the automaton of one block.

Cases: null and wordless texts have no words and no hits; null and wordless items have no window;
an item without an id is left out by ``hits`` alone, but with ``unnamed``, as in the query and
``keep_clean``, its windows are hits like any other, and only the list of items lacks it; ids may be of
any type; equal windows of several items count for each; a repeated item id counts once;
overlapping matches cover their union; rows equal in id and text get equal results; extra columns are not
read, and ``keep_clean`` returns them all.
"""

from __future__ import annotations

from itertools import repeat

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import free_name, map_texts
from reviewlens.session import settle

BASE = 64
#: Every byte of a word character as itself, lower-cased; every other byte as a blank.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def windows(text: str | None, words: int) -> list[tuple[bytes, ...]]:
    tokens = normal_words(text)
    return [tuple(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []


class Windows:
    """One automaton over windows: each word is ``digits`` letters of an alphabet of ``BASE`` for each
    place, so that no node has many branches and no match begins inside a word."""

    def __init__(self, items: list[tuple[object, str]], words: int):
        owners: dict[tuple[bytes, ...], set] = {}
        for item, text in items:
            for window in windows(text, words):
                owners.setdefault(window, set()).update(() if item is None else (item,))
        known = sorted({word for window in owners for word in window})
        self.digits = 1
        while BASE**self.digits < len(known):
            self.digits += 1
        self.letters = {word: self._spelled(number) for number, word in enumerate(known)}
        self.other = "\0" * self.digits
        self.machine = ahocorasick.Automaton() if owners else None
        for window, ids in owners.items():
            self.machine.add_word("".join(map(self.letters.get, window)), (len(window), tuple(ids)))
        if owners:
            self.machine.make_automaton()

    def _spelled(self, number: int) -> str:
        return "".join(chr(1 + BASE * place + number // BASE**place % BASE) for place in range(self.digits))

    def scan(self, text: str | None) -> tuple[int, list[list[int]], set]:
        """Number of words, hit runs of words as (first, end) in order, and items that occur."""
        tokens = normal_words(text)
        if self.machine is None or not tokens:
            return len(tokens), [], set()
        found = list(self.machine.iter("".join(map(self.letters.get, tokens, repeat(self.other)))))
        ends = [((end + 1) // self.digits, n) for end, (n, _) in found]
        return len(tokens), _merge((end - n, end) for end, n in ends), {i for _, (_, ids) in found for i in ids}


def original_spans(text: str | None, runs: list[list[int]]) -> list[list[int]]:
    """Runs of words as (first, end) characters of the original text."""
    if not runs:
        return []
    raw = (text or "").encode("utf-8", "surrogatepass")
    at = np.frombuffer(b" " + raw.translate(_NORMAL) + b" ", np.uint8) != 32
    starts, ends = np.flatnonzero(at[1:] & ~at[:-1]), np.flatnonzero(at[:-1] & ~at[1:])
    chars = np.cumsum(np.frombuffer(raw + b" ", np.uint8) & 0xC0 != 0x80)  # characters begun up to a byte
    return [[int(chars[starts[a]]) - 1, int(chars[ends[b - 1] - 1])] for a, b in runs]


def _merge(runs) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(map(tuple, runs)):
        if out and first <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([first, end])
    return out


def hits(
    docs: DataFrame, items: DataFrame, keep: list[str], name: str, words: int = 10, block_bytes: int = 1 << 20,
    text: str = "text", item_id: str = "item_id", item_text: str = "text", unnamed: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every row, and under ``name`` a struct of ``n_words``, hit ``runs``
    of words, ``items`` and character ``spans`` of the original text."""
    queries = items.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").alias("t")).where(
        (F.lit(unnamed) | F.col("item").isNotNull()) & F.col("t").isNotNull()
    )
    size = queries.agg(F.sum(F.octet_length("t").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks > 1:
        queries = settle(queries.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(blocks))), "benchmark", by="block")
    given = []
    for block in range(blocks):
        part = queries if blocks == 1 else queries.where(F.col("block") == block)
        given.append(docs.sparkSession.sparkContext.broadcast([tuple(r) for r in part.select("item", "t").collect()]))

    def make():
        only = Windows(given[0].value, words) if len(given) == 1 else None

        def run(texts):
            found = [[0, [], set()] for _ in texts]
            for block in given:
                machine = only or Windows(block.value, words)
                for t, so_far in zip(texts, found):
                    so_far[0], runs, ids = machine.scan(t)
                    so_far[1] += runs
                    so_far[2] |= ids
            out = []
            for t, (n, runs, ids) in zip(texts, found):
                runs = _merge(runs)
                out.append({"n_words": n, "runs": runs, "items": sorted(ids), "spans": original_spans(t, runs)})
            return [out]

        return run

    kind = items.schema[item_id].dataType.simpleString()
    schema = f"`{name}` struct<n_words: bigint, runs: array<array<bigint>>, items: array<{kind}>, spans: array<array<bigint>>>"
    return map_texts(docs, keep, [text], schema, make)


def keep_clean(docs: DataFrame, items: DataFrame, words: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window."""
    name = free_name(docs, "llm_hits")
    return hits(docs, items, docs.columns, name, words, unnamed=True).where(F.size(f"{name}.runs") == 0).drop(name)


def op6_decontaminate(spark, sf: str) -> DataFrame:
    """Every document's benchmark hits."""
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    found = hits(docs, items, ["doc_id"], "hit", unnamed=True)
    covered = F.aggregate("hit.runs", F.lit(0).cast("bigint"), lambda n, run: n + run[1] - run[0])
    ids = F.array_join(F.array_sort(F.transform("hit.items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("hit.n_words").alias("n_words"),
        covered.alias("n_hit"),
        F.size("hit.items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (covered > 0).alias("contaminated"),
        F.col("hit.spans").alias("spans"),
    )
