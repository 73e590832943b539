"""Spelling variants: words one edit apart, found in a trie of letter-group frequencies.

A word's vector counts its code points in each of ``GROUPS`` letter groups. The trie arranges the
words by the successive counts of their vectors, down to leaves of few words. One inserted code point is
a surplus of one in one group, a deleted one a deficit of one, a replaced one both at most; so a
depth-first search that may spend one surplus and one deficit on its way down reaches every word that
is one edit away, and few others. The words of the leaves it reaches are verified letter by letter.

Every pair is found from one side only: from its shorter word, or from the one that the
other exceeds in the first group in which they differ. So a search spends its surplus first, and
its deficit only after that.

The trie is never whole in one task. Its upper levels are dealt out as nodes: a word belongs to the
first depth of ``DEPTHS`` at which its counts so far are shared by at most ``Settings.members``
words, and searches walk down the same levels as rows, meeting only nodes that exist, before they
enter a node. A node's words and its searches are sorted into one task's stream, words first;
the words become a trie, the searches pass it one by one. Searches of a node are cut into
slices of about ``Settings.searches``, each with the node's words; a node of the last depth that is
still too large is cut into chunks of words, each met by all searches. So memory is bounded, and
every pair is met exactly once, whatever the vocabulary holds.

Roots follow the forms by pointer jumping: a form occurs at least ``ratio`` times as often as its
word, so chains are short, and each round halves what is left of them.

Cases: null, empty and wordless texts have no words; a null id counts as an empty string; repeated rows
count each; ties between near words go to the first in code-point order; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import LOWER
from reviewlens.session import settle

#: Runs of A-Z, a-z and U+00C0 to U+00FF in lower-cased UTF-8.
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
GROUPS = 16
DEPTHS = (0, 4, 6, 8, 11, GROUPS)
LEAF = 8  # words that are verified at once, rather than arranged any further
#: What a search has spent: nothing, its surplus, both; a word that only goes to its own place.
NOTHING, SURPLUS, BOTH, OWN = range(4)
HELD = 200_000  # words that a task counts before it hands them on


@dataclass(frozen=True)
class Settings:
    min_length: int = 6
    min_count: int = 5
    ratio: int = 5
    modulus: int = 199
    members: int = 20_000
    searches: int = 4_000


def document_words(id: object, raw: bytes, settings: Settings) -> Iterator[tuple[bytes, int]]:
    """The words of one text with their counts; some runs lose a letter, by a hash of id and run."""
    start = crc32(f"{'' if id is None else id}:".encode())
    for run, n in Counter(RUN.findall(raw.translate(LOWER))).items():
        h = crc32(run, start)
        if h % settings.modulus == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        if len(run) - run.count(b"\xc3") >= settings.min_length:
            yield run, n


def word_counts(docs: DataFrame, settings: Settings, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    given = docs.select(F.col(f"`{id}`").cast("string").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))

    def batch(total: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(list(total), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for given in batches:
            for own, raw in zip(given.column("id"), given.column("text")):
                for word, n in document_words(own.as_py(), raw.as_py() or b"", settings):
                    total[word] = total.get(word, 0) + n
                if len(total) >= HELD:
                    yield batch(total)
                    total = {}
        yield batch(total)

    sums = given.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= settings.min_count)


def frequencies(word: str) -> tuple[int, ...]:
    """How many code points of a word are in each letter group."""
    counts = [0] * GROUPS
    for letter in word:
        counts[ord(letter) % GROUPS] += 1
    return tuple(counts)


def exceeds(word: str, other: str) -> bool:
    """Whether ``other`` is ``word`` with one code point inserted, or with one replaced by one of an
    earlier letter group or, in the same group, a later one."""
    extra = len(other) - len(word)
    if extra not in (0, 1):
        return False
    for at, (a, b) in enumerate(zip(word, other)):
        if a != b:
            if extra:
                return word[at:] == other[at + 1 :]
            own, its = ord(a) % GROUPS, ord(b) % GROUPS
            return word[at + 1 :] == other[at + 1 :] and (its < own or its == own and a < b)
    return extra == 1


def build(words: list[tuple], depth: int) -> dict | list:
    """The trie of (word, n, vector) below ``depth``: by count, then at leaves the words."""
    if len(words) <= LEAF or depth == GROUPS:
        return words
    by_count: dict[int, list] = {}
    for word in words:
        by_count.setdefault(word[2][depth], []).append(word)
    return {count: build(some, depth + 1) for count, some in by_count.items()}


def search(root: dict | list, word: str, depth: int, spent: int) -> list[tuple]:
    """The words of a trie that exceed ``word`` by one edit."""
    counts, found, half = frequencies(word), [], len(word) // 2
    start, end = word[:half], word[half:]  # one edit leaves one of them as it is
    stack = [(root, depth, spent)]
    while stack:
        node, level, state = stack.pop()
        if type(node) is list:
            for other in node:
                name = other[0]
                if (name.startswith(start) or name.endswith(end)) and exceeds(word, name):
                    found.append(other)
            continue
        count = counts[level]
        if count in node:
            stack.append((node[count], level + 1, state))
        if state == NOTHING and count + 1 in node:
            stack.append((node[count + 1], level + 1, SURPLUS))
        elif state == SURPLUS and count - 1 in node:
            stack.append((node[count - 1], level + 1, BOTH))
    return found


def descend(word: str, path: str, depth: int, to: int, spent: int) -> list[tuple[str, int]]:
    """The nodes at depth ``to`` that a search at ``path`` may reach, with what it has spent there."""
    found = [(path, spent)]
    for count in frequencies(word)[depth:to]:
        steps = {NOTHING: ((count, NOTHING), (count + 1, SURPLUS)), SURPLUS: ((count, SURPLUS), (count - 1, BOTH))}
        found = [
            (f"{at}{step},", state) for at, before in found for step, state in steps.get(before, ((count, before),)) if step >= 0
        ]
    return found


def _walk(rows: DataFrame, depth: int, to: int) -> DataFrame:
    """Rows ``word, n, path, spent`` at ``depth`` as rows at ``to``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns))
                out = [(word, n, *place) for word, n, path, spent in part for place in descend(word, path, depth, to, spent)]
                columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.string(), pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "path", "spent"])

    return rows.select("word", "n", "path", "spent").mapInArrow(run, "word string, n bigint, path string, spent int")


def _shares(rows: DataFrame, nodes: DataFrame, own: str, other: str) -> DataFrame:
    """Rows dealt into the ``own`` parts of their node by a hash of the word, once for each ``other`` part."""
    met = rows.join(nodes, "path").withColumn(own, F.pmod(F.xxhash64("word"), F.col(own)))
    return met.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)))


def near_words(words: DataFrame, settings: Settings) -> DataFrame:
    """``word, n_near, best``: of each word with a word one edit away, how many there are, and
    the most frequent, as a struct of ``less`` (its negative count) and ``near``."""
    start = {"path": F.substring("word", 1, 0), "spent": F.lit(OWN)}  # no constant: the root is a key like any other
    members = words.select("word", "n").withColumns(start)
    searches, parts = members.withColumn("spent", F.lit(NOTHING)), []
    for above, depth in zip((0, *DEPTHS), DEPTHS):
        if depth:
            members, searches = (settle(_walk(x, above, depth), "spelling-walk") for x in (members, searches))
        sizes = settle(members.groupBy("path").agg(F.count("*").alias("n_members")), "spelling-nodes")
        last = depth == DEPTHS[-1]
        chunks = F.ceil(F.col("n_members") / settings.members) if last else F.lit(1).cast("bigint")
        entered = F.lit(True) if last else F.col("n_members") <= settings.members
        entered_nodes = sizes.where(entered).select("path", chunks.alias("chunk"))
        if not entered_nodes.isEmpty():
            asked = searches.join(entered_nodes, "path").groupBy("path")
            slices = F.ceil(F.count("*") / settings.searches)
            nodes = settle(asked.agg(slices.alias("slice"), F.first("chunk").alias("chunk")), "spelling-parts")
            own = _shares(members, nodes, "chunk", "slice").withColumn("kind", F.lit(0))
            ask = _shares(searches, nodes, "slice", "chunk").withColumn("kind", F.lit(1))
            columns = ["path", "slice", "chunk", "kind", "word", "n", "spent"]
            parts.append(_met(own.select(columns).union(ask.select(columns)), depth))
        large = sizes.where(~entered).select("path")
        if large.isEmpty():
            break
        members, searches = (x.join(large, "path") for x in (members, searches))
    if not parts:
        return words.sparkSession.createDataFrame([], "word string, n_near bigint, best struct<less: bigint, near: string>")
    met = parts[0]
    for part in parts[1:]:
        met = met.union(part)
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "near")).alias("best"))


def _met(rows: DataFrame, depth: int) -> DataFrame:
    """``word, n_near, less, near`` of each word that is found or finds one, in its part of a node."""
    key = ["path", "slice", "chunk"]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: not to be coalesced
    ordered = rows.repartition(tasks, *key).sortWithinPartitions(*key, "kind", "word")

    def columns(found: dict[str, list]) -> pa.RecordBatch:
        near = [pa.array(c, k) for c, k in zip(zip(*found.values()), (pa.int64(), pa.int64(), pa.string()))]
        near = near or [pa.array([], k) for k in (pa.int64(), pa.int64(), pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *near], names=["word", "n_near", "less", "near"])

    def add(found: dict[str, list], word: str, less: int, near: str) -> None:
        if word not in found:
            found[word] = [1, less, near]
            return
        so_far = found[word]
        so_far[0] += 1
        if (less, near) < (so_far[1], so_far[2]):
            so_far[1:] = less, near

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, trie, found = None, [], None, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                for *place, kind, word, n, spent in zip(*(c.to_pylist() for c in batch.slice(at, 2000).columns)):
                    if place != node:
                        node, held, trie = place, [], None
                    if kind == 0:
                        held.append((word, n, frequencies(word)))
                        continue
                    if trie is None:
                        trie, held = build(held, depth), []
                    for other, m, _ in search(trie, word, depth, spent):
                        add(found, word, -m, other)
                        add(found, other, -n, word)
                if len(found) >= HELD:
                    yield columns(found)
                    found = {}
        yield columns(found)

    return ordered.mapInArrow(run, "word string, n_near bigint, less bigint, near string")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form, from ``word, form``; each round doubles the steps."""
    found = settle(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        found = moved.select("word", "root")
        if moved.where("next IS NOT NULL").isEmpty():
            return found


def variants(docs: DataFrame, settings: Settings = Settings(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs`` that is long and frequent enough."""
    words = settle(word_counts(docs, settings, id, text), "spelling-words")
    near = near_words(words, settings)
    often: Column = -F.col("best.less") >= settings.ratio * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
    )
    told = settle(joined, "spelling-forms")
    found = told.join(roots(told.where("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark, sf: str) -> DataFrame:
    """Every frequent word with its form and root."""
    return variants(spark.read.parquet(f"{sf}/documents.parquet"))


#: One character for each letter that a word may hold, so that distances in bytes are distances in letters.
_ACCENTS = "".join(map(chr, range(0xC0, 0x100)))
_SINGLE = "".join(chr(c) for c in range(33, 127) if not 97 <= c <= 122 and c != 39)[: len(_ACCENTS)]

SQL = rf"""
WITH RECURSIVE
bit AS (SELECT range AS b, range AS v, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM bit WHERE k < 8),
tab AS (SELECT list(v ORDER BY b) AS t FROM bit WHERE k = 8),
run AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
cnt AS (SELECT doc_id, w, count(*) AS n, doc_id || ':' || w AS s FROM run GROUP BY ALL),
byt AS (SELECT cnt.*, list_transform(range(len(hex(encode(s))) // 2),
    lambda i: CAST('0x' || substr(hex(encode(s)), 2 * i + 1, 2) AS BIGINT)) AS bytes FROM cnt),
crc AS (SELECT doc_id, w, n, xor(list_reduce(bytes, lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1]), 4294967295), 4294967295) AS h FROM byt, tab),
cut AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM crc),
voc AS (SELECT word, CAST(sum(n) AS BIGINT) AS n, translate(word, '{_ACCENTS}', '{_SINGLE.replace("'", "''")}') AS x
  FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
near AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM voc a JOIN voc b
  ON abs(length(a.x) - length(b.x)) <= 1 AND a.word <> b.word AND levenshtein(a.x, b.x) = 1),
best AS (SELECT word, n, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n FROM near GROUP BY word, n),
form AS (SELECT voc.word, voc.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * voc.n THEN form END AS form,
    CASE WHEN form_n >= 5 * voc.n THEN form_n END AS form_n FROM voc LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, form AS up, 0 AS step FROM form
  UNION ALL SELECT c.word, f.word, f.form, c.step + 1 FROM chain c JOIN form f ON f.word = c.up)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM form f JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) c USING (word)
"""
