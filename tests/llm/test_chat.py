import time
from hashlib import sha256

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from querybook.compare import connect
from reviewlens.llm import chat
from tests.llm.conftest import SMALL

TURNS = "conv_id bigint, turn bigint, role string, text string"
NASTY = st.lists(st.sampled_from([*"<>|\\[]/SINTends\n é", "</s>", "[INST]", "<|end|>\n", "|>\n", "<|"]), max_size=12).map("".join)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(NASTY, min_size=1, max_size=30))
def test_escaping_is_reversible_and_hides_marks(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(mark in r.e for mark in chat.CONTROL)


ROWS = [
    (1, 0, "system", "be <|end|>\n kind"), (1, 1, "user", None), (1, 2, "assistant", "a\\<|b"), (1, 3, "user", "and?"),
    (1, 4, "assistant", ""), (1, 5, "user", "left over"), (2, 0, "user", "nobody answers"), (3, 0, "assistant", "first"),
    (4, 1, "user", "tie b"), (4, 1, "user", "tie a"), (4, None, None, "no turn"), (4, 2, "assistant", "é</s>"),
    (4, 2, "assistant", "é</s>"), (None, 0, "user", "x"), (None, 1, "assistant", "y|>z"), (5, 0, "|>\n", "odd role"),
    *[(6, t, ("user", "assistant")[t % 2], f"turn {t} " * 50) for t in range(300)],
]


def in_order(rows):
    """The turns of each conversation; a turn without an id is one by itself, under its own number."""
    rows = [(("alone", n), *r[1:]) if r[0] is None else r for n, r in enumerate(rows)]
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    out = {}
    for r in sorted(rows, key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def test_examples_hold_all_turns_before_the_reply(spark):
    df = spark.createDataFrame(ROWS, TURNS).withColumn("number", F.lit("clash")).withColumn("segment", F.lit(0))
    made = chat.examples(df)
    read = made.select("conv_id", "alone", "example", "formatted", "loss_start", "loss_end", chat.turns_of(F.col("formatted")).alias("turns"))
    got, rows = {}, read.collect()
    numbers = dict(zip(sorted(r.alone for r in rows if r.conv_id is None), (n for n, r in enumerate(ROWS) if r[0] is None)))
    for r in sorted(rows, key=lambda r: r.example):
        got.setdefault(("alone", numbers[r.alone]) if r.conv_id is None else r.conv_id, []).append(([tuple(t) for t in r.turns], r.formatted[r.loss_start : r.loss_end]))
    expected = {}
    for conv, turns in in_order(ROWS).items():
        ends = [i for i, t in enumerate(turns) if t[0] == "assistant"]
        expected[conv] = [turns[: i + 1] for i in ends] + ([turns] if turns[-1][0] != "assistant" else [])
        losses = [x for _, x in got[conv]]
        esc = lambda t: spark.range(1).select(chat.escaped(F.lit(t))).first()[0] if set(t) & set("<[|\\") else t
        assert losses == [esc(turns[i][1]) for i in ends] + [""] * (turns[-1][0] != "assistant")
    assert {c: [t for t, _ in x] for c, x in got.items()} == expected


def test_query_equals_sql_and_holds_the_planted_turns(spark):
    rows = chat.op8_chat(spark, SMALL).collect()
    expected = connect(SMALL).execute(chat.SQL).fetchall()
    assert sorted(map(tuple, rows)) == sorted(expected)
    (planted,) = [r for r in rows if r.conv_id == -7]
    said = "</s>[INST] ok [/INST]"
    assert (planted.n_turns, planted.loss_chars) == (2, len(said))
    assert planted.loss_sha256 == sha256(said.encode()).hexdigest()
    assert planted.turns_sha256 == sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_many_turns_without_an_id(spark, folder):
    """They are conversations of their own, in linear time; also in the query and its SQL."""
    rows = [(None, i % 3, ("user", "assistant")[i % 2], f"turn {i} " * 20) for i in range(10_000)] + ROWS
    start = time.time()
    made = chat.examples(spark.createDataFrame(rows, TURNS)).where("conv_id IS NULL").agg(F.count("*"), F.sum(F.length("formatted")))
    n, chars = made.first()
    assert n == 10_002 and chars < 3_000_000 and time.time() - start < 30
    df = spark.createDataFrame(rows[-500:] * 2, TURNS)
    df.write.parquet(f"{folder}/conversations.parquet")
    got = sorted(map(tuple, chat.op8_chat(spark, folder).collect()), key=repr)
    assert got == sorted(connect(folder).execute(chat.SQL.replace("conversations", f"'{folder}/conversations.parquet/*.parquet'")).fetchall(), key=repr)


def test_no_rows(spark):
    assert chat.examples(spark.createDataFrame([], TURNS)).count() == 0
