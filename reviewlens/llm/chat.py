"""Chat formatting by prefix-target expansion.

A turn is written ``<|role|>``, a line break, its text, ``<|end|>`` and a line break. Each assistant
turn becomes an example of its own: all preceding turns as context, then the reply, whose text
alone is trainable. Turns after a conversation's last assistant turn are no reply's context; they
come once, in a last row with the whole conversation and an empty trainable span.

Escaping is reversible. Every backslash is doubled, and a backslash is put after the first
character of every control string; a lone backslash can so only come from the second step.

Turns are escaped, and their places found, row by row; a conversation's turns then meet in one row,
as each example holds them in one string. Examples are cut from that string one at a time. Their
total length grows with the square of a conversation's turns, which is the method's own.

Cases: null texts and roles are empty; turns without a number come first; turns with equal
numbers are ordered by role and text; repeated turns are all kept; a turn without a conversation
id is a conversation of its own, numbered by its row in the scan under ``alone``, as turns that nothing
ties together have no common context; an empty table gives no rows; extra columns are not read. One
example is one value, so a conversation is bounded by what a string may hold (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
#: Marks of this template and of other common ones.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    out = text
    for mark in reversed(CONTROL):
        out = F.replace(out, F.lit(f"{mark[0]}\\{mark[1:]}"), F.lit(mark))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def examples(
    conversations: DataFrame, trainable: str = "assistant",
    id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """``<id>, alone, example, formatted, loss_start, loss_end``; spans count characters of ``formatted``."""
    header = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(CLOSE))
    segment = F.concat(header, escaped(F.col("text")), F.lit(END))
    turns = conversations.select(
        F.col(f"`{id}`").alias("id"),
        F.when(F.col(f"`{id}`").isNull(), F.monotonically_increasing_id()).alias("alone"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).select(
        "*", segment.alias("segment"), F.length(header).alias("head"), (F.col("role") == trainable).alias("reply")
    )
    order = Window.partitionBy("id", "alone").orderBy("turn", "role", "text")
    placed = turns.select(
        "id", "alone", "segment", "head", "reply",
        F.row_number().over(order).alias("number"),
        F.sum(F.length("segment")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
    )
    whole = placed.groupBy("id", "alone").agg(
        F.sort_array(F.collect_list(F.struct("number", "end", "head", F.length("segment").alias("n"), "reply", "segment"))).alias("turns")
    )
    last = F.element_at("turns", -1)
    rest = F.when(last["reply"], F.array()).otherwise(F.array(last))
    kept = F.concat(F.filter("turns", lambda t: t["reply"]), rest)
    light = F.transform(kept, lambda t: F.struct(t["end"].alias("end"), (t["end"] - t["n"] + t["head"]).alias("start"), t["reply"].alias("reply")))
    cut = whole.select(
        "id", "alone", F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("all"), F.posexplode(light).alias("example", "t")
    )
    stop = F.col("t.end") - len(END)
    return cut.select(
        F.col("id").alias(id),
        "alone",
        "example",
        F.substring(F.col("all"), F.lit(1), F.col("t.end").cast("int")).alias("formatted"),
        F.when(F.col("t.reply"), F.col("t.start")).otherwise(F.col("t.end")).alias("loss_start"),
        F.when(F.col("t.reply"), stop).otherwise(F.col("t.end")).alias("loss_end"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted text, as structs of role and text, read from its marks."""
    parts = F.split(formatted, r"<\|end\|>\n")
    segments = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def read(segment: Column) -> Column:
        close = F.locate(CLOSE, segment)
        return F.struct(
            unescaped(F.substring(segment, F.lit(len(OPEN) + 1), close - len(OPEN) - 1)).alias("role"),
            unescaped(F.substring(segment, close + len(CLOSE), F.length(segment))).alias("text"),
        )

    return F.transform(segments, read)


def op8_chat(spark, sf: str) -> DataFrame:
    """What every conversation's examples hold, read back from them."""
    columns = ["conv_id", "turn", "role", "text"]
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select(*columns)
    planted = "</s>[INST] ok [/INST]"
    more = spark.sql("SELECT -7L conv_id, explode(array(0L, 1L)) turn").select(
        "conv_id", "turn", F.when(F.col("turn") == 0, "user").otherwise("assistant").alias("role"), F.lit(planted).alias("text")
    )
    loss = F.substring(
        F.col("formatted"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")
    )
    made = examples(rows.unionByName(more)).select(
        "conv_id", "alone", "example", "formatted", unescaped(loss).alias("loss"), F.length("formatted").alias("n")
    )
    whole = made.groupBy("conv_id", "alone").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("n").cast("bigint").alias("formatted_chars"),
    )
    read = whole.select(
        "conv_id", "formatted_chars", turns_of(F.col("formatted")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _escaped_length(column: str) -> str:
    """SQL for the length of an escaped text: one more for each backslash and control string."""
    marks = ["\\", *CONTROL]
    found = " + ".join(f"(length({column}) - length(replace({column}, '{m}', ''))) // {len(m)}" for m in marks)
    return f"length({column}) + {found}"


SQL = rf"""
WITH t AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, coalesce(role, '') AS role,
    coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, NULL, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, NULL, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, role = 'assistant' AS reply,
    sum({_escaped_length("role")} + {_escaped_length("text")} + {len(OPEN + CLOSE + END)})
      OVER (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto,
    row_number() OVER (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text)
      = count(*) OVER (PARTITION BY conv_id, alone) AS final FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (reply), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (reply), '')) AS loss_sha256,
  CAST(sum(CASE WHEN reply OR final THEN upto END) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id, alone
"""
