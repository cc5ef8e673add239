"""Reply trees as training conversations, with DataFrame functions only.

Messages point to the message they answer. Self-joins by doubled jumps (parent, grandparent, 4th
ancestor ...) give each leaf the length and score of its root-to-leaf path, and then the messages of
the chosen paths: as many joins as the logarithm of the longest path, and no row that holds a path
before the end. The best-scored paths of each tree become one conversation each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import table, written

# The template's marks, and what stands for their first characters inside texts.
TURN, END = "<|turn|>", "<|end|>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
NEWLINE = "&#10;"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """No control string of the template, nor any other that begins with < or [, is left in it."""
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit(NEWLINE))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def chosen_paths(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """tree, leaf, score, depth (0 at the root), role, text of each message on a chosen path.

    messages: tree (not null), node (unique in its tree), parent, role, text, score. A parent that is
    null or not there makes a root. Paths rank by mean score, null scores being 0, ties by the smaller
    leaf; the best of each tree are chosen, all if best is None. Messages that answer each other in a
    ring have no root and are on no path.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).alias("total"))
    known = nodes.select("tree", F.col("node").alias("up"))
    jump = written(
        nodes.withColumnRenamed("parent", "_parent")
        .join(known.withColumnRenamed("up", "_parent").withColumn("_there", F.lit(True)), ["tree", "_parent"], "left")
        .select("tree", "node", F.when(F.col("_there"), F.col("_parent")).alias("up"), F.lit(1).alias("length"), "total"),
        "jumps",
    )
    leaves = jump.select("tree", "node").join(
        jump.select("tree", F.col("up").alias("node")).filter("node IS NOT NULL"), ["tree", "node"], "left_anti"
    )
    longest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    jumps = []
    while not jump.filter("up IS NOT NULL").isEmpty() and 2 ** len(jumps) <= longest:
        jumps.append(jump.filter("up IS NOT NULL").select("tree", "node", "up"))
        above = jump.select(
            "tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("length").alias("_length"), F.col("total").alias("_total")
        )
        moved = jump.filter("up IS NOT NULL").join(above, ["tree", "up"], "left")
        further = moved.select(
            "tree",
            "node",
            F.col("_up").alias("up"),
            (F.col("length") + F.coalesce("_length", F.lit(0))).alias("length"),
            (F.col("total") + F.coalesce("_total", F.lit(0.0))).alias("total"),
        )
        jump = written(further.unionByName(jump.filter("up IS NULL")), "jumps")  # what has reached its root rests
    lengths = jump.filter("up IS NULL").select("tree", "node", "length", (F.col("total") / F.col("length")).alias("score"))
    paths = leaves.join(lengths, ["tree", "node"])
    if best is not None:
        rank = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
        paths = paths.withColumn("_rank", F.row_number().over(rank)).filter(F.col("_rank") <= best)
    on_path = paths.select("tree", F.col("node").alias("leaf"), "score", "node")
    for step in jumps:
        further = on_path.join(step, ["tree", "node"]).select("tree", "leaf", "score", F.col("up").alias("node"))
        on_path = written(on_path.unionByName(further), "paths")  # else the plan would double in every step
    return (
        on_path.join(lengths.select("tree", "node", (F.col("length") - 1).alias("depth")), ["tree", "node"])
        .join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
        .select("tree", "leaf", "score", "depth", "role", "text")
    )


def formatted(paths: DataFrame) -> DataFrame:
    """tree, leaf, score, formatted (the conversation) and loss (start and end, in code points, of each
    assistant text inside it). One conversation is one string, so its messages meet in one row here."""
    turn = F.struct(
        "depth", escaped_role(F.coalesce("role", F.lit(""))).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text")
    )
    turns = paths.groupBy("tree", "leaf", "score").agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    head = lambda t: F.concat(F.lit(TURN), t["role"], F.lit("\n"))
    empty = F.expr("named_struct('at', 0, 'spans', CAST(array() AS array<struct<start:int,end:int>>))")

    def further(seen: Column, t: Column) -> Column:
        start = seen["at"] + F.length(head(t))
        end = start + F.length(t["text"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(t["role"] == LEARNED_ROLE, F.concat(seen["spans"], span)).otherwise(seen["spans"])
        return F.struct((end + len(END)).alias("at"), spans.alias("spans"))

    return turns.select(
        "tree",
        "leaf",
        "score",
        F.concat_ws("", F.transform("_turns", lambda t: F.concat(head(t), t["text"], F.lit(END)))).alias("formatted"),
        F.aggregate("_turns", empty, further, lambda seen: seen["spans"]).alias("loss"),
    )


def read_back(conversation: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    ends = F.split(conversation, r"<\|end\|>\n")
    pieces = F.slice(ends, 1, F.size(ends) - 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped_role(
                F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), "\n", 1)
            ).alias("role"),
            unescaped(F.substr(p, F.instr(p, "\n") + 1)).alias("text"),
        ),
    )


def learned_text(conversation: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(loss, lambda s: unescaped(F.substr(conversation, s["start"] + 1, s["end"] - s["start"]))))


def as_chains(conversations: DataFrame) -> DataFrame:
    """Rows by turn as reply trees: each turn answers the one before. Rows without conv_id are one
    conversation; null turns come first, equal turns by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (
        conversations.select("conv_id", "turn", "role", F.col("text").cast("string").alias("text"))
        .withColumn("node", F.row_number().over(order))
        .select(
            F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"),
            "node",
            F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
            "role",
            "text",
            F.lit(0.0).alias("score"),
        )
    )


def chat_query(spark, sf_dir: str) -> DataFrame:
    """One row for each conversation, read back from its formatted text; null role and text are empty."""
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    made = formatted(chosen_paths(written(as_chains(rows), "messages")))
    turns, learned = read_back(F.col("formatted")), learned_text(F.col("formatted"), F.col("loss"))
    return made.withColumn("_turns", turns).withColumn("_learned", learned).select(
        F.when(F.col("tree") != "", F.col("tree").cast("long")).alias("conv_id"),
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(
            F.concat_ws("", F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256
        ).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"),
        F.sha2("_learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CHAT_SQL = """
WITH rows AS (
    SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'))
            + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;'))
            + 17 AS chars
    FROM rows
)
SELECT conv_id,
       COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
