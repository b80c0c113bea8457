"""Chat formatting of reply trees.

Messages know their parent. Self-joins climb from every message at once and double their reach:
round k knows the ancestor 2^k replies above and the score on the way to it, so a thread of n
replies takes log2(n) rounds, each a row per message written to the shared folder. That gives
each leaf the length and the score of its branch. Leaves are ranked inside their tree by score,
and only the chosen ones are walked: the rounds joined from the last to the first reach each
ancestor once. So a thread of any length is rows, never an array per message; its turns meet
when the conversation is written.

The template marks turns with control strings that start with ``<`` or ``[``. In texts and
role names these two characters and the backslash are written as escapes, so no text can hold
a control string and the original is read back exactly. The loss mask is a list of spans of the formatted
text, a span per assistant turn; what is trained on is read through it.

Cases: null texts and roles are empty; messages whose parent is missing are roots; messages in
a cycle, and those without a tree or a number, belong to no path; of rows with the same tree
and number the smallest parent, score and turn count; ties in score go to the smaller message
number. In ``turns_as_messages`` repeated rows are messages of their own and rows without a
conversation form one. Only the named columns are read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartlens.llm.common import NO_ID, shown_id, stored

#: Written for the three characters that texts may not hold: backslash first.
ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("[", "\\s")]
USER, ASSISTANT, SYSTEM = "user", "assistant", "system"
OPEN = {USER: "[INST] ", ASSISTANT: "[REPLY] ", SYSTEM: "<<SYS>> "}
CLOSE = "</s>"


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def opening(role: Column) -> Column:
    """The control string of a role, with its name if it has none of its own."""
    start = F.concat(F.lit("[ROLE] "), escaped(role), F.lit("[TEXT] "))
    for name, mark in OPEN.items():
        start = F.when(role == name, F.lit(mark)).otherwise(start)
    return start


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    turns = F.split(formatted, CLOSE)
    turns = F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))

    def parsed(turn: Column) -> Column:
        role = unescaped(F.substring_index(F.substring(turn, 8, F.length(turn)), "[TEXT] ", 1))
        # the text follows the last control string; it holds no bracket itself
        text = F.substring(turn, F.length(F.substring_index(turn, "[TEXT] ", 1)) + 8, F.length(turn))
        for name, mark in OPEN.items():
            own = turn.startswith(mark)
            role = F.when(own, F.lit(name)).otherwise(role)
            text = F.when(own, F.substring(turn, len(mark) + 1, F.length(turn))).otherwise(text)
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(turns, parsed)


def climbed(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Every branch's end, and the jumps that lead up it.

    ``messages`` has tree, message, parent (null for roots) and score. The first result has
    tree, message, leaf (nobody answers the message), total and size of the branch up to its
    root. Jump k has tree, message and before, the ancestor 2^k replies above.
    """
    numbered = messages.where("tree is not null and message is not null")
    given = F.struct("parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    rows = numbered.groupBy("tree", "message").agg(F.min(given).alias("given")).select("tree", "message", "given.*")
    known = rows.select("tree", F.col("message").alias("parent"), F.lit(True).alias("known"))
    answered = rows.where("parent is not null").select("tree", F.col("parent").alias("message")).distinct()
    single = (
        rows.join(known, ["tree", "parent"], "left")
        .join(answered.withColumn("answered", F.lit(True)), ["tree", "message"], "left")
        .select(
            "tree",
            "message",
            F.when(F.col("known"), F.col("parent")).alias("before"),
            F.col("score").alias("total"),
            F.lit(1).cast("long").alias("size"),
            F.col("answered").isNull().alias("leaf"),
        )
    )
    current = stored(single)
    rooted, open_ = current.where("before is null"), current.where("before is not null")
    jumps: list[DataFrame] = []
    left = None
    while True:
        # while there is a way to a root, some message reaches it in each round; what remains are cycles
        still = open_.count()
        if not still or still == left:
            break
        left = still
        jumps.append(open_.select("tree", "message", "before"))
        upper = rooted.unionByName(open_).select(
            "tree",
            F.col("message").alias("before"),
            F.col("before").alias("above"),
            F.col("total").alias("upper_total"),
            F.col("size").alias("upper_size"),
        )
        # messages that have reached their root are not joined again
        longer = open_.join(upper, ["tree", "before"]).select(
            "tree",
            "message",
            F.col("above").alias("before"),
            (F.col("total") + F.col("upper_total")).alias("total"),
            (F.col("size") + F.col("upper_size")).alias("size"),
            "leaf",
        )
        current = stored(longer)
        rooted = rooted.unionByName(current.where("before is null"))
        open_ = current.where("before is not null")
    return rooted.drop("before"), jumps


def branches_of(ends: DataFrame) -> DataFrame:
    """A row per leaf: tree, leaf, score. A branch scores the mean of its messages."""
    return ends.where("leaf").select(
        "tree", F.col("message").alias("leaf"), (F.col("total") / F.col("size")).alias("score")
    )


def walked(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """The messages of the chosen branches, a row each: height counts from the leaf.

    ``chosen`` has tree and leaf; its other columns are kept. An ancestor's height, written in
    powers of two, tells the one way to it.
    """
    steps = chosen.withColumns({"message": F.col("leaf"), "height": F.lit(0).cast("long")})
    for k in reversed(range(len(jumps))):
        here = F.struct("message", "height")
        above = F.struct(F.col("before").alias("message"), (F.col("height") + 2**k).alias("height"))
        both = F.when(F.col("before").isNull(), F.array(here)).otherwise(F.array(here, above))
        steps = (
            steps.join(jumps[k], ["tree", "message"], "left")
            .select("tree", *(x for x in chosen.columns if x != "tree"), F.explode(both).alias("step"))
            .select("*", "step.message", "step.height")
            .drop("step")
        )
    return steps


def paths(messages: DataFrame) -> DataFrame:
    """A row per leaf: tree, leaf, path (message numbers from the root), score of the branch."""
    ends, jumps = climbed(messages)
    steps = walked(branches_of(ends), jumps)
    path = F.sort_array(F.collect_list(F.struct((-F.col("height")).alias("at"), "message")))
    whole = steps.groupBy("tree", "leaf", "score").agg(path.alias("path"))
    return whole.select("tree", "leaf", F.transform("path", lambda x: x["message"]).alias("path"), "score")


def conversations_of(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best ``branches`` paths of each tree, formatted.

    ``messages`` has tree, message, parent, role, text and score. Columns: tree, rank, score,
    leaf, formatted, mask (start and end of each span in ``formatted``, in code points from 0).
    """
    ends, jumps = climbed(messages)
    by_score = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    ranked = branches_of(ends).withColumn("rank", F.row_number().over(by_score))
    steps = walked(ranked.where(F.col("rank") <= branches), jumps)
    role, text = (F.coalesce(messages[x], F.lit("")) for x in ("role", "text"))
    written = F.struct(F.concat(opening(role), escaped(text), F.lit(CLOSE)).alias("turn"), role.alias("role"))
    # of repeated message numbers the first turn counts
    turns = messages.groupBy("tree", "message").agg(F.min(written).alias("written"))
    branch = ["tree", "rank", "score", "leaf"]
    down = Window.partitionBy(*branch).orderBy(F.desc("height"))
    placed = (
        steps.join(turns, ["tree", "message"])
        .select(*branch, "height", "written.*")
        .withColumn("end", F.sum(F.length("turn")).over(down))
    )
    is_reply = F.col("role") == ASSISTANT
    start = F.col("end") - F.length("turn") + len(OPEN[ASSISTANT])
    span = F.struct(start.alias("start"), (F.col("end") - len(CLOSE)).alias("end"))
    whole = placed.groupBy(*branch).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("height")).alias("at"), "turn"))).alias("turns"),
        F.sort_array(F.collect_list(F.when(is_reply, span))).alias("mask"),
    )
    formatted = F.array_join(F.transform("turns", lambda x: x["turn"]), "")
    return whole.select(*branch, formatted.alias("formatted"), "mask")


def _cut(formatted: pd.Series, mask: pd.Series) -> pd.Series:
    pairs = zip(formatted, mask, strict=True)
    return pd.Series(["".join(text[x["start"] : x["end"]] for x in spans) for text, spans in pairs], dtype=object)


def under_mask(formatted: str, mask: str) -> Column:
    """The code points of the spans, nothing between them."""
    return F.pandas_udf(_cut, "string")(formatted, mask)


def turns_as_messages(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees: each turn answers the one before.

    Rows of equal turn follow each other by role and text. The score is the length of the text.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("tree"), "turn", "role", F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("message", F.row_number().over(order))
    return rows.select(
        "tree",
        "message",
        F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"),
        "role",
        "text",
        F.length("text").cast("double").alias("score"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations.

    Columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_spans. The
    turns are parsed from the control strings, the trained text is cut out by the mask.
    """
    turns = formatted.select(
        "tree",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        unescaped(under_mask("formatted", "mask")).alias("masked"),
        F.size("mask").cast("long").alias("n_spans"),
    )
    parts = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    masked = turns.withColumn("whole", F.array_join(parts, ""))
    return masked.select(
        shown_id("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("whole", 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_spans",
    )
