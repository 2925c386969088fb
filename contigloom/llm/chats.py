"""Reply trees to chats: all paths from a root to a leaf, ranked by score, each chosen one formatted as one conversation.

Paths are enumerated by self-joins that double the distance: jump tables (ancestor 1, 2, 4, ... steps up) are joined with
themselves, then each leaf meets each of its ancestors once, by the binary digits of the distance. So the number of joins
is logarithmic in the depth, and the rows are those of the paths. Keys are (conv_id, msg_id).

Rows with a null key are left out. A message whose parent is null or absent is a root. Messages on a cycle hang on no root and are left out. Null text and null
role: empty. Null scores count as 0. Equal scores: the path whose leaf has the smaller msg_id comes first. Repeated rows
(equal conv_id and msg_id): one of them counts. An empty table gives an empty result. Extra columns are left out.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. In texts and roles a backslash is doubled and ``<|`` becomes ``<\\|``; a
line end in a role becomes ``\\~``. So no control string is left inside, and the way back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contigloom.session import settle

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = ("assistant",)  # roles whose texts are under the loss mask


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    return _replace(_replace(text, "\\", "\\\\"), "<|", "<\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return _replace(escape(role), "\n", "\\~")


def _line_ends(role: Column) -> Column:
    """``\\~`` to a line end, unless its backslash is itself escaped."""
    return F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\~", "$1\n")


def leaf_paths(messages: DataFrame) -> DataFrame:
    """(conv_id, leaf, msg_id, up): each leaf with itself and all that is above it, ``up`` steps away.

    ``messages``: conv_id, msg_id, parent_id.
    """
    nodes = settle(messages.select("conv_id", "msg_id", "parent_id").dropDuplicates(["conv_id", "msg_id"]))
    has_child = nodes.select("conv_id", F.col("parent_id").alias("msg_id")).filter("msg_id is not null").distinct()
    ups = settle(nodes.join(nodes.select("conv_id", F.col("msg_id").alias("parent_id")), ["conv_id", "parent_id"], "left_semi")
                 .select("conv_id", "msg_id", F.col("parent_id").alias("to_")))
    jumps, n, most = [], ups.count(), nodes.count()
    while n and 2 ** len(jumps) <= most:  # messages on a cycle would never come to an end
        jumps.append(ups)
        up = ups.select("conv_id", F.col("msg_id").alias("to_"), F.col("to_").alias("next_"))
        ups = settle(ups.join(up, ["conv_id", "to_"]).select("conv_id", "msg_id", F.col("next_").alias("to_")))
        n = ups.count()
    paths = nodes.join(has_child, ["conv_id", "msg_id"], "left_anti").select(
        "conv_id", F.col("msg_id").alias("leaf"), "msg_id", F.lit(0).cast("long").alias("up"))
    for k in range(len(jumps) - 1, -1, -1):
        higher = paths.join(jumps[k], ["conv_id", "msg_id"]).select(
            "conv_id", "leaf", F.col("to_").alias("msg_id"), (F.col("up") + 2 ** k).alias("up"))
        paths = settle(paths.unionByName(higher))
    return paths


def ranked(paths: DataFrame, messages: DataFrame, most: int) -> DataFrame:
    """The ``most`` leaves of each conversation whose paths have the greatest mean score: conv_id, leaf, rank."""
    scored = paths.join(messages.select("conv_id", "msg_id", F.coalesce("score", F.lit(0.0)).alias("score")), ["conv_id", "msg_id"])
    means = scored.groupBy("conv_id", "leaf").agg(F.avg("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "leaf"))
    return means.withColumn("rank", place).filter(F.col("rank") <= most).select("conv_id", "leaf", "rank", "score")


def formatted(turns: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per ``keys``: ``formatted``, from rows with role and text in the order of ``order``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.concat(F.lit(START), escape_role(role), F.lit("\n"), escape(text), F.lit(END + "\n"))
    rows = turns.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), turn.alias("t")))).alias("turns_"))
    return rows.select(*keys, F.array_join(F.col("turns_.t"), "").alias("formatted"))


def format_trees(messages: DataFrame, most: int = 1) -> DataFrame:
    """The best ``most`` paths of each conversation: conv_id, leaf, rank, score, formatted.

    ``messages``: conv_id, msg_id, parent_id, role, text, score.
    """
    messages = settle(messages.select("conv_id", "msg_id", "parent_id", "role", "text", "score").dropDuplicates(["conv_id", "msg_id"]))
    paths = leaf_paths(messages)
    best = ranked(paths, messages, most)
    steps = paths.join(best, ["conv_id", "leaf"]).join(messages.select("conv_id", "msg_id", "role", "text"), ["conv_id", "msg_id"])
    return formatted(steps.withColumn("down_", -F.col("up")), ["conv_id", "leaf", "rank", "score"], "down_")


def parsed(text: Column) -> Column:
    """A formatted conversation's turns, read back: array of (role, text)."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p != "")
    body = lambda p: F.substr(p, F.lit(len(START) + 1))
    return F.transform(parts, lambda p: F.struct(
        unescape(_line_ends(F.substring_index(body(p), "\n", 1))).alias("role"),
        unescape(F.substr(body(p), F.instr(body(p), "\n") + 1)).alias("text")))


def chain(rows: DataFrame) -> DataFrame:
    """Rows by conv_id and turn as messages: each answers the one before; rows of one turn in the order of role and text."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return rows.withColumn("msg_id", place.cast("long")).select(
        "conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))
