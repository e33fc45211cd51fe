"""Chat formatting of reply trees with DataFrame functions only.

Method: messages form trees by (conversation, node, parent). Iterative self-joins
enumerate the root-to-leaf paths: the ancestor table is joined with itself, so that
round k knows the ancestor 2**k steps up, and the paths, which begin as the leaves,
are joined with it round by round; a path of n messages needs log2(n) rounds. Paths
are ranked within their conversation by the mean score of their messages, ties to
the smaller leaf, and each chosen path is formatted as one conversation.

Template: every message is ``<turn>role<says>text</turn>\\n``; a text that carries
loss has ``<reply>`` in the place of ``<says>``. Inside roles and texts ``\\`` is written
``\\b`` and ``<`` is written ``\\l``, so no control string can occur there, and the
escape is undone exactly.

Defined cases: null text or role is the empty string; a null score is 0; a parent
that is missing makes its child a root; a null conversation is one conversation, and a null
node one node of its conversation, which no parent names; messages repeated under one node id of a
conversation are different messages of one turn, in the order of role and text; an
empty table gives no rows. A parent cycle raises ValueError. Rows of a
conversation meet in one task only where its formatted text, one value, is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def format_turn(role: Column, text: Column, loss: Column) -> Column:
    return F.concat(F.lit("<turn>"), escape(role), F.when(loss, F.lit("<reply>")).otherwise(F.lit("<says>")),
                    escape(text), F.lit("</turn>\n"))


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by key columns of one name, where null equals null."""
    right = right.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns])
    return left.join(right, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys], how).drop(*[f"_{c}" for c in keys])


def paths(links: DataFrame) -> DataFrame:
    """(conv_id, leaf, node, up) for every node on every root-to-leaf path; ``up`` steps from the leaf.

    ``links`` has conv_id, node and parent; (conv_id, node) is unique.
    """
    nodes = links.select("conv_id", "node")
    jump = written(_join(links.where("parent is not null"), nodes.withColumnRenamed("node", "parent"),
                         ["conv_id", "parent"], "left_semi")
        .select("conv_id", "node", F.col("parent").alias("above")), "chat-links")
    inner = jump.select("conv_id", F.col("above").alias("node")).distinct()
    parts = [written(_join(nodes, inner, ["conv_id", "node"], "left_anti").select(
        "conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "chat-leaves")]
    steps, left = 1, jump.count()
    longest = left + 1
    while left:
        if steps > longest:
            raise ValueError("the parents of some messages form a cycle")
        # each round adds only the nodes that its jump reaches
        parts.append(written(_join(reduce(DataFrame.union, parts), jump, ["conv_id", "node"]).select(
            "conv_id", "leaf", F.col("above").alias("node"), (F.col("up") + steps).alias("up")), "chat-paths"))
        jump = written(_join(jump, jump.select("conv_id", F.col("node").alias("above"), F.col("above").alias("top")),
                             ["conv_id", "above"])
                       .select("conv_id", "node", F.col("top").alias("above")), "chat-jump")
        left, steps = jump.count(), 2 * steps
    return reduce(DataFrame.union, parts)


def format_trees(messages: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES, top_paths: int | None = None,
                 conv_col: str = "conv_id", node_col: str = "node", parent_col: str = "parent",
                 role_col: str = "role", text_col: str = "text", score_col: str | None = None) -> DataFrame:
    """One formatted conversation per chosen root-to-leaf path.

    Returns conv_id, leaf, path_rank, path_score, n_turns, formatted and loss_spans
    (start and length, in code points of ``formatted``, of every text with loss).
    ``top_paths`` keeps that many paths of each conversation; None keeps all.
    """
    score = F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)) if score_col else F.lit(0.0)
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(node_col).cast("long").alias("node"),
                           F.col(parent_col).cast("long").alias("parent"),
                           F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), score.alias("score"))
    links = rows.groupBy("conv_id", "node").agg(F.min("parent").alias("parent"))
    walked = paths(links)
    said = _join(walked, rows.drop("parent"), ["conv_id", "node"])
    turn = format_turn(F.col("role"), F.col("text"), F.col("role").isin(*loss_roles))
    in_path = W.partitionBy("conv_id", "leaf").orderBy(F.col("up").desc(), "role", "text")
    said = (said.withColumn("turn", turn)
            .withColumn("place", F.row_number().over(in_path))
            .withColumn("before", F.coalesce(F.sum(F.length("turn")).over(
                in_path.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))))
    body = F.length(escape(F.col("text")))
    span = F.struct("place", (F.col("before") + F.length("turn") - body - len("</turn>\n")).alias("start"),
                    body.cast("long").alias("length"))
    whole = said.groupBy("conv_id", "leaf").agg(
        F.count(F.lit(1)).alias("n_turns"), F.avg("score").alias("path_score"),
        F.array_sort(F.collect_list(F.struct("place", "turn"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("role").isin(*loss_roles), span))).alias("spans"))
    ranked = W.partitionBy("conv_id").orderBy(F.col("path_score").desc(), "leaf")
    whole = whole.select(
        "conv_id", "leaf", "path_score", "n_turns", F.array_join(F.col("turns.turn"), "").alias("formatted"),
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss_spans"))
    ids = whole.select("conv_id", "leaf", "path_score").withColumn("path_rank", F.row_number().over(ranked))
    if top_paths is None:
        return whole.withColumn("path_rank", F.row_number().over(ranked))
    return _join(whole.drop("path_score"), ids.where(F.col("path_rank") <= top_paths), ["conv_id", "leaf"])


def read_back(formatted: Column) -> tuple[Column, Column]:
    """Turns (array of role, text) and texts with loss (array), read from a formatted conversation."""
    bodies = F.filter(F.split(formatted, "</turn>\n"), lambda x: x != "")
    turns = F.transform(bodies, lambda x: F.struct(
        unescape(F.regexp_extract(x, r"^<turn>([^<]*+)<", 1)).alias("role"),
        unescape(F.regexp_extract(x, r"(?:<says>|<reply>)([^<]*+)$", 1)).alias("text")))
    replies = F.transform(F.regexp_extract_all(formatted, F.lit(r"<reply>([^<]*+)</turn>"), F.lit(1)), unescape)
    return turns, replies


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of what each formatted conversation says, read back from it."""
    turns, replies = read_back(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (formatted.select("conv_id", "formatted", said.alias("said"), F.array_join(replies, "").alias("loss"),
                             F.size(turns).cast("long").alias("n_turns"))
            .select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def chain(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """Messages of plain conversations as trees of one path: each follows the one before it by turn.

    Messages of one turn follow each other in the order of role and text; a null
    turn comes first.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
