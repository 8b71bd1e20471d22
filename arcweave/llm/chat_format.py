"""Chat formatting: root-to-leaf paths of reply trees as conversations.

Everything here is DataFrame expressions. A reply tree is a set of rows (tree,
node, parent, score). Paths come from iterative self-joins that double the
distance covered in each round, so a path of d turns takes log2(d) rounds and
no row ever carries a whole path before the best one is chosen.

Template: a user turn is ``[INST] text [/INST]``, an assistant turn
``<s> text </s>``, a system turn ``<<SYS>> text <</SYS>>`` and any other role
``<<TURN hex>> text <</TURN>>`` with the role in hexadecimal. Control strings
inside a text get one more backslash after their first character, which
``unescape`` takes away again, so ``parse_turns`` gives back roles and texts
exactly.

Defined results: a null text is an empty one, a null role an empty one, a null
tree a tree of its own; a row whose parent is missing, or is not in the tree,
is a root; rows on or below a cycle have no root and are on no path; of
branches with equal scores the longer wins, then the smaller leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arcweave.scratch import Scratch

_CONTROL = r"(/?INST\]|/?s>|</?SYS>>|</?TURN)"
ESCAPE = r"([\[<])(\\*)" + _CONTROL
UNESCAPE = r"([\[<])\\(\\*)" + _CONTROL
OPEN = r"(?:\[INST\]|<s>|<<SYS>>|<<TURN [0-9A-F]*>>)"
CLOSE = r"(?:\[/INST\]|</s>|<</SYS>>|<</TURN>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def turn_markers(role: Column) -> tuple[Column, Column]:
    """What stands before and after the text of a turn."""
    other = F.concat(F.lit("<<TURN "), F.hex(role), F.lit(">> "))
    return (
        F.when(role == "user", "[INST] ").when(role == "assistant", "<s> ").when(role == "system", "<<SYS>> ").otherwise(other),
        F.when(role == "user", " [/INST]")
        .when(role == "assistant", " </s>")
        .when(role == "system", " <</SYS>>")
        .otherwise(" <</TURN>>"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s){OPEN} .*? {CLOSE}"), F.lit(0))

    def turn(piece: Column) -> Column:
        opening = F.regexp_extract(piece, f"^({OPEN}) ", 1)
        inner = F.regexp_replace(F.regexp_replace(piece, f"^{OPEN} ", ""), f" {CLOSE}$", "")
        role = (
            F.when(opening == "[INST]", "user")
            .when(opening == "<s>", "assistant")
            .when(opening == "<<SYS>>", "system")
            .otherwise(F.unhex(F.regexp_extract(opening, "<<TURN ([0-9A-F]*)>>", 1)).cast("string"))
        )
        return F.struct(role.alias("role"), unescape(inner).alias("text"))

    return F.transform(pieces, turn)


def best_paths(nodes: DataFrame, scratch: Scratch, per_tree: int = 1) -> DataFrame:
    """The nodes (tree, leaf, rank, depth, node) on the best branches of each tree.

    ``nodes`` has tree and node (never null, unique together), parent and
    score. A branch scores the sum of its nodes' scores; null counts as 0.
    """
    here = scratch.save(nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "nodes")
    known = here.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    hops = here.join(known, ["tree", "parent"], "left").select(
        "tree",
        "node",
        F.when(F.col("known"), F.col("parent")).alias("up"),
        F.lit(1).cast("long").alias("depth"),
        "score",
    )
    # Rows that have met their root stay as they are; later rounds join the rest only.
    whole = hops = scratch.save(hops, "hops")
    rounds = []
    most = max(1, here.count()).bit_length() + 1
    while len(rounds) < most:
        going = hops.where(F.col("up").isNotNull())
        if going.isEmpty():
            break
        rounds.append(going)
        above = whole.select(
            "tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("score").alias("above")
        )
        hops = scratch.save(
            going.join(above, ["tree", "up"]).select(
                "tree", "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("score") + F.col("above")).alias("score")
            ),
            "hops",
        )
        whole = whole.where(F.col("up").isNull()).unionByName(hops)
    rooted = whole.where(F.col("up").isNull())
    inner = here.select("tree", F.col("parent").alias("node")).where(F.col("node").isNotNull()).distinct()
    order = [F.desc("score"), F.desc("depth"), F.asc("node")]
    leaves = (
        rooted.join(inner, ["tree", "node"], "left_anti")
        .withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order)))
        .where(F.col("rank") <= per_tree)
    )
    path = leaves.select("tree", F.col("node").alias("leaf"), "rank", "node")
    for hop in rounds:
        up = path.join(hop.select("tree", "node", "up"), ["tree", "node"])
        path = scratch.save(path.unionByName(up.select("tree", "leaf", "rank", F.col("up").alias("node"))), "path")
    return path.join(rooted.select("tree", "node", "depth"), ["tree", "node"])


def format_paths(turns: DataFrame) -> DataFrame:
    """One row (tree, leaf, rank, n_turns, formatted, loss_spans) for each path.

    ``turns`` has tree, leaf, rank, depth, role and text. ``loss_spans`` are
    the [start, end) code points of the assistants' texts, as escaped.
    """
    path = ["tree", "leaf", "rank"]
    role = F.coalesce("role", F.lit(""))
    before, after = turn_markers(role)
    inner = escape(F.coalesce("text", F.lit("")))
    cut = turns.select(
        *path,
        "depth",
        (role == "assistant").alias("loss"),
        F.length(before).alias("lead"),
        F.length(inner).alias("long"),
        F.concat(before, inner, after).alias("piece"),
    )
    so_far = Window.partitionBy(*path).orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(so_far), F.lit(0)).cast("long") + F.col("lead"))
    return (
        placed.groupBy(*path)
        .agg(
            F.array_sort(
                F.collect_list(F.struct("depth", "piece", "loss", "at", (F.col("at") + F.col("long")).alias("end")))
            ).alias("turns")
        )
        .select(
            *path,
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join("turns.piece", "").alias("formatted"),
            F.transform(
                F.filter("turns", lambda turn: turn["loss"]),
                lambda turn: F.struct(turn["at"].alias("start"), turn["end"].alias("end")),
            ).alias("loss_spans"),
        )
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda span: unescape(F.substring(formatted, span["start"].cast("int") + 1, (span["end"] - span["start"]).cast("int"))),
        ),
        "",
    )


def format_conversations(rows: DataFrame, scratch: Scratch, extra: tuple[str, ...] = ()) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees, formatted.

    Each turn answers the one before it; equal turn numbers follow in order of
    role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = scratch.save(
        rows.select("conv_id", "turn", "role", "text")
        .withColumn("node", F.row_number().over(order).cast("long"))
        .select(
            F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "conv_id", "node", "role", "text"
        ),
        "turns",
    )
    nodes = turns.select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.lit(0.0).alias("score"),
    )
    path = best_paths(nodes, scratch)
    formatted = format_paths(path.join(turns.select("tree", "node", "role", "text"), ["tree", "node"]))
    ids = turns.where(F.col("node") == 1).select("tree", "conv_id")
    return ids.join(formatted, "tree").select("conv_id", "n_turns", "formatted", "loss_spans")
