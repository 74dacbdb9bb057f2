"""Chat formatting of reply trees.

Every message names its parent.  Root-to-leaf paths are enumerated by iterative
self-joins with doubling steps: the table of 2**k-step ancestors joined with
itself gives that of 2**(k+1) steps, and from the leaves each table, longest
steps first, doubles what is reached.  So a tree of depth n takes about
2 * log2(n) joins on (tree, node), rows are as many as the paths are long, and no
tree is gathered anywhere before its text is put together.

A formatted conversation is, for each turn, ``### Role: `` + text + ``</turn>\\n``.
Inside texts ``\\``, ``<`` and ``#`` are written ``\\b``, ``\\l`` and ``\\h``, so control
strings occur where turns begin and end only and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.llm.session import durable

# The template.
OPEN, CLOSE = "### ", "</turn>\n"
ROLES = (("system", "System"), ("user", "User"), ("assistant", "Assistant"))
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for plain, written in pairs:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for plain, written in reversed(pairs):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def role_name(role: Column) -> Column:
    """A known role's name, or ``=`` and the escaped role."""
    out = F.concat(F.lit("="), escape(role, ROLE_ESCAPES))
    for known, name in ROLES:
        out = F.when(role == known, F.lit(name)).otherwise(out)
    return out


def role_of(name: Column) -> Column:
    out = unescape(F.substring(name, 2, 1 << 30), ROLE_ESCAPES)
    for known, shown in ROLES:
        out = F.when(name == shown, F.lit(known)).otherwise(out)
    return out


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Steps of 1, 2, 4, ... parents (tree, node, above, sum), and the leaves (tree, node) that reach a root.

    ``sum`` adds up ``score`` from a node to the last below ``above``.  ``nodes`` has
    tree, node, parent and score, each (tree, node) once, none of these but the
    parent null; an empty table gives empty ones.
    """
    parents = nodes.select("tree", F.col("node").alias("parent"))
    step = durable(nodes.join(parents, ["tree", "parent"], "left_semi").select("tree", "node", F.col("parent").alias("above"), F.col("score").alias("sum")))
    inner = step.select("tree", F.col("above").alias("node")).distinct()
    leaves = nodes.select("tree", "node").join(inner, ["tree", "node"], "left_anti")
    steps, most = [], nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    while (1 << len(steps)) < most and not step.isEmpty():
        steps.append(step)
        on = step.select("tree", F.col("node").alias("above"), F.col("above").alias("top"), F.col("sum").alias("more"))
        step = durable(step.join(on, ["tree", "above"]).select("tree", "node", F.col("top").alias("above"), (F.col("sum") + F.col("more")).alias("sum")))
    if (1 << len(steps)) >= most:  # more steps than a tree has nodes: only a cycle has so many
        leaves = leaves.join(step.select("tree", "node"), ["tree", "node"], "left_anti")
    return steps, durable(leaves)


def totals(nodes: DataFrame, steps: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """(tree, leaf, branch_score, depth): one row a leaf climbs to its root by the largest steps first."""
    at = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("depth"))
    for k in range(len(steps) - 1, -1, -1):
        on = at.join(steps[k], ["tree", "node"], "left")
        at = durable(on.select("tree", "leaf", F.coalesce("above", "node").alias("node"), (F.col("score") + F.coalesce("sum", F.lit(0.0))).alias("score"), (F.col("depth") + F.when(F.col("above").isNotNull(), 1 << k).otherwise(0)).alias("depth")))
    root = nodes.select("tree", "node", F.col("score").alias("own"))
    return at.join(root, ["tree", "node"]).select("tree", "leaf", (F.col("score") + F.col("own")).alias("branch_score"), "depth")


def paths(steps: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): for each of ``leaves`` (tree, node) all nodes up to its root, ``up`` steps above it, by the steps of :func:`climb`."""
    reached = durable(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    for k in range(len(steps) - 1, -1, -1):
        further = reached.join(steps[k], ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        reached = durable(reached.unionByName(further))
    return reached


def branches(nodes: DataFrame, top: int | None = None) -> DataFrame:
    """(tree, leaf, rank, branch_score, turn, role, text): the turns of the ``top`` best branches of each tree (all, if None).

    ``nodes`` has tree, node, parent, role, text and score.  A branch's score is
    the sum of its messages' scores (null: 0); ties go to the smaller leaf.
    ``turn`` counts from 0 at the root; null roles and texts come out empty.  Rows
    with a null tree or node are left out; of rows that repeat a (tree, node) the
    least by parent, role, text and score stays, nulls first.  A node is a root if
    its parent is null or not in the tree; nodes on cycles and below cycles reach
    none and are on no branch.  Leaves are scored and ranked before the chosen ones'
    branches are laid out.  Other columns are ignored; an empty table gives an
    empty result.
    """
    rest = F.struct("parent", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    nodes = nodes.where("tree is not null and node is not null").groupBy("tree", "node").agg(F.min(rest).alias("r"))
    nodes = durable(nodes.select("tree", "node", "r.parent", "r.role", "r.text", "r.score"))
    steps, leaves = climb(nodes)
    total = totals(nodes, steps, leaves)
    total = total.withColumn("rank", F.row_number().over(W.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")))
    total = durable(total if top is None else total.where(F.col("rank") <= top))
    leaves = total.select("tree", F.col("leaf").alias("node"))
    found = paths(steps, leaves).join(nodes.select("tree", "node", "role", "text"), ["tree", "node"])
    return found.join(total, ["tree", "leaf"]).select("tree", "leaf", "rank", "branch_score", (F.col("depth") - F.col("up")).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def format_branches(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """(tree, leaf, rank, branch_score, formatted, loss_spans): one conversation for each branch.

    ``loss_spans`` are the (start, end) code points in ``formatted`` of the texts,
    as escaped, of turns of the role ``learn``, end exclusive.  ``turns`` are those
    of :func:`branches`: no nulls, each (tree, leaf, turn) once; an empty table gives an empty result.
    """
    head = F.concat(F.lit(OPEN), role_name(F.col("role")), F.lit(": "))
    shown = turns.withColumn("head", head).withColumn("body", escape(F.col("text")))
    shown = shown.select("tree", "leaf", "rank", "branch_score", "turn", (F.col("role") == learn).alias("loss"), F.length("head").cast("long").alias("n"), F.length("body").cast("long").alias("m"), F.concat("head", "body", F.lit(CLOSE)).alias("shown"))
    order = W.partitionBy("tree", "leaf").orderBy("turn")
    shown = shown.withColumn("end", F.sum(F.length("shown").cast("long")).over(order) - len(CLOSE))
    span = F.when(F.col("loss"), F.struct((F.col("end") - F.col("m")).alias("start"), F.col("end").alias("end")))
    gathered = shown.groupBy("tree", "leaf", "rank", "branch_score").agg(F.sort_array(F.collect_list(F.struct("turn", "shown"))).alias("t"), F.sort_array(F.collect_list(span)).alias("loss_spans"))
    return gathered.select("tree", "leaf", "rank", "branch_score", F.array_join("t.shown", "").alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """(tree, leaf, turn, role, text, learned): the turns of formatted conversations; ``learned`` is a turn's text under the loss mask, null if it has none.

    ``formatted`` has tree, leaf, formatted and loss_spans, each (tree, leaf) once;
    a null or empty text has no turns, other columns are ignored, an empty table
    gives an empty result.
    """
    chunks = formatted.select("tree", "leaf", F.posexplode(F.split("formatted", CLOSE, -1)).alias("turn", "chunk")).where(F.col("chunk") != "")
    order = W.partitionBy("tree", "leaf").orderBy("turn")
    chunks = chunks.withColumn("begin", F.sum(F.length("chunk").cast("long") + len(CLOSE)).over(order) - F.length("chunk") - len(CLOSE))
    chunks = chunks.withColumn("name", F.regexp_extract("chunk", f"^{OPEN}([^:]*): ", 1)).withColumn("n", F.length("name") + len(OPEN) + 2)
    spans = formatted.select("tree", "leaf", F.explode("loss_spans").alias("s")).select("tree", "leaf", F.col("s.start").alias("start"), (F.col("s.end") - F.col("s.start")).alias("size"))
    body = chunks.select("tree", "leaf", "turn", "name", F.substring(F.col("chunk"), F.col("n") + 1, F.length("chunk")).alias("body"), (F.col("begin") + F.col("n")).alias("start"))
    masked = body.join(spans, ["tree", "leaf", "start"], "left")
    learned = F.when(F.col("size").isNotNull(), unescape(F.substring(F.col("body"), F.lit(1), F.col("size").cast("int"))))
    return masked.select("tree", "leaf", "turn", role_of(F.col("name")).alias("role"), unescape(F.col("body")).alias("text"), learned.alias("learned"))


def threads(messages: DataFrame) -> DataFrame:
    """Nodes of a table of plain conversations (conv_id, turn, role, text): each row replies to the one before.

    Rows are ordered by turn, nulls first, equal turns by role and text; a null
    text stays null here and counts as empty in a conversation.  Rows with a null
    conv_id are no conversation's and are left out.
    """
    order = W.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = messages.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("tree"), "turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def format_conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) for each conversation of ``messages``; see :func:`threads`.

    Extra columns are ignored; an empty table gives an empty result.
    """
    return format_branches(branches(threads(messages))).select(F.col("tree").alias("conv_id"), "leaf", "formatted", "loss_spans")
