"""Chat formatting: reply trees to one text a chosen path, with the mask of what is learned.

A message answers its parent; a parent that is null or not in the tree makes a root. Iterative
self-joins double jump tables (node, its ancestor 2^k above) until none reaches further, so a tree of
depth d takes log2(d) joins. Leaves walk the tables to their root, adding up how far each message's
score lies below that of its best sibling; the paths of a tree are ranked by that sum, then by the leaf's score and id, and
the first `keep` are formatted (all, with None). Only the chosen leaves are written out, by the same
tables from the widest jump down, and only then do texts join in.

A turn is written `### role: text</turn>` and a line feed. Inside roles and texts a backslash, a `#` after
a `#`, the `/` of `</turn>` and, in roles, a colon get a backslash before them, so neither `##` nor
`</turn>` can occur there, and taking one backslash from each escape gives the text back. The mask has
(start, stop) in code points, one for each turn of a learned role, around its escaped text.

Only DataFrame functions are used. Joins and windows are on (tree, message) or (tree, leaf), so a tree with a
third of all rows is spread; siblings are compared by a maximum that is formed before the shuffle;
only a formatted path, which is one row of the result, is gathered.

Null roles and texts are empty. A null or not finite score counts as 0. Rows without an id are named by what they hold;
of rows equal in tree and id one stays, the greatest in score, role and text. A null tree is a tree like
others. Messages whose ancestors form a circle have no root and are on no path. An empty table gives no rows; very
long texts are whole; other columns are ignored. `chains` makes messages of rows by turn: each
answers the row before it, in the order of turn (null first), role and text; there, repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
LEARNED = ("assistant",)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|(?<=#)#|(?<=<)/(?=turn>)", r"\\$0")


def escaped_role(role: Column) -> Column:
    return F.regexp_replace(role, r"\\|(?<=#)#|(?<=<)/(?=turn>)|:", r"\\$0")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def messages(rows: DataFrame, tree: str = "tree_id", node: str = "message_id", parent: str = "parent_id", role: str = "role", text: str = "text", score: str | None = "score") -> DataFrame:
    """tree_, node_, parent_, role_, text_, score_, one row a message."""
    worth = F.col(score).cast("double") if score else F.lit(0.0)
    worth = F.when(worth.isNull() | F.isnan(worth) | (F.abs(worth) == float("inf")), 0.0).otherwise(worth)
    own = rows.select(F.col(tree).cast("string").alias("tree_"), F.col(node).cast("string").alias("id_"), F.col(parent).cast("string").alias("parent_"), _or_empty(role).alias("role_"), _or_empty(text).alias("text_"), worth.alias("score_"))
    name = F.coalesce(F.concat(F.lit("="), "id_"), F.sha2(F.to_json(F.struct("tree_", "parent_", "role_", "text_", "score_")), 256))
    own = own.withColumn("node_", name).withColumn("parent_", F.concat(F.lit("="), "parent_"))
    best = own.groupBy("tree_", "node_").agg(F.max(F.struct("score_", "role_", "text_", "parent_")).alias("best_"))
    return best.select("tree_", "node_", "best_.*")


def chains(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of conversations that are rows by turn."""
    own = rows.select(F.col(tree).cast("string").alias("tree_"), F.col(turn).alias("turn_"), _or_empty(role).alias("role_"), _or_empty(text).alias("text_"))
    place = F.row_number().over(Window.partitionBy("tree_").orderBy(F.col("turn_").asc_nulls_first(), "role_", "text_"))
    own = own.withColumn("place_", place)
    return own.select("tree_", F.col("place_").cast("string").alias("node_"), F.when(F.col("place_") > 1, F.col("place_") - 1).cast("string").alias("parent_"), "role_", "text_", F.lit(0.0).alias("score_"))


def _same(left: DataFrame, right: DataFrame, how: str = "inner", **on: str) -> DataFrame:
    """Join on the tree, null as a value, and the named columns. right's are dropped."""
    pairs = {"tree_": "tree_"} | on
    right = right.select(*(F.col(r).alias(f"r{i}_") for i, r in enumerate(pairs.values())), *(c for c in right.columns if c not in pairs.values()))
    met = F.lit(True)
    for i, name in enumerate(pairs):
        met = met & (F.col(name).eqNullSafe(F.col(f"r{i}_")) if name == "tree_" else F.col(name) == F.col(f"r{i}_"))
    made = left.join(right, met, how)
    return made if how in ("left_semi", "left_anti") else made.drop(*(f"r{i}_" for i in range(len(pairs))))


def jumps(nodes: DataFrame) -> list[DataFrame]:
    """Tables k = 0, 1, ... of (tree_, node_, up_, cost_): the message 2^k above, and the cost of the steps
    from node_ to just below it."""
    most = nodes.count()
    one = nodes.where("parent_ IS NOT NULL").select("tree_", "node_", F.col("parent_").alias("up_"), "cost_")
    made = []
    # a chain without a circle has fewer steps than there are messages
    while (1 << len(made)) <= most and not one.isEmpty():
        made.append(cut(one, f"jump{len(made)}", tidy=False))
        further = made[-1].select("tree_", "node_", F.col("up_").alias("up2_"), F.col("cost_").alias("cost2_"))
        one = _same(made[-1], further, up_="node_").select("tree_", "node_", F.col("up2_").alias("up_"), (F.col("cost_") + F.col("cost2_")).alias("cost_"))
        one = cut(one, "further", tidy=False)
    return made


def paths(said: DataFrame, keep: int | None = 1) -> DataFrame:
    """tree_, leaf_, rank_ (from 1; null if all are kept), node_, above_ (messages between leaf and node)."""
    ids = said.select("tree_", "node_", "parent_", "score_")
    there = ids.select("tree_", "node_")
    answers = _same(ids.where("parent_ IS NOT NULL"), there, "left_semi", parent_="node_").select("tree_", "node_", F.col("parent_").alias("found_"))
    ids = _same(ids.drop("parent_"), answers.withColumnRenamed("found_", "parent_"), "left", node_="node_")
    best = ids.groupBy("tree_", "parent_").agg(F.max("score_").alias("most_")).withColumnRenamed("parent_", "above_").withColumnRenamed("tree_", "tree2_")
    ids = ids.join(best, F.col("tree_").eqNullSafe(F.col("tree2_")) & F.col("parent_").eqNullSafe(F.col("above_"))).drop("tree2_", "above_")
    nodes = cut(ids.withColumn("cost_", F.col("most_") - F.col("score_")).drop("most_"), "messages", tidy=False)
    tables = jumps(nodes)
    parents = nodes.where("parent_ IS NOT NULL").select("tree_", "parent_")
    leaves = _same(nodes, parents, "left_anti", node_="parent_").select("tree_", F.col("node_").alias("leaf_"), F.col("node_").alias("at_"), F.lit(0.0).alias("sum_"), "score_")
    for up in reversed(tables):
        leaves = _same(leaves, up, "left", at_="node_")
        leaves = leaves.withColumns({"at_": F.coalesce("up_", "at_"), "sum_": F.col("sum_") + F.coalesce("cost_", F.lit(0.0))}).drop("up_", "cost_")
    # what is left at a message that answers another is below a circle; a root adds its own cost
    roots = nodes.where("parent_ IS NULL").select("tree_", "node_", "cost_")
    chosen = _same(leaves, roots, at_="node_").select("tree_", "leaf_", (F.col("sum_") + F.col("cost_")).alias("sum_"), "score_")
    if keep is None:
        chosen = chosen.select("tree_", "leaf_", F.lit(None).cast("int").alias("rank_"))
    else:
        order = Window.partitionBy("tree_").orderBy("sum_", F.desc("score_"), "leaf_")
        chosen = chosen.withColumn("rank_", F.row_number().over(order)).where(F.col("rank_") <= keep).select("tree_", "leaf_", "rank_")
    chosen = cut(chosen, "leaves", tidy=False)
    on = chosen.select("tree_", "leaf_", "rank_", F.col("leaf_").alias("node_"), F.lit(0).cast("long").alias("above_"))
    for k in range(len(tables) - 1, -1, -1):
        further = _same(on, tables[k].drop("cost_"), node_="node_")
        further = further.select("tree_", "leaf_", "rank_", F.col("up_").alias("node_"), (F.col("above_") + (1 << k)).alias("above_"))
        on = cut(on.unionByName(further), f"path{k}", tidy=False)
    return on


def formatted(said: DataFrame, keep: int | None = 1, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row per chosen path: tree_, leaf_, rank_, n_turns, formatted, mask (array of start, stop)."""
    on = paths(said, keep)
    rows = _same(on, said.select("tree_", "node_", "role_", "text_"), node_="node_")
    head = F.concat(F.lit(HEAD), escaped_role(F.col("role_")), F.lit(MIDDLE))
    rows = rows.withColumns({"head_": head, "body_": escaped(F.col("text_"))})
    long_ = F.length("head_").cast("long") + F.length("body_") + len(END)
    path = Window.partitionBy("tree_", "leaf_").orderBy(F.desc("above_")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("stop_", F.sum(long_).over(path) - len(END))
    turn = F.struct(
        (-F.col("above_")).alias("k"), F.concat("head_", "body_", F.lit(END)).alias("said"),
        F.when(F.col("role_").isin(*learned), F.struct((F.col("stop_") - F.length("body_")).alias("start"), F.col("stop_").alias("stop"))).alias("span"),
    )
    made = rows.groupBy("tree_", "leaf_", "rank_").agg(F.count("*").alias("n_turns"), F.array_sort(F.collect_list(turn)).alias("turns_"))
    return made.select("tree_", "leaf_", "rank_", "n_turns", F.array_join(F.transform("turns_", lambda t: t["said"]), "").alias("formatted"), F.array_compact(F.transform("turns_", lambda t: t["span"])).alias("mask"))


def from_replies(rows: DataFrame, keep: int | None = 1, learned: tuple[str, ...] = LEARNED, **columns) -> DataFrame:
    """Reply trees: tree_, leaf_, rank_, n_turns, formatted, mask of each tree's `keep` best paths."""
    return formatted(messages(rows, **columns), keep, learned)


def turns(text: Column) -> Column:
    """The turns of a formatted text, read back: array of (role, text)."""
    parts = F.split(text, END)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    role = r"(?s)^### ((?:[^\\:]++|\\.)*+): (.*+)$"
    return F.transform(parts, lambda p: F.struct(unescaped(F.regexp_extract(p, role, 1)).alias("role"), unescaped(F.regexp_extract(p, role, 2)).alias("text")))


def learned_text(text: Column, mask: Column) -> Column:
    """What is under the mask, escapes taken back."""
    under = F.transform(mask, lambda m: unescaped(F.substring(text, (m["start"] + 1).cast("int"), (m["stop"] - m["start"]).cast("int"))))
    return F.array_join(under, "")


def digests(made: DataFrame) -> DataFrame:
    """tree_ with n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the text and its mask."""
    rows = made.select("tree_", "formatted", turns(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("mask")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "tree_", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = r"\### Assistant: </turn> ok"
    two = F.inline(F.array(*(F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(planted).alias("text")) for k, role in enumerate(("user", "assistant")))))
    said = chains(own.unionByName(spark.range(1).select(two)))
    return digests(formatted(said)).select(F.col("tree_").cast("long").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text)) AS k,
  replace(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '##', '#\#'), '</turn>', '<\/turn>') AS body,
  replace(replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '##', '#\#'), '</turn>', '<\/turn>'), ':', '\:') AS head FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(head) + length(body) + 14)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""
