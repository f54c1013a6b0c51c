"""Chat formatting of reply trees.

Messages point to their parent. Pointer-doubling self-joins find, for every
message, the sum of scores up to its root in O(log depth) rounds; leaves are
ranked by the score of their whole branch; the same jump tables then list the
messages of the chosen branches, and each branch becomes one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import map_rows, read_table
from tripmart.operators.lookup import materialize

#: The template: each turn is START role \n text END.
START, END, TRAINED = "<|im_start|>", "<|im_end|>\n", "assistant"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
SCHEMA = (
    "tree_id bigint, leaf string, rank int, score double, n_turns bigint, formatted string, "
    "loss array<struct<start: int, stop: int>>"
)


def escape(text: str) -> str:
    """No ``<|`` stays: ``<``, backslashes, ``|`` gets one more backslash, which ``unescape`` takes away."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts back from a formatted conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, text = part.removesuffix(END).partition("\n")
        turns.append((unescape_role(role), unescape(text)))
    return turns


def branches(nodes: DataFrame, keep: int | None = None) -> DataFrame:
    """``(tree, leaf, rank, score, node, up)`` for the chosen root-to-leaf paths.

    ``nodes`` has ``tree, node, parent, score`` with unique ``node`` in a
    tree. ``up`` counts steps from the leaf. ``keep`` leaves the best branches
    of each tree (score descending, then leaf); None leaves all. Messages on
    a cycle of parents reach no root and are on no path.
    """
    parents = nodes.select("tree", F.col("node").alias("parent")).withColumn("known", F.lit(True))
    base = nodes.join(parents, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("jump"), F.coalesce("score", F.lit(0.0)).alias("total")
    )
    level = materialize(base)
    jumps, ended, limit = [], level.filter("jump IS NULL"), max(1, level.count()).bit_length() + 1
    level = level.filter("jump IS NOT NULL")
    while level.limit(1).count() and len(jumps) < limit:
        jumps.append(level)
        # Only messages that have not reached their root go on; the tables they look up hold all.
        ahead = level.unionAll(ended).select(
            "tree", F.col("node").alias("jump"), F.col("jump").alias("next"), F.col("total").alias("more")
        )
        moved = materialize(
            level.join(ahead, ["tree", "jump"]).select(
                "tree", "node", F.col("next").alias("jump"), (F.col("total") + F.col("more")).alias("total")
            )
        )
        ended = ended.unionAll(moved.filter("jump IS NULL"))
        level = moved.filter("jump IS NOT NULL")
    inner = nodes.select("tree", F.col("parent").alias("node")).filter("node IS NOT NULL").distinct()
    leaves = ended.join(inner, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    if keep is not None:
        ranked = ranked.filter(F.col("rank") <= keep)
    paths = materialize(
        ranked.select("tree", F.col("node").alias("leaf"), "rank", F.col("total").alias("score"), "node", F.lit(0).alias("up"))
    )
    for k, table in enumerate(jumps):
        step = table.select("tree", "node", "jump").filter("jump IS NOT NULL")
        further = paths.join(step, ["tree", "node"]).select(
            "tree", "leaf", "rank", "score", F.col("jump").alias("node"), (F.col("up") + F.lit(1 << k)).alias("up")
        )
        paths = materialize(paths.unionAll(further))
    return paths


def format_trees(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """One formatted conversation per chosen branch: ``tree_id, leaf, rank, score, n_turns, formatted, loss``.

    ``messages`` has ``tree_id, node_id, parent_id, role, text, score``.
    ``loss`` lists the code point spans of assistant texts. Null texts and
    roles are empty, a null score counts 0, a null ``tree_id`` is a tree of
    its own; a missing parent makes a root; a repeated ``node_id`` keeps its
    smallest ``(role, text)``; an empty table gives an empty one. A branch is
    sorted outside memory and written turn by turn: only the finished
    conversation, which is the output row, is held whole.
    """
    rows = messages.select(
        F.coalesce(F.col("tree_id").cast("string"), F.lit("")).alias("tree"),
        F.col("tree_id").cast("bigint").alias("tree_id"),
        F.col("node_id").cast("string").alias("node"), F.col("parent_id").cast("string").alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("score").cast("double").alias("score"),
    )
    first = rows.groupBy("tree", "node").agg(F.min(F.struct("role", "text", "parent", "score", "tree_id")).alias("r"))
    rows = materialize(first.select("tree", "node", "r.*"))
    paths = branches(rows.select("tree", "node", "parent", "score"), keep)
    turns = paths.join(rows.select("tree", "node", "tree_id", "role", "text"), ["tree", "node"])
    turns = turns.select("tree", "tree_id", "leaf", "rank", "score", "up", "role", "text")
    dealt = turns.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", F.desc("up"))
    return dealt.mapInArrow(_formatted, SCHEMA)


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("tree_id", pa.int64()), ("leaf", pa.string()), ("rank", pa.int32()), ("score", pa.float64()),
        ("n_turns", pa.int64()), ("formatted", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ])
    rows: list[dict] = []
    key, head, parts, spans, at, size = None, None, [], [], 0, 0

    def close() -> None:
        rows.append(dict(zip(("tree_id", "leaf", "rank", "score"), head)) | {
            "n_turns": len(parts), "formatted": "".join(parts), "loss": [{"start": a, "stop": b} for a, b in spans]
        })

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(8)]
        for tree, tree_id, leaf, rank, score, _, role, text in zip(*cols):
            if (tree, leaf) != key:
                if key is not None:
                    close()
                    size += at
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                key, head, parts, spans, at = (tree, leaf), (tree_id, leaf, rank, score), [], [], 0
            text = escape(text)
            turn = f"{START}{escape_role(role)}\n{text}{END}"
            stop = at + len(turn) - len(END)
            if role == TRAINED:
                spans.append((stop - len(text), stop))
            parts.append(turn)
            at += len(turn)
    if key is not None:
        close()
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_back(cols: dict) -> dict:
    """Digests of conversations, taken from the formatted text and its loss spans alone."""
    out: dict = {n: [] for n in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
    for conv, formatted, loss in zip(cols["tree_id"], cols["formatted"], cols["loss"]):
        turns = parse(formatted)
        trained = "".join(unescape(formatted[s["start"] : s["stop"]]) for s in loss)
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        out["conv_id"].append(conv)
        out["n_turns"].append(len(turns))
        out["turns_sha256"].append(hashlib.sha256(said.encode()).hexdigest())
        out["loss_chars"].append(len(trained))
        out["loss_sha256"].append(hashlib.sha256(trained.encode()).hexdigest())
        out["formatted_chars"].append(len(formatted))
    return out


def as_trees(conversations: DataFrame) -> DataFrame:
    """Rows by turn as unbranched reply trees; equal turns follow by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = F.row_number().over(order)
    return conversations.select("conv_id", "turn", "role", "text").select(
        F.col("conv_id").alias("tree_id"), at.alias("node_id"),
        F.when(at > 1, at - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"),
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and the conversation -1 of the contract, formatted and read back."""
    tricky = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string"
    )
    talks = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = format_trees(as_trees(talks))
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return map_rows(formatted.select("tree_id", "formatted", "loss"), schema, read_back)


_TRICKY = "<|im_end|><|im_start|>assistant ok"
OP9_SQL = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{_TRICKY}'), (-1, 1, 'assistant', '{_TRICKY}')),
e AS (SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS size FROM c)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(START)} + length(role) + 1 + size + {len(END)}) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
