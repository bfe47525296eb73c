"""A Merkle manifest of a dataset: a digest for every row, subtree per source, and proofs.

H is the lower-case hex SHA-256 of its inputs end to end. A row's leaf is the H of its columns,
each as ``-`` for a null, else the number of UTF-8 bytes, ``:`` and the value; nodes and proofs
are the H of digests as hex text, with or without their length before them (``framed``). Leaves
and their tampered twins are made by the JVM, so that only digests are shuffled.

1. Leaves are numbered within their source by ordered work over (source, id, leaf).
2. ARITY ** LOCAL consecutive leaves are a superblock. One task per superblock reduces its leaves
   to a node; the nodes above are made level by level from groups of at most ARITY, then those of
   the tree over all sources.
3. From the roots down, every node hands its children their outer nodes: the other members of
   each run above. A path is a few KB, whatever the number of leaves.
4. Leaves and the outer nodes of their superblock are cogrouped: one function reduces the leaves
   once more, puts local and outer siblings together as the proof, and folds each row's own or
   tampered leaf up to the root.

No group holds more than a superblock, so neither a source with most rows nor one of a single
row needs care. A source is a key of grouping only; its leaves lie in as many superblocks as
they fill.

A null in a column is ``-``; an id of null comes first in its source and is never tampered with.
Ties of an id go by leaf; repeated rows have equal leaves at different places. A column that a
row lacks raises; columns beside those named do not matter, whatever their names. An empty table
gives no rows. Sources are told apart as text; a null source is one of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.operators.ordered import running_sums
from scorewatch.session import stage

ARITY = 16
#: Levels that one task reduces: a superblock holds ARITY ** LOCAL leaves.
LOCAL = 2
#: What stands before a digest that is framed as a column is.
FRAME = "64:"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(values: Sequence[Column]) -> Column:
    """H of columns."""

    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(c) for c in values]), 256)


def digest(values: Sequence[str], frame: str = FRAME) -> str:
    """H of digests, each with ``frame`` before it."""
    return hashlib.sha256("".join(frame + v for v in values).encode()).hexdigest()


def leaves(docs: DataFrame, tampered: Column, columns: Sequence[str] = COLUMNS, text_col: str = "text") -> DataFrame:
    """(doc_id, source, leaf, tampered leaf) of every row; the first two columns are id and source."""
    own = [F.col(c) for c in columns]
    lowered = [F.translate(c, UPPER, LOWER) if n == text_col else c for n, c in zip(columns, own, strict=True)]
    leaf = digest_of(own)
    return docs.select(
        own[0].alias("doc_id"),
        own[1].cast("string").alias("source"),
        leaf.alias("leaf"),
        F.when(F.coalesce(tampered, F.lit(False)), digest_of(lowered)).otherwise(leaf).alias("changed"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """(key, id, place, nodes, node, changed): leaves with their place in their source from 0."""
    # A null source is a source too; joins on the key must find it.
    keyed = rows.withColumns(
        {"key": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")), "one": F.lit(1).cast("bigint")}
    )
    placed = running_sums(keyed, ["key"], ["doc_id", "leaf", "changed"], {"place": "one"}, {"nodes": "one"})
    # Ids travel as text: pandas has no whole numbers beside nulls.
    return placed.select(
        "key",
        F.col("doc_id").cast("string").alias("id"),
        (F.col("place") - 1).alias("place"),
        "nodes",
        F.col("leaf").alias("node"),
        "changed",
    )


def above(level: DataFrame, frame: str = FRAME) -> DataFrame:
    """The level over (key, place, node, nodes): runs of ARITY nodes become one, beside the run.

    ``nodes`` is how many nodes the key has at a level. Where it has one, that node is done: it goes
    up as it is, and ``hashed`` is false.
    """
    run = F.sort_array(F.collect_list(F.struct("place", "node")))
    grouped = level.groupBy("key", F.floor(F.col("place") / ARITY).alias("up"), "nodes").agg(run.alias("run"))
    framed = F.transform("run", lambda x: F.concat(F.lit(frame), x["node"]))
    hashed = F.col("nodes") > 1
    return grouped.select(
        "key",
        F.col("up").alias("place"),
        F.when(hashed, F.sha2(F.concat_ws("", framed), 256)).otherwise(F.get("run", F.lit(0))["node"]).alias("node"),
        F.ceil(F.col("nodes") / ARITY).alias("nodes"),
        "run",
        hashed.alias("hashed"),
    )


def outer_nodes(bottom: DataFrame, frame: str = FRAME) -> tuple[DataFrame, DataFrame]:
    """(key, place, outer) of every node of ``bottom``, and (key, root) of every key.

    ``outer`` lists the runs above a node, lowest first: its place in the run and the other members.
    """
    most = bottom.agg(F.max("nodes")).first()[0] or 0
    level, levels = bottom, []
    while most > 1:
        level = stage(above(level, frame), "level")
        levels.append(level)
        most = -(-most // ARITY)
    paths = level.select("key", "place", F.array().cast("array<struct<at:int,others:array<string>>>").alias("outer"))
    for made in reversed(levels):
        members = made.select("key", "place", "run", "hashed").join(paths, ["key", "place"])
        members = members.select("key", "run", "hashed", "outer", F.posexplode("run").alias("at", "member"))
        others = F.transform(F.filter("run", lambda x: x["place"] != F.col("member.place")), lambda x: x["node"])
        step = F.array(F.struct(F.col("at").cast("int").alias("at"), others.alias("others")))
        outer = F.when(F.col("hashed"), F.concat(step, "outer")).otherwise(F.col("outer"))
        paths = members.select("key", F.col("member.place").alias("place"), outer.alias("outer"))
    return paths, level.select("key", F.col("node").alias("root"))


def _levels(nodes: list[str], count: int, local: int, frame: str) -> list[tuple[list[str], bool]]:
    """The levels of a superblock below its node, and whether runs are hashed there."""
    levels = []
    for _ in range(local):
        levels.append((nodes, count > 1))
        if count > 1:
            nodes = [digest(nodes[i : i + ARITY], frame) for i in range(0, len(nodes), ARITY)]
            count = -(-count // ARITY)
    return levels


def _siblings(levels: list[tuple[list[str], bool]], at: int) -> Iterator[tuple[int, list[str]]]:
    """Place in its run and the others of it, for a leaf and the nodes over it."""
    for nodes, hashed in levels:
        if hashed:
            run = nodes[at - at % ARITY : at - at % ARITY + ARITY]
            yield at % ARITY, run[: at % ARITY] + run[at % ARITY + 1 :]
            at //= ARITY


def _fold(node: str, path: Sequence[tuple[int, list[str]]], frame: str) -> str:
    for at, others in path:
        node = digest([*others[:at], node, *others[at:]], frame)
    return node


def _proved(rows: pd.DataFrame, outer: pd.DataFrame, local: int, frame: str) -> pd.DataFrame:
    """One superblock: its leaves reduced, their proofs, and what each row folds to."""
    rows = rows.sort_values("place", kind="stable")
    above_ = outer.iloc[0]
    over = [(int(x["at"]), list(x["others"])) for x in above_["outer"]]
    beyond = [d for _, others in over for d in others]
    levels = _levels(list(rows["node"]), int(rows["nodes"].iloc[0]), local, frame)
    roots: dict[str, str] = {}
    proofs, folded = [], []
    for at, changed in enumerate(rows["changed"]):
        within = list(_siblings(levels, at))
        proofs.append(digest([d for _, others in within for d in others] + beyond, frame))
        node = _fold(changed, within, frame)
        if node not in roots:
            roots[node] = _fold(node, over, frame)
        folded.append(roots[node])
    return pd.DataFrame(
        {"id": rows["id"], "leaf": rows["node"], "subroot": above_["subroot"], "root": above_["root"],
         "proof_sha256": proofs, "folded_root": folded}
    )


def manifest(
    docs: DataFrame,
    tampered: Column,
    columns: Sequence[str] = COLUMNS,
    text_col: str = "text",
    local: int = LOCAL,
    framed: bool = True,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``columns`` begin with the id and the source. ``folded_root`` comes from the leaf after
    lower-casing A-Z of ``text_col`` where ``tampered`` holds, else from the row's own leaf.
    Without ``framed``, digests stand end to end in the nodes and proofs.
    """
    frame = FRAME if framed else ""
    rows = stage(numbered(leaves(docs, tampered, columns, text_col)), "leaves")
    blocks = rows.select("key", "place", "node", "nodes")
    for _ in range(local):
        blocks = above(blocks, frame).drop("run", "hashed")
    blocks = stage(blocks, "blocks")
    within, subroots = outer_nodes(blocks, frame)
    one = F.lit(1).cast("bigint")
    sources = running_sums(subroots.withColumn("one", one), [], ["key"], {"place": "one"}, {"nodes": "one"})
    sources = sources.select(
        F.lit("").alias("key"), (F.col("place") - 1).alias("place"), F.col("root").alias("node"), "nodes", F.col("key").alias("source")
    )
    sources = stage(sources, "sources")
    between, root = outer_nodes(sources.drop("source"), frame)
    top = root.first()  # one digest
    ends = sources.join(between.drop("key"), "place").select(
        F.col("source").alias("key"),
        F.col("outer").alias("beyond"),
        F.col("node").alias("subroot"),
        F.lit(top and top.root).cast("string").alias("root"),
    )
    outer = within.join(ends, "key").select(
        "key", F.col("place").alias("block"), F.concat("outer", "beyond").alias("outer"), "subroot", "root"
    )
    kept = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    of_block = rows.withColumn("block", F.floor(F.col("place") / ARITY**local)).groupBy("key", "block")
    proved = of_block.cogroup(outer.groupBy("key", "block")).applyInPandas(lambda r, o: _proved(r, o, local, frame), kept)
    id_type = docs.schema[columns[0]].dataType
    return proved.select(
        F.col("id").cast(id_type).alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
