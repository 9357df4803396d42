"""Merkle dataset manifest as a postorder append log, with proofs and a tamper test.

Every row of a table is a leaf: H (lowercase hex SHA-256 of the inputs concatenated) of its fields,
each ``-`` when null, else its UTF-8 byte count, ``:`` and its value. Per group (here: lang), leaves
ascend by key (doc_id, then leaf for equal keys); while several nodes remain, every two consecutive
ones become H of their concatenated digests, and a last one alone becomes H of itself. The
remaining node (a lone leaf itself) is the group's subroot; subroots, ordered by group (null first,
UTF-8 bytewise), give the root alike.

How it is built. The tree of a group with n leaves is aligned: the node at (level k, index j)
covers leaves j * 2^k up to (j + 1) * 2^k or n. So a block of 2^B consecutive items, B =
``BLOCK_LEVELS``, holds its whole subtree: one builder task per (group, block) hashes it and writes
its nodes in completion order (postorder) to the log. The block roots are the next round's items,
until each group has one node. A hot group thus spreads over n / 2^B tasks, never one. A node's
place in the group's postorder log has a closed form from subtree sizes,

    pos(k, j) = sum_{m <= k} ceil(E / 2^m) + sum_{k < m <= L} floor((E - 1) / 2^m) - 1,
    E = min((j + 1) * 2^k, n),  L = ceil(log2 n),

and a builder reads siblings for the proofs by that position. A proof lists, level by level from
the item up, the sibling's side and digest (``L``/``R`` + hex) or ``S`` where the node stood
alone. Proofs of block roots (small tables) are joined onto the rows once, by (group, block).
The rank of a row in its group comes from a range partitioning by (group, key): a partition's
first position and count per group give offsets by a window over a few rows per group.

Defined cases: nulls in any field hash as ``-``; a null doc_id sorts first; repeated rows are
separate leaves next to each other; an empty table gives no rows; a group of one leaf has that
leaf as subroot and an empty proof part; extra input columns are ignored.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderline.llm.common import written

BLOCK_LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOW = (1 << 33) - 1


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text (integers decimal)."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*(field(c) for c in (doc_id, source, lang, n_chars, text))), 256)


def tampered(doc_id: Column) -> Column:
    """Rows to tamper with: 7 divides the unsigned CRC-32 of the decimal doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False))


def levels_of(n: int) -> int:
    return int(n - 1).bit_length() if n > 1 else 0


def positions(k: int, j: np.ndarray, n: int) -> np.ndarray:
    """Closed-form postorder positions of nodes (k, j) in the aligned tree over n leaves."""
    top = levels_of(n)
    end = np.minimum((j.astype(np.int64) + 1) << k, n)
    pos = np.full(len(j), -1, dtype=np.int64)
    for m in range(0, top + 1):
        pos += -((-end) >> m) if m <= k else (end - 1) >> m
    return pos


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


SCHEMA = (
    "kind string, tree string, level int, idx long, pos long, digest string, path array<string>, "
    "own_id long, own_text string, n long, base int"
)


def _build(key: tuple, block: pd.DataFrame, span: int) -> pd.DataFrame:
    """One aligned block of 2^span items: its nodes in postorder positions, each item's path inside it, its root."""
    tree = key[0]
    block = block.sort_values("idx", kind="stable")
    n, base = int(block["n"].iloc[0]), int(block["base"].iloc[0])
    top_level = levels_of(n)
    top = min(base + span, top_level)
    idx = block["idx"].to_numpy(dtype=np.int64)
    start = int(idx[0])
    cur = block["digest"].tolist()
    log: dict[int, str] = dict(zip(positions(base, idx, n).tolist(), cur))
    rows = []
    if base == 0:
        for j, p, d in zip(idx.tolist(), positions(0, idx, n).tolist(), cur):
            rows.append(("node", tree, 0, j, p, d, None, None, None, n, 0))
    for k in range(base + 1, top + 1):
        cur = [_h(cur[t] + cur[t + 1]) if t + 1 < len(cur) else _h(cur[t]) for t in range(0, len(cur), 2)]
        start >>= 1
        js = np.arange(start, start + len(cur), dtype=np.int64)
        for j, p, d in zip(js.tolist(), positions(k, js, n).tolist(), cur):
            log[p] = d
            rows.append(("node", tree, k, j, p, d, None, None, None, n, k))
    counts = {k: -((-n) >> k) for k in range(base, top + 1)}
    for j0, digest, own_id, own_text in zip(idx.tolist(), block["digest"].tolist(), block["own_id"].tolist(), block["own_text"].tolist()):
        path = []
        for k in range(base, top):
            j = j0 >> (k - base)
            other = j ^ 1
            if other >= counts[k]:
                path.append("S")
            else:
                path.append(("L" if j & 1 else "R") + log[int(positions(k, np.array([other]), n)[0])])
        rows.append(("path", tree, base, j0, None, digest, path, own_id, own_text, n, base))
    if top < top_level:
        rows.append(("next", tree, top, start, None, cur[0], None, None, None, n, top))
    frame = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in SCHEMA.split(", ")])
    return frame.astype({"level": "int32", "base": "int32"})


def ranked(items: DataFrame, order: list[str], label: str) -> DataFrame:
    """Items with ``idx``, their 0-based rank by ``order`` within ``tree``, and ``n``, the tree's size."""
    laid = (
        items.repartitionByRange("tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("mid", F.monotonically_increasing_id())
    )
    laid = written(laid, label).withColumn("part", F.shiftright("mid", 33)).withColumn("at", F.col("mid").bitwiseAND(F.lit(_LOW)))
    runs = laid.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("count"))
    runs = runs.select(
        F.col("tree").alias("run_tree"), F.col("part").alias("run_part"), "first",
        F.coalesce(F.sum("count").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("count").over(Window.partitionBy("tree")).alias("n"),
    )
    joined = laid.join(runs, laid["tree"].eqNullSafe(runs["run_tree"]) & (laid["part"] == runs["run_part"]))
    return joined.select(*items.columns, (F.col("before") + F.col("at") - F.col("first")).alias("idx"), "n")


def tree_of(items: DataFrame, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Build the trees of ``items`` (tree, idx, n, digest, own_id, own_text) round by round.

    Returns the node log (all rounds), every item's whole path to its tree's root, and the roots.
    """
    span = BLOCK_LEVELS
    current = items.select("tree", "idx", "n", "digest", "own_id", "own_text", F.lit(0).alias("base"))
    logs, paths = [], []
    while True:
        grouped = current.groupBy("tree", F.shiftright("idx", span).alias("block"))
        built = written(grouped.applyInPandas(lambda key, frame: _build(key, frame, span), SCHEMA), f"{label}-round")
        logs.append(built.where("kind = 'node'").select("tree", "level", "idx", "pos", "digest", "n"))
        paths.append(built.where("kind = 'path'").select("tree", "idx", "digest", "path", "own_id", "own_text"))
        current = built.where("kind = 'next'").select("tree", "idx", "n", "digest", "own_id", "own_text", "base")
        if current.isEmpty():
            break
    upper = None
    for part in reversed(paths[1:]):
        if upper is not None:
            part = part.alias("p").join(
                upper.alias("u"),
                F.col("p.tree").eqNullSafe(F.col("u.tree")) & (F.shiftright(F.col("p.idx"), span) == F.col("u.idx")),
                "left",
            ).select("p.tree", "p.idx", F.concat(F.col("p.path"), F.coalesce(F.col("u.path"), F.array().cast("array<string>"))).alias("path"))
        upper = part.select("tree", "idx", "path")
    whole = paths[0]
    if upper is not None:
        whole = whole.alias("p").join(
            upper.alias("u"),
            F.col("p.tree").eqNullSafe(F.col("u.tree")) & (F.shiftright(F.col("p.idx"), span) == F.col("u.idx")),
            "left",
        ).select("p.tree", "p.idx", "p.digest", F.concat(F.col("p.path"), F.coalesce(F.col("u.path"), F.array().cast("array<string>"))).alias("path"), "p.own_id", "p.own_text")
    log = logs[0]
    for more in logs[1:]:
        log = log.unionByName(more)
    top = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    roots = log.where((F.col("level") == top) & (F.col("idx") == 0)).select("tree", "digest")
    return log, whole, roots


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` and the path's siblings give, level by level."""
    return F.aggregate(
        path,
        start,
        lambda acc, x: F.when(F.substring(x, 1, 1) == "L", F.sha2(F.concat(F.substring(x, 2, 64), acc), 256))
        .when(F.substring(x, 1, 1) == "R", F.sha2(F.concat(acc, F.substring(x, 2, 64)), 256))
        .otherwise(F.sha2(acc, 256)),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (from the tampered leaf), verified."""
    rows = docs.select(*(F.col(c).alias(f"f_{c}") for c in FIELDS))
    base = rows.select(
        F.col("f_lang").alias("tree"), F.col("f_doc_id").alias("own_id"),
        leaf_of(*(F.col(f"f_{c}") for c in FIELDS)).alias("digest"),
        leaf_of(F.col("f_doc_id"), F.col("f_source"), F.col("f_lang"),
                F.when(tampered(F.col("f_doc_id")), F.col("f_n_chars") + 1).otherwise(F.col("f_n_chars")), F.col("f_text")).alias("own_text"),
    )
    leaves = ranked(base, ["own_id", "digest"], "manifest-leaves")
    _, paths, subroots = tree_of(leaves, "manifest-groups")
    tops = ranked(subroots.select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("lang"), "digest", F.lit(None).cast("long").alias("own_id"),
                                  F.col("tree").alias("own_text")), ["lang"], "manifest-subroots")
    _, top_paths, root = tree_of(tops.drop("lang"), "manifest-top")
    found = root.limit(2).collect()
    root_value = found[0]["digest"] if found else None
    sub = subroots.select(F.col("tree").alias("s_tree"), F.col("digest").alias("subroot"))
    upper = top_paths.select(F.col("own_text").alias("t_tree"), F.col("path").alias("t_path"))
    out = (
        paths.join(sub, paths["tree"].eqNullSafe(sub["s_tree"]), "left")
        .join(upper, paths["tree"].eqNullSafe(upper["t_tree"]), "left")
    )
    whole = F.concat(F.col("path"), F.coalesce(F.col("t_path"), F.array().cast("array<string>")))
    out = out.select(
        F.col("own_id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", F.lit(root_value).cast("string").alias("root"),
        F.sha2(F.array_join(F.transform(whole, lambda x: F.substring(x, 2, 64)), ""), 256).alias("proof_sha256"),
        folded(F.col("own_text"), whole).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
