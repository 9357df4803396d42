"""N-gram Jaccard self-join of documents and its groups: a size-aware heavy-light join.

Two documents link when 100 * |A and B| >= 75 * |A or B| for their shingle sets, which is the same
as sharing ceil(3 (|A| + |B|) / 7) shingles. Equal sets are one set from the start.

* Small sets (up to a size chosen by cost from the number of sets of each size) enumerate their
  subsets of the sizes that a partner could require; sharing such a subset is the link.
* Large sets are found by inverted lists. Shingles are ordered by how often they occur (a sketch
  of fixed size, summed over all sets), and a set stands in the lists of its rarest shingles: as
  many as it can miss, plus one, so linked sets meet in at least one list, and passages that very
  many documents share stay out of the lists.

Only the groups are asked for, so lists need not be expanded into all pairs: in up to four rounds each
list tests its members against one leader, groups are formed, and lists within one group are laid
aside; a round without a link ends this. A last exact round tests the pairs of each list that
still lie in different groups. There, lists of many members are cut into blocks that meet in twos;
parity bitmaps, whose difference can only underestimate the sets' difference, tell which members may
link, and those meet again with their sets and give only the links that join groups: less than one
per member, however many pairs of the group link. Shorter lists give their pairs.

Scale: texts are read twice to hash shingles. Pairs are first compared by bitmaps of a few hundred
bytes; only for pairs that these leave, texts are shuffled, once per round, and their sets made
again. Postings (a quarter of the shingles, three longs each) and such a round are the largest
shuffles. Copies in one task post once. The sketch is 2 MB whatever the input; nothing else is collected but counts
of small sizes. Groups are found by star contraction on tables.

Defined cases: null or blank texts have no shingles, link with nothing and are their own group;
a text of under five words has its whole word sequence as its one shingle; repeated rows link
with each other; rows with a null id take the smallest id of their group, null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, groupby
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tenderline.llm.common import mixed, removed, written
from tenderline.llm.shingles import set_id, shingle_sets

CELLS, BLOCKS = 1 << 18, 256
#: Sizes considered for enumeration, and what a posting costs against an enumerated subset.
LARGEST_ENUMERATED, POSTING_COST = 24, 8
#: Members of a list above which the exact round uses bitmaps, and per block of such a list.
LONG_LIST, BLOCK = 256, 1024
ROUNDS = 4
#: Rows of short lists paired at a time, and the columns of a member of a long list.
CHUNK_ROWS = 1 << 16
LONG = ["key", "low", "high", "block", "set", "n", "need", "label"]


def needed(n: int, m: int) -> int:
    """Shingles that sets of these sizes must share."""
    return -(-3 * (n + m) // 7)


def prefix_size(n: int) -> int:
    return n - -(-3 * n // 4) + 1 if n else 0


def subset_sizes(n: int) -> set[int]:
    return {needed(n, m) for m in range(ceil(0.75 * n), n * 4 // 3 + 1)}


def boundary(sets_of_size: dict[int, int]) -> int:
    """Largest size to enumerate: where enumeration and lists together cost least."""
    def cost(limit: int) -> int:
        total = 0
        for n, count in sets_of_size.items():
            listed = n > limit or 4 * n >= 3 * (limit + 1)
            total += count * ((sum(comb(n, c) for c in subset_sizes(n)) if n <= limit else 0) + (POSTING_COST * prefix_size(n) if listed else 0))
        return total

    return min(range(LARGEST_ENUMERATED + 1), key=lambda limit: (cost(limit), limit))


def _cell(own: np.ndarray) -> np.ndarray:
    return (own >> np.uint64(46)).astype(np.int64)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text (row, n, set, and the bitmap at a set's first row in the task), and at the
    end the task's counts of shingles by cell."""
    counts, seen = np.zeros(CELLS, dtype=np.int64), set()
    names = ["doc_id", "row", "n", "set", "bits", "block", "cells"]
    for batch in batches:
        sizes, ids, bits = [], [], []
        for own in shingle_sets(batch.column(2).to_pylist()):
            name = set_id(own) if len(own) else None
            sizes.append(len(own))
            ids.append(name)
            fresh = name is not None and name not in seen
            bits.append(bitmap(own) if fresh else None)
            if fresh:
                seen.add(name)
                np.add.at(counts, _cell(own), 1)
        size = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, type=pa.int64()), pa.array(ids, type=pa.int64()), pa.array(bits, type=pa.binary()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())],
            names=names,
        )
    parts = counts.astype(np.uint32).reshape(BLOCKS, -1)
    used = [i for i in range(BLOCKS) if parts[i].any()]
    none = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
    yield pa.RecordBatch.from_arrays([*none, pa.array(used, type=pa.int32()), pa.array([parts[i].tobytes() for i in used], type=pa.binary())], names=names)


def _summed(key, batches):
    import pandas as pd

    total = np.zeros(CELLS // BLOCKS, dtype=np.int64)
    for own in batches["cells"]:
        total += np.frombuffer(own, dtype=np.uint32)
    return pd.DataFrame({"block": [key[0]], "cells": [total.tobytes()]})


def _postings(batches: Iterator[pa.RecordBatch], counts: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """(key, set, n, need): subsets of small sets with their size, lists of rare shingles with 0."""
    seen: set[int] = set()
    for batch in batches:
        keys, sets, sizes, needs = [], [], [], []
        for own in shingle_sets(batch.column(0).to_pylist()):
            n = len(own)
            name = set_id(own) if n else None
            if name is None or name in seen:
                continue
            seen.add(name)
            if n <= limit:
                spread = mixed(own).tolist()
                for c in subset_sizes(n):
                    found = np.array([sum(s) & 0xFFFFFFFFFFFFFFFF for s in combinations(spread, c)], dtype=np.uint64)
                    keys.append(mixed(found + np.uint64(c)))
                    needs.append(np.full(len(found), c, dtype=np.int32))
            if n > limit or 4 * n >= 3 * (limit + 1):
                rare = own[np.lexsort((own, counts[_cell(own)]))[: prefix_size(n)]]
                keys.append(rare)
                needs.append(np.zeros(len(rare), dtype=np.int32))
            made = sum(map(len, keys)) - sum(map(len, sets))
            sets.append(np.full(made, name, dtype=np.int64))
            sizes.append(np.full(made, n, dtype=np.int32))
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sets)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(needs))],
                names=["key", "set", "n", "need"],
            )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys that two or more sets hold, from rows sorted by key and set."""
    held: list[np.ndarray] | None = None
    held_shared = False
    names = ["key", "set", "n", "need"]
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if not len(columns[0]):
            continue
        if held is not None:
            columns = [np.concatenate((h, c)) for h, c in zip(held, columns)]
        key, name = columns[0], columns[1]
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])))
        columns = [c[fresh] for c in columns]
        key = columns[0]
        same = key[1:] == key[:-1]
        before = np.concatenate(([held_shared], same))
        out = (before[:-1] | same).nonzero()[0]
        held, held_shared = [c[-1:] for c in columns], bool(before[-1])
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in columns], names=names)
    if held is not None and held_shared:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=names)


def bitmap(own: np.ndarray) -> bytes:
    """Parity of the shingles by the low bits of their hashes; at least four bits per shingle."""
    size = max(256, 1 << (4 * len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows of bitmaps folded to ``size`` bytes."""
    return bits if bits.shape[1] == size else np.bitwise_xor.reduce(bits.reshape(len(bits), -1, size), axis=1)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets (set, members) of texts, each once per task."""
    seen: set[int] = set()
    for batch in batches:
        sets = {name: own for own in shingle_sets(batch.column(0).to_pylist()) if (name := set_id(own)) not in seen}
        seen.update(sets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sets), type=pa.int64()), pa.array([own.tobytes() for own in sets.values()], type=pa.binary())], names=["set", "members"]
        )


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n_a, n_b, bits_a, bits_b) whose bitmaps do not rule a link out."""
    for batch in batches:
        keep = []
        for i, (n, m, x, y) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(2, 6)])):
            size = min(len(x), len(y))
            a, b = (_folded(np.frombuffer(v, dtype=np.uint8)[None, :], size) for v in (x, y))
            if 4 * min(n, m) >= 3 * max(n, m) and 7 * int(np.bitwise_count(a ^ b).sum()) <= n + m:
                keep.append(i)
        picked = batch.take(pa.array(keep, type=pa.int64()))
        yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1)], names=["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, members_a, members_b) that share enough shingles."""
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            if len(np.intersect1d(a, b, assume_unique=True)) >= needed(len(a), len(b)):
                keep.append(i)
        picked = batch.take(pa.array(keep, type=pa.int64()))
        yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1)], names=["a", "b"])


def _worth_a_test(n: np.ndarray, m: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes that meet under a key may link."""
    return (4 * np.minimum(n, m) >= 3 * np.maximum(n, m)) & ((need == 0) | (7 * need >= 3 * (n + m)))


def _pairs_between_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) in different groups of each short list, from rows (key, set, n, need, label) sorted by key."""
    def pairs(key, name, n, need, label) -> list[np.ndarray]:
        found, step, i = [], 1, np.arange(len(key))
        while len(i):  # the lists that still have a member this many places on
            i = i[i + step < len(key)]
            i = i[key[i] == key[i + step]]
            j = i + step
            fine = (label[i] != label[j]) & _worth_a_test(n[i], n[j], need[i])
            if fine.any():
                x, y = name[i[fine]], name[j[fine]]
                found.append(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1))
            step += 1
        return found

    def out(found: list[np.ndarray]) -> pa.RecordBatch:
        both = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])

    held: list[list[np.ndarray]] = []
    size, found, waiting = 0, [], 0
    for batch in chain(batches, [None]):
        if batch is not None:
            held.append([column.to_numpy(zero_copy_only=False).astype(np.int64) for column in batch.columns])
            size += batch.num_rows
            if size < CHUNK_ROWS:
                continue
        if size:
            rows = [np.concatenate(c) for c in zip(*held)]
            done = size if batch is None else int(np.searchsorted(rows[0], rows[0][-1]))  # the last list may go on
            made = pairs(*[c[:done] for c in rows])
            held, size = [[c[done:] for c in rows]], size - done
            found += made
            waiting += sum(map(len, made))
        if found and (batch is None or waiting > 200_000):
            yield out(found)
            found, waiting = [], 0


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each (key, low, high), from rows that begin with and are sorted by those three."""
    rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns]))
    for _, run in groupby(rows, key=lambda row: row[:3]):
        yield list(run)


def _near_members(run: list[tuple], bitmaps: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(i, all j) of a run's members in different groups whose bitmaps do not rule a link out, each pair once.

    Rows begin with key, low, high, block, set, n, need, label.
    """
    low, high = run[0][1], run[0][2]
    block, _, n, need, label = (np.array([row[i] for row in run], dtype=np.int64) for i in range(3, 8))
    width = np.array([len(b) for b in bitmaps])
    for u in np.unique(width):
        for v in np.unique(width):
            if v < u or v > 2 * u:
                continue
            left, right = np.flatnonzero(width == u), np.flatnonzero(width == v)
            bits, others = (np.frombuffer(b"".join(bitmaps[i] for i in side), dtype=np.uint8).reshape(len(side), -1) for side in (left, right))
            bits, others = bits.view(np.uint64), np.ascontiguousarray(_folded(others, u)).view(np.uint64)
            for p, i in enumerate(left):
                at = np.flatnonzero(right > i) if u == v else np.arange(len(right))
                j = right[at]
                fine = (label[j] != label[i]) & _worth_a_test(n[i], n[j], need[i])
                if low != high:
                    fine &= block[j] != block[i]
                j, at = j[fine], at[fine]
                if len(j):
                    j = j[7 * np.bitwise_count(others[at] ^ bits[p]).sum(axis=1, dtype=np.int64) <= n[i] + n[j]]
                if len(j):
                    yield int(i), j


def _members_to_test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each (key, low, high) without their bitmaps that may link with another of them.

    Columns: key, low, high, block, set, n, need, label, bits.
    """
    types = [pa.int64(), *[pa.int32()] * 3, pa.int64(), *[pa.int32()] * 2, pa.int64()]
    for run in _runs(batches):
        near = np.zeros(len(run), dtype=bool)
        for i, j in _near_members(run, [row[8] for row in run]):
            near[i] = near[j] = True
        kept = [run[i] for i in np.flatnonzero(near)]
        yield pa.RecordBatch.from_arrays([pa.array([row[c] for row in kept], type=t) for c, t in enumerate(types)], names=LONG)


def _links_between_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of each (key, low, high), as few as join the same groups: less than one a row.

    Columns: key, low, high, block, set, n, need, label, members.
    """
    for run in _runs(batches):
        sets = [np.frombuffer(row[8], dtype=np.uint64) for row in run]
        parent = {row[7]: row[7] for row in run}

        def root(label: int) -> int:
            while parent[label] != label:
                parent[label] = label = parent[parent[label]]
            return label

        links = []
        for i, others in _near_members(run, [bitmap(own) for own in sets]):
            for j in others.tolist():
                x, y = root(run[i][7]), root(run[j][7])
                if x != y and len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= needed(len(sets[i]), len(sets[j])):
                    parent[x] = y
                    links.append(sorted((run[i][4], run[j][4])))
        yield pa.RecordBatch.from_arrays([pa.array([link[c] for link in links], type=pa.int64()) for c in (0, 1)], names=["a", "b"])


def groups_of(edges: DataFrame) -> DataFrame:
    """(set, label) for every set on an edge (a, b): the smallest set reachable."""
    def small(df: DataFrame) -> DataFrame:
        own = df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        low = own.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("low"))
        joined = own.join(low, F.col("a") == F.col("of"))
        return joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()

    def large(df: DataFrame) -> DataFrame:
        both = df.select("a", "b").unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("of")).agg(F.least(F.min("b"), F.first("a")).alias("low"))
        joined = both.join(low, F.col("a") == F.col("of")).where("b > a")
        return joined.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()

    def sum_of(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = written(edges.select("a", "b"), "near-edges")
    state = None
    while True:
        current = written(small(large(current)), "near-stars")
        now = sum_of(current)
        if now == state:
            break
        state = now
    return current.select(F.col("a").alias("set"), F.col("b").alias("label"))


def _members_of(sets: DataFrame, first_rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The sets (set, members) of the column ``set``, made again from their texts."""
    wanted = sets.select("set").distinct().join(first_rows, "set").select("of_row")
    # always by a shuffle, so that small inputs take the way of large ones
    members = texts.join(wanted.hint("merge"), F.col("row") == F.col("of_row")).select("data").mapInArrow(_members, "set bigint, members binary")
    return written(members, "near-members")


def _linked_in_long_lists(rows: DataFrame, bits: DataFrame, first_rows: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links (a, b) that join the groups of each long list; ``rows`` has (key, set, n, need, label, blocks, block).

    Every two blocks of a list meet once, by bitmaps; only sets that these leave come again with their members.
    """
    def together(df: DataFrame) -> DataFrame:
        return df.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")

    meeting = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(bits.select("set", "bits"), "set")
    meeting = meeting.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "set", "n", "need", "label", "bits")
    near = written(together(meeting).mapInArrow(_members_to_test, "key bigint, low int, high int, block int, set bigint, n int, need int, label bigint"), "near-rows")
    if near.isEmpty():
        return None
    members = _members_of(near, first_rows, texts)
    found = together(near.join(members, "set").select(*LONG, "members")).mapInArrow(_links_between_groups, "a bigint, b bigint")
    found = written(found.distinct(), "near-links")
    removed(members)
    return found


def _tested(pairs: DataFrame, bits: DataFrame, first_rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: by bitmaps first, then by the sets of the pairs that are left.

    ``bits`` has (set, n, bits), ``first_rows`` (set, of_row), ``texts`` (row, data).
    """
    def two(df: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
        for side in ("a", "b"):
            own = sets.select(F.col("set").alias(f"of_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in columns])
            df = df.join(own, F.col(side) == F.col(f"of_{side}")).drop(f"of_{side}")
        return df.select("a", "b", *[f"{c}_{side}" for c in columns for side in ("a", "b")])

    near = written(two(pairs, bits, ["n", "bits"]).mapInArrow(_may_link, "a bigint, b bigint"), "near-pairs")
    members = _members_of(near.select(F.explode(F.array("a", "b")).alias("set")), first_rows, texts)
    found = written(two(near, members, ["members"]).mapInArrow(_linked, "a bigint, b bigint").distinct(), "near-links")
    removed(members)
    return found


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n, set, label): documents with the same non-null label form a group.

    ``row`` names a row by its id and text.
    """
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), F.col("text").cast("binary").alias("data"))
    profile = written(texts.mapInArrow(_profile, "doc_id bigint, row bigint, n bigint, set bigint, bits binary, block int, cells binary"), "near-profile")
    rows = profile.where("block IS NULL").select("doc_id", "row", "n", "set")
    cells = profile.where("block IS NOT NULL").select("block", "cells").groupBy("block").applyInPandas(_summed, "block int, cells binary")
    counts = np.zeros((BLOCKS, CELLS // BLOCKS), dtype=np.int64)
    for own in cells.collect():
        counts[own.block] = np.frombuffer(own.cells, dtype=np.int64)
    counts = spark.sparkContext.broadcast(counts.ravel())
    small = rows.where(f"n BETWEEN 1 AND {LARGEST_ENUMERATED}").groupBy("n").agg(F.countDistinct("set").alias("c")).collect()
    limit = boundary({r.n: r.c for r in small})

    def post(batches):
        return _postings(batches, counts.value, limit)

    postings = texts.select("data").mapInArrow(post, "key bigint, set bigint, n int, need int")
    lists = postings.repartition("key").sortWithinPartitions("key", "set").mapInArrow(_shared, "key bigint, set bigint, n int, need int")
    lists = written(lists, "near-lists")

    listed = lists.select("set").distinct()
    first_rows = rows.where("set IS NOT NULL").groupBy("set").agg(F.min("row").alias("of_row")).join(listed, "set", "left_semi")
    first_rows = written(first_rows, "near-rows")
    bits = profile.where("bits IS NOT NULL").select("set", "n", "bits").join(listed, "set", "left_semi")
    bits = written(bits.groupBy("set").agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "near-bits")
    bytes_of = texts.select("row", "data")

    labels = None
    for step in range(ROUNDS):
        labelled = lists if labels is None else lists.join(labels, "set", "left")
        labelled = labelled.withColumn("label", F.col("set") if labels is None else F.coalesce("label", "set"))
        first = F.min(F.struct(F.xxhash64("set", F.lit(step)), F.col("set").alias("set"), F.col("n").alias("n"), F.col("label").alias("label"))).alias("first")
        leaders = labelled.groupBy(F.col("key").alias("of_key")).agg(first, F.max("label").alias("high"), F.min("label").alias("low")).where("high <> low")
        # a list whose members are in one group can tell nothing more: only the others are read again
        live = labelled.join(leaders, F.col("key") == F.col("of_key")).select("key", "set", "n", "need", "label", F.col("first.set").alias("other"), F.col("first.n").alias("other_n"), F.col("first.label").alias("other_label"))
        live = written(live, "near-lists")
        removed(lists)
        pairs = live.where("label <> other_label AND 4 * least(n, other_n) >= 3 * greatest(n, other_n) AND (need = 0 OR 7 * need >= 3 * (n + other_n))")
        pairs = pairs.select(F.least("set", "other").alias("a"), F.greatest("set", "other").alias("b")).distinct()
        lists = live.select("key", "set", "n", "need")
        found = _tested(pairs, bits, first_rows, bytes_of)
        if labels is not None and found.isEmpty():
            break
        edges = found if labels is None else labels.select(F.col("set").alias("a"), F.col("label").alias("b")).unionByName(found)
        labels = groups_of(edges)

    labelled = lists.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
    open_lists = labelled.groupBy(F.col("key").alias("of_key")).agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").drop("low", "high")
    live = labelled.join(open_lists, F.col("key") == F.col("of_key")).drop("of_key")
    live = live.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    links = _linked_in_long_lists(live.where(F.col("members") > LONG_LIST), bits, first_rows, bytes_of)
    if links is not None:
        labels = groups_of(labels.select(F.col("set").alias("a"), F.col("label").alias("b")).unionByName(links))
        live = live.drop("label").join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
    short = live.where(F.col("members") <= LONG_LIST).select("key", "set", "n", "need", "label")
    pairs = short.repartition("key").sortWithinPartitions("key").mapInArrow(_pairs_between_groups, "a bigint, b bigint").distinct()
    labels = groups_of(labels.select(F.col("set").alias("a"), F.col("label").alias("b")).unionByName(_tested(pairs, bits, first_rows, bytes_of)))
    return rows.join(labels, "set", "left").select("doc_id", "row", "n", "set", F.coalesce("label", "set").alias("label"))


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    grouped = written(near_groups(docs), "near-groups")
    lowest = grouped.where("label IS NOT NULL").groupBy(F.col("label").alias("of_label")).agg(F.min("doc_id").alias("lowest"))
    joined = grouped.join(lowest, F.col("label") == F.col("of_label"), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("lowest")).alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each group; rows without shingles all stay."""
    order = F.struct(F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).alias("id"), F.col("row").alias("row"))
    chosen = near_groups(docs).where("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("first")).select(F.col("first.row").alias("of_row"))
    named = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64("doc_id", "text").alias("row"), (F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     ")) == "").alias("blank"))
    first = named.where("NOT blank").join(chosen, F.col("row") == F.col("of_row"), "left_semi")
    first = first.withColumn("nth", F.row_number().over(Window.partitionBy("row").orderBy("row"))).where("nth = 1")
    return first.select("doc.*").unionByName(named.where("blank").select("doc.*"))


#: DuckDB SQL of the same components over the table documents: all pairs that share a shingle.
NEAR_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT row, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM texts),
sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY row),
shared AS (SELECT a.row AS x, b.row AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.row < b.row GROUP BY a.row, b.row),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.row = x JOIN sizes q ON q.row = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT row AS x, row AS y FROM texts UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT t.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM texts t JOIN reach r ON r.x = t.row JOIN texts o ON o.row = r.y LEFT JOIN sizes s ON s.row = t.row
GROUP BY t.row, t.doc_id
"""
