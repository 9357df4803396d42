"""Removing byte strings that occur more than once in the corpus, with run-length indexes.

A window is a string of ``WINDOW`` bytes inside one text. Every window has an anchor: the
``ANCHOR``-byte string in it with the smallest hash, the first of several. Equal windows have
equal anchors, so it is enough to compare windows that share one. A stretch of windows with the
same anchor position is handled as one span of bytes:

1. spans are counted by anchor (map-side combined); anchors seen once are done with;
2. where all spans of an anchor have the same bytes, all of them are repeats;
3. the other anchors get an index of their distinct spans: suffix order, its Burrows-Wheeler
   transform in runs, and the text positions at run ends. The longest match of every position
   with any other is streamed from those samples: it is worked out at run ends only, and one
   shorter from each position to the next inside a run. Positions that match ``WINDOW`` bytes
   are repeats.

An anchor with more than ``INDEXED`` distinct spans (a passage that very many texts share, at
the edge where they differ) is not indexed in one task: its windows are counted by hash instead,
map-side combined, which is exact as well.

Scale: text is hashed where it is read; spans are some 50 bytes per 70 bytes of text in memory,
less on the wire, and all groupings combine before they shuffle. Text itself is shuffled twice by
row: to cut out the spans of step 3, and to remove the repeats. Spans per row are bounded by the
row's own length. Results of steps are written to the shared folder; no index outlives its task.

Defined cases: a null text is empty; texts shorter than ``WINDOW`` bytes keep everything; equal
rows are separate texts, so a text of ``WINDOW`` bytes or more that occurs twice is removed
whole; matches never cross texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tenderline.llm.common import mixed, powers, written

WINDOW, ANCHOR = 200, 64
#: Distinct spans of one anchor that are indexed in one task.
INDEXED = 2000
#: Bytes hashed at a time; longer texts are cut into overlapping pieces of this many windows.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64((1 << 24) - 1)


@lru_cache(maxsize=1)
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value of each byte, powers of the base and of its inverse."""
    return mixed(np.arange(1, 257, dtype=np.uint64)), powers(_BASE, size), powers(pow(_BASE, -1, 1 << 64), size)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def spans_of(data: bytes, starts: np.ndarray, ends: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(text index, first byte, length, anchor hash, span hash) of the spans of texts.

    Texts lie in ``data`` at [start, end). One span is a maximal stretch of windows whose anchor
    is the same place.
    """
    none = np.zeros(0, dtype=np.int64)
    size = len(data)
    if size < window:
        return none, none, none, none, none
    values, up, down = _tables(max(CHUNK + (1 << 16), 1 << (size + 1).bit_length()))
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(values[np.frombuffer(data, dtype=np.uint8)] * up[:size], out=sums[1:])
    grams = mixed((sums[anchor:] - sums[: size - anchor + 1]) * down[: size - anchor + 1])
    packed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    place = (_smallest(packed, window - anchor + 1) & _PLACE).astype(np.int64)
    inside = np.zeros(size + 1, dtype=np.int32)
    long_enough = ends - starts >= window
    np.add.at(inside, starts[long_enough], 1)
    np.add.at(inside, ends[long_enough] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[: len(place)]) > 0)
    if not len(at):
        return none, none, none, none, none
    own = place[at]
    text = np.searchsorted(starts, at, side="right") - 1
    new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (text[1:] != text[:-1]))))
    first = at[new]
    last = at[np.concatenate((new[1:], [len(at)])) - 1] + window
    whole = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return text[new], first - starts[text[new]], last - first, grams[own[new]].view(np.int64), whole.view(np.int64)


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray, np.ndarray]]:
    """Texts packed into chunks: (text index, offset in the text) per piece, bytes, starts, ends."""
    rows, offsets, parts, size = [], [], [], 0
    for row, data in enumerate(texts):
        data = data or b""
        for offset in range(0, max(len(data) - WINDOW + 1, 0), CHUNK):
            part = data[offset : offset + CHUNK + WINDOW - 1]
            if size and size + len(part) > CHUNK:
                ends = np.cumsum([len(p) for p in parts])
                yield rows, offsets, b"".join(parts), np.concatenate(([0], ends[:-1])), ends
                rows, offsets, parts, size = [], [], [], 0
            rows.append(row)
            offsets.append(offset)
            parts.append(part)
            size += len(part)
    if parts:
        ends = np.cumsum([len(p) for p in parts])
        yield rows, offsets, b"".join(parts), np.concatenate(([0], ends[:-1])), ends


def _batch_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for rows, offsets, data, starts, ends in _pieces(batch.column(1).to_pylist()):
            piece, first, size, anchor, content = spans_of(data, starts, ends)
            if len(piece):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[np.asarray(rows)[piece]]), pa.array(first + np.asarray(offsets, dtype=np.int64)[piece]), pa.array(size),
                        pa.array(anchor), pa.array(content),
                    ],
                    names=["row", "first", "size", "anchor", "content"],
                )


def longest_elsewhere(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every position of the joined, distinct texts, its longest match with another position.

    Second result: start of each text in the joined sequence, which has one separator after each
    text. Matches are not cut at separators: callers look at positions far enough before one.
    """
    lengths = np.array([len(t) for t in texts])
    symbols = np.zeros(int(lengths.sum()) + len(texts), dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    filled = np.ones(len(symbols), dtype=bool)
    filled[starts + lengths] = False
    symbols[filled] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int64) + 1
    n, step = len(symbols), 7
    padded = np.concatenate((symbols, np.zeros(step, dtype=np.int64)))
    keys = np.zeros(n, dtype=np.int64)
    for i in range(step):
        keys = (keys << 9) | padded[i : i + n]
    # suffix order by doubling; texts are distinct, so their longest length tells all apart
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
    depth = step
    while depth <= int(lengths.max()) + 1 and rank[order[-1]] < n - 1:
        later = np.zeros(n, dtype=np.int64)
        later[: max(n - depth, 0)] = rank[depth:] + 1
        pair = rank * (n + 1) + later
        order = np.argsort(pair, kind="stable")
        ranked = pair[order]
        rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
        depth *= 2
    # runs of the transform; a separator is a symbol of its own each time
    before = symbols[order - 1]
    boundary = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] == 0))
    left, right = order[boundary], order[boundary + 1]
    # matches between the samples on both sides of each run boundary
    match = np.zeros(len(left), dtype=np.int64)
    active = np.arange(len(left))
    wide = np.concatenate((keys, np.full(step, -1, dtype=np.int64)))
    while len(active):
        a, b = left[active] + match[active], right[active] + match[active]
        same = (np.maximum(a, b) < n) & (wide[np.minimum(a, n)] == wide[np.minimum(b, n)])
        active = active[same]
        match[active] += step
    ends = np.concatenate((symbols, np.array([-1, -2])))
    for _ in range(step):
        a, b = left + match, right + match
        same = (np.maximum(a, b) < n) & (ends[np.minimum(a, n)] == ends[np.minimum(b, n)])
        match[same] += 1
    reach = np.zeros((2, n), dtype=np.int64)
    np.maximum.at(reach[0], right, right + match)
    np.maximum.at(reach[1], left, left + match)
    return np.maximum.accumulate(reach, axis=1).max(axis=0) - np.arange(n), starts


def _index_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among spans that come sorted by anchor; whole anchors are indexed together."""
    def indexed(spans: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        longest, starts = longest_elsewhere([s[2] for s in spans])
        rows, firsts, ends = [], [], []
        for (row, first, data), start in zip(spans, starts.tolist()):
            hit = np.flatnonzero(longest[start : start + len(data) - WINDOW + 1] >= WINDOW)
            if len(hit):
                cut = np.flatnonzero(np.diff(hit) > 1)
                a = hit[np.concatenate(([0], cut + 1))]
                b = hit[np.concatenate((cut, [len(hit) - 1]))]
                rows += [row] * len(a)
                firsts += (first + a).tolist()
                ends += (first + b + WINDOW).tolist()
        return pa.RecordBatch.from_arrays([pa.array(rows, type=pa.int64()), pa.array(firsts, type=pa.int64()), pa.array(ends, type=pa.int64())], names=["row", "first", "end"])

    held: list[tuple[int, int, bytes]] = []
    size, open_at, current = 0, 0, None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for anchor, row, first, data in zip(*columns):
            if anchor != current:
                if size > CHUNK:
                    yield indexed(held)
                    held, size = [], 0
                current = anchor
            held.append((row, first, data))
            size += len(data)
    if held:
        yield indexed(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted spans of each text; for anchors that are not indexed, hashes of their windows."""
    for batch in batches:
        out = {"row": [], "anchor": [], "first": [], "data": [], "hash": []}
        for row, data, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for w in wanted:
                part = data[w["first"] : w["first"] + w["size"]]
                if w["indexed"]:
                    for name, value in (("row", row), ("anchor", w["anchor"]), ("first", w["first"]), ("data", part), ("hash", None)):
                        out[name].append(value)
                else:
                    for i in range(len(part) - WINDOW + 1):
                        digest = int.from_bytes(hashlib.blake2b(part[i : i + WINDOW], digest_size=8).digest(), "little", signed=True)
                        for name, value in (("row", row), ("anchor", w["anchor"]), ("first", w["first"] + i), ("data", None), ("hash", digest)):
                            out[name].append(value)
        kinds = {"row": pa.int64(), "anchor": pa.int64(), "first": pa.int64(), "data": pa.binary(), "hash": pa.int64()}
        yield pa.RecordBatch.from_arrays([pa.array(out[c], type=t) for c, t in kinds.items()], names=list(kinds))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(row, first, end) of byte ranges that repeats cover, from (row, data); ranges may overlap."""
    schema = "row bigint, first bigint, size bigint, anchor bigint, content bigint"
    spans = texts.mapInArrow(_batch_spans, schema)
    anchors = spans.groupBy("anchor").agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
    shared = written(anchors.where("n > 1").select(F.col("anchor").alias("of_anchor"), (F.col("low") != F.col("high")).alias("differ")), "repeats-anchors")
    live = written(spans.join(shared, F.col("anchor") == F.col("of_anchor")).drop("of_anchor"), "repeats-spans")
    mixed_spans = live.where("differ")
    contents = mixed_spans.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("row", "first", "size")).alias("at"))
    contents = written(contents, "repeats-contents")
    again = contents.where("n > 1").select(F.col("anchor").alias("of_anchor"), F.col("content").alias("of_content"))
    copies = mixed_spans.join(again, (F.col("anchor") == F.col("of_anchor")) & (F.col("content") == F.col("of_content")), "left_semi")
    certain = live.where("NOT differ").select("row", "first", (F.col("first") + F.col("size")).alias("end")).unionByName(
        copies.select("row", "first", (F.col("first") + F.col("size")).alias("end"))
    )
    spread = contents.groupBy(F.col("anchor").alias("of_anchor")).agg(F.count("*").alias("distinct"))
    wanted = contents.join(spread, F.col("anchor") == F.col("of_anchor")).select(
        F.col("at.row").alias("of_row"), F.struct("at.first", "at.size", "anchor", (F.col("distinct") <= INDEXED).alias("indexed")).alias("wanted")
    )
    wanted = wanted.groupBy("of_row").agg(F.collect_list("wanted").alias("wanted"))
    cut = texts.join(wanted, F.col("row") == F.col("of_row")).select("row", "data", "wanted").mapInArrow(
        _cut, "row bigint, anchor bigint, first bigint, data binary, hash bigint"
    )
    cut = written(cut, "repeats-cut")
    indexed = cut.where("data IS NOT NULL").dropDuplicates(["anchor", "row", "first"]).repartition("anchor").sortWithinPartitions("anchor")
    found = indexed.select("anchor", "row", "first", "data").mapInArrow(_index_spans, "row bigint, first bigint, end bigint")
    windows = cut.where("data IS NULL").dropDuplicates(["row", "first"]).select("row", "first", "hash")
    twice = windows.groupBy(F.col("hash").alias("of_hash")).agg(F.count("*").alias("n")).where("n > 1")
    counted = windows.join(twice, F.col("hash") == F.col("of_hash"), "left_semi").select("row", "first", (F.col("first") + WINDOW).alias("end"))
    return certain.unionByName(found).unionByName(counted)


def merged_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of ranges; touching ranges are one run."""
    out: list[list[int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_columns
        out = {"n_bytes": [], "runs": [], "kept": []}
        for data, spans in zip(batch.column(n - 2).to_pylist(), batch.column(n - 1).to_pylist()):
            runs = merged_ranges([(s["first"], s["end"]) for s in spans or []])
            view, at, parts = data, 0, []
            for first, end in runs:
                parts.append(view[at:first])
                at = end
            parts.append(view[at:])
            out["n_bytes"].append(len(data))
            out["runs"].append([{"first": a, "end": b} for a, b in runs])
            out["kept"].append(b"".join(parts))
        run = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        columns = [pa.array(out["n_bytes"], type=pa.int64()), pa.array(out["runs"], type=run), pa.array(out["kept"], type=pa.binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[: n - 2], *columns], names=[*batch.schema.names[: n - 2], *out])


def remove_repeats(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default doc_id), ``n_bytes``, removed ``runs`` and the ``kept`` bytes."""
    keep = ["doc_id"] if keep is None else keep
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.xxhash64("doc_id", "text").alias("row"), data.alias("data"))
    spans = written(repeated_spans(texts.select("row", "data")), "repeats-found")
    per_row = spans.distinct().groupBy(F.col("row").alias("of_row")).agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    joined = texts.join(per_row, F.col("row") == F.col("of_row"), "left")
    kept = [f"kept_{i}" for i in range(len(keep))]
    narrow = joined.select(*kept, "data", "spans")
    names = "".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}, " for c in kept)
    out = narrow.mapInArrow(_removed, f"{names}n_bytes bigint, runs array<struct<first: bigint, end: bigint>>, kept binary")
    for i, c in enumerate(keep):
        out = out.withColumnRenamed(f"kept_{i}", c)
    return out


def digests(docs: DataFrame) -> DataFrame:
    size = F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["first"])
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("runs").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


#: DuckDB SQL of the same digests over the table documents: all windows, in hexadecimal.
REPEATS_SQL = """
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT row, i, md5_number(substr(h, 2 * i + 1, 400)) AS k
  FROM (SELECT row, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM texts WHERE length(h) >= 400)),
twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
hits AS (SELECT row, i, lag(i) OVER (PARTITION BY row ORDER BY i) AS before FROM windows SEMI JOIN twice USING (k)),
marked AS (SELECT row, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY i) AS run FROM hits),
runs AS (SELECT row, run, min(i) AS a, max(i) + 200 AS b FROM marked GROUP BY row, run),
parts AS (
  SELECT t.row, r.a, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY t.row ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY t.row ORDER BY a), 0))) AS part
  FROM texts t JOIN runs r ON t.row = r.row
  UNION ALL
  SELECT t.row, NULL, substr(h, 2 * coalesce(r.b, 0) + 1) FROM texts t LEFT JOIN (SELECT row, max(b) AS b FROM runs GROUP BY row) r ON t.row = r.row),
kept AS (SELECT row, sha256(unhex(string_agg(part, '' ORDER BY a NULLS LAST))) AS kept_sha256 FROM parts GROUP BY row),
sums AS (SELECT row, sum(b - a) AS n, count(*) AS c FROM runs GROUP BY row)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans, kept_sha256
FROM texts JOIN kept USING (row) LEFT JOIN sums USING (row)
"""
