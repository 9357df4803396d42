"""Document fingerprints: Merkle trees over sections, paragraphs and phrases.

A paragraph is a line; a section is a run of paragraphs that ends at a blank line or at a
paragraph whose hash says so, so that an edit moves no other border. Leaves are sentences, long
ones cut at words whose hash says so. Inner hashes cover the children's full hashes, and the root
the sections', so equal roots mean equal texts. The fingerprint writes the tree out, shortened:

    root|section=paragraph.leaf.leaf,paragraph.leaf;section=...

Two fingerprints are compared top down: equal roots are 1; else the share of leaves in common.
``differing`` lists the paragraphs of one that the other lacks, which locates an edit.

Comparing each document with the next by descending id needs neighbours together: ids are dealt
to ranges at quantiles, each range's first row is copied to the range before, and every task
streams its sorted ranges, holding two rows at a time. Text is shuffled once.

Defined cases: a null text is empty (its root is that of no sections); rows with equal ids are
ordered by text; null ids come last; the last row's next is the first, and a lone row's next is
itself; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows of a range, and ranges at most.
ROWS, RANGES = 2000, 4096
_SENTENCE = re.compile(r"[^.!?]*[.!?]+[ \t]*|[^.!?]+")
_WORD = re.compile(r"[^ ]* *")
LONG_SENTENCE = 160
_LOW = -(1 << 63)


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def phrases(paragraph: str) -> list[str]:
    """The leaves of a paragraph; joined, they give it back."""
    if len(paragraph) <= LONG_SENTENCE // 4:
        return [paragraph] if paragraph else []
    out = []
    for sentence in _SENTENCE.findall(paragraph):
        if len(sentence) <= LONG_SENTENCE:
            out.append(sentence)
            continue
        held = []
        for word in _WORD.findall(sentence):
            held.append(word)
            if zlib.crc32(word.encode()) & 7 == 0:
                out.append("".join(held))
                held = []
        if held and held != [""]:
            out.append("".join(held))
    return out


class Tree:
    """The hashes of one text; ``leaves`` counts the shortened leaf hashes."""

    def __init__(self, text: str) -> None:
        sections: list[list[tuple[bytes, list[bytes]]]] = [[]]
        if text:
            for paragraph in text.split("\n"):
                leaves = [_hash(p.encode()) for p in phrases(paragraph)]
                own = _hash(b"p" + b"".join(leaves))
                sections[-1].append((own, leaves))
                if not paragraph.strip() or own[0] & 7 == 0:
                    sections.append([])
        whole = []
        written = []
        names: list[str] = []
        for paragraphs in sections:
            if paragraphs:
                own = _hash(b"s" + b"".join(p for p, _ in paragraphs))
                whole.append(own)
                lines = []
                for p, leaves in paragraphs:
                    short = [leaf[:4].hex() for leaf in leaves]
                    names += short
                    lines.append(".".join([p[:4].hex(), *short]))
                written.append(own[:4].hex() + "=" + ",".join(lines))
        self.root = _hash(b"r" + b"".join(whole)).hex()
        self.text = self.root + "|" + ";".join(written)
        self.leaves = Counter(names)
        self.size = len(names)


def likeness(a: Tree, b: Tree) -> float:
    """1 for equal roots, else the share of leaves in common (twice over both)."""
    if a.root == b.root:
        return 1.0
    if not a.size or not b.size:
        return 0.0
    few, many = (a, b) if len(a.leaves) <= len(b.leaves) else (b, a)
    get = many.leaves.get
    common = sum(min(n, get(name, 0)) for name, n in few.leaves.items())
    return min(2.0 * common / (a.size + b.size), 1.0)


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) positions of fingerprint ``a`` whose paragraph ``b`` lacks; only
    sections that differ are looked into."""
    def parts(text: str) -> list[tuple[str, list[str]]]:
        body = text.partition("|")[2]
        return [(s.partition("=")[0], s.partition("=")[2].split(",")) for s in body.split(";")] if body else []

    if a.partition("|")[0] == b.partition("|")[0]:
        return []
    sections = Counter(name for name, _ in parts(b))
    paragraphs = Counter(p for _, own in parts(b) for p in own)
    out = []
    for i, (name, own) in enumerate(parts(a)):
        if sections[name] > 0:
            sections[name] -= 1
            continue
        for j, p in enumerate(own):
            if paragraphs[p] > 0:
                paragraphs[p] -= 1
            else:
                out.append((i, j))
    return out


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default doc_id) and ``fingerprint`` of every text: one pass, no shuffle."""
    keep = ["doc_id"] if keep is None else keep
    named = docs.select(*keep, F.coalesce("text", F.lit("")).alias("the_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in named.schema[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([Tree(t).text for t in batch.column(batch.num_columns - 1).to_pylist()], type=pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*batch.schema.names[:-1], "fingerprint"])

    return named.mapInArrow(run, f"{schema}fingerprint string")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, extra, doc_id, text) in order, each compared with the one after it in its range."""
    kinds = {
        "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
        "near_edited": pa.float64(), "near_next": pa.float64(),
    }
    out: dict[str, list] = {name: [] for name in kinds}
    held = None
    for batch in batches:
        for place, extra, doc_id, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            tree = Tree(text)
            if held is not None and held[0] == place and not held[1]:
                _, _, own_id, own_text, own = held
                changed = edited(own_text, text)
                other = Tree(changed)
                for name, value in zip(kinds, (own_id, len(own_text), hashlib.sha256(changed.encode()).hexdigest(), own.text, other.text, likeness(own, other), likeness(own, tree))):
                    out[name].append(value)
            held = (place, extra, doc_id, text, tree)
        if out["doc_id"]:
            yield pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in kinds.items()], names=list(kinds))
            out = {name: [] for name in kinds}


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, compared, and with the next document's."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOW)).alias("place"))
    count = ids.count()
    ranges = min(max(1, count // ROWS), RANGES)
    if ranges > 1:
        cuts = ids.agg(F.percentile_approx("place", [i / ranges for i in range(1, ranges)], 10 * ranges).alias("cuts")).first()["cuts"]
        cuts = sorted(set(cuts))
    else:
        cuts = []

    @F.pandas_udf("int")
    def range_of(place):
        import pandas as pd

        # ranges by descending id: the highest ids are range 0
        return pd.Series(len(cuts) - np.searchsorted(np.array(cuts, dtype=np.int64), place.to_numpy(), side="right").astype(np.int32))

    # the highest id of every range that has rows, at most RANGES of them
    heads = sorted((r["range"], r["head"]) for r in ids.groupBy(range_of("place").alias("range")).agg(F.max("place").alias("head")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOW)).alias("place"))
    rows = rows.withColumn("range", range_of("place"))
    own = rows.select("range", F.lit(0).alias("extra"), "doc_id", "text", "place")
    copied = rows.where(F.col("place").isin(list(before)))
    target = F.lit(None).cast("int")
    for head, to in before.items():
        target = F.when(F.col("place") == head, F.lit(to)).otherwise(target) if len(before) <= 16 else target
    if len(before) > 16:
        pairs = docs.sparkSession.createDataFrame(list(before.items()), "head bigint, to int")
        copied = copied.join(F.broadcast(pairs), F.col("place") == F.col("head")).drop("head")
        target = F.col("to")
    copies = copied.select(target.alias("range"), F.lit(1).alias("extra"), "doc_id", "text", "place")
    dealt = own.unionByName(copies).repartition(max(len(heads), 1), "range")
    dealt = dealt.sortWithinPartitions("range", "extra", F.col("place").desc(), "text").select("range", "extra", "doc_id", "text")
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(_compared, schema)
