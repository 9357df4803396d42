"""Byte-level BPE encoding and decoding of a tokenizer file, by forced-boundary splitting.

A merge model only ever joins two symbols into a token of its vocabulary. So where two adjacent
bytes of a word stand next to each other inside no vocabulary token at all, no token can cover
both, and no merge ever crosses that place: it is a certain cut. A word falls apart at its certain
cuts into fragments that are encoded independently and concatenated. The table of pairs that
occur inside tokens is 256 x 256 bits, built once from the vocabulary.

Fragments are encoded many at a time with numpy: the new words of a batch are laid end to end,
word ends and certain cuts start new segments, and each step merges, in every segment, all
non-overlapping places (leftmost first) of its lowest-ranked pair. That equals merging one place
at a time by (rank, position), as a merge that uses a new token always ranks after the merge that
made it. Steps stop when no segment has a pair left; a run of one repeated byte takes a step per
doubling, so a fragment of n bytes needs at most n steps and usually a handful. Words are taken
``CHUNK`` bytes at a time, which bounds the arrays.

Before that, the text is split where an added token's string stands (the library's default, in
which such a string in a text becomes its id), then into words by the byte-level pattern.
Encodings of words are remembered per worker in two generations of up to ``REMEMBERED`` words:
when the newer one is full it becomes the older one and the oldest is dropped, and a word found
in the older one moves to the newer; so frequent words stay and a worker holds a bounded amount
whatever the input.

Decoding maps every id to its bytes (an added token to its string), joins them and reads the
bytes as UTF-8, with U+FFFD for a sequence that is not valid.

Scale: one pass over the rows, no shuffle; the tokenizer file's bytes are the only broadcast.
Defined cases: a null text is the empty text (no ids, digest of the empty string); white space
runs, characters of any script, added-token strings and words of any length are encoded exactly;
repeated rows are encoded each; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

REMEMBERED = 150_000
#: Fragments up to this many bytes merge by a plain scan for the lowest rank; longer ones by a heap.
SHORT = 24
_NEVER = 1 << 40
CHUNK = 1 << 20
#: Words longer than this many bytes are encoded one by one (a heap per fragment, n log n), as one
#: long fragment would hold a batch step per distinct pair rank.
LONG = 64

# Fixed values that must equal the byte-level pre-tokenizer's for the same words:
# the word pattern of the byte-level pre-tokenizer (contractions, letters, digits, other, spaces).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Bytes shown as themselves in vocabulary strings: "!" to "~", "¡" to "¬", "®" to "ÿ"; the other
# bytes are shown as the characters from U+0100 on, in byte order.
SHOWN_AS_THEMSELVES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in vocabulary strings, inverted: character -> byte."""
    own = set(SHOWN_AS_THEMSELVES)
    shown, extra = {}, 0
    for byte in range(256):
        if byte in own:
            shown[chr(byte)] = byte
        else:
            shown[chr(256 + extra)] = byte
            extra += 1
    return shown


class BytePairModel:
    """Encoder and decoder of one tokenizer file (a byte-level BPE model)."""

    def __init__(self, spec: bytes) -> None:
        data = json.loads(spec)
        model = data["model"]
        if model.get("type") != "BPE":
            raise ValueError(f"not a BPE model: {model.get('type')}")
        of_char = byte_characters()
        vocab: dict[str, int] = model["vocab"]
        size = max([*vocab.values(), *(a["id"] for a in data.get("added_tokens", []))]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, index in vocab.items():
            self.bytes_of[index] = bytes(of_char[c] for c in token)
        self.byte_id = [0] * 256
        for token, index in vocab.items():
            if len(self.bytes_of[index]) == 1:
                self.byte_id[self.bytes_of[index][0]] = index
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[(vocab[left], vocab[right])] = (rank, vocab[left + right])
        # The same by one integer key, left * 2^20 + right: rank, and the id the merge gives.
        self.rank_of = {(a << 20) | b: r for (a, b), (r, _) in self.merges.items()}
        self.joined = {(a << 20) | b: new for (a, b), (_, new) in self.merges.items()}
        # Pairs of bytes that stand next to each other inside some vocabulary token, at 256 * a + b.
        inside = np.zeros((256, 256), dtype=bool)
        for token in self.bytes_of:
            if len(token) > 1:
                raw = np.frombuffer(token, dtype=np.uint8)
                inside[raw[:-1], raw[1:]] = True
        self.inside = inside.ravel().tolist()
        self.inside_table = inside
        self.byte_ids = np.array(self.byte_id, dtype=np.int64)
        keys = np.array([(a << 20) | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.merge_keys = keys[order]
        self.merge_ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.merge_new = np.array([n for _, n in self.merges.values()], dtype=np.int64)[order]
        self.added = {a["content"]: a["id"] for a in data.get("added_tokens", [])}
        for content, index in self.added.items():
            self.bytes_of[index] = content.encode("utf-8")
        self.added_pattern = regex.compile("|".join(regex.escape(a) for a in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.words = regex.compile(WORD_PATTERN)
        self.remembered: dict[str, tuple[tuple[int, ...], str]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str]] = {}

    def fragments(self, raw: bytes) -> list[bytes]:
        """The word's bytes cut at every place where the two bytes stand together in no token."""
        inside = self.inside
        bounds = [0, *(at for at, pair in enumerate(map(int.__add__, map((256).__mul__, raw), raw[1:]), 1) if not inside[pair]), len(raw)]
        if len(bounds) == 2:
            return [raw]
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def merged(self, raw: bytes) -> list[int]:
        """The ids of one fragment: merges by rank, leftmost first among equals, by a heap."""
        ids = list(map(self.byte_id.__getitem__, raw))
        n = len(ids)
        if n < 2:
            return ids
        merges = self.merges
        if n <= SHORT:
            rank_of, joined, never = self.rank_of.get, self.joined, _NEVER
            ranks = [rank_of((ids[i] << 20) | ids[i + 1], never) for i in range(n - 1)]
            while ranks:
                best = min(ranks)
                if best == never:
                    break
                at = ranks.index(best)
                ids[at] = joined[(ids[at] << 20) | ids[at + 1]]
                del ids[at + 1], ranks[at]
                if at < len(ranks):
                    ranks[at] = rank_of((ids[at] << 20) | ids[at + 1], never)
                if at > 0:
                    ranks[at - 1] = rank_of((ids[at - 1] << 20) | ids[at], never)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        after[-1] = -1
        alive = [True] * n
        heap = []
        for at in range(n - 1):
            found = merges.get((ids[at], ids[at + 1]))
            if found is not None:
                heap.append((found[0], at))
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            nxt = after[at] if alive[at] else -1
            if nxt < 0:
                continue
            found = merges.get((ids[at], ids[nxt]))
            if found is None or found[0] != rank:
                continue
            ids[at] = found[1]
            alive[nxt] = False
            after[at] = after[nxt]
            if after[at] >= 0:
                before[after[at]] = at
                right = merges.get((ids[at], ids[after[at]]))
                if right is not None:
                    heapq.heappush(heap, (right[0], at))
            if before[at] >= 0:
                left = merges.get((ids[before[at]], ids[at]))
                if left is not None:
                    heapq.heappush(heap, (left[0], before[at]))
        return [ids[i] for i in range(n) if alive[i]]

    def _segments(self, ids: np.ndarray, seg: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge inside every segment (seg ascending) until none has a pair; ids and words, in order."""
        keys_sorted, ranks_sorted, new_sorted = self.merge_keys, self.merge_ranks, self.merge_new
        done_ids, done_seg, done_word = [], [], []
        while len(ids):
            cand = np.zeros(0, dtype=bool)
            if len(ids) > 1:
                keys = (ids[:-1] << 20) | ids[1:]
                at = np.searchsorted(keys_sorted, keys)
                at[at == len(keys_sorted)] = 0
                rank = np.where((seg[:-1] == seg[1:]) & (keys_sorted[at] == keys), ranks_sorted[at], _NEVER)
                first = np.flatnonzero(np.r_[True, seg[1:-1] != seg[:-2]])
                low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(rank)]))
                cand = (rank == low) & (rank < _NEVER)
            if not cand.any():
                done_ids.append(ids), done_seg.append(seg), done_word.append(word)
                break
            index = np.arange(len(cand))
            start = cand & ~np.r_[False, cand[:-1]]
            base = np.maximum.accumulate(np.where(start, index, 0))
            chosen = np.flatnonzero(cand & (((index - base) & 1) == 0))
            ids[chosen] = new_sorted[at[chosen]]
            keep = np.ones(len(ids), dtype=bool)
            keep[chosen + 1] = False
            live = np.isin(seg, seg[:-1][cand])
            done = keep & ~live
            done_ids.append(ids[done]), done_seg.append(seg[done]), done_word.append(word[done])
            keep &= live
            ids, seg, word = ids[keep], seg[keep], word[keep]
        seg = np.concatenate(done_seg)
        order = np.argsort(seg, kind="stable")
        return np.concatenate(done_ids)[order], np.concatenate(done_word)[order]

    def learn(self, words: list[str]) -> dict[str, tuple[tuple[int, ...], str]]:
        """The (ids, ids as text) of every one of the words: remembered ones looked up, the others
        encoded all at once and remembered."""
        known, older = self.remembered.get, self.older.get
        learnt = {w: e for w in set(words) if (e := known(w) or older(w)) is not None}
        new = list(set(words) - learnt.keys())
        for text in [w for w in new if len(w) * 4 > LONG and len(w.encode("utf-8")) > LONG]:
            parts = self.fragments(text.encode("utf-8"))
            own = tuple(i for part in parts for i in self.merged(part))
            if len(self.remembered) >= REMEMBERED:
                self.older, self.remembered = self.remembered, {}
            self.remembered[text] = learnt[text] = (own, ",".join(map(str, own)))
        new = [w for w in new if w not in learnt]
        at = 0
        while at < len(new):
            raws, size = [], 0
            while at < len(new) and (size < CHUNK or not raws):
                raws.append(new[at].encode("utf-8"))
                size += len(raws[-1])
                at += 1
            flat = np.frombuffer(b"".join(raws), dtype=np.uint8)
            word = np.repeat(np.arange(len(raws), dtype=np.int64), [len(r) for r in raws])
            breaks = np.ones(len(flat), dtype=bool)
            breaks[1:] = (word[1:] != word[:-1]) | ~self.inside_table[flat[:-1], flat[1:]]
            ids, owner = self._segments(self.byte_ids[flat], np.cumsum(breaks), word)
            bounds = [0, *np.searchsorted(owner, np.arange(1, len(raws))).tolist(), len(ids)]
            ids = ids.tolist()
            for k, text in enumerate(new[at - len(raws) : at]):
                own = tuple(ids[bounds[k] : bounds[k + 1]])
                if len(self.remembered) >= REMEMBERED:
                    self.older, self.remembered = self.remembered, {}
                self.remembered[text] = learnt[text] = (own, ",".join(map(str, own)))
        return learnt

    def pieces(self, text: str | None) -> tuple[list[str | int], bool]:
        """The words of a text and the ids of added tokens in it, in order; whether it had any."""
        text = text or ""
        if self.added_pattern is None or not self.added_pattern.search(text):
            return self.words.findall(text), False
        out: list[str | int] = []
        at = 0
        for found in self.added_pattern.finditer(text):
            out.extend(self.words.findall(text[at : found.start()]))
            out.append(self.added[found.group()])
            at = found.end()
        out.extend(self.words.findall(text[at:]))
        return out, True

    def entries_many(self, texts: list[str | None]) -> list[list[tuple[tuple[int, ...], str]]]:
        """The (ids, ids as text) of every word and added token of each text; new words learnt at once."""
        split = [self.pieces(t) for t in texts]
        words = [w for own, added in split for w in own if not added or type(w) is str]
        table = self.learn(words).__getitem__
        return [
            [((w,), str(w)) if type(w) is int else table(w) for w in own] if added else list(map(table, own))
            for own, added in split
        ]

    def entries(self, text: str | None) -> list[tuple[tuple[int, ...], str]]:
        return self.entries_many([text])[0]

    def encode(self, text: str | None) -> list[int]:
        return [i for ids, _ in self.entries(text) for i in ids]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        return self.digest_many([text])[0]

    def digest_many(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Per text: number of ids, SHA-256 of the ids joined by commas, SHA-256 of decode(ids)."""
        out = []
        for found in self.entries_many(texts):
            ids = [i for own, _ in found for i in own]
            out.append((
                len(ids),
                hashlib.sha256(",".join([t for _, t in found]).encode()).hexdigest(),
                hashlib.sha256(self.decode(ids).encode("utf-8")).hexdigest(),
            ))
        return out


_MODELS: dict[bytes, BytePairModel] = {}


def model_of(spec: bytes) -> BytePairModel:
    """One model object per worker and file."""
    key = hashlib.sha256(spec).digest()
    if key not in _MODELS:
        _MODELS[key] = BytePairModel(spec)
    return _MODELS[key]


def _mapped(docs: DataFrame, path: str, keep: list[str], schema: str, made) -> DataFrame:
    """The kept columns next to what ``made(model, texts)`` gives, by Arrow batches."""
    with open(path, "rb") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    named = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col("text").alias("the_text"))
    kept_schema = ", ".join(f"`kept_{i}` {t.dataType.simpleString()}" for i, t in enumerate(named.schema[:-1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(spec.value)
        for batch in batches:
            columns = made(model, batch.column(batch.num_columns - 1).to_pylist())
            names = batch.schema.names[:-1] + list(columns)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns.values()], names=names)

    out = named.mapInArrow(run, f"{kept_schema}{', ' if keep else ''}{schema}")
    for i, c in enumerate(keep):
        out = out.withColumnRenamed(f"kept_{i}", c)
    return out


def encode(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default doc_id) and ``ids``, the token ids of ``text``."""
    def made(model: BytePairModel, texts: list[str | None]) -> dict[str, pa.Array]:
        found = model.entries_many(texts)
        return {"ids": pa.array([[i for own, _ in e for i in own] for e in found], type=pa.list_(pa.int32()))}

    return _mapped(docs, path, ["doc_id"] if keep is None else keep, "ids array<int>", made)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns and ``decoded``, the text of the column ``ids``."""
    with open(path, "rb") as file:
        spec = encoded.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("string")
    def text_of(ids):
        import pandas as pd

        model = model_of(spec.value)
        return pd.Series([model.decode([] if own is None else list(own)) for own in ids], dtype=object)

    return encoded.withColumn("decoded", text_of("ids"))


def digests(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """The kept columns, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every text."""
    def made(model: BytePairModel, texts: list[str | None]) -> dict[str, pa.Array]:
        rows = model.digest_many(texts)
        return {
            "n_tokens": pa.array([r[0] for r in rows], type=pa.int64()),
            "ids_sha256": pa.array([r[1] for r in rows], type=pa.string()),
            "decoded_sha256": pa.array([r[2] for r in rows], type=pa.string()),
        }

    return _mapped(docs, path, ["doc_id"] if keep is None else keep, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", made)
