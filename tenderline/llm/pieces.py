"""Exact encoding and decoding with a SentencePiece merge model, by backtracking.

A merge model joins neighbouring symbols by score, best first, leftmost among equals. A split of
a text into tokens is that model's answer exactly if each token is its own answer and every two
neighbours are the answer for their joined text. So the encoder needs no merge queue: from each
position it takes the longest token that Aho-Corasick found there, checks it against the token
before by merging the two short strings again (remembered per pair), goes on to shorter tokens,
and steps back over a token when none fits. Positions from which no split exists are marked in a
bit field and never tried again. Where the leftmost longest tokens fit as they are, which one
automaton pass shows, that is the split already.

No piece holds a word mark after another character, so a text falls into words that are encoded
apart; splits of words are remembered per worker, the last ``REMEMBERED`` to twice as many.

Scale: one pass over the rows, no shuffle; the model (its file's bytes) is the only broadcast.
Defined cases: a null text is the empty text, whose only id is the end id if one is asked for;
runs of spaces, unknown characters (encoded as bytes) and words of any length are exact; repeated
rows are encoded each; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MARK = "▁"
REMEMBERED = 250_000
REMEMBERED_PAIRS = 1_000_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else varint(at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class PieceModel:
    """Encoder and decoder of one model file."""

    def __init__(self, proto: bytes) -> None:
        import struct

        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        self.shown: list[bytes | None] = []
        self.unknown, self.end, self.byte_fallback, self.dummy_prefix = 0, -1, False, True
        kinds = []
        for number, value in _fields(proto):
            if number == 1:
                own = {1: b"", 2: b"\0\0\0\0", 3: _NORMAL, **dict(_fields(value))}
                piece, kind = own[1].decode(), own[3]
                index = len(self.shown)
                kinds.append(kind)
                if kind in (_NORMAL, _USER, _UNUSED):
                    self.ids[piece] = index
                    self.score[piece] = struct.unpack("<f", own[2])[0]
                if kind == _BYTE:
                    self.byte_ids[int(piece[3:5], 16)] = index
                if kind == _UNKNOWN:
                    self.unknown = index
                if piece == "</s>":
                    self.end = index
                self.shown.append(None if kind == _CONTROL else bytes([int(piece[3:5], 16)]) if kind == _BYTE else " ⁇ ".encode() if kind == _UNKNOWN else piece.replace(MARK, " ").encode())
            elif number == 2:
                spec = dict(_fields(value))
                if spec.get(3, 1) != 2:
                    raise ValueError("the model is not of the merge type")
                self.byte_fallback = bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2) or spec.get(4, 1) or not spec.get(3, 1):
                    raise ValueError("only models with identity normalisation and a dummy prefix are supported")
        if {_USER, _UNUSED} & set(kinds):
            raise ValueError("models with user-defined or unused pieces are not supported")
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("a piece holds a word mark inside")
        alone = "" if any("\n" in piece for piece in self.ids) else "\\n"
        self.word_pattern = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|{alone}" if alone else ""))
        self.automaton = ahocorasick.Automaton()
        for piece, index in self.ids.items():
            self.automaton.add_word(piece, (len(piece), index))
        self.automaton.make_automaton()
        self.whole: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}
        self.pieces = {index: piece for piece, index in self.ids.items()}

    def merged(self, text: str) -> list[str]:
        """The model's answer for a short text, by merging."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                value = score.get(parts[i] + parts[i + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    # A token is the index of its piece, or -1 - code point for a character without a piece.

    def text_of(self, token: int) -> str:
        return self.pieces[token] if token >= 0 else chr(-1 - token)

    def stands(self, token: int) -> bool:
        """Whether a token is the answer for its own text."""
        found = self.whole.get(token)
        if found is None:
            text = self.text_of(token)
            found = self.whole[token] = self.merged(text) == [text]
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether two neighbours are the answer for their joined text."""
        key = (left << 24) + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            a, b = self.text_of(left), self.text_of(right)
            found = self.pairs[key] = self.stands(left) and self.stands(right) and self.merged(a + b) == [a, b]
        return found

    def longest_first(self, word: str) -> list[int] | None:
        """Leftmost longest tokens if neighbours fit, else None."""
        out: list[int] = []
        at, before = 0, None
        pairs, whole = self.pairs, self.whole
        for end, (size, token) in self.automaton.iter_long(word):
            start = end - size + 1
            if start > at:
                for c in word[at:start]:
                    own = -1 - ord(c)
                    if before is not None and not self.fits(before, own):
                        return None
                    out.append(own)
                    before = own
            if before is None:
                if not (whole.get(token) or self.stands(token)):
                    return None
            elif not (pairs.get((before << 24) + token) or self.fits(before, token)):
                return None
            out.append(token)
            at, before = end + 1, token
        for c in word[at:]:
            own = -1 - ord(c)
            if before is not None and not self.fits(before, own):
                return None
            out.append(own)
            before = own
        return out

    def split(self, word: str) -> list[int]:
        """Tokens of a word; characters without a piece stand alone."""
        found = self.longest_first(word)
        if found is not None:
            return found
        n = len(word)
        options: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for end, option in self.automaton.iter(word):
            options[end - option[0] + 1].append(option)
        for i, own in enumerate(options[:n]):
            if not own or own[0][0] != 1:
                own.insert(0, (1, -1 - ord(word[i])))
        failed = bytearray((n >> 3) + 1)
        stack: list[tuple[int, int]] = []
        out: list[int] = []
        at, k = 0, len(options[0]) - 1
        while at < n:
            own = options[at]
            while k >= 0:
                size, token = own[k]
                to = at + size
                if not failed[to >> 3] >> (to & 7) & 1 and (self.fits(out[-1], token) if out else self.stands(token)):
                    break
                k -= 1
            if k >= 0:
                stack.append((at, k))
                out.append(token)
                at = to
                k = len(options[at]) - 1
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not stack:
                    raise ValueError("no split exists: the model's pieces are not closed under merging")
                at, k = stack.pop()
                out.pop()
                k -= 1
        return out

    def word_ids(self, word: str) -> list[int]:
        found = self.split(word)
        if min(found, default=0) >= 0:
            return found
        out: list[int] = []
        for token in found:
            if token >= 0:
                out.append(token)
            elif self.byte_fallback:
                out += [self.byte_ids[b] for b in chr(-1 - token).encode()]
            else:
                out.append(self.unknown)
        return out

    def words(self, text: str) -> list[str]:
        return self.word_pattern.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str, end: bool = True) -> list[int]:
        out = [i for word in self.words(text) for i in self.word_ids(word)]
        return out + [self.end] if end else out

    def _decoded(self, ids: list[int]) -> str:
        return b"".join(self.shown[i] or b"" for i in ids).decode("utf-8", "replace")

    def decode(self, ids: list[int]) -> str:
        text = self._decoded(ids)
        return text[1:] if text.startswith(" ") else text

    def of_word(self, word: str) -> tuple[int, str, str]:
        """(number of ids, ids in decimal, decoded text) of a word, remembered if short."""
        found = self.known.get(word) or self.older.get(word)
        if found is None:
            ids = self.word_ids(word)
            found = (len(ids), " ".join(map(str, ids)), self._decoded(ids))
        if len(word) <= 64:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[word] = found
        return found

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids with the end id, SHA-256 of the ids, SHA-256 of the decoded text)."""
        of_word = self.of_word
        parts = [self.known.get(w) or of_word(w) for w in self.words(text)]
        ids = [p[1] for p in parts]
        ids.append(str(self.end))
        decoded = "".join([p[2] for p in parts])
        return (
            sum([p[0] for p in parts]) + 1,
            hashlib.sha256(" ".join(ids).encode()).hexdigest(),
            hashlib.sha256(decoded.removeprefix(" ").encode()).hexdigest(),
        )


_MODELS: dict[bytes, PieceModel] = {}


def model_of(proto: bytes) -> PieceModel:
    """One model object per worker and file."""
    key = hashlib.sha256(proto).digest()
    if key not in _MODELS:
        _MODELS[key] = PieceModel(proto)
    return _MODELS[key]


def _mapped(docs: DataFrame, path: str, keep: list[str], schema: str, made) -> DataFrame:
    """The kept columns next to what ``made(model, texts)`` gives, by Arrow batches."""
    with open(path, "rb") as file:
        proto = docs.sparkSession.sparkContext.broadcast(file.read())
    named = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.coalesce(F.col("text"), F.lit("")).alias("the_text"))
    kept_schema = ", ".join(f"`kept_{i}` {t.dataType.simpleString()}" for i, t in enumerate(named.schema[:-1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(proto.value)
        for batch in batches:
            columns = made(model, batch.column(batch.num_columns - 1).to_pylist())
            names = batch.schema.names[:-1] + list(columns)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns.values()], names=names)

    out = named.mapInArrow(run, f"{kept_schema}{', ' if keep else ''}{schema}")
    for i, c in enumerate(keep):
        out = out.withColumnRenamed(f"kept_{i}", c)
    return out


def encode(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default doc_id) and ``ids``, the token ids of ``text`` with the end id."""
    def made(model: PieceModel, texts: list[str]) -> dict[str, pa.Array]:
        ends = {"ids": []}
        for text in texts:
            ids: list[int] = []
            for word in model.words(text):
                ids += map(int, model.of_word(word)[1].split())
            ends["ids"].append(ids + [model.end])
        return {"ids": pa.array(ends["ids"], type=pa.list_(pa.int32()))}

    return _mapped(docs, path, ["doc_id"] if keep is None else keep, "ids array<int>", made)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns and ``text``, decoded from the column ``ids``."""
    with open(path, "rb") as file:
        proto = encoded.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("string")
    def text_of(ids):
        import pandas as pd

        model = model_of(proto.value)
        return pd.Series([model.decode([] if own is None else list(own)) for own in ids], dtype=object)

    return encoded.withColumn("text", text_of("ids"))


def digests(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """The kept columns, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every text."""
    def made(model: PieceModel, texts: list[str]) -> dict[str, pa.Array]:
        rows = [model.digest(text) for text in texts]
        return {
            "n_tokens": pa.array([r[0] for r in rows], type=pa.int64()),
            "ids_sha256": pa.array([r[1] for r in rows], type=pa.string()),
            "decoded_sha256": pa.array([r[2] for r in rows], type=pa.string()),
        }

    return _mapped(docs, path, ["doc_id"] if keep is None else keep, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", made)
