"""Language identification by cross-parsing entropy.

Each language has a reference text from labelled rows and its suffix automaton. A text is parsed
against it into phrases: the longest match from the current position, then the next. Few phrases
mean that the reference predicts the text well; per language the phrases are weighed by the
logarithm of the reference's length and divided by the text's, and the smallest entropy wins.

All texts of a batch are parsed together in numpy, one step of every automaton at a time; a parse
restarts every ``SEGMENT`` characters so that long texts are parsed side by side. Texts count
letters in lower case; all else between letters is one space.

Scale: the fit takes at most ``TEXTS`` distinct labelled texts per language and ``REFERENCE``
characters of each language (a bound of the classifier, a few MB per language to broadcast);
prediction is one pass without a shuffle over whole texts.

Defined cases: a null text or one without a letter is ``und`` with score 0; ties go to the
language first in code-point order; with no labelled text all texts are ``und``; with one
language the score is 1; repeated rows are predicted each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Bounds of the fit: distinct texts per language, characters of the reference, of one text in it.
TEXTS, REFERENCE = 120, 36_000
PER_TEXT = REFERENCE // TEXTS
#: Characters after which a parse restarts, and characters parsed at a time.
SEGMENT, CHUNK = 512, 1 << 20
UNKNOWN_LANGUAGE = "und"
_SPACE, _OTHER, _PAD = 0, 1, 2


@lru_cache(maxsize=1)
def lower_letters() -> np.ndarray:
    """Lower-case letter of every code point; 32 for what is not a letter."""
    out = np.full(0x110000, 32, dtype=np.int32)
    for c in range(0x110000):
        own = chr(c)
        if own.isalpha():
            low = own.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def normalised(text: str) -> np.ndarray:
    """Lower-case letters with single spaces between them, as code points."""
    codes = lower_letters()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def suffix_automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """Transitions of the suffix automaton, one row per state, -1 where there is none."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.full((len(moves), alphabet), -1, dtype=np.int32)
    for state, own in enumerate(moves):
        for s, to in own.items():
            table[state, s] = to
    return table


class References:
    """Automata of all languages in one table, with what maps characters to its columns."""

    def __init__(self, texts: dict[str, list[str]]) -> None:
        joined = {}
        for name in sorted(texts):
            # from the middle of each text: openings are often alike
            parts = []
            for t in texts[name]:
                codes = normalised(t)
                start = max(0, (len(codes) - PER_TEXT) // 2)
                parts += [codes[start : start + PER_TEXT], np.array([-1], dtype=np.int32)]
            whole = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
            if (whole > 32).any():
                joined[name] = whole
        self.names = list(joined)
        letters = sorted({int(c) for codes in joined.values() for c in np.unique(codes) if c > 32})
        self.letters = np.array(letters, dtype=np.int64)
        self.alphabet = len(letters) + 3
        column = {32: _SPACE, **{c: i + 3 for i, c in enumerate(letters)}}
        tables, self.roots, self.weights = [], [], []
        size = 0
        for name, codes in joined.items():
            # a break between texts is a symbol that no text has
            own = suffix_automaton([column.get(int(c), _OTHER) for c in codes], self.alphabet)
            own[:, _OTHER] = -1
            own = np.where(own >= 0, own + size, -1).astype(np.int32)
            own[:, _PAD] = np.arange(size, size + len(own))
            tables.append(own)
            self.roots.append(size)
            self.weights.append(float(np.log2(max(2, (codes > 0).sum()))))
            size += len(own)
        self.table = np.concatenate(tables) if tables else np.zeros((0, self.alphabet), dtype=np.int32)

    def columns(self) -> np.ndarray:
        """Column of the table for every code point."""
        low = lower_letters()
        out = np.full(0x110000, _OTHER, dtype=np.int32)
        out[32] = _SPACE
        out[self.letters] = np.arange(3, self.alphabet)
        return np.where(low == 32, _SPACE, out[low]).astype(np.int32)

    def entropies(self, texts: list[str], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language, and the number of letters of each text."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        codes = columns[np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)]
        text = np.repeat(np.arange(len(texts)), sizes)
        letters = np.bincount(text[codes != _SPACE], minlength=len(texts))
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE) | (text[1:] != text[:-1])
        codes, text = codes[keep], text[keep]
        length = np.bincount(text, minlength=len(texts))
        lanes = -(-length // SEGMENT)
        lane_of = np.concatenate(([0], np.cumsum(lanes)))
        at = np.arange(len(codes)) - np.concatenate(([0], np.cumsum(length)))[text]
        steps = np.full((SEGMENT, lane_of[-1]), _PAD, dtype=np.int32)
        steps[at % SEGMENT, lane_of[text] + at // SEGMENT] = codes
        flat, width = self.table.ravel(), self.alphabet
        roots = np.repeat(np.array(self.roots, dtype=np.int64)[:, None], lane_of[-1], axis=1)
        state, phrases = roots.copy(), np.zeros(roots.shape, dtype=np.int64)
        for own in steps:
            to = flat[state * width + own]
            ended = to < 0
            phrases += ended
            again = flat[roots * width + own]
            state = np.where(ended, np.where(again < 0, roots, again), to)
        phrases += state != roots
        by_text = np.zeros((len(self.names), len(texts)))
        filled = lanes > 0
        if filled.any():
            by_text[:, filled] = np.add.reduceat(phrases, lane_of[:-1][filled], axis=1)
        return by_text * np.array(self.weights)[:, None] / np.maximum(length, 1), letters

    def predict(self, texts: list[str | None], columns: np.ndarray) -> tuple[list[str], list[float]]:
        names, scores = [], []
        held: list[str] = []
        size = 0

        def finish() -> None:
            entropy, letters = self.entropies(held, columns)
            best = entropy.argmin(axis=0)
            ordered = np.sort(entropy, axis=0)
            for i in range(len(held)):
                if not letters[i]:
                    names.append(UNKNOWN_LANGUAGE)
                    scores.append(0.0)
                else:
                    names.append(self.names[best[i]])
                    scores.append(1.0 - float(ordered[0, i] / ordered[1, i]) if len(ordered) > 1 and ordered[1, i] else float(len(ordered) == 1))

        if not self.names:
            return [UNKNOWN_LANGUAGE] * len(texts), [0.0] * len(texts)
        for t in texts:
            t = t or ""
            if held and size + len(t) > CHUNK:
                finish()
                held, size = [], 0
            held.append(t)
            size += len(t)
        if held:
            finish()
        return names, scores


def fit(labelled: DataFrame) -> References:
    """References from (text, lang) rows, both not null: distinct texts with the smallest hashes."""
    rows = labelled.select("lang", "text", F.xxhash64("text").alias("mark"))
    marks = rows.groupBy("lang", "mark").agg(F.lit(1).alias("one"))
    counts = marks.groupBy(F.col("lang").alias("of_lang")).agg(F.count("*").alias("n"))
    cells = 1 << 20
    near = marks.join(counts, F.col("lang") == F.col("of_lang")).where(F.pmod("mark", F.lit(cells)).cast("double") * F.col("n") <= 4.0 * TEXTS * cells)
    first = Window.partitionBy("lang").orderBy(F.pmod("mark", F.lit(cells)), "mark")
    near = near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= TEXTS).select(F.col("lang").alias("of_lang"), F.col("mark").alias("of_mark"))
    chosen = [(r.of_lang, r.of_mark) for r in near.collect()]
    texts: dict[str, list[str]] = {}
    if chosen:
        wanted = rows.where(F.col("mark").isin([m for _, m in chosen])).groupBy("lang", "mark").agg(F.min("text").alias("text"))
        kept = set(chosen)
        for r in wanted.orderBy("lang", "mark").collect():
            if (r["lang"], r["mark"]) in kept:
                texts.setdefault(r["lang"], []).append(r["text"])
    return References(texts)


def predict(docs: DataFrame, references: References, keep: list[Column]) -> DataFrame:
    """The kept columns, ``lang_pred`` and ``score`` of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(references)
    named = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("the_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        columns = own.columns()
        for batch in batches:
            names, scores = own.predict(batch.column(batch.num_columns - 1).to_pylist(), columns)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64())], names=[*batch.schema.names[:-1], "lang_pred", "score"]
            )

    return named.mapInArrow(run, f"{schema}, lang_pred string, score double")


def predict_held_out(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): fitted on the rows that are not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    references = fit(docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    return predict(docs, references, [F.col("doc_id"), held_out.alias("held_out")])
