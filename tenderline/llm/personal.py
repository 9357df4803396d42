"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions.

Base patterns find emails, ip addresses, card and phone numbers. The tagger, trained in numpy from
labelled spans, finds more of the same kinds in forms that no pattern names. Texts are cut into
windows that overlap by half; each is decoded by Viterbi, spans that touch an inner window edge
are left to the neighbour, and what is left is reconciled over the whole text: the better score
first, nothing that overlaps a span already taken. An added span must also read as its kind (four
parts up to 255, a valid check digit, enough digits), so it never rests on the network alone.

Every kind needs a digit or an @, so windows without either hold no span and are not decoded;
that skips no result.

Scale: one pass over whole texts, no shuffle. The fit takes the base spans of at most
``SAMPLE_TEXTS`` texts of up to ``SAMPLE_CHARS`` characters (the bound of the classifier), written
also in other forms; its few thousand weights are the only broadcast.

Defined cases: a null text is empty and has no spans; repeated rows are searched each; a text of
any length is searched whole; with nothing to learn from, only base spans are found; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ["email", "ip", "card", "phone"]
WINDOW, STRIDE = 96, 48
HIDDEN, EPOCHS, BATCH, RATE = 20, 10, 48, 0.02
SAMPLE_TEXTS, SAMPLE_CHARS, SAMPLE_WINDOWS = 2000, 20_000, 900
LANES = 512

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small_parts(text: str) -> bool:
    parts = [p.lstrip("0") for p in re.findall(r"[0-9]+", text)]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that pass their check, by start and kind."""
    out: list[tuple[int, int, int]] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, 0, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    for k, pattern, fine in (
        (1, _IP, _small_parts),
        (2, _CARD, lambda s: 12 <= len(d := _digits(s)) <= 19 and passes_luhn(d)),
        (3, _PHONE, lambda s: 9 <= len(_digits(s)) <= 15),
    ):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if fine(m[0])]
    return [(KINDS[k], start, end) for start, k, end in sorted(out)]


_READS_AS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+\s?(?:@|\(at\)|\[at\]|\(@\)|\[@\])\s?[A-Za-z0-9-]+(?:\s?(?:\.|\(dot\)|\[dot\]|\[\.\]|\(\.\))\s?[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[ ./-]{0,2}[0-9]){11,18}"),
    "phone": re.compile(r"(?:00|\+)?\s?\(?[0-9]{1,4}\)?(?:[ ./()-]{1,2}[0-9]{2,}){2,6}"),
}


def reads_as(kind: str, text: str) -> bool:
    """Whether a found span is a possible value of its kind."""
    if not _READS_AS[kind].fullmatch(text):
        return False
    if kind == "ip":
        return _small_parts(text)
    if kind == "card":
        return passes_luhn(_digits(text))
    return kind != "phone" or 9 <= len(_digits(text)) <= 15 and not _small_parts(text)


def _character_classes() -> np.ndarray:
    """Class of code points below 592; digits share one, letters ignore case, others share two."""
    table = np.zeros(592, dtype=np.int16)
    for c in range(592):
        own = chr(c).lower()
        if "a" <= own <= "z":
            table[c] = 4 + ord(own[0]) - ord("a")
        elif own.isalpha():
            table[c] = 1
        elif "0" <= own <= "9":
            table[c] = 2
        elif 32 <= c < 127:
            table[c] = 31 + sum(not chr(i).isalnum() for i in range(32, c))
        elif own.isspace():
            table[c] = 3
    return table


_CLASS = _character_classes()
CLASSES = int(_CLASS.max()) + 2
_PAD = CLASSES - 1
TAGS = 1 + 2 * len(KINDS)
#: Inside tags follow their own begin or inside tag only.
_ALLOWED = np.array([[j == 0 or j % 2 == 1 or (i in (j, j - 1)) for j in range(TAGS)] for i in range(TAGS)])
_STARTS = np.array([j == 0 or j % 2 == 1 for j in range(TAGS)])


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.where(codes < 592, _CLASS[np.minimum(codes, 591)], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Weights and what is computed with them; arrays are (lane, step, ...)."""

    def __init__(self, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.15).astype(np.float32)
        self.w = {"b": np.zeros(TAGS, np.float32), "a": small(TAGS, TAGS), "s": small(TAGS)}
        for side in "fr":
            self.w |= {f"x{side}": small(CLASSES, 4 * HIDDEN), f"h{side}": small(HIDDEN, 4 * HIDDEN), f"u{side}": small(HIDDEN, TAGS)}
            self.w[f"x{side}"][:, HIDDEN : 2 * HIDDEN] += 1.0

    def _run(self, side: str, codes: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states of one direction, and what its gradient needs."""
        lanes, steps = codes.shape
        h = c = np.zeros((lanes, HIDDEN), np.float32)
        out, kept = np.empty((lanes, steps, HIDDEN), np.float32), []
        wx, wh = self.w[f"x{side}"], self.w[f"h{side}"]
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = wx[codes[:, t]] + h @ wh
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            kept.append((t, i, f, o, g, before, tc, h_before))
        return out, kept

    def _back(self, side: str, codes: np.ndarray, kept: list, grad: np.ndarray, into: dict) -> None:
        wh = self.w[f"h{side}"]
        dh = dc = np.zeros((len(codes), HIDDEN), np.float32)
        for t, i, f, o, g, before, tc, h_before in reversed(kept):
            dh = dh + grad[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), axis=1)
            np.add.at(into[f"x{side}"], codes[:, t], dz)
            into[f"h{side}"] += h_before.T @ dz
            dh, dc = dz @ wh.T, dc * f

    def scores(self, codes: np.ndarray) -> tuple[np.ndarray, dict]:
        states = {side: self._run(side, codes) for side in "fr"}
        return states["f"][0] @ self.w["uf"] + states["r"][0] @ self.w["ur"] + self.w["b"], states

    def _moves(self) -> tuple[np.ndarray, np.ndarray]:
        return np.where(_ALLOWED, self.w["a"], np.float32(-1e4)), np.where(_STARTS, self.w["s"], np.float32(-1e4))

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags, and its gradient."""
        emitted, states = self.scores(codes)
        lanes, steps, _ = emitted.shape
        a, s = self._moves()

        def summed(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        alpha, beta = np.empty_like(emitted), np.zeros_like(emitted)
        alpha[:, 0] = s + emitted[:, 0]
        for t in range(1, steps):
            alpha[:, t] = summed(alpha[:, t - 1][:, :, None] + a, 1) + emitted[:, t]
        for t in range(steps - 2, -1, -1):
            beta[:, t] = summed(a + (emitted[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        whole = summed(alpha[:, -1], 1)
        into = {k: np.zeros_like(v) for k, v in self.w.items()}
        each = np.exp(alpha + beta - whole[:, None, None])
        row = np.arange(lanes)
        gold = s[tags[:, 0]] + emitted[row[:, None], np.arange(steps), tags].sum(axis=1)
        into["s"] += each[:, 0].sum(axis=0)
        np.subtract.at(into["s"], tags[:, 0], 1)
        for t in range(1, steps):
            pair = np.exp(alpha[:, t - 1][:, :, None] + a + (emitted[:, t] + beta[:, t])[:, None, :] - whole[:, None, None])
            into["a"] += pair.sum(axis=0)
            np.subtract.at(into["a"], (tags[:, t - 1], tags[:, t]), 1)
            gold = gold + a[tags[:, t - 1], tags[:, t]]
        each[row[:, None], np.arange(steps), tags] -= 1
        into["b"] += each.sum(axis=(0, 1))
        for side in "fr":
            out, kept = states[side]
            into[f"u{side}"] += out.reshape(-1, HIDDEN).T @ each.reshape(-1, TAGS)
            self._back(side, codes, kept, each @ self.w[f"u{side}"].T, into)
        into["a"][~_ALLOWED] = 0
        into["s"][~_STARTS] = 0
        return float((whole - gold).mean()), {k: v / lanes for k, v in into.items()}

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of every lane, and how far each step's tag leads over the outside tag."""
        emitted, _ = self.scores(codes)
        lanes, steps, _ = emitted.shape
        a, s = self._moves()
        best = s + emitted[:, 0]
        came = np.zeros((steps, lanes, TAGS), dtype=np.int8)
        for t in range(1, steps):
            options = best[:, :, None] + a
            came[t] = options.argmax(axis=1)
            best = options.max(axis=1) + emitted[:, t]
        tags = np.empty((lanes, steps), dtype=np.int64)
        tags[:, -1] = best.argmax(axis=1)
        row = np.arange(lanes)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = came[t][row, tags[:, t]]
        lead = emitted[row[:, None], np.arange(steps), tags] - emitted[:, :, 0]
        return tags, lead


def tags_of(size: int, spans: list[Span], start: int, width: int = WINDOW) -> np.ndarray:
    """Tags of the window at ``start``; a span cut by an edge is tagged as far as it is inside."""
    out = np.zeros(width, dtype=np.int64)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        lo, hi = max(a, start) - start, min(b, start + width, size) - start
        if lo < hi:
            out[lo:hi] = k + 1
            out[lo] = k
    return out


def window_of(codes: np.ndarray, start: int, width: int = WINDOW) -> np.ndarray:
    out = np.full(width, _PAD, dtype=np.int16)
    own = codes[start : start + width]
    out[: len(own)] = own
    return out


def train(labelled: list[tuple[str, list[Span]]], seed: int = 1) -> Tagger | None:
    """A tagger from texts with labelled spans; None without any span."""
    rng = random.Random(seed)
    samples = []
    for text, spans in labelled:
        codes = classes_of(text)
        starts = []
        for _, a, b in spans:
            low, high = max(0, b - WINDOW + 4), max(0, a - 4)
            starts.append(rng.randint(min(low, high), high))
        places = [m.start() for m in _TRIGGER.finditer(text)]
        if places:
            starts.append(max(0, rng.choice(places) - rng.randrange(WINDOW)))
        samples += [(window_of(codes, s), tags_of(len(text), spans, s)) for s in starts]
    rng.shuffle(samples)
    with_span = [s for s in samples if s[1].any()][: SAMPLE_WINDOWS * 2 // 3]
    without = [s for s in samples if not s[1].any()][: SAMPLE_WINDOWS // 3]
    samples = with_span + without
    if not with_span:
        return None
    rng.shuffle(samples)
    codes, tags = np.stack([s[0] for s in samples]), np.stack([s[1] for s in samples])
    tagger = Tagger(seed)
    first, second = ({k: np.zeros_like(v) for k, v in tagger.w.items()} for _ in range(2))
    step = 0
    for epoch in range(EPOCHS):
        order = np.random.default_rng(seed + epoch).permutation(len(samples))
        rate = RATE * (1 - 0.8 * epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            _, grad = tagger.gradient(codes[pick], tags[pick])
            step += 1
            norm = float(np.sqrt(sum((g * g).sum() for g in grad.values())))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                tagger.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return tagger


def _other_forms(text: str, spans: list[Span], rng: random.Random) -> tuple[str, list[Span]]:
    """The text with its labelled values written in forms that the base patterns do not name."""
    out, at, moved = [], 0, []
    size = 0
    for kind, a, b in spans:
        if a < at:
            continue
        value = text[a:b]
        digits = _digits(value)
        if kind == "email":
            value = value.replace("@", rng.choice(("@", " @ ", "[@]", " @")))
        elif kind == "ip":
            value = value.replace(".", rng.choice((".", "[.]", " . ")))
        elif kind == "card":
            value = rng.choice((".", "/", "  ", " ")).join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            value = rng.choice(("{1}-{2}-{3}", "({1}) {2}-{3}", "00{0} {1} {2} {3}", "{1}.{2}.{3}", "{0}/{1} {2} {3}")).format(digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:])
            value = value.lstrip("/")
        out += [text[at:a], value]
        size += a - at
        moved.append((kind, size, size + len(value)))
        size += len(value)
        at = b
    return "".join(out) + text[at:], moved


def fit(docs: DataFrame) -> Tagger | None:
    """A tagger from the base spans of a bounded sample of texts, as they are and in other forms."""
    rows = docs.select("text").where((F.char_length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    # marks first: only the chosen texts, each once, come to the driver
    marks = [r["mark"] for r in rows.select("mark").distinct().orderBy("mark").limit(SAMPLE_TEXTS).collect()]
    chosen = rows.where(F.col("mark").isin(marks)).groupBy("mark").agg(F.min("text").alias("text"))
    texts = [r["text"] for r in chosen.orderBy("mark").collect()]
    rng = random.Random(7)
    labelled = []
    for i, text in enumerate(texts):
        spans = base_spans(text)
        labelled.append(_other_forms(text, spans, rng) if i % 3 == 0 else (text, spans))
    return train(labelled)


def added_spans(texts: list[str], base: list[list[Span]], tagger: Tagger | None) -> list[list[Span]]:
    """Spans that the tagger adds to the base spans of each text."""
    out: list[list[Span]] = [[] for _ in texts]
    if tagger is None:
        return out
    found: list[list[tuple[float, str, int, int]]] = [[] for _ in texts]
    lanes: list[tuple[int, int, int, np.ndarray]] = []

    def decode() -> None:
        tags, lead = tagger.decode(np.stack([lane[3] for lane in lanes]))
        for (number, start, size, _), own, ahead in zip(lanes, tags, lead):
            begins = np.flatnonzero(own % 2 == 1)
            for b in begins.tolist():
                kind, e = own[b], b + 1
                while e < WINDOW and own[e] == kind + 1:
                    e += 1
                first, end = start + b, start + e
                if (b == 0 and start > 0) or (e == WINDOW and end < size):
                    continue
                found[number].append((float(ahead[b:e].mean()), KINDS[(kind - 1) // 2], first, min(end, size)))
        lanes.clear()

    for number, text in enumerate(texts):
        wanted = set()
        for m in _TRIGGER.finditer(text):
            k = m.start() // STRIDE
            wanted.add(k)
            if k:
                wanted.add(k - 1)
        if wanted:
            codes = classes_of(text)
            for k in sorted(wanted):
                lanes.append((number, k * STRIDE, len(text), window_of(codes, k * STRIDE)))
                if len(lanes) == LANES:
                    decode()
    if lanes:
        decode()
    for number, text in enumerate(texts):
        if found[number]:
            taken = [(a, b) for _, a, b in base[number]]
            for _, kind, a, b in sorted(set(found[number]), key=lambda s: (-s[0], s[2], s[3], s[1])):
                while a < b and text[a] in " .,;:-/\n":
                    a += 1
                while a < b and text[b - 1] in " .,;:-/\n":
                    b -= 1
                if a < b and reads_as(kind, text[a:b]) and not any(a < y and x < b for x, y in taken):
                    taken.append((a, b))
                    out[number].append((kind, a, b))
    return out


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, each by start and kind."""
    base = [base_spans(t) if _TRIGGER.search(t) else [] for t in texts]
    more = added_spans(texts, base, tagger)
    return [(own, sorted([*own, *extra], key=lambda s: (s[1], KINDS.index(s[0])))) for own, extra in zip(base, more)]


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans are one gap."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def find(docs: DataFrame, keep: list[str] | None = None, tagger: Tagger | None = None) -> DataFrame:
    """The kept columns (default doc_id), base counts, ``base``, ``spans`` and ``redacted`` text.

    Without a tagger, one is fitted on ``docs``.
    """
    keep = ["doc_id"] if keep is None else keep
    tagger = fit(docs) if tagger is None else tagger
    sent = docs.sparkSession.sparkContext.broadcast(tagger)
    named = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.coalesce("text", F.lit("")).alias("the_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in named.schema[:-1])
    names = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            both = all_spans(texts, sent.value)
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in both], type=pa.int64()) for kind in KINDS]
            strings = [
                pa.array([spelled(base) for base, _ in both], type=pa.string()), pa.array([spelled(spans) for _, spans in both], type=pa.string()),
                pa.array([redacted(t, spans) if spans else t for t, (_, spans) in zip(texts, both)], type=pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counts, *strings], names=[*batch.schema.names[:-1], *names, "base", "spans", "redacted"])

    out = named.mapInArrow(run, f"{schema}{''.join(f'{n} bigint, ' for n in names)}base string, spans string, redacted string")
    for i, c in enumerate(keep):
        out = out.withColumnRenamed(f"kept_{i}", c)
    return out


def digests(docs: DataFrame) -> DataFrame:
    return find(docs).select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def sha256_of(spans: list[Span]) -> str:
    return hashlib.sha256(spelled(spans).encode()).hexdigest()
