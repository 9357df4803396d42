import hashlib
import random

import numpy as np

from tenderline.llm import repeats


def by_brute_force(texts):
    where = {}
    for t, data in enumerate(texts):
        for i in range(len(data) - repeats.WINDOW + 1):
            where.setdefault(data[i : i + repeats.WINDOW], []).append((t, i))
    spans = [[] for _ in texts]
    for places in where.values():
        if len(places) > 1:
            for t, i in places:
                spans[t].append((i, i + repeats.WINDOW))
    out = []
    for data, own in zip(texts, spans):
        runs = repeats.merged_ranges(own)
        gone = set()
        for a, b in runs:
            gone.update(range(a, b))
        out.append((len(data), len(gone), len(runs), hashlib.sha256(bytes(x for i, x in enumerate(data) if i not in gone)).hexdigest()))
    return out


def sample(rng):
    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passage = noise(420)
    texts = [None, "", "short", noise(199), "a" * 450, "ab" * 300, noise(700)]
    texts += [noise(rng.randrange(150)) + passage[rng.randrange(150) :] + noise(rng.randrange(200)) for _ in range(12)]
    texts += [passage, passage, "x" + passage[1:], texts[6], texts[6][:350] + "#" + texts[6][351:]]
    return texts


def check(spark):
    texts = sample(random.Random(3))
    docs = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts)], "doc_id bigint, text string, `row` string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.digests(docs).collect()}
    want = by_brute_force([(t or "").encode() for t in texts])
    assert got == dict(enumerate(want))
    assert sum(w[1] for w in want) > 3000


def test_removes_what_brute_force_removes(spark):
    check(spark)


def test_anchors_that_are_not_indexed_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(repeats, "INDEXED", 0)
    check(spark)


def test_long_texts_are_cut_into_pieces_without_loss(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    rng = random.Random(4)
    text = "".join(rng.choice("abcdef") for _ in range(2500))
    starts, sizes = [], []
    for rows, offsets, data, a, b in repeats._pieces([b"", text.encode(), None, text[:900].encode()]):
        piece, first, size, _, _ = repeats.spans_of(data, a, b)
        for p, f, s in zip(piece, first, size):
            if rows[p] == 1:
                starts.append(offsets[p] + f)
                sizes.append(s - repeats.WINDOW + 1)
    covered = sorted(i for a, n in zip(starts, sizes) for i in range(a, a + n))
    assert covered == list(range(2500 - repeats.WINDOW + 1))


def test_longest_matches_equal_brute_force():
    rng = random.Random(9)
    base = bytes(rng.choice(b"ab") for _ in range(60))
    texts = list({base[rng.randrange(20) :][: rng.randrange(15, 40)] + bytes([rng.choice(b"abc")]) for _ in range(12)})
    longest, starts = repeats.longest_elsewhere(texts)
    for t, start in zip(texts, starts):
        for i in range(len(t)):
            best = 0
            for u in texts:
                for j in range(len(u)):
                    if u is t and i == j:
                        continue
                    n = 0
                    while i + n < len(t) and j + n < len(u) and t[i + n] == u[j + n]:
                        n += 1
                    best = max(best, n)
            assert min(longest[start + i], len(t) - i) == best


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert repeats.digests(docs).count() == 0
    assert np.array_equal(repeats.spans_of(b"", np.zeros(0, int), np.zeros(0, int))[0], np.zeros(0))
