import random
import re
import string

import numpy as np
import pyarrow as pa

from tenderline.llm import near, shingles

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def set_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def by_brute_force(rows):
    sets = [set_of(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            groups.setdefault(root(i), []).append(doc_id)
    return sorted(((d, len(s), min(groups.get(root(i), [None]), default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def sample(rng, n=160):
    vocabulary = ["w%d" % i for i in range(60)] + ["é", "Ab", "aB", "x y"]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    bases = [[rng.choice(vocabulary) for _ in range(size)] for size in (3, 4, 5, 6, 8, 10, 13, 16, 20, 30, 60, 200)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            words = words[: rng.randrange(1, len(words) + 1)]
        if rng.random() < 0.2:
            words += passage
        rows.append((i, rng.choice((" ", "\n", "  ", "\t")).join(words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "one"), (n + 4, "One"), (5, rows[5][1]), (7, "different text under a known id"), (None, rows[9][1]), (None, None)]


def check(spark, rows):
    docs = spark.createDataFrame([(d, t, "r") for d, t in rows], "doc_id bigint, text string, `label` string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near.components(docs).collect()), key=str)
    assert got == by_brute_force(rows)


def test_groups_equal_brute_force(spark):
    check(spark, sample(random.Random(1)))


def test_the_exact_round_alone_and_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "LONG_LIST", 3)
    monkeypatch.setattr(near, "BLOCK", 4)
    monkeypatch.setattr(near, "ROUNDS", 1)
    check(spark, sample(random.Random(2), 110))


def test_a_long_list_gives_fewer_links_than_members():
    rng = np.random.default_rng(5)
    common = rng.integers(0, 1 << 63, 90).astype(np.uint64)
    sets = [np.unique(np.concatenate((common, rng.integers(0, 1 << 63, 4).astype(np.uint64)))) for _ in range(50)]
    sets += [np.unique(rng.integers(0, 1 << 63, 94).astype(np.uint64)) for _ in range(10)]
    names = list(range(100, 160))

    def rows(last):
        columns = [[7] * 60, [0] * 60, [0] * 60, [0] * 60, names, [len(s) for s in sets], [0] * 60, names, last]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=[*near.LONG, "last"])
        return iter([batch.slice(0, 25), batch.slice(25)])

    kept = [r for b in near._members_to_test(rows([near.bitmap(s) for s in sets])) for r in b.to_pylist()]
    assert [r["set"] for r in kept] == names[:50]  # all of the group, nothing else
    links = [(r["a"], r["b"]) for b in near._links_between_groups(rows([s.tobytes() for s in sets])) for r in b.to_pylist()]
    assert len(links) == 49 and {x for link in links for x in link} == set(names[:50])


def test_short_lists_that_go_on_in_the_next_batch(monkeypatch):
    monkeypatch.setattr(near, "CHUNK_ROWS", 4)
    rng = random.Random(6)
    rows = sorted((rng.randrange(9), i, rng.choice((40, 50, 90)), 0, rng.randrange(12)) for i in range(70))
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=["key", "set", "n", "need", "label"])
    found = [tuple(r.values()) for b in near._pairs_between_groups(batch.slice(i, 3) for i in range(0, 70, 3)) for r in b.to_pylist()]
    want = {(x[1], y[1]) for x in rows for y in rows if x[1] < y[1] and x[0] == y[0] and x[4] != y[4] and 4 * min(x[2], y[2]) >= 3 * max(x[2], y[2])}
    assert set(found) == want


def test_an_empty_table(spark):
    assert near.components(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = sample(random.Random(3), 60)
    docs = spark.createDataFrame([(d, t, "de") for d, t in rows], "doc_id bigint, text string, lang string")
    kept = near.one_of_each_group(docs)
    assert kept.columns == docs.columns
    groups = {c for (d, n, c) in by_brute_force(rows) if n}
    blank = [d for d, t in rows if not set_of(t)] + [7]  # id 7 names two texts, each a group
    got = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, got)) == sorted(map(str, [*groups, *blank]))


def test_shingles_equal_plain_sets():
    texts = [t for _, t in sample(random.Random(4))]
    for text, own in zip(texts, shingles.shingle_sets([None if t is None else t.encode() for t in texts])):
        assert len(own) == len(set_of(text)) and np.all(own[1:] > own[:-1])


def test_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for n in (1, 5, 100, 700):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], rng.integers(0, 1 << 63, n).astype(np.uint64))))
        x, y = (np.frombuffer(near.bitmap(v), dtype=np.uint8)[None, :] for v in (a, b))
        size = min(x.shape[1], y.shape[1])
        assert np.bitwise_count(near._folded(x, size) ^ near._folded(y, size)).sum() <= len(np.setxor1d(a, b))


def test_boundary_follows_the_cost():
    assert near.boundary({}) == 0
    assert near.boundary({24: 1000}) < 24
    assert near.boundary({3: 1000}) >= 3
