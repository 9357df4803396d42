import hashlib
import zlib

import numpy as np
import pytest

from tenderline.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, bump=False):
    doc_id, source, lang, n_chars, text = row
    if bump and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None:
        n_chars += 1
    return h("".join(field(v) for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(nodes):
    """Levels of the tree as lists, bottom first, by the contract's words."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        cur = levels[-1]
        levels.append([h("".join(cur[i : i + 2])) for i in range(0, len(cur), 2)])
    return levels


def plain_path(levels, i):
    path = []
    for level in levels[:-1]:
        other = i ^ 1
        path.append(("S", "") if other >= len(level) else ("L" if i & 1 else "R", level[other]))
        i >>= 1
    return path


def fold(start, path):
    for side, d in path:
        start = h(d + start) if side == "L" else h(start + d) if side == "R" else h(start)
    return start


def plain(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees, order = {}, {}
    for lang in langs:
        ordered = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        order[lang] = ordered
        trees[lang] = plain_tree([leaf(r) for r in ordered])
    top = plain_tree([trees[lang][-1][0] for lang in langs])
    root = top[-1][0]
    out = []
    for li, lang in enumerate(langs):
        for i, r in enumerate(order[lang]):
            path = plain_path(trees[lang], i) + plain_path(top, li)
            folded = fold(leaf(r, bump=True), path)
            out.append((r[0], leaf(r), trees[lang][-1][0], root, h("".join(d for _, d in path)), folded, folded == root))
    return sorted(out, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[4]))


def got(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", "1 AS tree", "'x' AS idx", "2 AS path", "'y' AS own_id", "3 AS digest", "4 AS kind", "5 AS leaf")
    res = manifest.manifest(df).collect()
    return sorted([tuple(r) for r in res], key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[4]))


def test_positions_are_postorder():
    for n in range(1, 70):
        order = []

        def visit(k, j):
            if k > 0:
                for child in (2 * j, 2 * j + 1):
                    if child < -(-n >> (k - 1)):
                        visit(k - 1, child)
            order.append((k, j))

        visit(manifest.levels_of(n), 0)
        for p, (k, j) in enumerate(order):
            assert manifest.positions(k, np.array([j]), n)[0] == p, (n, k, j)


def test_matches_plain_version_with_nulls_repeats_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", 2)
    rows = [(i, f"s{i % 3}", ["en", "de", None, "fr"][i % 4] if i % 9 else "en", i * 7 if i % 5 else None, None if i % 11 == 0 else "é" * (i % 13)) for i in range(1, 60)]
    rows += [(None, None, None, None, None), (5, "s2", "de", 35, "ééééé"), rows[3], rows[3], (7, "x", "zz", 1, "only")]
    assert got(spark, rows) == plain(rows)
    assert got(spark, rows, extra=True) == plain(rows)


def test_single_rows_and_empty(spark):
    one = [(3, "a", "en", 10, "hello")]
    assert got(spark, one) == plain(one)
    assert got(spark, []) == []
    two_langs = [(1, "a", "en", 1, "x"), (2, "a", "ä", 2, "y"), (3, "a", "ab", None, "")]
    assert got(spark, two_langs) == plain(two_langs)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select(*manifest.FIELDS).collect()]
    result = got(spark, rows)
    assert result == plain(rows)
    assert any(not r[6] for r in result) and any(r[6] for r in result)
