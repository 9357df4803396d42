import hashlib

from tenderline.llm import merkle


def test_phrases_give_the_paragraph_back():
    for text in ("", "a", "A b. C d! E", "x" * 500, "word " * 100 + ".", "One. Two? " * 40 + "end", " . ", "é. " * 80):
        assert "".join(merkle.phrases(text)) == text


def test_equal_roots_and_located_edits():
    lines = [f"Paragraph number {i}, with words. And a second sentence here." for i in range(40)]
    a, b = merkle.Tree("\n".join(lines)), merkle.Tree("\n".join([*lines[:20], "Changed.", *lines[21:]]))
    assert merkle.Tree("\n".join(lines)).text == a.text and a.root != b.root
    assert 0.9 < merkle.likeness(a, b) < 1.0
    assert len(merkle.differing(a.text, b.text)) == 1 and merkle.differing(a.text, a.text) == []
    assert merkle.Tree("a\nb").root != merkle.Tree("ab").root and merkle.Tree("").root == merkle.Tree("").root
    assert merkle.likeness(merkle.Tree(""), a) == 0.0 and merkle.likeness(merkle.Tree(""), merkle.Tree("")) == 1.0


def plain(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), merkle.likeness(merkle.Tree(text), merkle.Tree(following))))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, `range` int")
    out = merkle.compare_with_next(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_next) for r in out), key=str) == plain(rows)
    for r in out:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.fingerprint and r.edited_fingerprint


ROWS = [(i * 7 % 101, f"Text {i}. " + "Words of it, é. " * (i % 23) + "\n" * (i % 3)) for i in range(101)]
ODD = [(5, "same id"), (5, "same id"), (None, "no id"), (None, None), (3000, ""), (-4, "x")]


def test_neighbours_in_one_range(spark):
    check(spark, ROWS + ODD)
    check(spark, [(1, "alone here. Twice.")])


def test_neighbours_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS", 3)
    check(spark, ROWS + ODD)
    monkeypatch.setattr(merkle, "ROWS", 12)
    check(spark, ROWS + ODD)


def test_edited_texts_are_nearer_than_the_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = merkle.compare_with_next(docs).collect()
    assert sum(r.near_edited > r.near_next for r in out) > 0.9 * len(out)
    assert merkle.compare_with_next(docs.limit(0)).count() == 0
    by_id = {r.doc_id: r.fingerprint for r in out}
    assert {r.doc_id: r.fingerprint for r in merkle.fingerprints(docs).collect()} == by_id
