import random
import re

import numpy as np
import pytest

from tenderline.llm import personal

LUHN = "4111 1111 1111 1111"


def spans(text):
    return personal.base_spans(text)


def test_base_patterns():
    assert spans("") == [] and spans("plain") == []
    assert spans("a@b.c") == [("email", 0, 5)]
    assert spans("x a@b c@d.ee.f, @g.h i@") == [("email", 6, 14)]
    assert spans("a@b.c@d.e") == [("email", 0, 5)]
    assert spans("1.2.3.4 256.1.1.1 1.2.3.4.5 0000255.1.2.3") == [("ip", 0, 7), ("ip", 18, 25), ("ip", 28, 41)]
    assert spans(f"é {LUHN} and 4111111111111112") == [("card", 2, 21)]
    assert spans("+1 (854) 555-8570 +12 3") == [("phone", 0, 17)]
    assert spans("9" * 6000) == []
    # The contract's ip pattern matches "1.1.1.1" again and again in a run of "1.": 750 spans.
    assert spans("1." * 3000) == [("ip", 8 * k, 8 * k + 7) for k in range(750)]
    both = spans("+41 111 111 111 111 1111")
    assert [s[0] for s in both] == ["phone"] or both == []


def test_emails_equal_the_plain_pattern():
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("ab.@-_ 1") for _ in range(rng.randrange(30)))
        want = [("email", m.start(), m.end()) for m in pattern.finditer(text)]
        assert [s for s in spans(text) if s[0] == "email"] == want, text


def test_gradient_by_differences():
    tagger = personal.Tagger(3)
    for k in tagger.w:
        tagger.w[k] = tagger.w[k].astype(np.float64)
    rng = np.random.default_rng(0)
    codes = rng.integers(0, personal.CLASSES, (3, 7))
    tags = np.array([[0, 1, 2, 2, 0, 3, 4], [0] * 7, [7, 8, 8, 0, 0, 5, 6]])
    _, grad = tagger.gradient(codes, tags)
    for k, at in (("b", (7,)), ("a", (0, 1)), ("s", (0,)), ("uf", (4, 2)), ("ur", (1, 0)), ("xf", (codes[0, 2], 5)), ("hr", (2, 9))):
        tagger.w[k][at] += 1e-3
        up, _ = tagger.gradient(codes, tags)
        tagger.w[k][at] -= 2e-3
        down, _ = tagger.gradient(codes, tags)
        tagger.w[k][at] += 1e-3
        assert abs((up - down) / 2e-3 - grad[k][at]) < 1e-3


@pytest.fixture(scope="module")
def labelled(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where("text RLIKE '[0-9@]' AND length(text) < 20000").collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_held_out_accuracy(labelled):
    half = len(labelled) // 2
    rng = random.Random(7)
    made = [personal._other_forms(t, spans(t), rng) if i % 3 == 0 else (t, spans(t)) for i, t in enumerate(labelled[:half])]
    tagger = personal.train(made)
    held = labelled[half:]
    alone = personal.added_spans(held, [[] for _ in held], tagger)
    want = [set(spans(t)) for t in held]
    hit = sum(len(set(a) & w) for a, w in zip(alone, want))
    assert hit >= 0.85 * sum(map(len, want)) and hit >= 0.9 * sum(map(len, alone))
    forms = [personal._other_forms(t, spans(t), rng) for t in held]
    both = personal.all_spans([t for t, _ in forms], tagger)
    base_hit = sum(len(set(b) & set(s)) for (b, _), (_, s) in zip(both, forms))
    all_hit = sum(len(set(a) & set(s)) for (_, a), (_, s) in zip(both, forms))
    total = sum(len(s) for _, s in forms)
    assert base_hit < 0.5 * total and all_hit > 0.75 * total
    for text, (base, every) in zip(held, personal.all_spans(held, tagger)):
        assert set(base) <= set(every) and base == spans(text)
        assert len(every) - len(base) <= 1


def test_windows_cover_long_texts(labelled):
    made = [(t, spans(t)) for t in labelled[:300]]
    tagger = personal.train(made)
    text = ("word " * 500 + "mail some.name@mail5.example.com now. ") * 3
    (base, every), = personal.all_spans([text], tagger)
    assert len(base) == 3 and every == base
    alone, = personal.added_spans([text], [[]], tagger)
    assert len(alone) >= 2 and set(alone) <= set(base)


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (None, "x"), (4, "1.2.3.4")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, spans string")
    out = personal.find(docs, keep=["doc_id", "spans"], tagger=None).drop("spans")
    got = sorted([(r.doc_id, r.n_email, r.n_ip, r.redacted) for r in out.collect()], key=str)
    assert got == sorted([(1, 0, 0, ""), (2, 0, 0, ""), (3, 1, 0, "[EMAIL]"), (3, 1, 0, "[EMAIL]"), (None, 0, 0, "x"), (4, 0, 1, "[IP]")], key=str)
    first = personal.digests(docs).where("doc_id = 3").first()
    assert first.base_sha256 == personal.sha256_of([("email", 0, 5)]) and first.spans == "email:0:5"
    assert personal.digests(docs.limit(0)).count() == 0
    assert personal.train([("no spans 12", [])]) is None
