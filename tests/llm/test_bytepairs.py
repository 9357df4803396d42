import hashlib
import random

import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from tenderline.llm import bytepairs  # noqa: E402

PATH = public.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "\n", "Hello wörld", "  two  spaces\n\n\tand tabs ", "😀 x 語 日本語 ﬁ", " " * 37 + "x" + " " * 50,
    "a" * 45, "x" * 3000, "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|>", "<|endoftext", "\x00\x01 ​", "'s 're 'LL I'm",
    "1234567890" * 30, "é ́", "antidisestablishmentarianism" * 40, "Öffnungszeiten,éèïœuvre;ñandú—“quoted”…", "a\nb \n c\r\n", "퟿\U0010ffff",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as file:
        return bytepairs.BytePairModel(file.read())


def test_edge_cases_match_the_library(model, library):
    for text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert model.encode(text) == ids, repr(text)
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False), repr(text)


def test_random_strings_match_the_library(model, library):
    rng = random.Random(11)
    pieces = [library.id_to_token(rng.randrange(50256)) for _ in range(300)]
    shown = bytepairs.byte_characters()
    for _ in range(300):
        raw = b"".join(bytes(shown[c] for c in rng.choice(pieces)) for _ in range(rng.randrange(1, 20)))
        text = raw.decode("utf-8", errors="replace") + rng.choice(["", " ", "é", "\n"])
        ids = library.encode(text, add_special_tokens=False).ids
        assert model.encode(text) == ids, repr(text)
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cuts_fall_only_where_no_token_spans(model):
    for token in model.bytes_of[:50256]:
        assert model.fragments(token) == [token] or len(token) < 2
    for text in ["hello world", "x" * 100, "日本語"]:
        raw = text.encode()
        assert b"".join(model.fragments(raw)) == raw


def test_digests_of_all_documents_match_the_library(spark, library):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(0, None, "again", 2)], "doc_id bigint, text string, ids string, n_tokens int")
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text", "source AS ids", "1 AS n_tokens")
    both = docs.unionByName(real)
    texts = {}
    for r in both.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    rows = bytepairs.digests(both, PATH).collect()
    assert len(rows) == both.count()
    for row in rows:
        ids = library.encode(texts[row.doc_id][0] if row.doc_id else "", add_special_tokens=False).ids
        if row.doc_id == 0:
            continue
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    encoded = bytepairs.encode(both, PATH)
    for row in bytepairs.decode(encoded, PATH).collect():
        assert row.decoded in texts[row.doc_id]
    assert bytepairs.digests(both.limit(0), PATH).count() == 0
