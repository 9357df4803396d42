import hashlib

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("public_tokenizers")

from tenderline.llm import pieces  # noqa: E402

PATH = tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "\n", "Hello wörld", "  two  spaces\n\n\tand tabs ", "▁ a▁b ▁▁", "😀 x 語 日本語 ﬁ", " " * 37 + "x" + " " * 50,
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "x" * 3000, "<s></s><0x0A><unk>", "\x00\x01 ​", "the the the. the", "1234567890" * 30, "é ́",
    "antidisestablishmentarianismpneumonoultramicroscopic" * 4, "Öffnungszeiten,éèïœuvre;ñandú—“quoted”…", "a\nb \n c\r\n",
]


def test_matches_the_library_on_edge_cases_and_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, None, "again")], "doc_id bigint, text string, ids string")
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text", "source AS ids")
    both = docs.unionByName(real)
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    for row in pieces.digests(both, PATH).collect():
        ids = library.encode(texts[row.doc_id], add_eos=True)
        assert row.n_tokens == len(ids), texts[row.doc_id][:80]
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    encoded = pieces.encode(both, PATH)
    for row in pieces.decode(encoded, PATH).collect():
        assert list(row.ids) == library.encode(texts[row.doc_id], add_eos=True)
        assert row.text == library.decode(list(row.ids))
    assert pieces.digests(both.limit(0), PATH).count() == 0


def test_random_strings_match_the_library():
    import random

    rng = random.Random(5)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    with open(PATH, "rb") as file:
        model = pieces.PieceModel(file.read())
    words = [library.id_to_piece(rng.randrange(259, 32000)) for _ in range(400)]
    for _ in range(400):
        text = "".join(rng.choice([*words, " ", "\n", "in", "er", "▁", "é"]) for _ in range(rng.randrange(1, 25))).replace("▁", rng.choice([" ", "▁"]))
        assert model.encode(text) == library.encode(text, add_eos=True), text
        assert model.decode(model.encode(text)) == library.decode(library.encode(text)), text
