import zlib

from pyspark.sql import functions as F

from tenderline.llm import language


def phrases(text, reference):
    """Plain cross-parsing of normalised strings."""
    count = at = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in reference:
            size += 1
        count += 1
        at += max(size, 1)
    return count


def test_parses_as_plain_cross_parsing_does():
    texts = {"a": ["the cat sat on the mat", "a dog and a cat"], "b": ["die katze sass auf der matte"]}
    own = language.References(texts)
    columns = own.columns()
    samples = ["the dog sat", "die matte", "Auf DER Katze, the mat!", "x", "  ", "cat 12 dog", "the " * 400]
    entropy, letters = own.entropies(samples, columns)
    for i, text in enumerate(samples):
        plain = "".join(map(chr, language.normalised(text)))
        for k, name in enumerate(own.names):
            reference = "\0".join("".join(map(chr, language.normalised(t))) for t in texts[name])
            got = entropy[k, i] / own.weights[k] * len(plain)
            cut = [plain[j : j + language.SEGMENT] for j in range(0, len(plain), language.SEGMENT)]
            known = set(reference) - {"\0"}
            if all(c in known for c in plain):
                assert round(got) == sum(phrases(c, reference) for c in cut), (text, name)
    assert letters[4] == 0 and letters[3] == 1


def test_held_out_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.predict_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(out) > 200
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in out) and all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)


def test_defined_cases(spark):
    rows = [(1, "der die das und nicht", "de", None), (2, "the and of it is", "en", "x"), (4, None, "en", "x"), (5, "", None, "x"), (6, "123 !?", "en", "x"), (None, "nicht und", None, "x"), (1, "der die das und nicht", "de", None)]
    docs = spark.createDataFrame([(i, t, l, s) for i, t, l, s in rows], "doc_id bigint, text string, lang string, score string")
    own = language.fit(docs.where("lang IS NOT NULL AND text IS NOT NULL"))
    out = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(docs, own, [F.col("doc_id")]).collect()]
    assert [x[1] for x in out] == ["de", "en", "und", "und", "und", "de", "de"] and out[2][2] == 0.0
    assert language.predict_held_out(docs.limit(0)).count() == 0
    none = language.predict_held_out(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    one = language.predict(docs.limit(1), language.References({"de": ["der die das"]}), [F.col("doc_id")]).collect()
    assert one[0].lang_pred == "de" and one[0].score == 1.0
