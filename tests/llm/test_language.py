import numpy as np

from rowproof.llm import language
from tests.llm.helpers import awkward, frame


def test_held_out_documents_of_the_given_tables(spark):
    rows = language.op2_language_id(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = rows.merge(docs, on="doc_id")
    held = both[both.held_out]
    assert len(rows) == 1000 and (held.lang_pred == held.lang).mean() > 0.98
    assert held.ambiguous.mean() < 0.02


def test_margins_equal_a_plain_sum():
    r = np.random.default_rng(0)
    codes = language.Codes(["a", "b", "c"], r.integers(0, 9, (3, 512)))
    texts = [b"Hello World", b"", b"x", "äöü ÄÖ".encode(), b"42 is not a word"]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    got = codes.margins(data, at)
    for k, text in enumerate(texts):
        grams = []
        letters = language.FOLDED[np.frombuffer(text, np.uint8)].tolist()
        for order in language.ORDERS:
            for i in range(len(letters) - order + 1):
                code = np.array([int.from_bytes(bytes(letters[i : i + order]))], np.uint64)
                grams.append(int(language.mix(code, order)[0] % np.uint64(512)))
        want = codes.odds[grams].mean(0) if grams else np.zeros(codes.odds.shape[1])
        assert np.allclose(got[k], want, atol=1e-6)


def test_codewords_are_apart():
    for k in (2, 3, 4, 5, 9, 20):
        code = language.codewords(k)
        least = min((code[i] != code[j]).sum() for i in range(k) for j in range(i))
        assert least >= max(1, code.shape[1] // 4)


def test_a_wrong_bit_is_corrected():
    codes = language.Codes(["a", "b", "c", "d"], np.eye(4, 256) * 100)
    for i, word in enumerate(codes.code):
        for bit in range(len(word)):
            margins = (2.0 * word - 1) * 0.5
            margins[bit] = -margins[bit]
            assert codes.decode(margins[None])[0][0] == i
    assert codes.decode(np.zeros((1, 7)))[2][0]  # no evidence: ambiguous


def test_awkward_rows(spark):
    texts = awkward()
    langs = ["en" if i % 2 else "xx" for i in range(len(texts))]
    langs[0], langs[3] = None, ""
    docs = frame(spark, texts, langs)
    got = {r.doc_id: r for r in language.predict(docs, language.learn(docs)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        letters = any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred != "und") == letters and 0 <= got[i].score <= 1
    nothing = language.learn(docs.filter("lang is null"))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), language.learn(docs)).count() == 0
    carried = language.predict(docs, None, carry=("doc_id", "text", "kept"))
    assert carried.columns[:3] == ["doc_id", "text", "kept"]
