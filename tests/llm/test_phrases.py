import hashlib
import random

import pytest
import xxhash

from rowproof.llm.phrases import (
    SIGNATURE, edited, fingerprints, likeness, op13_phrase_fingerprint, parse, phrases, read, signature, written,
)
from tests.llm.helpers import awkward, frame, sentences


def brute(data, most=1 << 20):
    """LZ78 as it is defined, one byte after another."""
    seen, found, piece = set(), [], b""
    for i in range(len(data)):
        piece += data[i : i + 1]
        if piece not in seen:
            seen.add(piece)
            found.append(piece)
            if len(seen) >= most:
                seen.clear()
            piece = b""
    return found


def brute_print(text, most=1 << 20):
    return sorted({xxhash.xxh32_intdigest(p) for p in brute((text or "").encode(), most)})[:SIGNATURE]


def brute_likeness(a, b):
    both = sorted(set(a) | set(b))[:SIGNATURE]
    return sum(x in a and x in b for x in both) / len(both) if both else 1.0


def brute_rows(rows, most=1 << 20):
    """All documents beside their next one, by (id, hash of the text)."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        own, new, other = (brute_print(x, most) for x in (text, changed, after))
        hexed = ["".join(f"{x:08x}" for x in p) for p in (own, new)]
        out.append(
            (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *hexed, brute_likeness(own, new), brute_likeness(own, other))
        )
    return out


@pytest.mark.parametrize("most", [1 << 20, 7])
def test_parse_equals_definition(most):
    r = random.Random(most)
    texts = [x or "" for x in awkward(3)] + ["".join(r.choice("ab") for _ in range(n)) for n in range(40)] + ["a" * 5000]
    for text in texts:
        data = text.encode()
        assert phrases(data, parse(data, most=most)) == brute(data, most)


def test_fingerprint_can_be_read_back():
    for text in awkward(2):
        least = signature(brute((text or "").encode()))
        assert (read(written(least)) == least).all()
    assert likeness(read(""), read("")) == 1.0


@pytest.mark.parametrize("part_bytes, most", [(1 << 24, 1 << 20), (3000, 1 << 20), (1, 50)])
def test_rows_equal_brute_force(spark, part_bytes, most):
    texts = awkward(5)
    docs = frame(spark, texts)
    got = edited(docs, dictionary=most, part_bytes=part_bytes)
    assert sorted(map(tuple, got.collect())) == brute_rows(list(enumerate(texts)), most)


def test_shared_and_null_ids_and_repeats(spark):
    """Rows of one id come by the hash of their text; the same rows in any number are each other's next."""
    texts = sentences(4, 12, 60)
    rows = [(None, t) for t in texts[:4]] + [(None, texts[0])] * 3 + [(5, t) for t in texts[4:8]] + [(5, None)] * 2 + [(9, texts[9])] * 4 + [(2, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    hashes = {r.text: r.h for r in docs.selectExpr("text", "xxhash64(cast(coalesce(text, '') as binary)) h").collect()}
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, hashes[x[1]]))
    for part_bytes in (1 << 24, 1, 200):
        got = sorted(map(tuple, edited(docs, part_bytes=part_bytes).collect()), key=str)
        assert got == sorted(brute_rows(ordered), key=str)


def test_text_ids_one_row_and_no_rows(spark):
    docs = spark.createDataFrame([("b", "one two three"), ("ä", "two"), ("a", "three four five six")], "doc_id string, text string")
    for part_bytes in (1 << 24, 1):
        got = sorted(map(tuple, edited(docs, part_bytes=part_bytes).collect()))
        assert got == brute_rows(sorted((r.doc_id, r.text) for r in docs.collect()))
    one = spark.createDataFrame([(7, "so it goes, so it goes")], "doc_id long, text string")
    assert list(map(tuple, edited(one).collect())) == brute_rows([(7, "so it goes, so it goes")])
    assert edited(one.limit(0)).count() == 0


def test_likeness_tells_edits_from_strangers(spark, tmp_path):
    texts = sentences(8, 60, 500)
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op13_phrase_fingerprint(spark, str(tmp_path)).collect()
    assert [r.doc_id for r in sorted(rows)] == list(range(60))
    assert all(r.near_edited > r.near_next for r in rows)
    own = {r.doc_id: r.fingerprint for r in rows}
    assert {r.doc_id: r.fingerprint for r in fingerprints(frame(spark, texts)).collect()} == own
