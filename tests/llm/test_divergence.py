import random
import re
from collections import Counter, defaultdict

import pytest

from rowproof.llm import divergence as module
from rowproof.llm.divergence import divergence, op12_source_divergence
from tests.llm.helpers import LOWER, awkward, frame

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, documents, terms):
    """Every kept term of every pair of sources."""
    seen, count, groups = defaultdict(int), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").encode().translate(LOWER).decode())
        groups.add((lang, source))
        count.update((lang, source, t) for t in found)
        for t in set(found):
            seen[lang, t] += 1
    kept = defaultdict(list)
    for (lang, t), n in seen.items():
        if n >= documents:
            kept[lang].append(t)

    def share(lang, sources):
        n = {t: sum(count[lang, s, t] for s in sources) for t in kept[lang]}
        below = sum(n.values()) + 5 * len(n)
        return {t: 1 + 1_000_000_000 * (c + 5) // below for t, c in n.items()}

    out = []
    for lang, source in groups:
        of_lang = [s for x, s in groups if x == lang]
        p, q = share(lang, [source]), share(lang, of_lang)
        shares = {s: share(lang, [s]) for s in of_lang if s != source}
        pairs = [(-sum(abs(p[t] - r[t]) for t in p), s) for s, r in shares.items()]
        above = [(q[t] - p[t], t) for t in p if count[lang, source, t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", above, terms)):
            found = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def rows_of(docs):
    return [(r.text, r.lang, r.source) for r in docs.collect()]


@pytest.mark.parametrize("documents, terms, held", [(2, 5, 1 << 20), (3, 50, 40), (10_000, 50, 40)])
def test_equals_brute_force(spark, monkeypatch, documents, terms, held):
    monkeypatch.setattr(module, "HELD", held)
    texts = awkward(4) * 3
    r = random.Random(documents)
    docs = frame(spark, texts, [r.choice(["en", "de", None, ""]) for _ in texts])
    found = divergence(docs, documents, terms)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute(rows_of(docs), documents, terms)


def test_tree_counts_shared_paths_once(spark):
    """Rows that repeat, begin alike, are beginnings of others, and lie in several languages."""
    r = random.Random(9)
    rows = [(lang, f"s{i}", r.randint(1, 3), r.choice("abc") * n) for lang in "xy" for i in range(7) for n in range(1, 30) if r.random() < 0.6]
    texts = [(" ".join([t] * n), lang, s) for lang, s, n, t in rows] + [(None, "x", "none"), ("", "z", "only"), ("!", "z", "two")]
    docs = spark.createDataFrame(
        [(i, t, lang, s, 0, "x", "x", "x", "x") for i, (t, lang, s) in enumerate(texts)], frame(spark, ["a"]).schema
    )
    for documents in (1, 2, 4):
        assert sorted(map(tuple, divergence(docs, documents).collect())) == brute(texts, documents, 50)


def test_shares_are_exact_for_large_counts(spark):
    df = spark.sql("select 30000000000L as n, 70000000001L as total, 3L as kept")
    got = df.select(module._share("n", "total", "kept")).first()[0]
    assert got == 1 + 1_000_000_000 * 30000000005 // (70000000001 + 15)


def test_query_and_empty_table(spark, tmp_path):
    texts = awkward(6) * 12
    frame(spark, texts).write.parquet(f"{tmp_path}/a/documents.parquet")
    rows = rows_of(spark.read.parquet(f"{tmp_path}/a/documents.parquet"))
    assert sorted(map(tuple, op12_source_divergence(spark, f"{tmp_path}/a").collect())) == brute(rows, 30, 50)
    frame(spark, ["a"]).limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert op12_source_divergence(spark, f"{tmp_path}/b").count() == 0
