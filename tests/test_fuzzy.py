"""Fuzzy matching against all pairs on small inputs."""

import random
import re
from itertools import combinations, product

import pytest
from pyspark.sql import functions as F

from rowproof.functions import similarity
from rowproof.operators import fuzzy


def words(text):
    kept = "".join(ch for ch in text if not 0x80 <= ord(ch) <= 0xFF)
    return re.sub(r"\W", " ", kept).lower().split()


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def ratio(a, b):
    if a == b:
        return 100
    return round(100 * (2 * common(a, b) / (len(a) + len(b)))) if a and b else 0


def sort_score(a, b):
    return ratio(" ".join(sorted(words(a))), " ".join(sorted(words(b))))


def set_score(a, b, words=words):
    x, y = set(words(a)), set(words(b))
    if not x or not y:
        return 100 if x == y else 0
    both = " ".join(sorted(x & y))
    one, two = ((both + " " + " ".join(sorted(s))).strip() for s in (x - y, y - x))
    return max(ratio(both, one), ratio(both, two), ratio(one, two))


def all_pairs(values, threshold):
    found = set()
    for name, score in (("token_sort_ratio", sort_score), ("token_set_ratio", set_score)):
        for v in values:
            best = sorted(((-score(v, m), m) for m in values))[:5]
            found |= {(name, v, m, -s) for s, m in best if -s >= threshold and v < m}
    return found


def made_up(seed, n):
    """Names with typing errors, swapped and repeated words, and one very frequent phrase."""
    rng = random.Random(seed)
    stock = ["acme", "corp", "international", "machines", "co", "é", "müller", "łódź", "a", "bb", "x1"]
    values = {"", "!!!", "???", "...", "é", "acme", "ACME", "acme corp", "corp acme", "Acme, Corp."}
    while len(values) < n:
        parts = [rng.choice(stock) for _ in range(rng.randint(1, 4))]
        if rng.random() < 0.4:
            parts += ["international", "business"]
        text = list(" ".join(parts))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text))
            text[at] = rng.choice(["", "q", " ", "-", text[at].upper(), text[at] * 2])
        values.add("".join(text))
    return sorted(values)


@pytest.mark.parametrize("seed, threshold", [(1, 85), (2, 86), (3, 70), (4, 95), (5, 60), (6, 100), (7, 68), (8, 30)])
def test_matches_equal_all_pairs(spark, seed, threshold):
    values = made_up(seed, 90)
    df = spark.createDataFrame([(v,) for v in values] + [(values[3],), (None,)], "v string")
    rows = [tuple(r) for r in fuzzy.fuzzy_matches(df, "v", threshold).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == all_pairs(values, threshold)


def test_one_crowded_form(spark):
    """Many values of one form never pair up with one another, yet everyone has a full top five."""
    values = [f"{'-' * (i % 50 + 1)}Same Name{'.' * (i // 50)}" for i in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    pairs = fuzzy.candidate_pairs(
        df.selectExpr("'name same' AS form", "true AS is_token_sort_ratio", "true AS is_token_set_ratio"), 85
    )
    assert pairs.count() == 0
    rows = {tuple(r) for r in fuzzy.fuzzy_matches(df, "v").collect()}
    assert rows == all_pairs(values, 85)


def test_lists(spark):
    rows = [("token_sort_ratio", "a", "c", 90), ("token_sort_ratio", "b", "c", 95), ("token_set_ratio", "a", "d", 90),
            ("token_sort_ratio", "a", "d", 90)]
    matches = spark.createDataFrame(rows, "scorer string, value string, match string, score int")
    got = {tuple(r) for r in fuzzy.compare_scores(matches).collect()}
    assert got == {("c", "a: 90, b: 95", ""), ("d", "a: 90", "a: 90")}
    assert {tuple(r) for r in fuzzy.score_lists(matches).collect()} == {
        ("token_sort_ratio", "b", 95, "c"), ("token_sort_ratio", "a", 90, "c, d"),
        ("token_set_ratio", "a", 90, "d")}
    assert fuzzy.score_lists(matches, ["token_set_ratio"]).count() == 1


def test_forms(apply):
    rows = ["B a b", "Müller-Łódź_1", "", None]
    assert apply(similarity.sort_form("a"), rows) == ["a b b", "mller łódź_1".replace("ó", ""), "", None]
    assert apply(similarity.set_form("a"), rows)[0] == "a b"


def test_known_score(apply):
    one, two = F.col("a"), F.col("b")
    places = similarity.char_places(one)
    rows = [("cold anvil", "old anvil"), ("", "a"), ("", "")]
    assert apply(similarity.sort_score(one, two, places), rows) == [95, 0, 100]
    assert apply(similarity.set_score(one, two, places), [("acme", "acme corp"), ("", "a"), ("", "")]) == [100, 0, 100]


def test_scores_equal_the_definition(spark):
    """Lengths around the ends of one and two longs, characters of several bytes, shared words."""
    rng = random.Random(7)
    pairs = []
    for n in [0, 1, 3, 10, 30, 61, 62, 63, 64, 100, 124, 125, 200] * 12:
        a, b = ("".join(rng.choice("abcd é🙂") for _ in range(k)).split() for k in (n, rng.choice([n, 5, 40])))
        pairs += [(" ".join(sorted(a)), " ".join(sorted(b))), (" ".join(sorted(set(a))), " ".join(sorted(set(b))))]
    one, two = F.col("a"), F.col("b")
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("places", similarity.char_places(one))
    places = F.col("places")
    for a, b, by_sort, by_set, n in df.select(
        "a", "b", similarity.sort_score(one, two, places), similarity.set_score(one, two, places), similarity.common_length(places, two)
    ).collect():
        assert (by_sort, n) == (ratio(a, b), common(a, b))
        if len(set(a.split())) == len(a.split()) and len(set(b.split())) == len(b.split()):
            assert by_set == set_score(a, b, str.split)


@pytest.mark.parametrize("cell, at_once", [(3, 0), (2048, 0), (3, 10**9)])
def test_bands_and_cells_lose_nothing(spark, monkeypatch, cell, at_once):
    """Numbered keys, nearly all alike: every band is used, and pieces are divided into many cells."""
    monkeypatch.setattr(fuzzy, "CELL", cell)
    monkeypatch.setattr(fuzzy, "TESTS_AT_ONCE", at_once)
    monkeypatch.setattr(fuzzy, "TESTS_IN_TASK", 2000)
    values = [f"Customer#{i:09d}" for i in range(0, 2400, 17)] + made_up(11, 40)
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = [tuple(r) for r in fuzzy.fuzzy_matches(df, "v", 80).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == all_pairs(values, 80)


@pytest.mark.parametrize("threshold", [1, 40, 67, 68, 75, 85, 99])
def test_bounds_hold_for_all_short_texts(spark, threshold):
    """Every pair of texts over two letters that reaches the threshold is a candidate."""
    texts = ["".join(t) for n in range(1, 6) for t in product("ab", repeat=n)]
    forms = spark.createDataFrame([(t, True, True) for t in texts],
                                  "form string, is_token_sort_ratio boolean, is_token_set_ratio boolean")
    rows = fuzzy.candidate_pairs(forms, threshold).select("a", "b").collect()
    wanted = {(a, b) for a, b in combinations(sorted(texts), 2) if ratio(a, b) >= threshold}
    assert wanted <= {tuple(r) for r in rows}
    assert len(rows) == len(set(rows))


def test_short_forms_meet_by_edits(spark, monkeypatch):
    """Numbered keys give tests in step with their matches, and no pair of any length or word order is lost."""
    monkeypatch.setattr(fuzzy, "TESTS_AT_ONCE", 0)
    monkeypatch.setattr(fuzzy, "NEAR_LENGTH", 20)
    share = fuzzy._share(90)
    near = fuzzy._near_length(share)
    assert 10 <= near < 20
    rng = random.Random(5)
    words = ["ab", "abc", "b", "bcd", "cdab", "d", "dd", "a"]
    values = {" ".join(rng.choices(words, k=rng.randint(2, 8))) for _ in range(260)}
    forms = sorted({" ".join(sorted(v.split())) for v in values} | {" ".join(sorted(set(v.split()))) for v in values})
    rows = spark.createDataFrame([(f,) for f in forms], "form string").selectExpr("form", "1L AS n_token_sort_ratio", "1L AS n_token_set_ratio")
    index = fuzzy.indexed(rows)
    asked = index.withColumn("asked", F.col("id") % 2 == 0)
    text = {r.id: r.form for r in index.select("id", "form").collect()}
    met = fuzzy.Candidates([*fuzzy._by_edits(asked, share), fuzzy._by_words(asked, share)])
    found = {frozenset((text[r.a], text[r.b])) for r in met.pairs().collect()}
    some = {f for i, f in text.items() if i % 2 == 0}
    wanted = {
        frozenset((a, b)) for a, b in combinations(forms, 2)
        if (a in some or b in some)
        and (ratio(a, b) >= 90 or (a.split() == sorted(set(a.split())) and b.split() == sorted(set(b.split())) and set_score(a, b, str.split) >= 90))
    }
    assert wanted <= found and {len(f) <= near for f in forms} == {True, False}

    numbered = spark.range(4000).selectExpr("printf('%09d supplier', id) AS form", "1L AS n_token_sort_ratio", "1L AS n_token_set_ratio")
    met = fuzzy.candidates(fuzzy.indexed(numbered), numbered.select(F.monotonically_increasing_id().alias("id")), 94, deep=True)
    assert met.tests < 200 * 4000
