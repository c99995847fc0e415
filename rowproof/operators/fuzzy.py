"""Fuzzy matching: every value with its most similar values, five unless `keep` says otherwise.

Two texts are compared through a normal form, so all work up to the last join is done once per
distinct form. Candidates come from equi-joins on rare pieces (prefix filtering): texts that reach a
score must share one of the rarest characters or character pairs, or for word sets one of the rarest words,
of either text. Where single pieces would give many tests, short texts that may differ by one edit meet by what is left
after it (`_by_edits`). The bounds are proven in `_needed`, `_always_needed`, `_near_length` and `_word_prefix`;
they lose no match, and no block of similar texts is capped. Values with an equal form are never paired with one another:
the `keep` smallest of them stand for the group, with `keep=None` all of them.

The matches wanted are the best, so the search goes down in bands of falling score (`BANDS`). High
scores leave few candidates; a form that has its `keep` matches in a band is done and no longer asks. The
threshold itself is searched at once when few pairs have to be tested for the forms that are left.

The joins hold ids, lengths, bit sets and pieces only; texts join the pairs that are left. A piece of many
forms is divided into cells on both sides, so that no task tests more than `CELL` times `CELL` pairs of
it, and the number of tasks follows the number of tests, which is counted first. Scores are expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowproof.functions.similarity import char_places, let, set_form, set_score, sort_form, sort_score
from rowproof.functions.text import identifier_text
from rowproof.operators.duplicates import distinct_values
from rowproof.sources.staging import staged

# --- fixed values: scorers, matches kept per value, default threshold -------------------------
SCORERS = ("token_sort_ratio", "token_set_ratio")
KEEP = 5
THRESHOLD = 85
# Scores searched from, in turn, above the threshold.
BANDS = (97, 94, 90, 85, 80, 70)
# Pair tests up to which the threshold is searched at once, and those of one task.
TESTS_AT_ONCE = 20_000_000
TESTS_IN_TASK = 4_000_000
# Forms that a task indexes, and pairs that it scores: both cost far more time than bytes.
FORMS_IN_TASK = 2_000
PAIRS_IN_TASK = 20_000
# Rows of one piece that meet one another in one task.
CELL = 2048
# Forms up to this length may be met by their single edits where pieces are too frequent.
NEAR_LENGTH = 62
# Hash buckets in which the frequency of pieces is counted.
RANK_BUCKETS = 4096
# 64-bit words of the bit sets that rule out most pairs before their bags are compared.
MASK_WORDS = 4


def _share(threshold: int) -> float:
    """Smallest similarity 2*common/(m+n) that can round to the threshold."""
    return (threshold - 0.5) / 100


def fuzzy_matches(
    df: DataFrame, column: str, threshold: int = THRESHOLD, scorers: Sequence[str] = SCORERS,
    keep: int | None = KEEP,
) -> DataFrame:
    """`scorer, value, match, score`: the `keep` best matches of each value that reach `threshold`.

    `keep=None` returns all. The value itself takes part with score 100 and uses a place. Ties go to the smaller match.
    Only pairs with `value < match` are returned.
    """
    values = distinct_values(df, column).select(F.col(column).cast("string").alias("value"))
    makers = {"token_sort_ratio": sort_form, "token_set_ratio": set_form}
    formed = staged(
        values.select(
            "value",
            F.array(
                *(F.struct(F.lit(s).alias("scorer"), makers[s]("value").alias("form")) for s in scorers)
            ).alias("forms"),
        )
    ).select("value", F.inline("forms"))

    forms = formed.groupBy("form").agg(
        *(F.count_if(F.col("scorer") == s).alias(f"n_{s}") for s in SCORERS)
    )
    index = indexed(forms)
    by_id = formed.join(index.select("form", "id"), "form").select("value", "scorer", "id")
    best = Window.partitionBy("scorer", "id").orderBy(F.desc("score"), "match")
    top = (
        best_forms(index, threshold, keep)
        .join(_members(by_id, keep), ["scorer", "other"])
        .select("scorer", "id", "match", "score")
    )
    if keep is not None:
        top = top.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep).drop("place")
    return (
        by_id.join(top, ["scorer", "id"])
        .where(F.col("value") < F.col("match"))
        .select("scorer", "value", "match", "score")
    )


def _members(by_id: DataFrame, keep: int | None) -> DataFrame:
    """The `keep` smallest values of each form; the rank filter is applied before the shuffle."""
    ranked = Window.partitionBy("scorer", "id").orderBy("value")
    if keep is not None:
        by_id = by_id.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= keep)
    return by_id.select("scorer", F.col("id").alias("other"), F.col("value").alias("match"))


def indexed(forms: DataFrame) -> DataFrame:
    """The forms with their id, length, pieces, bit sets and places of characters, written once.

    `forms` holds `form` and for each scorer the number of values that have it. Pieces are in order of
    rising frequency in the table.
    """
    text = F.col("form")
    numbered = staged(forms.withColumn("id", F.monotonically_increasing_id()))
    tasks = 1 + numbered.count() // FORMS_IN_TASK
    places = char_places(text).alias("places")
    set_words = F.when((text != "") & (F.col("n_token_set_ratio") > 0), F.split(text, " ")).otherwise(F.array())
    bags = {f"bag{n}": F.when(F.length(text) > 0, _bag(text, n)).otherwise(F.array().cast("array<bigint>")) for n in (1, 2)}
    bags["words"] = set_words.cast("array<string>")
    rows = numbered.repartition(tasks).select(
        "*", F.length(text).alias("m"), places, *(bag.alias(name) for name, bag in bags.items())
    )
    rows = _rare_first(staged(rows), list(bags))
    return staged(rows.withColumns({f"masks{n}": _masks(F.col(f"bag{n}")) for n in (1, 2)}))


def best_forms(index: DataFrame, threshold: int, keep: int | None = KEEP) -> DataFrame:
    """`scorer, id, other, score`: of every form all others that its `keep` best values may come from, itself included.

    A form that has `keep` values in a band needs no others: all that are left score less.
    """
    wanted = F.array(*(F.when(F.col(f"n_{s}") > 0, F.struct(F.lit(s).alias("scorer"), F.col(f"n_{s}").alias("n"))) for s in SCORERS))
    own = index.select("id", F.inline(F.array_compact(wanted)))
    itself = own.select("scorer", "id", F.col("id").alias("other"), F.lit(100).alias("score"))
    asking, found = index.select("id", *((F.col(f"n_{s}") > 0).alias(f"asks_{s}") for s in SCORERS)), [itself]
    asks = [f"asks_{s}" for s in SCORERS]
    bands = [threshold] if keep is None else [b for b in BANDS if b > threshold] + [threshold]
    for band in bands:
        met = candidates(index, asking, threshold)
        if met.tests <= TESTS_AT_ONCE:
            band = threshold
        else:
            met = candidates(index, asking, band, deep=True)
        scored = staged(_scored(index, met.pairs(), asking, band))
        if band == threshold:
            return reduce(DataFrame.unionByName, [*found, scored])
        sizes = own.select("scorer", F.col("id").alias("other"), F.col("n").alias("there"))
        counted = scored.join(sizes, ["scorer", "other"]).groupBy("scorer", "id").agg(F.sum("there").alias("there"))
        done = (
            own.join(counted, ["scorer", "id"], "left").where(F.col("n") + F.coalesce("there", F.lit(0)) >= keep)
            .select("scorer", "id")
        )
        done = staged(done)
        found.append(scored.join(done, ["scorer", "id"], "left_semi"))
        left = asking
        for s in SCORERS:
            ready = done.where(F.col("scorer") == s).select("id", F.lit(True).alias("ready"))
            left = left.join(ready, "id", "left").withColumn(f"asks_{s}", F.col(f"asks_{s}") & F.col("ready").isNull()).drop("ready")
        asking = staged(left.where(reduce(lambda x, y: x | y, [F.col(a) for a in asks])))
        if asking.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def _scored(index: DataFrame, pairs: DataFrame, asking: DataFrame, band: int) -> DataFrame:
    """`scorer, id, other, score` of those pairs that reach the band, from the side that asks."""
    def side(name: str, *more: str) -> DataFrame:
        flags = [(F.col(f"n_{s}") > 0).alias(f"{name}_{s}") for s in SCORERS]
        return index.select(F.col("id").alias(name), F.col("form").alias(f"{name}_form"), *flags, *more)

    pairs = staged(pairs)
    tasks = 1 + pairs.count() // PAIRS_IN_TASK
    with_texts = pairs.join(side("b"), "b").repartition(tasks, "a").join(side("a", "places").repartition(tasks, "a"), "a")
    scorers = {"token_sort_ratio": sort_score, "token_set_ratio": set_score}
    scores = F.array(
        *(
            F.struct(
                F.lit(s).alias("scorer"),
                F.when(F.col(f"a_{s}") & F.col(f"b_{s}"), score(F.col("a_form"), F.col("b_form"), F.col("places"), _share(band))).alias("score"),
            )
            for s, score in scorers.items()
        )
    )
    reached = with_texts.select("a", "b", F.inline(scores)).where(F.col("score") >= band)
    ways = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other")))
    asked = asking.select(
        "id", F.inline(F.array(*(F.struct(F.lit(s).alias("scorer"), F.col(f"asks_{s}").alias("asks")) for s in SCORERS)))
    ).where("asks").drop("asks")
    return reached.select("scorer", "score", F.inline(ways)).join(asked, ["scorer", "id"], "left_semi").select("scorer", "id", "other", "score")


class Candidates:
    """Joins on pieces, and how many pairs they will test."""

    def __init__(self, joins: list[_PieceJoin]) -> None:
        self.joins = joins
        self.tests = sum(j.tests for j in joins)

    def pairs(self) -> DataFrame:
        """`a, b`: unordered pairs of ids, each once."""
        met = reduce(DataFrame.unionByName, [j.pairs() for j in self.joins])
        return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def candidates(index: DataFrame, asking: DataFrame, threshold: int, deep: bool = False) -> Candidates:
    """Pairs of forms that may reach the threshold, of which one at least is among the `asking` ids.

    With `deep` short forms meet by their edits if single pieces give too many tests, and more than those.
    """
    flagged = index.join(asking.select("id", F.lit(True).alias("asked")), "id", "left").fillna(False, "asked")
    share = _share(threshold)
    by_characters = [_by_characters(flagged, share)]
    if deep and by_characters[0].tests > TESTS_AT_ONCE:
        by_characters = min(by_characters, _by_edits(flagged, share), key=lambda joins: sum(j.tests for j in joins))
    return Candidates([*by_characters, _by_words(flagged, share)])


def candidate_pairs(forms: DataFrame, threshold: int) -> DataFrame:
    """`a, b`: unordered pairs of forms that may reach the threshold, each once.

    `forms` holds `form` and one flag per scorer that uses the form.
    """
    index = indexed(forms.groupBy("form").agg(*(F.count_if(f"is_{s}").alias(f"n_{s}") for s in SCORERS)))
    found = candidates(index, index.select("id"), threshold).pairs()
    texts = index.select("id", "form")
    one, two = (texts.select(F.col("id").alias(x), F.col("form").alias(f"{x}_form")) for x in "ab")
    both = found.join(one, "a").join(two, "b")
    return both.select(F.least("a_form", "b_form").alias("a"), F.greatest("a_form", "b_form").alias("b"))


class _PieceJoin:
    """Rows of both sides that share a piece, tested by `fits`.

    Rows have `id` and `piece`. How often a piece occurs on each side is counted first: the sum of the
    products is the number of tests, and a piece of more than `CELL` rows is divided into cells of about so
    many, of which each meets each of the other side.
    """

    def __init__(self, left: DataFrame, right: DataFrame, fits: Column) -> None:
        self.left, self.right, self.fits = left, right, fits
        both = left.select("piece", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
            right.select("piece", F.lit(0).alias("l"), F.lit(1).alias("r"))
        )
        counted = both.groupBy("piece").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        some = staged(counted.where(((F.col("l") > 0) & (F.col("r") > 0)) | (F.greatest("l", "r") > CELL)))
        self.crowded = some.where(F.greatest("l", "r") > CELL).select(
            "piece", *(F.ceil(F.col(side) / CELL).cast("int").alias(side) for side in "lr")
        )
        tests, most = some.agg(F.sum(F.col("l").cast("double") * F.col("r")), F.max(F.greatest("l", "r"))).first()
        self.tests, self.divided = tests or 0.0, (most or 0) > CELL

    def pairs(self) -> DataFrame:
        tasks = max(1, int(self.tests // TESTS_IN_TASK))
        keys = ("piece", "cell_l", "cell_r")

        def dealt(rows: DataFrame, name: str, own: str, others: str) -> DataFrame:
            columns = [F.col(c).alias(f"{name}_{c}") for c in rows.columns if c != "piece"]
            if self.divided:
                rows = rows.join(self.crowded, "piece", "left").fillna(1, ["l", "r"])
            else:
                rows = rows.withColumns({"l": F.lit(1), "r": F.lit(1)})
            # A piece that the other side does not have has no cells there, so its rows go.
            cells = F.when(F.col(others) > 0, F.sequence(F.lit(1), F.col(others)))
            rows = rows.withColumn(f"cell_{others}", F.explode(cells))
            rows = rows.withColumn(f"cell_{own}", 1 + F.pmod(F.xxhash64("id"), F.greatest(F.col(own), F.lit(1))).cast("int"))
            return rows.select(*keys, *columns).repartition(tasks, *keys)

        # Exploding multiplies the rows, which size estimates do not see: no broadcast of either side.
        joined = dealt(self.left, "x", "l", "r").join(dealt(self.right, "y", "r", "l").hint("merge"), list(keys))
        return joined.where(self.fits).select(F.col("x_id").alias("a"), F.col("y_id").alias("b"))


# ---- pairs that share characters -------------------------------------------------------------


def _needed(both: Column, share: float, pieces: int) -> Column:
    """Pieces that two texts of joined length `both` must have in common to reach `share`.

    Their longest common subsequence has c >= share*both/2 characters, so they share c single
    characters. Padded with a blank on both sides the subsequence has c+1 neighbouring pairs. Each
    of the both-2c characters left out parts at most one of them, so at least
    c+1-(both-2c) = 3c-both+1 pairs are neighbours in both texts.
    """
    common = F.ceil(both * (share / 2) - 1e-9)
    return (common if pieces == 1 else 3 * common - both + 1).cast("int")


def _always_needed(both: Column, share: float, pieces: int) -> Column:
    """The least of `_needed` over all joined lengths from `both` on.

    Rounding makes `_needed` rise and fall; without it the bound only rises, for pairs of
    characters as long as share >= 2/3.
    """
    least = both * (share / 2) if pieces == 1 else both * (1.5 * share - 1) + 1
    return F.ceil(least - 1e-9).cast("int")


def _pieces_for(share: float) -> int:
    """Characters per piece: pairs are rarer, but only guaranteed to be shared from 2/3 on."""
    return 2 if share >= 2 / 3 else 1


def _bag(form: Column, pieces: int) -> Column:
    """Pieces of the text as numbers; a repeat gets its own number.

    Two code points of 21 bits and a repeat count of 20 bits fit one long, so equal numbers mean
    equal pieces. Pairs are taken from the padded text; with a blank around every word the bag
    does not depend on the order of the words.
    """
    padded = F.concat(F.lit(" "), form, F.lit(" ")) if pieces == 2 else form
    places = F.sequence(F.lit(1), F.length(form) + pieces - 1)

    def number(i: Column) -> Column:
        first = F.ascii(F.substr(padded, i, F.lit(1))).cast("bigint")
        if pieces == 1:
            return F.shiftleft(first, 20)
        second = F.ascii(F.substr(padded, i + 1, F.lit(1))).cast("bigint")
        return F.shiftleft(first, 41) + F.shiftleft(second, 20)

    def numbered(found: Column) -> Column:
        return F.transform(found, lambda p, i: p + (i + 1 - F.array_position(found, p)))

    # The outer lambda's argument is sorted once, not once per piece.
    return F.get(F.transform(F.array(F.array_sort(F.transform(places, number))), numbered), F.lit(0))


def _bucket(piece: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(buckets)).cast("int")


def _rare_first(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Sort each array column by how often its pieces occur in the table, rarest first.

    Pieces are counted by hash bucket, so what every task must know is one array of fixed size for a column.
    Any common order gives the same pairs; this one keeps frequent pieces out of the join keys.
    """
    buckets = F.array(
        *(F.struct(F.lit(c).alias("of"), F.transform(c, lambda p: _bucket(p, RANK_BUCKETS)).alias("buckets")) for c in names)
    )
    counted = (
        frame.select(F.inline(buckets)).select("of", F.explode("buckets").alias("bucket"))
        .groupBy("of", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    every = F.sequence(F.lit(0), F.lit(RANK_BUCKETS - 1))

    def filled(c: str) -> Column:
        return F.transform(every, lambda b: F.coalesce(F.try_element_at(F.col(c), b), F.lit(0))).alias(c)

    def of_column(c: str) -> Column:
        return F.map_from_entries(F.collect_list(F.when(F.col("of") == c, F.struct("bucket", "n")))).alias(c)

    ranks = counted.agg(*(of_column(c) for c in names)).select(F.struct(*(filled(c) for c in names))).scalar()

    def ordered(c: str) -> Column:
        ranked = F.transform(c, lambda p: F.struct(F.get(F.col("ranks")[c], _bucket(p, RANK_BUCKETS)).alias("n"), p.alias("p")))
        return F.array_sort(ranked)["p"]

    return frame.withColumn("ranks", ranks).withColumns({c: ordered(c) for c in names}).drop("ranks")


def _masks(bag: Column) -> Column:
    """The bag as a set of MASK_WORDS * 64 bits: every piece sets the bit that its hash names."""

    def word(places: Column, i: int) -> Column:
        def add(bits: Column, place: Column) -> Column:
            # A shift of a long uses the last six bits of the place.
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
            return F.when(F.shiftright(place, 6) == i, bits.bitwiseOR(bit)).otherwise(bits)

        return F.aggregate(places, F.lit(0).cast("bigint"), add).alias(f"mask{i}")

    places = F.transform(bag, lambda piece: _bucket(piece, MASK_WORDS * 64))
    return let(places, lambda found: F.struct(*(word(found, i) for i in range(MASK_WORDS))))


def _missing_bits(a: str, b: str) -> Column:
    """Bits of `a` that `b` lacks: at least so many pieces of `a` are not in `b`."""
    words = [
        F.bit_count(F.col(f"{a}mask{i}").bitwiseAND(F.bitwise_not(F.col(f"{b}mask{i}"))))
        for i in range(MASK_WORDS)
    ]
    return reduce(lambda x, y: x + y, words)


def _prefixes(index: DataFrame, share: float) -> DataFrame:
    """A row for each form and each of its rarest pieces, of which a match must have one."""
    pieces = _pieces_for(share)
    bag = F.col(f"bag{pieces}")
    # A form may meet texts down to the shortest length whose ratio can still be reached.
    shortest = F.ceil(F.col("m") * share / (2 - share) - 1e-9)
    prefix = F.slice(bag, F.lit(1), F.size(bag) - _always_needed(F.col("m") + shortest, share, pieces) + 1)
    return index.where("m > 0").select(
        "id", "asked", "m", F.size(bag).alias("n"),
        *(F.col(f"masks{p}.mask{i}").alias(f"p{p}_mask{i}") for p in {1, pieces} for i in range(MASK_WORDS)),
        F.posexplode(prefix).alias("place", "piece"),
    )


def _fits(share: float) -> Column:
    """Whether two rows that share a piece may reach the share."""
    pieces = _pieces_for(share)
    both = F.col("x_m") + F.col("y_m")
    needed = _needed(both, share, pieces)
    # At the first piece that both prefixes have, no more can be common than is left on either side.
    left = F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place"))
    low, high = F.least("x_m", "y_m"), F.greatest("x_m", "y_m")
    return (
        # A form that asks meets each other one that asks once.
        ((F.col("x_id") < F.col("y_id")) | (~F.col("y_asked") & (F.col("x_id") != F.col("y_id"))))
        & (low >= high * (share / (2 - share)) - 1e-9)
        & (left >= needed)
        & (F.col("x_n") - _missing_bits(f"x_p{pieces}_", f"y_p{pieces}_") >= needed)
        & (F.col("x_m") - _missing_bits("x_p1_", "y_p1_") >= _needed(both, share, 1))
    )


def _by_characters(index: DataFrame, share: float) -> _PieceJoin:
    rows = _prefixes(index, share)
    return _PieceJoin(rows.where("asked"), rows, _fits(share))


def _near_length(share: float) -> int:
    """Longest form, up to `NEAR_LENGTH`, for which a match of the same length or one more or less differs by one edit.

    Of two texts of joined length b that reach the share, both - 2c characters at most are not common. As long as that
    is two at most, texts of one length have lost one character each, texts that differ by one in length one in all.
    """
    def apart(both: int) -> int:
        return both - 2 * ceil(both * (share / 2) - 1e-9)

    longest = 0
    while longest < NEAR_LENGTH and max(apart(2 * longest + 2), apart(2 * longest + 3)) <= 2:
        longest += 1
    return longest


def _edits(form: Column) -> Column:
    """Hashes of the words in order, as they are and after each loss of one character, a blank included.

    Two texts with one character lost each are then equal, and so are their words. In set scores the words that are
    shared come first and the others follow in order, so a lost blank may join any two words of a text.
    """

    def number(words: Column) -> Column:
        return F.xxhash64(F.array_sort(words))

    def lost(words: Column) -> Column:
        def of_word(w: Column, i: Column) -> Column:
            def without(k: Column) -> Column:
                rest = F.concat(F.substr(w, F.lit(1), k - 1), F.substr(w, k + 1))
                return number(F.transform(words, lambda v, t: F.when(t == i, rest).otherwise(v)))

            return F.transform(F.sequence(F.lit(1), F.length(w)), without)

        return F.flatten(F.transform(words, of_word))

    def joined(words: Column) -> Column:
        def of_word(w: Column, i: Column) -> Column:
            def with_later(u: Column, j: Column) -> Column:
                one = F.transform(words, lambda v, t: F.when(t == i, F.concat(w, u)).when(t != i + 1 + j, v))
                return number(F.array_compact(one))

            return F.transform(F.slice(words, i + 2, F.size(words)), with_later)

        return F.flatten(F.transform(words, of_word))

    return let(F.split(form, " "), lambda w: F.array_distinct(F.concat(F.array(number(w)), lost(w), joined(w))))


def _by_edits(index: DataFrame, share: float) -> list[_PieceJoin]:
    """As `_by_characters`, but short forms of nearly one length meet by `_edits`, so that their tests are nearly all matches.

    All other pairs meet by single pieces: short ones whose lengths differ by more than one by piece and both lengths,
    and pairs with a long form by piece. Keys whose hashes clash give a test more, never a pair less.
    """
    near = _near_length(share)
    short = index.where((F.col("m") > 0) & (F.col("m") <= near)).select("id", "asked", "m", F.explode(_edits(F.col("form"))).alias("piece"))
    order = (F.col("x_id") < F.col("y_id")) | (~F.col("y_asked") & (F.col("x_id") != F.col("y_id")))
    both, differ = F.col("x_m") + F.col("y_m"), F.abs(F.col("x_m") - F.col("y_m"))
    # Different texts lose two characters at least if their lengths are equal.
    apart = both - 2 * F.ceil(both * (share / 2) - 1e-9)
    fits = order & (differ <= 1) & (apart >= F.when(differ == 0, 2).otherwise(1))
    by_edits = _PieceJoin(short.where("asked"), short, fits)

    rows = _prefixes(index, share)
    is_long = F.col("m") > near
    # Lengths that a form may meet; all short ones but its own and its neighbours'.
    lowest, highest = F.ceil(F.col("m") * share / (2 - share) - 1e-9), F.floor(F.col("m") * (2 - share) / share + 1e-9)
    lengths = F.filter(
        F.sequence(lowest.cast("int"), F.least(highest, F.lit(near)).cast("int")), lambda n: F.abs(n - F.col("m")) > 1
    )
    short_rows = rows.where(~is_long).withColumn("other", F.explode(lengths))

    def keyed(at: DataFrame, kind: str, *more: str) -> DataFrame:
        return at.select(*(c for c in rows.columns if c != "piece"), F.xxhash64(F.lit(kind), "piece", *more).alias("piece"))

    left = [keyed(short_rows, "lengths", "m", "other"), keyed(rows.where(is_long), "long"), keyed(rows.where(~is_long), "short")]
    right = [keyed(short_rows, "lengths", "other", "m"), keyed(rows, "long"), keyed(rows.where(is_long), "short")]
    others = _PieceJoin(
        reduce(DataFrame.unionByName, left).where("asked"), reduce(DataFrame.unionByName, right), _fits(share)
    )
    return [by_edits, others]


# ---- pairs that share words ------------------------------------------------------------------


def _weight(words: Column) -> Column:
    """Length of the joined words plus one: every word counts one more than its characters."""
    return F.aggregate(words, F.lit(0), lambda total, w: total + F.length(w) + 1)


def _word_need(form: Column, share: float) -> Column:
    """Weight of shared words at which they alone reach the threshold against this text.

    With shared words of joined length s and a text of length m the ratio is 2s/(s+m), which
    reaches `share` when s >= m*share/(2-share).
    """
    return F.length(form) * (share / (2 - share)) + 1 - 1e-9


def _word_prefix(words: Column, need: Column) -> Column:
    """Rarest words up to the point where the remaining ones weigh less than `need`.

    A text that shares none of them shares less than needed, so it cannot match through words.
    """
    total = _weight(words)
    state = F.struct(total.alias("left"), F.lit(0).alias("taken"))
    walked = F.aggregate(
        words,
        state,
        lambda s, w: F.when(
            s["left"] >= need,
            F.struct(
                (s["left"] - F.length(w) - 1).alias("left"), (s["taken"] + 1).alias("taken")
            ),
        ).otherwise(s),
    )
    return F.slice(words, F.lit(1), walked["taken"])


def _by_words(index: DataFrame, share: float) -> _PieceJoin:
    """Pairs whose shared words cover most of at least one of the two texts."""
    words = index.where(F.size("words") > 0).select("id", "asked", "form", "words")
    need = _word_need(F.col("form"), share)
    x = words.select("id", "asked", "words", need.alias("need"), F.explode(_word_prefix(F.col("words"), need)).alias("piece"))
    y = words.select("id", "asked", "words", F.explode("words").alias("piece"))
    fits = (
        (F.col("x_id") != F.col("y_id"))
        & (F.col("x_asked") | F.col("y_asked"))
        & (_weight(F.array_intersect("x_words", "y_words")) >= F.col("x_need"))
    )
    return _PieceJoin(x, y, fits)


# ---- report forms ----------------------------------------------------------------------------


def _match_list(scorer: str) -> Column:
    """The group's rows of one scorer as `value: score, ...`, sorted by value."""
    text = F.concat("value", F.lit(": "), F.col("score").cast("string"))
    entry = F.when(F.col("scorer") == scorer, F.struct("value", text.alias("text")))
    entries = F.array_sort(F.collect_list(entry))
    return F.array_join(F.transform(entries, lambda e: e["text"]), ", ").alias(scorer)


def compare_scores(matches: DataFrame) -> DataFrame:
    """Per match both scorers' lists `value: score, ...`, empty text where one has none.

    Both lists come from one grouping, so the matching is not computed again to join them.
    """
    return matches.groupBy(F.col("match")).agg(
        *(_match_list(s) for s in SCORERS)
    ).withColumnRenamed("match", "value")


def score_lists(matches: DataFrame, scorers: Sequence[str] = SCORERS) -> DataFrame:
    """Lists by score: the matches of a value for sorted words, the values of a match for word sets."""
    by_value = F.col("scorer") == "token_sort_ratio"
    rows = matches.where(F.col("scorer").isin(list(scorers))).select(
        "scorer",
        "score",
        F.when(by_value, F.col("value")).otherwise(F.col("match")).alias("key"),
        F.when(by_value, F.col("match")).otherwise(F.col("value")).alias("item"),
    )
    return (
        rows.groupBy("scorer", "key", "score")
        .agg(F.array_join(F.array_sort(F.collect_list("item")), ", ").alias("items"))
        .select(
            "scorer",
            F.when(by_value, F.col("key")).otherwise(F.col("items")).alias("value"),
            "score",
            F.when(by_value, F.col("items")).otherwise(F.col("key")).alias("match"),
        )
    )


def find_fuzzy_matches(
    df: DataFrame, columns: Sequence[str], table: str, threshold: int = THRESHOLD, keep: int | None = KEEP
) -> DataFrame:
    """`compare_scores` of every column, stacked with the column and table name."""
    parts = [
        compare_scores(fuzzy_matches(df, c, threshold, keep=keep)).select(
            F.lit(c).alias("table_column"), "*", F.lit(identifier_text(table)).alias("table_name")
        )
        for c in columns
    ]
    return reduce(DataFrame.unionByName, parts)


def multi_fuzzy_matches(
    df: DataFrame, columns: Sequence[str], threshold: int = THRESHOLD, keep: int | None = KEEP
) -> DataFrame:
    """`score_lists` of every column: `table_column, scorer, value, score, match`.

    A report sink may order it by falling score.
    """
    parts = [
        score_lists(fuzzy_matches(df, c, threshold, keep=keep)).select(F.lit(c).alias("table_column"), "*")
        for c in columns
    ]
    return reduce(DataFrame.unionByName, parts)
