"""Similarity of texts: normal forms and the ratio of matching pairs, all as expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowproof.functions.text import col, strip


def words_only(text: Column | str) -> Column:
    """Lower-case words: Latin-1 accents dropped, everything but letters, digits, `_` to space."""
    kept = F.regexp_replace(col(text), r"[\x{80}-\x{FF}]", "")
    return strip(F.lower(F.regexp_replace(kept, r"[^\p{L}\p{N}_]", " ")))


def sorted_words(text: Column | str) -> Column:
    return F.array_sort(F.filter(F.split(words_only(text), r"\s+"), lambda w: w != ""))


def sort_form(text: Column | str) -> Column:
    """Words in order, repeated words kept."""
    return F.array_join(sorted_words(text), " ")


def set_form(text: Column | str) -> Column:
    """Distinct words in order."""
    return F.array_join(F.array_distinct(sorted_words(text)), " ")


# ---- longest common subsequence as a fold --------------------------------------------------

# Places of a text in one long: two bits stay free, so a sum of two such numbers keeps its carry.
LONG_BITS = 62


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", _long(1), place.cast("int"))


def char_places(text: Column) -> Column:
    """The text for `common_length`: its length, its distinct characters, and for each its places as bits.

    The bits of a character are one long for each `LONG_BITS` characters of the text, one character after another.
    """

    def built(chars: Column) -> Column:
        m = F.size(chars)

        def part(c: Column, k: Column) -> Column:
            inside = F.slice(chars, k * LONG_BITS + 1, F.lit(LONG_BITS))
            marks = F.transform(inside, lambda x, i: F.when(x == c, _bit(i)).otherwise(_long(0)))
            return F.aggregate(marks, _long(0), lambda bits, mark: bits.bitwiseOR(mark))

        longs = F.sequence(F.lit(0), F.floor((m - 1) / LONG_BITS).cast("int"))
        letters = F.array_distinct(chars)
        bits = F.flatten(F.transform(letters, lambda c: F.transform(longs, lambda k: part(c, k))))
        return F.struct(
            m.alias("m"), F.array_join(letters, "").alias("letters"), F.when(m > 0, bits).alias("bits")
        )

    return let(characters(text), built)


def _ones(n: Column) -> Column:
    return _bit(n) - 1


def _free_after(m: Column, hits: Column) -> Column:
    """Free places of a text of up to LONG_BITS characters after steps with these places of a character."""

    def step(free: Column, h: Column) -> Column:
        moved = (free + free.bitwiseAND(h)).bitwiseOR(free.bitwiseAND(F.bitwise_not(h)))
        return moved.bitwiseAND(_long((1 << LONG_BITS) - 1))

    return F.bit_count(F.aggregate(hits, _ones(m), step).bitwiseAND(_ones(m)))


def _short_common(places: Column, other: Column, allowed: Column | None = None) -> Column:
    """`common_length` of a text of up to LONG_BITS characters; only its `allowed` places are looked at."""
    m, letters, bits = (places[c] for c in ("m", "letters", "bits"))

    def hit(c: Column) -> Column:
        found = F.coalesce(F.get(bits, F.instr(letters, c) - 1), _long(0))
        return found if allowed is None else found.bitwiseAND(allowed)

    return m - _free_after(m, F.transform(characters(other), hit))


def _long_common(places: Column, other: Column) -> Column:
    """`common_length` of a text of any length, with a carry from one long to the next."""
    m, letters, bits = (places[c] for c in ("m", "letters", "bits"))
    last = F.floor((m - 1) / LONG_BITS).cast("int")

    def longs(free: Column, c: Column) -> Column:
        def step(at: Column) -> Column:
            def add(done: Column, k: Column) -> Column:
                f, h = F.get(free, k), F.get(bits, at * (last + 1) + k)

                def with_sum(total: Column) -> Column:
                    kept = total.bitwiseOR(f.bitwiseAND(F.bitwise_not(h))).bitwiseAND(_long((1 << LONG_BITS) - 1))
                    return F.struct(
                        F.shiftright(total, LONG_BITS).alias("carry"), F.array_append(done["free"], kept).alias("free")
                    )

                return let(f + f.bitwiseAND(h) + done["carry"], with_sum)

            none = F.struct(_long(0).alias("carry"), F.array().cast("array<bigint>").alias("free"))
            return F.when(at < 0, free).otherwise(F.aggregate(F.sequence(F.lit(0), last), none, add)["free"])

        return let(F.instr(letters, c) - 1, step)

    start = F.transform(F.sequence(F.lit(0), last), lambda k: _long((1 << LONG_BITS) - 1))

    def own(free: Column, k: Column) -> Column:
        inside = F.when(k < last, _long((1 << LONG_BITS) - 1)).otherwise(_ones(m - last * LONG_BITS))
        return F.bit_count(free.bitwiseAND(inside))

    counts = F.transform(F.aggregate(characters(other), start, longs), own)
    return m - F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def common_length(places: Column, other: Column) -> Column:
    """Length of the longest common subsequence of a text, given by `char_places`, and another one.

    A bit is free while its place of the text is not used. One step per character of the other text
    moves the lowest free place of every block to the character's next one; what is not free at the
    end counts. Texts of up to `LONG_BITS` characters take one long, others a list with carry.
    """
    m = places["m"]
    return F.when(m == 0, 0).when(m <= LONG_BITS, _short_common(places, other)).otherwise(_long_common(places, other))


def _percent(common: Column, both: Column) -> Column:
    """Rounded to the nearest whole number, halves to the even one."""
    return F.rint(F.lit(100) * ((F.lit(2) * common) / both)).cast("int")


def _may_reach(a: Column, b: Column, both: Column, share: float) -> Column:
    """Whether a ratio of two texts of joined length `both`, of which a and b are what may differ, may be `share`.

    Then both-2c characters at most are in one text only, c being their fewest common ones for that ratio. So
    many deletions and insertions turn one text into the other, and the edit distance, which also has
    replacements, is no larger.
    """
    apart = (both - 2 * F.ceil(both * (share / 2) - 1e-9)).cast("int")
    return F.call_function("levenshtein", a, b, apart) >= 0


def sort_score(a: Column, b: Column, places: Column, share: float = 0.0) -> Column:
    """Ratio of two sort forms, 0 to 100; `places` are the `char_places` of `a`. One below `share` may be 0."""
    both = F.length(a) + F.length(b)
    ratio = _percent(common_length(places, b), both)
    if share > 0:
        ratio = F.when(_may_reach(a, b, both, share), ratio).otherwise(0)
    return F.when(a == b, 100).when((a == "") | (b == ""), 0).otherwise(ratio)


def set_score(a: Column, b: Column, places: Column, share: float = 0.0) -> Column:
    """Best ratio of two set forms: shared words against each side, and the sides. One below `share` may be lower.

    The sides begin with the shared words, which are then common to both in full; only the words
    that are left need a common subsequence. Without shared words the sides are the forms.
    """

    def own_places(words: Column, shared: Column) -> Column:
        """The places of the words that are not shared, with one blank after each but the last."""

        def add(done: Column, w: Column) -> Column:
            n, at = F.length(w), done["at"]
            own = ~F.array_contains(shared, w)
            bits = F.call_function("shiftleft", _ones(n + 1), at)
            return F.struct(
                (at + n + 1).alias("at"),
                F.when(own, done["bits"].bitwiseOR(bits)).otherwise(done["bits"]).alias("bits"),
                F.when(own, _bit(at + n)).otherwise(done["blank"]).alias("blank"),
            )

        start = F.struct(F.lit(0).alias("at"), _long(0).alias("bits"), _long(0).alias("blank"))
        return F.aggregate(words, start, add, lambda done: done["bits"].bitwiseAND(F.bitwise_not(done["blank"])))

    def scored(parts: Column) -> Column:
        s, x, y = parts["s"], parts["x"], parts["y"]
        short = let(parts["own"], lambda own: _short_common(places, y, own))
        left = F.when(places["m"] <= LONG_BITS, short).otherwise(let(char_places(x), lambda p: common_length(p, y)))

        def side(text: Column) -> Column:
            return s + 1 + F.length(text)

        alone = _percent(s, s + F.least(side(x), side(y)))
        sides = _percent(s + 1 + left, side(x) + side(y))
        if share > 0:
            sides = F.when(_may_reach(x, y, side(x) + side(y), share), sides)
        # Without a word of its own one side is the shared words.
        return F.when((x == "") | (y == ""), 100).otherwise(F.greatest(alone, sides))

    def split_up(words: Column) -> Column:
        one, two, both = words["one"], words["two"], words["both"]
        return F.struct(
            F.length(F.array_join(both, " ")).alias("s"),
            F.array_join(F.array_except(one, both), " ").alias("x"),
            F.array_join(F.array_except(two, both), " ").alias("y"),
            F.when(places["m"] <= LONG_BITS, own_places(one, both)).alias("own"),
        )

    one, two = F.split(a, " "), F.split(b, " ")
    words = F.struct(one.alias("one"), two.alias("two"), F.array_intersect(one, two).alias("both"))
    ratio = let(
        words,
        lambda w: F.when(F.size(w["both"]) == 0, sort_score(a, b, places, share)).otherwise(let(split_up(w), scored)),
    )
    return F.when(a == b, 100).when((a == "") | (b == ""), 0).otherwise(ratio)
