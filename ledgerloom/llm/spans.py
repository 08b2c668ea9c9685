"""Places of pattern matches in texts, as SQL expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters before a match that come with it.
CONTEXT = 24


def matches(text: Column, pattern: str, may: Column | None = None) -> tuple[Column, Column]:
    """The matches of a pattern and the texts around them, one more; both empty where ``may`` says that nothing can match."""
    values, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    if may is None:
        return values, gaps
    none = F.array().cast("array<string>")
    return F.when(may, values).otherwise(none), F.when(may, gaps).otherwise(none)


def named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, also where ``body`` looks at it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def before_each(values: Column, zero: int, combine: Callable[[Column, Column], Column]) -> Column:
    """For each value all earlier ones combined (``zero`` for the first), and one more for all of them.

    In two steps, within blocks and over blocks of about the square root of the number of values: an array that grows by one
    is copied each time, so that one long row would take time with the square of its values.
    """
    empty = F.array().cast("array<int>")

    def short(numbers: Column) -> Column:
        start = F.array(F.lit(zero))
        return F.aggregate(numbers, start, lambda found, n: F.concat(found, F.array(combine(F.element_at(found, -1), n))))

    def shifted(part: Column, first: Column) -> Column:
        return F.transform(F.slice(part, F.lit(1), F.size(part) - 1), lambda n: combine(first, n))

    def joined(parts: Column) -> Column:
        firsts = short(F.transform(parts, lambda part: F.element_at(part, -1)))
        blocks = lambda first: F.zip_with(parts, F.slice(first, F.lit(1), F.size(parts)), shifted)
        return named(firsts, lambda first: F.concat(F.flatten(blocks(first)), F.slice(first, -1, 1)))

    def whole(all_values: Column) -> Column:
        n = F.size(all_values)
        block = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
        starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, block)).otherwise(empty)
        return joined(F.transform(starts, lambda i: short(F.slice(all_values, i + 1, block))))

    return named(values, lambda all_values: named(whole(all_values), lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(zero)))))


def placed(values: Column, gaps: Column) -> Column:
    """An array of start, stop, value, before and after for the matches."""

    def of(pairs: Column) -> Column:
        """From structs of a match, the gap before it and the character after it."""
        starts = before_each(F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["value"])), 0, lambda a, b: a + b)

        def place(pair: Column, before: Column) -> Column:
            begin = before + F.length(pair["gap"])
            return F.struct(
                begin.alias("start"),
                (begin + F.length(pair["value"])).alias("stop"),
                pair["value"].alias("value"),
                F.lower(F.right(pair["gap"], F.lit(CONTEXT))).alias("before"),
                pair["after"].alias("after"),
            )

        return F.zip_with(pairs, F.slice(starts, F.lit(1), F.size(pairs)), place)

    def pair(both: Column, after: Column) -> Column:
        return F.struct(both["gap"].alias("gap"), both["value"].alias("value"), F.left(after, F.lit(1)).alias("after"))

    both = F.zip_with(gaps, values, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    pairs = F.zip_with(both, F.slice(gaps, F.lit(2), F.greatest(F.size(gaps), F.lit(1))), pair)
    # the last gap has no match
    return named(F.filter(pairs, lambda p: p["value"].isNotNull()), of)


def apart(spans: Column, kept: Column) -> Column:
    """The ``spans`` (structs with start and stop) that overlap none of ``kept``, by start."""
    # a span meets the kept spans that begin before its end; the furthest of their ends is what counts
    own = F.transform(spans, lambda s: F.struct(s["stop"].alias("at"), F.lit(0).alias("is_kept"), F.lit(-1).alias("reach"), s.alias("span")))
    others = F.transform(
        kept, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("is_kept"), s["stop"].alias("reach"), F.get(F.slice(spans, 1, 0), F.lit(0)).alias("span"))
    )

    def free(both: Column) -> Column:
        reached = before_each(F.transform(both, lambda e: e["reach"]), -1, F.greatest)
        marked = F.zip_with(both, F.slice(reached, F.lit(1), F.size(both)), lambda e, far: F.struct(e.alias("e"), far.alias("far")))
        found = F.filter(marked, lambda m: (m["e"]["is_kept"] == 0) & (m["far"] <= m["e"]["span"]["start"]))
        return F.transform(found, lambda m: m["e"]["span"])

    return F.when(F.size(spans) > 0, F.array_sort(named(F.array_sort(F.concat(own, others)), free))).otherwise(spans)


def leading(spans: Column) -> Column:
    """The ``spans``, in order, that begin behind the ends of all earlier ones."""

    def first(given: Column) -> Column:
        reached = before_each(F.transform(given, lambda s: s["stop"]), -1, F.greatest)
        marked = F.zip_with(given, F.slice(reached, F.lit(1), F.size(given)), lambda s, far: F.struct(s.alias("s"), far.alias("far")))
        return F.transform(F.filter(marked, lambda m: m["far"] <= m["s"]["start"]), lambda m: m["s"])

    return named(spans, first)


def replaced(text: Column, spans: Column, tag: Callable[[Column], Column]) -> Column:
    """``text`` with every span (start, kind, stop), in order, replaced by its tag; overlapping spans by the first one's.

    Blocks of spans are cut out of the text first and pieces out of these, because finding a character counts from the front.
    """

    def filled(given: Column) -> Column:
        n, ends = F.size(given), before_each(F.transform(given, lambda s: s["stop"]), 0, F.greatest)
        block = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))

        def pieces(reached: Column) -> Column:
            def of_block(i: Column) -> Column:
                low, high = F.get(reached, i), F.get(reached, F.least(n, i + block))
                region = F.substr(text, low + 1, high - low)

                def piece(body: Column) -> Column:
                    def one(s: Column, k: Column) -> Column:
                        at = F.get(reached, i + k)
                        gap = F.substr(body, at - low + 1, F.greatest(F.lit(0), s["start"] - at))
                        return F.when(s["start"] >= at, F.concat(gap, tag(s["kind"]))).otherwise(F.lit(""))

                    return F.array_join(F.transform(F.slice(given, i + 1, block), one), "")

                return named(region, piece)

            last = F.get(reached, n)
            tail = F.substr(text, last + 1, F.length(text))
            return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), n - 1, block), of_block), ""), tail)

        return named(ends, pieces)

    return F.when(F.size(spans) > 0, named(spans, filled)).otherwise(text)
