"""Places of pattern matches in a text, with Spark's own functions only.

Spark returns the matches of a pattern but not where they are. The pieces between the matches, which ``split``
gives with the same pattern, have the missing lengths: match i starts after the first i + 1 pieces and the first
i matches. All places are code points, ends are exclusive. Sums run in blocks, so the work stays close to the
number of matches, however many a text has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLOCK = 256
#: A match: where it is, the number of its kind (the order of kinds that start together), its text and
#: the code points just before and just after it.
SPAN = "struct<start:int,rank:int,stop:int,kind:string,value:string,before:string,after:string>"
NO_SPANS = f"array<{SPAN}>"
CONTEXT = 48
#: Matches of a pattern with context have this many code points at least, so few of them reach over its width.
SHORTEST = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: inside a lambda it is a variable, not an expression."""
    return F.transform(F.array(value), body)[0]


def starts(lengths: Column) -> Column:
    """For an array of whole numbers, the sum of the elements before each."""

    def upto(low: Column, n: Column) -> Column:
        return F.aggregate(F.slice(lengths, low, n), F.lit(0), lambda total, x: total + x)

    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: upto(b * BLOCK + 1, F.lit(BLOCK)))
    before = F.aggregate(sums, F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))
    return let(before, lambda done: F.transform(lengths, lambda _, i: (
        F.get(done, F.floor(i / BLOCK).cast("int"))
        + upto((i - i % BLOCK + 1).cast("int"), (i % BLOCK).cast("int")))))


def spans(text: Column, pattern: str, kind: str, rank: int, group: int | None = None, context: bool = False) -> Column:
    """All leftmost, non-overlapping matches as an array of ``SPAN``; ``value`` is the match or one group of it.

    ``before`` and ``after`` are filled in if ``context`` is set, from the whole text, other matches included.
    """
    quoted = F.lit(pattern)
    found = F.struct(
        F.regexp_extract_all(text, quoted, F.lit(0)).alias("match"),
        (F.regexp_extract_all(text, quoted, F.lit(group)) if group else F.lit(None).cast("array<string>")).alias("value"),
        F.split(text, pattern, -1).alias("piece"))

    reach = -(-CONTEXT // SHORTEST)

    def side(f: Column, cut: Callable[[Column, Column], Column]) -> Column:
        """Each piece with the match that follows it, cut to the width of the context."""
        width = F.lit(CONTEXT)
        return F.zip_with(f["piece"], f["match"], lambda piece, match: cut(
            F.concat(cut(piece, width), cut(F.coalesce(match, F.lit("")), width)), width)) if context else F.array().cast("array<string>")

    def around(f: Column, lefts: Column, rights: Column, i: Column) -> tuple[Column, Column]:
        if not context:
            return F.lit(""), F.lit("")
        earlier = F.slice(lefts, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)))
        return (F.right(F.concat(F.array_join(earlier, ""), F.right(F.get(f["piece"], i), F.lit(CONTEXT))), F.lit(CONTEXT)),
                F.left(F.array_join(F.slice(rights, i + 2, F.lit(reach)), ""), F.lit(CONTEXT)))

    def placed(f: Column) -> Column:
        return let(F.struct(side(f, F.right).alias("left"), side(f, F.left).alias("right")), lambda c: located(f, c["left"], c["right"]))

    def located(f: Column, lefts: Column, rights: Column) -> Column:
        lengths = F.zip_with(F.slice(f["piece"], 1, F.size(f["match"])), f["match"],
                             lambda piece, match: F.length(piece) + F.length(match))
        return let(lengths, lambda ls: let(starts(ls), lambda s: F.transform(s, lambda at, i: F.struct(
            (at + F.length(F.get(f["piece"], i))).alias("start"), F.lit(rank).alias("rank"),
            (at + F.get(ls, i)).alias("stop"), F.lit(kind).alias("kind"),
            (F.get(f["value"], i) if group else F.get(f["match"], i)).alias("value"),
            *(c.alias(n) for c, n in zip(around(f, lefts, rights, i), ("before", "after")))))))

    return F.when(text.rlike(pattern), let(found, placed)).otherwise(F.array().cast(NO_SPANS))


def apart(found: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(found, lambda x: ~F.exists(others, lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"])))


def ordered(*found: Column) -> Column:
    """All spans by start, then kind."""
    return F.array_sort(F.concat(*found))


def written(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
