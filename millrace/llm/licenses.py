"""License scans: lines and whole texts compared with license templates by the Dice coefficient.

A text is normalised (A-Z in lower case, everything but letters a-z and digits reads as a space) and cut into words;
the units that are compared are its lines and, if it has several, the whole of it. The Dice coefficient of a unit and a
template is twice the number of different word bigrams they share, over the sum of how many each has. Since a
coefficient of at least t needs sizes within t / (2 - t) of each other, a unit is held only against templates whose
number of bigrams is within these bounds, and one of no fitting length is dropped before its bigrams are made. A
unit of a single word counts that word as its bigram.

Templates are rows of a table, so a user adds texts of their own; they are read on the driver (at most
``TEMPLATES``) and become part of the expression. Everything runs within the row: nothing is shuffled.

Lines and whole texts miss a notice within a longer line or wrapped within a longer text. ``passages`` compares windows
of words instead, as long as the templates' bounds allow, with whole license texts besides the notices.

Defined results: null and empty texts, and lines without a letter or digit, match nothing. All templates that fit a unit
are reported; of those whose passages overlap only the best, or all that are equally good. Repeated rows are each scanned, ids may be null or repeated, other columns are never
read. An empty table gives an empty result, an empty table of templates no match.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.spans import let
from millrace.llm.tables import documents

#: Short notices by which licenses are named in texts, and the ids under which they are known.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Least coefficient, in percent, and most templates.
LEAST, TEMPLATES = 80, 10_000


def normalised(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(lowered, F.lit("[^a-z0-9]+"), F.lit(" ")))


def bigrams(words: Column) -> Column:
    """Different pairs of neighbouring words; a single word by itself."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(words))


def template_bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split()
    return sorted({" ".join(p) for p in zip(words, words[1:])}) if len(words) > 1 else words


def matches(text: Column, templates: list[tuple[str, str]], least: int = LEAST) -> Column:
    """Array of ``unit`` (line from 0, or -1 for the whole text), ``license`` and ``dice`` in millionths."""
    known = [(name, grams) for name, grams in ((n, template_bigrams(t)) for n, t in templates) if grams]
    kind = "array<struct<unit:int,license:string,dice:long>>"
    if not known:
        return F.array().cast(kind)
    table = F.array(*(F.struct(F.lit(n).alias("license"), F.lit(len(g)).alias("size"), F.array(*map(F.lit, g)).alias("grams")) for n, g in known))
    smallest = min(len(g) for _, g in known) * least // (200 - least)
    largest = max(len(g) for _, g in known) * (200 - least) // least

    def of_unit(unit: Column, number: Column, templates_: Column) -> Column:
        words = F.split(unit, " ")

        def compared(grams: Column) -> Column:
            n = F.size(grams)
            near = F.filter(templates_, lambda t: (n * (200 - least) >= t["size"] * least) & (t["size"] * (200 - least) >= n * least))
            scored = F.transform(near, lambda t: F.struct(
                number.cast("int").alias("unit"), t["license"].alias("license"),
                F.floor(F.lit(2_000_000).cast("long") * F.size(F.array_intersect(grams, t["grams"])) / (n + t["size"])).alias("dice")))
            return F.filter(scored, lambda m: m["dice"] >= least * 10_000)

        # a text has at least as many bigrams as different words, less one
        fits = lambda w: (F.size(w) > smallest) & (F.size(F.array_distinct(w)) - 1 <= largest)
        return let(words, lambda w: F.when(fits(w), let(bigrams(w), compared)).otherwise(F.array().cast(kind)))

    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.transform(F.split(whole, "\n"), lambda line, i: F.struct(normalised(line).alias("text"), i.alias("at"))),
                     lambda x: x["text"] != "")
    units = F.concat(lines, F.when(F.contains(whole, F.lit("\n")), F.array(F.struct(normalised(whole).alias("text"), F.lit(-1).alias("at"))))
                     .otherwise(F.array().cast("array<struct<text:string,at:int>>")))
    return let(table, lambda t: F.flatten(F.transform(units, lambda x: of_unit(x["text"], x["at"], t))))


def scan(docs: DataFrame, templates: DataFrame | None = None, text: str = "text", name: str = "licenses") -> DataFrame:
    """Adds the array of matches; ``templates`` has ``license`` and ``text``."""
    known = list(NOTICES) if templates is None else [
        (r["license"], r["text"]) for r in templates.select("license", "text").where("license IS NOT NULL AND text IS NOT NULL").limit(TEMPLATES + 1).collect()]
    if len(known) > TEMPLATES:
        raise ValueError(f"more than {TEMPLATES} templates")
    return docs.withColumn(name, F.explode(F.array(matches(F.col(text), known))))


def op2_license_dice(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(documents(spark, folder).select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda m: m["license"])))
    return found.select(
        "doc_id", F.size(F.array_distinct(F.transform("licenses", lambda m: m["unit"]))).cast("long").alias("n_units"),
        F.array_join(names, ",").alias("licenses"), F.coalesce(F.array_max(F.transform("licenses", lambda m: m["dice"])), F.lit(0)).cast("long").alias("best_dice"),
        (F.size("licenses") > 0).alias("licensed"))


#: Whole texts and notices, uncut: ``<license>.txt``, or ``<license>.<part>.txt``.
TEXTS = Path(__file__).parent / "license_texts"

def whole_templates() -> list[tuple[str, str]]:
    """The short notices and all texts of the folder."""
    found = [(re.sub(r"\.(notice|permission)$", "", p.stem), p.read_text("utf-8", "replace")) for p in sorted(TEXTS.glob("*.txt"))]
    return [*NOTICES, *found]


def fewest(size: int, least: int = LEAST) -> int:
    """Bigrams of a template that a window of the least coefficient shares at least."""
    return -(-least * size // (200 - least))


def longest_window(n: int, least: int = LEAST) -> int:
    """Bigrams of the longest window that is compared with a template of ``n``, repeated ones counted."""
    return n * (200 - least) // least


def last_places(values: Column) -> Column:
    """For every place of an array, the last place before it with the same value, or -1."""
    def linked(order: Column) -> Column:
        return F.transform(order, lambda x, k: let(F.get(order, k - 1), lambda y: F.struct(
            x["at"].alias("at"), F.when(y["value"] == x["value"], y["at"]).otherwise(-1).alias("before"))))

    order = F.array_sort(F.transform(values, lambda v, i: F.struct(v.alias("value"), i.alias("at"))))
    return F.transform(F.array_sort(let(order, linked)), lambda x: x["before"])


def passages(spark: SparkSession, text: Column, templates: list[tuple[str, str]], least: int = LEAST) -> Column:
    """Array of ``license`` and ``dice`` (millionths) of each template found in a window of words, wherever it stands.

    Of templates whose best windows overlap the one that shares most counts, of those the one of the highest coefficient:
    notices that differ in the version only, or one text within another, are told apart. Equals are all reported.

    Windows start where a row of bigrams shared with the template starts and end with one of them, at every length up to
    ``longest_window``. One pass from the end of the text drops the starts from which no window can reach the least
    coefficient; from each of the others one pass counts what is new in the window, so time grows with the text. A
    text that lacks the probes of a template (so many of its bigrams that too few are left) is not compared with it.
    Templates of a single word are left out.
    """
    kind = "array<struct<license:string,dice:long>>"
    known = [(name, template_bigrams(t), len(re.sub("[^A-Za-z0-9]+", " ", t).split()) - 1) for name, t in templates]
    known = [k for k in known if k[2] > 0]
    if not known:
        return F.array().cast(kind)
    every = sorted({g for _, grams, _ in known for g in grams})
    pair = lambda p: F.xxhash64(F.element_at(F.split(p, " "), 1), F.element_at(F.split(p, " "), 2))
    hashes = dict(zip(every, spark.range(1).select(F.transform(F.split(F.lit("\n".join(every)), "\n"), pair)).first()[0]))
    # long words are rare, so they make good probes
    probes = [sorted(grams, key=lambda g: (-len(g), g))[:len(grams) - fewest(len(grams), least) + 1] for _, grams, _ in known]

    def numbers(values, type_: str) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{type_}>")

    table = F.array(*(F.struct(
        F.lit(name).alias("license"), F.lit(len(grams)).alias("size"), F.lit(fewest(len(grams), least)).alias("fewest"),
        numbers((hashes[g] for g in probe), "bigint").alias("probes"), numbers((hashes[g] for g in grams), "bigint").alias("grams"),
        F.lit(longest_window(n, least)).alias("longest")) for (name, grams, n), probe in zip(known, probes)))
    some = numbers(sorted({hashes[g] for probe in probes for g in probe}), "bigint")

    def shared(t: Column, window: Column) -> Column:
        return F.size(F.array_intersect(t["grams"], window))

    def starts(t: Column, marks: Column) -> Column:
        """Where a window may start: ``gain`` is above what any window from a place on can have."""
        def step(state: Column, m: Column) -> Column:
            cost = F.when(m["inside"], 200 - least).when(m["before"] <= m["at"] - t["longest"], -least).otherwise(0)
            return let(F.greatest(F.lit(0).cast("long"), state["gain"] + cost), lambda gain: F.struct(
                gain.alias("gain"), F.when(m["first"] & (gain >= t["size"] * least), F.concat(state["starts"], F.array(m["at"])))
                .otherwise(state["starts"]).alias("starts")))

        none = F.struct(F.lit(0).cast("long").alias("gain"), F.array().cast("array<int>").alias("starts"))
        return F.aggregate(F.reverse(marks), none, step, lambda state: state["starts"])

    def best(t: Column, marks: Column, at: Column) -> Column:
        def step(state: Column, m: Column) -> Column:
            shared_, all_ = state["shared"] + F.when(m["inside"], 1).otherwise(0), state["all"] + 1
            window = F.struct(F.floor(F.lit(2_000_000).cast("long") * shared_ / (all_ + t["size"])).alias("dice"), shared_.alias("shared"),
                              at.alias("at"), (m["at"] - at + 1).alias("length"))
            better = m["inside"] & (F.struct(window["dice"], window["shared"]) > F.struct(state["best"]["dice"], state["best"]["shared"]))
            counted = F.struct(shared_.alias("shared"), all_.alias("all"), F.when(better, window).otherwise(state["best"]).alias("best"))
            return F.when(m["before"] < at, counted).otherwise(state)

        zero = F.lit(0)
        none = F.struct(zero.alias("shared"), zero.alias("all"), F.struct(
            zero.cast("long").alias("dice"), zero.alias("shared"), at.alias("at"), zero.alias("length")).alias("best"))
        return F.aggregate(F.slice(marks, at + 1, t["longest"]), none, step, lambda state: state["best"])

    def found(t: Column, grams: Column, before: Column) -> Column:
        def marked(inside: Column) -> Column:
            return F.transform(inside, lambda x, i: F.struct(
                i.alias("at"), x.alias("inside"), (x & ~F.coalesce(F.get(inside, i - 1), F.lit(False))).alias("first"), F.get(before, i).alias("before")))

        inside = F.transform(grams, lambda g: F.array_contains(t["grams"], g))
        window = let(let(inside, marked), lambda marks: F.array_max(F.transform(starts(t, marks), lambda at: best(t, marks, at))))
        return F.struct(t["license"].alias("license"), window.alias("window"))

    def outdone(m: Column, by: Column) -> Column:
        mine, other = m["window"], by["window"]
        overlap = (other["at"] < mine["at"] + mine["length"]) & (mine["at"] < other["at"] + other["length"])
        return overlap & (F.struct(other["shared"], other["dice"]) > F.struct(mine["shared"], mine["dice"]))

    def compared(grams: Column) -> Column:
        def all_(table_: Column) -> Column:
            near = F.filter(F.filter(table_, lambda t: F.arrays_overlap(t["probes"], grams)), lambda t: shared(t, grams) >= t["fewest"])
            compared_ = let(near, lambda ts: F.when(F.size(ts) > 0, let(last_places(grams), lambda before: F.transform(ts, lambda t: found(t, grams, before)))))
            some_ = F.filter(F.coalesce(compared_, F.array()), lambda m: m["window"]["dice"] >= least * 10_000)
            own = let(some_, lambda ms: F.filter(ms, lambda m: ~F.exists(ms, lambda o: outdone(m, o))))
            return F.transform(own, lambda m: F.struct(m["license"].alias("license"), m["window"]["dice"].alias("dice")))

        return F.when(F.arrays_overlap(some, grams), let(table, all_)).otherwise(F.array().cast(kind))

    words = F.split(normalised(F.coalesce(text, F.lit(""))), " ")
    pairs = lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.xxhash64(a, b))
    return let(words, lambda w: F.when(F.size(w) > 1, let(pairs(w), compared)).otherwise(F.array().cast(kind)))


def op2_license_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses named or quoted anywhere in a text: the whole job, of which ``op2_license_dice`` compares lines and texts only."""
    docs = documents(spark, folder).select("doc_id", "text")
    found = docs.select("doc_id", F.explode(F.array(passages(spark, F.col("text"), whole_templates()))).alias("found"))
    return found.select(
        "doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda m: m["license"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("found", lambda m: m["dice"])), F.lit(0)).cast("long").alias("best_dice"),
        (F.size("found") > 0).alias("licensed"))
