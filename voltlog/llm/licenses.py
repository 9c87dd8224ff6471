"""License detection by ordered signature rules over normalised words.

A document is one row from beginning to end: normalise, look for keywords, and only where one
occurs run the rules of that keyword. Rules are data, an array literal of structs; matching,
positions and the suppression of overlapped detections are array expressions. No shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlog.llm.common import ascii_lower, let, named, others, packed, unpacked
from voltlog.llm.pii import running

#: Everything but ASCII letters and digits and characters beyond ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases whose every place is counted, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# One of these stands in every match of every rule; texts without them are done at once.
COVER = (
    "licen", "copyright", "copyleft", "public domain", "cc by", "cc0", "rights reserved", "warrant",
    "confidential", "redistribut", "permission", "gpl", "wtfpl", "cecill",
)

# License families as label, keyword (must occur for a rule to run), pattern of the name.
FAMILIES = (
    ("afl", "academic free", "academic free license"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[sc]e"),
    ("apache", "apache", "apache(?: software)? licen[sc]e"),
    ("artistic", "artistic", "(?:perl )?artistic licen[sc]e"),
    ("beerware", "beerware", "beerware licen[sc]e"),
    ("boost", "boost", "boost software licen[sc]e"),
    ("bsd", "bsd", "(?:[234] clause |new |simplified |modified |revised )?bsd(?: [234] clause)? licen[sc]e"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa"),
    ("cc-by-nc", "cc by", "cc by nc"),
    ("cc-by-nd", "cc by", "cc by nd"),
    ("cc-by-sa", "cc by", "cc by sa"),
    ("creative-commons", "creative commons", "creative commons(?: [a-z]+){0,4} licen[sc]e"),
    ("cddl", "common development", "common development and distribution licen[sc]e"),
    ("cecill", "cecill", "cecill(?: [bc])?(?: licen[sc]e)?"),
    ("copyleft", "copyleft", "copyleft(?: licen[sc]e)?"),
    ("cpl", "common public", "common public licen[sc]e"),
    ("ecl", "educational community", "educational community licen[sc]e"),
    ("epl", "eclipse", "eclipse public licen[sc]e"),
    ("eupl", "european union", "european union public licen[sc]e"),
    ("fdl", "free documentation", "(?:gnu )?free documentation licen[sc]e"),
    ("gpl", "general public", "(?:gnu )?general public licen[sc]e"),
    ("isc", "isc li", "isc licen[sc]e"),
    ("lgpl", "general public", "(?:gnu )?(?:lesser|library) general public licen[sc]e"),
    ("lppl", "latex", "latex project public licen[sc]e"),
    ("mit", "mit ", "mit(?: x11)? licen[sc]e"),
    ("mpl", "mozilla", "mozilla public licen[sc]e"),
    ("ms-pl", "microsoft", "microsoft (?:public|reciprocal) licen[sc]e"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e"),
    ("odbl", "open database", "open database licen[sc]e"),
    ("odc-by", "open data commons", "open data commons(?: attribution)? licen[sc]e"),
    ("ofl", "sil open font", "sil open font licen[sc]e"),
    ("osl", "open software", "open software licen[sc]e"),
    ("pddl", "public domain dedication", "public domain dedication(?: and licen[sc]e)?"),
    ("php", "php li", "php licen[sc]e"),
    ("postgresql", "postgresql", "postgresql licen[sc]e"),
    ("public-domain", "public domain", "public domain"),
    ("python", "python software", "python software foundation licen[sc]e"),
    ("ruby", "ruby li", "ruby licen[sc]e"),
    ("unlicense", "unlicense", "the unlicense"),
    ("upl", "universal permissive", "universal permissive licen[sc]e"),
    ("vim", "vim li", "vim licen[sc]e"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("x11", "x11 li", "x11 licen[sc]e"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e"),
    ("zpl", "zope", "zope public licen[sc]e"),
)

# What may stand around a family's name, with priority and confidence in percent.
FORMS = (
    ("{name}", 20, 60),
    ("{name} v(?:ersion )?[0-9]+(?: [0-9]+)?(?: or later| only)?", 40, 85),
    ("{name} version [0-9]+(?: [0-9]+)?(?: or (?:any )?later(?: version)?| only)?", 45, 90),
    ("(?:licen[sc]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?{name}", 60, 95),
    ("(?:licen[sc]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?{name} v?(?:ersion )?[0-9]+(?: [0-9]+)?", 70, 99),
    ("spdx licen[sc]e identifier (?:[a-z]+ )?{name}", 80, 100),
)

# Rules of their own, as label, keyword, pattern, priority, confidence.
SINGLE = (
    ("spdx", "spdx", "spdx licen[sc]e identifier [a-z0-9]+(?: [0-9]+)*", 75, 98),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?(?: by)?", 50, 70),
    ("copyright", "copyright", "copyright (?:c|notice|holder|owner)s?", 30, 50),
    ("reserved", "reserved", "all rights reserved", 50, 70),
    ("reserved", "reserved", "(?:some|no) rights reserved", 45, 60),
    ("permission", "permission", "permission is hereby granted(?: free of charge)?", 65, 90),
    ("permission", "redistribut", "redistribution and use in source and binary forms(?: with or without modification)?", 65, 95),
    ("warranty", "warrant", "(?:provided )?as is without warrant(?:y|ies)(?: of any kind)?", 55, 80),
    ("proprietary", "proprietary", "proprietary and confidential", 60, 85),
    ("proprietary", "confidential", "confidential and proprietary", 60, 85),
    ("no-redistribution", "redistribut", "(?:may not be|not to be|do not) redistributed?", 50, 70),
    ("gpl", "gpl", "(?:gnu )?gpl ?v?[0-9](?: [0-9])?(?: or later| only)?", 50, 85),
    ("lgpl", "lgpl", "lgpl ?v?[0-9](?: [0-9])?(?: or later| only)?", 50, 85),
    ("agpl", "agpl", "agpl ?v?[0-9](?: [0-9])?(?: or later| only)?", 50, 85),
    ("cc-by", "cc by", "cc by(?: [0-9](?: [0-9])?)?", 40, 85),
    ("cc-by-nc", "cc by", "licensed under cc by nc(?: [0-9] [0-9])?", 70, 98),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: int


def rules() -> list[Rule]:
    """Some hundreds of rules: every form of every family, and the single ones."""
    made = [
        Rule(label, keyword, form.format(name=name) if "{name}" in form else form, priority, confidence)
        for label, keyword, name in FAMILIES
        for form, priority, confidence in FORMS
        for form in (form.replace("{2}", "{{2}}"),)
    ]
    return made + [Rule(*r) for r in SINGLE]


def _rule_array(found: list[Rule]) -> Column:
    """The rules as an array literal; a match must have a space or an end on both sides."""
    return F.array(
        *[
            F.struct(
                F.lit(r.label).alias("label"),
                F.lit(r.keyword).alias("keyword"),
                F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.confidence).alias("confidence"),
            )
            for r in found
        ]
    )


def _matches(words: Column, rule: Column) -> Column:
    """Every match of a rule as word numbers (end exclusive), with the rule's data.

    Words are counted by the spaces in the pieces between matches and in the matches, so that each
    character is looked at once, however many matches there are. The text begins with a space.
    """
    both = F.struct(
        F.split(words, rule["pattern"], -1).alias("between"),
        F.regexp_extract_all(words, rule["pattern"], F.lit(0)).alias("found"),
    )
    spaces = lambda piece: F.length(piece) - F.length(F.replace(piece, F.lit(" ")))

    def placed(v: Column) -> Column:
        steps = F.transform(v["found"], lambda m, i: spaces(m) + spaces(F.get(v["between"], i)))
        return let(
            running(steps),
            lambda before: F.transform(
                v["found"],
                lambda m, i: let(
                    F.get(before, i) + spaces(F.get(v["between"], i)),
                    lambda first: F.struct(
                        (first - 1).alias("start"),
                        (first + spaces(m)).alias("end"),
                        rule["label"].alias("label"),
                        rule["priority"].alias("priority"),
                        rule["confidence"].alias("confidence"),
                    ),
                ),
            ),
        )

    return let(both, placed)


def _kept(found: Column) -> Column:
    """Detections that no other one with a higher claim contains.

    A higher claim is a higher priority, or the same with a longer match, or the same match with
    the label that sorts first. One sweep over the detections by place: one that contains another comes
    before it, and only those that have not ended yet are looked at.
    """
    by_place = F.array_sort(
        F.transform(
            found,
            lambda d: F.struct(
                d["start"].alias("start"), (-d["end"]).alias("back"), (-d["priority"]).alias("less"),
                d["label"].alias("label"), (-d["confidence"]).alias("unsure"),
            ),
        )
    )

    def step(state: Column, d: Column) -> Column:
        def judged(going: Column) -> Column:
            def wins(o: Column) -> Column:
                # of equal claims, what comes earlier is longer, or has the label that sorts first
                return (o["back"] <= d["back"]) & (o["less"] <= d["less"])

            return F.struct(
                F.array_append(going, d).alias("going"),
                F.when(F.exists(going, wins), state["kept"]).otherwise(F.array_append(state["kept"], d)).alias("kept"),
            )

        return let(F.filter(state["going"], lambda o: -o["back"] > d["start"]), judged)

    def sweep(places: Column) -> Column:
        none = F.filter(places, lambda _: F.lit(False))
        kept = F.aggregate(
            places, F.struct(none.alias("going"), none.alias("kept")), step, lambda state: state["kept"]
        )
        return F.transform(
            kept,
            lambda d: F.struct(
                d["start"].alias("start"), (-d["back"]).alias("end"), d["label"].alias("label"),
                (-d["less"]).alias("priority"), (-d["unsure"]).alias("confidence"),
            ),
        )

    return let(by_place, sweep)


def _places_of(phrase: str) -> Callable[[Column], Column]:
    """From an array of words, the numbers of those at which the phrase begins."""
    parts = phrase.split(" ")

    def places(words: Column) -> Column:
        def at(i: Column) -> Column:
            return reduce(and_, [F.get(words, i + k) == part for k, part in enumerate(parts)])

        return F.filter(F.sequence(F.lit(0), F.size(words) - 1), at)

    return places


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``base`` (arrays of places), ``detections``, ``labels`` and ``score``.

    ``detections`` has start and end as word numbers (end exclusive), label, priority and
    confidence of the rules' matches that are not suppressed; ``labels`` joins them, sorted, with
    the labels of base phrases. ``score`` is the highest confidence of any detection, 0.7 at least
    where a base phrase stands, 0 without any.

    Null and empty texts have no words and no detections. Repeated rows are scanned alike; no rows
    give no rows. Existing columns with the names of the new ones are replaced.
    """
    kept = others(docs, ("n_words", "base", "base_labels", "detections", "labels", "score"))
    all_rules = rules()
    plain = F.trim(F.regexp_replace(F.coalesce(named(text), F.lit("")), NOT_WORD, " "))
    rows = docs.select(packed(kept), plain.alias("_plain"))
    hit = reduce(or_, [F.col("_lower").contains(word) for word in COVER])
    rows = rows.select("_row", "_plain", F.lower("_plain").alias("_lower")).select(
        "_row", "_plain", hit.alias("_hit"),
        F.when(F.col("_plain") == "", 0)
        .otherwise(F.length("_plain") - F.length(F.replace(F.col("_plain"), F.lit(" "))) + 1)
        .cast("long").alias("n_words"),
    )
    lowered = F.when(F.col("_hit"), ascii_lower(F.col("_plain"))).otherwise(F.lit(""))
    rows = rows.select("_row", "n_words", "_hit", lowered.alias("_low"))
    no_places = F.expr("cast(array() as array<int>)")
    words = F.split("_low", " ")
    base = F.struct(
        *[
            F.when(F.concat(F.lit(" "), F.col("_low"), F.lit(" ")).contains(f" {phrase} "),
                   let(words, _places_of(phrase)))
            .otherwise(no_places).alias(label)
            for phrase, label in BASE
        ]
    )
    empty = F.expr(
        "cast(array() as array<struct<start:int,end:int,label:string,priority:int,confidence:int>>)"
    )

    def detected(low: Column) -> Column:
        gated = F.filter(_rule_array(all_rules), lambda r: low.contains(r["keyword"]))
        found = F.flatten(F.transform(gated, lambda r: _matches(low, r)))

        return F.array_sort(_kept(found))

    rows = rows.select(
        "_row", "n_words", base.alias("base"),
        F.when(F.col("_hit"), let(F.concat(F.lit(" "), F.col("_low"), F.lit(" ")), detected))
        .otherwise(empty).alias("detections"),
    )
    base_labels = F.array_compact(
        F.array(*[F.when(F.size(F.col("base")[label]) > 0, F.lit(label)) for _, label in BASE])
    )
    own = F.transform("detections", lambda d: d["label"])
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0)) / F.lit(100.0)
    return rows.select(
        *unpacked(kept), "n_words", "base",
        F.array_sort(base_labels).alias("base_labels"),
        "detections",
        F.array_sort(F.array_distinct(F.concat(base_labels, own))).alias("labels"),
        F.greatest(best, F.when(F.size(base_labels) > 0, 0.7).otherwise(0.0)).alias("score"),
    )
