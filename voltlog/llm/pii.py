"""Personal data: strict formats, and candidates that boosted trees judge by format and context.

A row is handled by itself, with column expressions alone: texts without digits or at signs are done at
once, the others are cut into matches of a few patterns. Generators propose spans generously;
trees fitted on one half of all texts score them inside the row, and a limit calibrated on the other
half decides. Strict matches are always kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlog.llm import trees
from voltlog.llm.common import let, named, others, packed, stored, unpacked

# Kinds in their order, strict patterns, generous patterns. Quantifiers are possessive
# and begin where a run begins, so no pattern goes back over a long run; what they match is the same.
KINDS = ("email", "ip", "card", "phone", "secret")
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENEROUS = {
    "email": r"(?<![^\s@])[^\s@]++@[^\s@]++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?: ?\[?\.\]? ?[0-9]{1,3}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,}+",
    "phone": r"(?<![0-9])[(+]?[0-9](?:[ ().-]{0,2}+[0-9]){6,}+",
    "secret": r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{16,}+",
}
CONTEXT = r"(?i)token|key|secret|passw|mail|tel|phone|call|mobile|card|account|addr|ip\b|host|login"
#: Names of a kind before a span, and shapes of spans, that are evidence without a strict format.
NAMED = {
    "email": r"(?i)mail|contact", "ip": r"(?i)\bip\b|host|server|\baddr",
    "phone": r"(?i)\btel\b|telef|phone|\bcall|mobile|\bfax",
}
NATIONAL = r"^(?:00[1-9]|\([0-9]{2,5}\) ?[0-9]|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$)"
DATE = r"^(?:19|20)[0-9]{2}[ .-][0-9]{2}[ .-][0-9]{2}"

FEATURES = (
    "kind", "length", "digits", "letters", "distinct", "separators", "dots", "at_sign", "plus",
    "hexadecimal", "both", "named", "quoted_before", "quoted_after", "luhn", "upper", "evident",
)
SPAN = "array<struct<start:int,kind:int,end:int>>"
BLOCK = 256


def running(lengths: Column) -> Column:
    """Sums of all earlier elements; sums of blocks keep the work far below the square of the size."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def sums(values: Column) -> Column:
        many = F.ceil(F.size(values) / BLOCK).cast("int")
        blocks = F.when(
            many > 0,
            F.transform(
                F.sequence(F.lit(0), many - 1),
                lambda b: total(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))),
            ),
        ).otherwise(F.expr("cast(array() as array<int>)"))
        begins = let(blocks, lambda s: F.transform(s, lambda _, i: total(F.slice(s, F.lit(1), i))))
        return let(
            begins,
            lambda b: F.transform(
                values,
                lambda _, i: F.get(b, F.floor(i / BLOCK).cast("int"))
                + total(F.slice(values, (i - i % BLOCK) + 1, i % BLOCK)),
            ),
        )

    return let(lengths, sums)


def matches(text: Column, pattern: str) -> Column:
    """All matches from left to right as (start, end, found), in characters."""
    both = F.struct(
        F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
    )

    def placed(v: Column) -> Column:
        steps = F.transform(v["found"], lambda m, i: F.length(m) + F.length(F.get(v["between"], i)))
        return let(
            running(steps),
            lambda before: F.transform(
                v["found"],
                lambda m, i: let(
                    F.get(before, i) + F.length(F.get(v["between"], i)),
                    lambda start: F.struct(
                        start.alias("start"), (start + F.length(m)).alias("end"), m.alias("found")
                    ),
                ),
            ),
        )

    return let(both, placed)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """True if the check digit of a string of digits is right."""
    size = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, size - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), lambda a, i: a + worth(i))
    return F.when(size > 0, total % 10 == 0).otherwise(False)


def _part_fits(part: Column) -> Column:
    number = F.regexp_replace(part, "^0+", "")
    return F.when(
        F.length(number) <= 3, F.concat(F.lit("0"), F.substring(number, 1, 3)).cast("int") <= 255
    ).otherwise(False)


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(found, r"\."), _part_fits)
    if kind == "card":
        return let(_digits(found), lambda d: F.length(d).between(14, 19) & luhn(d))
    if kind == "phone":
        return F.length(_digits(found)).between(10, 15)
    return F.lit(True)


def _may_hold(text: Column) -> Column:
    return text.rlike("[0-9@]")


def _strict(text: Column) -> Column:
    """Valid strict matches of all kinds, sorted by start, then kind."""
    gates = {"email": text.contains("@"), "ip": text.contains("."), "phone": text.contains("+")}

    def of(i: int, kind: str) -> Column:
        found = F.filter(matches(text, STRICT[kind]), lambda m: _valid(kind, m["found"]))
        spans = F.transform(
            found, lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end"))
        )
        return F.when(gates.get(kind, F.lit(True)), spans).otherwise(F.expr(f"cast(array() as {SPAN})"))

    return F.array_sort(F.concat(*[of(i, kind) for i, kind in enumerate(STRICT)]))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _evident(kind: str, found: Column, digits: Column, before: Column, after: Column) -> Column:
    """True for a span that is personal data by its name or its normalised form, whatever its format."""
    if kind == "email":
        plain = F.regexp_replace(found, r"(?i)[\[({]\s?(?:\.|dot)\s?[\])}]", ".")
        plain = F.regexp_replace(F.regexp_replace(plain, r"[\[({]@[\])}]", "@"), r"[^\x00-\x7F]", "x")
        named = before.rlike(NAMED[kind]) & found.rlike(r"[A-Za-z0-9]@[A-Za-z0-9]")
        return plain.rlike(STRICT[kind]) | named
    if kind == "ip":
        parts = F.filter(F.split(found, "[^0-9]+"), lambda p: p != "")
        told = found.rlike(r"\[\.|\.\]| \. ") | before.rlike(NAMED[kind])
        return told & (F.size(parts) == 4) & F.forall(parts, _part_fits) & ~after.rlike(r"^\.?[0-9]")
    if kind == "card":
        return F.length(digits).between(12, 19) & digits.rlike("[1-9]") & luhn(F.left(digits, F.lit(19)))
    if kind == "phone":
        size = F.length(digits)
        named = before.rlike(NAMED[kind]) & size.between(7, 15)
        return (named | (found.rlike(NATIONAL) & size.between(10, 15))) & ~found.rlike(DATE)
    return F.lit(False)


def _candidates(text: Column) -> Column:
    """Proposed spans with the features the trees look at."""
    gates = {"email": text.contains("@"), "ip": text.contains(".")}
    size = F.length(text)

    def of(i: int, kind: str) -> Column:
        def looked_at(m: Column) -> Column:
            before = F.substring(text, F.greatest(m["start"] - 23, F.lit(1)), F.least(m["start"], F.lit(24)))
            after = F.when(m["end"] < size, F.substring(text, m["end"] + 1, F.lit(2))).otherwise("")
            around = F.struct(_digits(m["found"]).alias("digits"), before.alias("before"), after.alias("after"))
            return let(around, lambda a: described(m, a["digits"], a["before"], a["after"]))

        def described(m: Column, digits: Column, before: Column, after: Column) -> Column:
            found = m["found"]
            letters = F.regexp_replace(found, "[^A-Za-z]+", "")
            yes = lambda c: F.when(c, 1.0).otherwise(0.0)
            return F.struct(
                m["start"].alias("start"), m["end"].alias("end"),
                F.lit(float(i)).alias("kind"),
                F.length(found).cast("double").alias("length"),
                F.length(digits).cast("double").alias("digits"),
                F.length(letters).cast("double").alias("letters"),
                F.size(F.array_distinct(F.split(found, ""))).cast("double").alias("distinct"),
                F.length(F.regexp_replace(found, "[^ ()_/+=-]+", "")).cast("double").alias("separators"),
                F.length(F.regexp_replace(found, r"[^.]+", "")).cast("double").alias("dots"),
                yes(found.contains("@")).alias("at_sign"),
                yes(found.startswith("+")).alias("plus"),
                yes(found.rlike("^[0-9a-fA-F]+$")).alias("hexadecimal"),
                yes((F.length(digits) > 0) & (F.length(letters) > 0)).alias("both"),
                yes(before.rlike(CONTEXT)).alias("named"),
                yes(before.rlike("[\"'=:]\\s?$")).alias("quoted_before"),
                yes(after.rlike("^[\"']")).alias("quoted_after"),
                yes(F.length(digits).between(12, 19) & luhn(F.left(digits, F.lit(19)))).alias("luhn"),
                F.length(F.regexp_replace(found, "[^A-Z]+", "")).cast("double").alias("upper"),
                yes(_evident(kind, found, digits, before, after)).alias("evident"),
            )

        found = F.transform(matches(text, GENEROUS[kind]), looked_at)
        return F.when(gates.get(kind, F.lit(True)), found).otherwise(F.filter(found, lambda _: F.lit(False)))

    return F.concat(*[of(i, kind) for i, kind in enumerate(KINDS)])


def _looks_secret(c: Column) -> Column:
    """A label for training: a long string of many different letters and digits, or one that is named."""
    mixed = (c["both"] == 1) & (c["distinct"] >= 8) & (c["digits"] >= 4)
    return (c["kind"] == KINDS.index("secret")) & mixed & ((c["length"] >= 32) | (c["named"] == 1))


@dataclass
class Model:
    score: trees.Score
    limit: float

    def of(self, candidate: Column) -> Column:
        return self.score([candidate[f] for f in FEATURES])


def fit(docs: DataFrame, text: str = "text", precision: float = 0.95) -> Model:
    """The model, from the candidates of all documents with digits or at signs.

    Candidates that share characters with a strict match are never selected, so they take no part.
    Labels of the others come from the texts themselves: 1 for candidates that are evident by name or
    normalised form, or look like a secret. One half of the texts, by hash, trains the trees; the other gives the
    lowest limit, in hundredths, from which on ``precision`` of the candidates have label 1.
    The limit is one half at least. Without any candidates nothing but strict matches is selected.
    Candidates with the same features and label are one row with their number as weight, in a fixed order within its part.
    """
    rows = docs.where(_may_hold(F.col(text))).select(F.col(text).alias("_text"))
    # written, or the optimizer would work out the candidates once more to pass over texts without any
    parts = stored(rows.select(
        _strict(F.col("_text")).alias("strict"), _candidates(F.col("_text")).alias("c"),
        F.pmod(F.xxhash64("_text", F.lit(3)), F.lit(2)).alias("half"),
    ))
    each = parts.select("half", "strict", F.explode("c").alias("c"))
    each = each.where(~F.exists("strict", lambda s: _overlaps(s, F.col("c"))))
    hit = (F.col("c.evident") == 1) | _looks_secret(F.col("c"))
    each = each.select("half", hit.cast("int").alias("label"), *[F.col("c")[f].alias(f) for f in FEATURES])
    kinds = stored(
        each.groupBy("half", "label", *FEATURES).agg(F.count(F.lit(1)).alias("many"))
        .sortWithinPartitions("half", "label", *FEATURES)
    )
    score = trees.fit(kinds.where("half = 0"), FEATURES, "label", weight="many")
    steps = (
        kinds.where("half = 1").select("label", "many", F.floor(score([F.col(f) for f in FEATURES]) * 100).alias("step"))
        .groupBy("step").agg(F.sum(F.col("label") * F.col("many")).alias("ones"), F.sum("many").alias("all")).collect()
    )
    limit, ones, every = 1.01, 0, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        ones, every = ones + r["ones"], every + r["all"]
        if ones / every < precision:
            break
        limit = r["step"] / 100.0
    return Model(score, max(limit, 0.5))


def _selected(text: Column, strict: Column, model: Model) -> Column:
    """Candidates over the limit that touch no strict match and no better candidate that is selected.

    The best is selected first, what touches it falls, and so on; a candidate that touches only fallen ones
    stays. Better is a higher probability, then the longer, the earlier, the kind that comes first. One sweep by
    place cuts the spans into chains that touch each other, and each chain is decided by itself.
    """

    def ranked(found: Column, p: Callable[[Column], Column]) -> Column:
        return F.transform(found, lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["kind"].cast("int").alias("kind"), p(x).alias("p")))

    over = lambda c: F.filter(ranked(c, model.of), lambda x: x["p"] >= model.limit)
    # strict matches are better than any candidate
    spans = F.array_sort(F.concat(ranked(strict, lambda _: F.lit(2.0)), over(_candidates(text))))

    def decided(chain: Column) -> Column:
        by_rank = F.array_sort(F.transform(chain, lambda x: F.struct(
            (-x["p"]).alias("less"), (x["start"] - x["end"]).alias("shorter"), x["start"].alias("start"),
            x["kind"].alias("kind"), x["end"].alias("end"))))
        step = lambda kept, x: F.when(F.exists(kept, lambda k: _overlaps(k, x)), kept).otherwise(F.array_append(kept, x))
        kept = F.aggregate(by_rank, F.filter(by_rank, lambda x: F.lit(False)), step)
        return F.transform(
            F.filter(kept, lambda x: x["less"] > -2.0),
            lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")),
        )

    def sweep(state: Column, x: Column) -> Column:
        return F.when(x["start"] < state["upto"], F.struct(
            F.array_append(state["chain"], x).alias("chain"), F.greatest(state["upto"], x["end"]).alias("upto"),
            state["out"].alias("out"),
        )).otherwise(F.struct(
            F.array(x).alias("chain"), x["end"].alias("upto"), F.concat(state["out"], decided(state["chain"])).alias("out"),
        ))

    def swept(s: Column) -> Column:
        begin = F.struct(
            F.filter(s, lambda x: F.lit(False)).alias("chain"), F.lit(0).alias("upto"),
            F.expr(f"cast(array() as {SPAN})").alias("out"),
        )
        return F.aggregate(s, begin, sweep, lambda state: F.concat(state["out"], decided(state["chain"])))

    return let(spans, swept)


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind, end), sorted by start, then kind.

    ``kind`` numbers ``KINDS``; places are characters, the end exclusive. ``base`` has the strict
    matches, ``spans`` these and the selected candidates (see ``_selected`` for ties). Null and empty
    texts have none. Repeated rows are judged alike; no rows give no rows. Columns ``base`` and ``spans`` are replaced.
    """
    kept = others(docs, ("base", "spans"))
    body = F.coalesce(named(text), F.lit(""))
    none = F.expr(f"cast(array() as {SPAN})")
    rows = docs.select(packed(kept), F.when(_may_hold(body), body).alias("_body"))
    held = F.col("_body").isNotNull()
    rows = rows.select("_row", "_body", F.when(held, _strict(F.col("_body"))).otherwise(none).alias("_base"))
    more = F.when(held, _selected(F.col("_body"), F.col("_base"), model)).otherwise(none)
    return rows.select(
        *unpacked(kept), F.col("_base").alias("base"), F.array_sort(F.concat("_base", more)).alias("spans")
    )


def written(spans: Column, kinds: Sequence[str] = KINDS) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in capitals and brackets, such as ``[EMAIL]``.

    Overlapping spans become one, named after the first. Texts without spans, null ones included, and
    all other columns stay as they are.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def cut(body: Column, spans: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            fresh = s["start"] >= state["at"]
            return F.struct(
                F.when(
                    fresh,
                    F.array_append(
                        F.array_append(
                            state["parts"], F.substring(body, state["at"] + 1, s["start"] - state["at"])
                        ),
                        F.get(names, s["kind"]),
                    ),
                ).otherwise(state["parts"]).alias("parts"),
                F.greatest(state["at"], s["end"]).alias("at"),
            )

        begin = F.struct(F.expr("cast(array() as array<string>)").alias("parts"), F.lit(0).alias("at"))
        return F.aggregate(
            spans, begin, step,
            lambda state: F.concat(
                F.array_join(state["parts"], ""), F.substring(body, state["at"] + 1, F.length(body))
            ),
        )

    judged = scan(docs.select(packed(docs.columns), named(text).alias("_text")), model, "_text")
    new = F.when(F.size("spans") > 0, cut(F.col("_text"), F.col("spans"))).otherwise(F.col("_text"))
    same = dict(zip(docs.columns, unpacked(docs.columns), strict=True))
    return judged.select(*[new.alias(c) if c == text else same[c] for c in docs.columns])
