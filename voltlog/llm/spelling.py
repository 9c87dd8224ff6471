"""Spelling variants: words at one edit's distance, found by an index of grams of variable length.

1. Words are counted in one narrow pass, in parts per task before the only large shuffle.
2. Grams of the words are counted from short to long. A gram that occurs too often is *frequent* and extended;
   the dictionary is pruned below all others. There are fewer frequent grams than ``MOST_FREQUENT`` for each length,
   whatever the number of words, so every task can have them.
3. A word is cut into grams: from each place the shortest one that is not frequent, up to the longest
   length allowed, unless it lies inside the one before. An edit can change only the grams whose window it
   touches; the most that any one edit touches is the word's affected-gram bound.
4. All but that many grams of a word are grams of each near word too, at the same place or one beside it. So if both
   give their rarest grams, one more than their bounds, the lists of at least one of these hold both words. Only
   those short lists are merged, by place and length of the words, and each pair is verified in the merge.

Words are paired by the length of the shorter one, and the longest gram is half of that at most: no edit then touches
both a word's first and its last gram, so every bound leaves a gram and no pair is lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlog.llm.common import small_batches, stored

#: Lengths of grams; the shortest word that has two whole grams of the middle length is ``LEAST_LETTERS`` long.
SHORTEST, LONGEST = 2, 6
LEAST_LETTERS = 6
#: A gram is frequent if more than one in so many occurrences of grams of its length is its own,
MOST_FREQUENT = 100_000
#: and if it occurs at least so often.
LEAST_FREQUENT = 64
#: Every so many runs of letters, one loses a letter.
MISSPELT = 199
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def runs_of(raw: bytes) -> Iterator[str]:
    """Maximal runs of letters, A-Z in lower case; one at a time, as a text may be long."""
    return (m[0] for m in _RUN.finditer(raw.lower().decode("utf-8", "replace")))


def misspelt(doc_id: str, run: str, every: int = MISSPELT) -> str:
    """The run, or the run without one of its letters, as a hash of document and run says."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % every:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def word_counts(docs: DataFrame, doc_id: str, text: str, letters: int, least: int) -> DataFrame:
    """``word``, ``n``: words of at least so many letters that occur ``least`` times in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return made

        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for run, n in Counter(runs_of(raw)).items():
                    word = misspelt(name, run)
                    if len(word) >= letters:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
        if held:
            yield out()

    source = small_batches(docs).select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")).cast("binary")
    )
    counted = source.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams that occur more often than one in ``MOST_FREQUENT`` of their length, with their number of words.

    A gram can only be frequent if the gram without its last letter is, so each length looks at few places.
    """
    frequent: dict[str, int] = {}
    for length in range(SHORTEST, LONGEST):
        known = frozenset(g for g in frequent if len(g) == length - 1)

        def cut(batches: Iterator[pa.RecordBatch], length=length, known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held: Counter[str] = Counter()
                places = 0
                for word in batch.column(0).to_pylist():
                    places += len(word) - length + 1
                    held.update(
                        word[i : i + length] for i in range(len(word) - length + 1)
                        if length == SHORTEST or word[i : i + length - 1] in known
                    )
                held[""] = places
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["gram", "n"]
                )

        counts = stored(words.select("word").mapInArrow(cut, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")))
        whole = counts.where("gram = ''").agg(F.sum("n")).first()[0] or 0
        least = max(LEAST_FREQUENT, whole // MOST_FREQUENT + 1)
        # at most whole / least of them, so fewer than MOST_FREQUENT
        rows = counts.where((F.col("gram") != "") & (F.col("n") >= least)).collect()
        frequent.update({r["gram"]: r["n"] for r in rows})
        if not rows:
            break
    return frequent


def grams_of(word: str, frequent: dict[str, int], longest: int) -> list[tuple[int, str]]:
    """(place, gram) of the word, none inside another; the shortest that is not frequent, or the longest allowed."""
    out, upto = [], 0
    for at in range(len(word) - SHORTEST + 1):
        end = at + SHORTEST
        while end < len(word) and end - at < longest and word[at:end] in frequent:
            end += 1
        if end > upto:
            out.append((at, word[at:end]))
            upto = end
    return out


def affected_bound(grams: list[tuple[int, str]], letters: int, longest: int) -> int:
    """The most grams that one edit of the word can change.

    Whether there is a gram, and how long it is, depends on the letters from where the longest gram that
    could hold it would begin to where the longest one from its place would end.
    """
    change, insert = [0] * (letters + 2), [0] * (letters + 2)
    for at, gram in grams:
        begin, end = at + len(gram) - longest, at + longest
        change[max(begin, 0)] += 1
        change[min(end, letters)] -= 1
        insert[max(begin + 1, 0)] += 1
        insert[min(end, letters + 1)] -= 1
    most = here = there = 0
    for i in range(letters + 1):
        here, there = here + change[i], there + insert[i]
        most = max(most, here, there)
    return most


def rarest(word: str, frequent: dict[str, int], longest: int) -> list[tuple[int, str]]:
    """The rarest grams of the word, one more than an edit can change."""
    grams = grams_of(word, frequent, longest)
    many = affected_bound(grams, len(word), longest) + 1
    # any order that is the same for all words will do; a hash keeps the lists of the rare ones even
    order = lambda g: (frequent.get(g[1], 0), zlib.crc32(g[1].encode()), g[1], g[0])
    return sorted(grams, key=order)[:many]


def near_pairs(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """Distinct pairs (a, b) of words, with their counts, at the distance of exactly one edit."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[str, bool, int, str, int]] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                letters = len(word)
                chosen = {q: rarest(word, frequent, q) for q in {min(LONGEST, m // 2) for m in (letters, letters - 1)}}
                # lists of words of equal length, and of words with those that have one letter more
                for at, gram in chosen[min(LONGEST, letters // 2)]:
                    rows.append((f"{letters}={at}:{gram}", False, letters, word, n))
                    rows.append((f"{letters}+{at}:{gram}", False, letters, word, n))
                    rows.append((f"{letters}+{at + 1}:{gram}", False, letters, word, n))
                for at, gram in chosen[min(LONGEST, (letters - 1) // 2)]:
                    rows.append((f"{letters - 1}+{at}:{gram}", True, letters, word, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(
                    zip(*rows) if rows else [[]] * 5,
                    (pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.int64()), strict=True,
                )],
                names=["list", "longer", "letters", "word", "n"],
            )

    lists = stored(words.select("word", "n").mapInArrow(
        entries, "list string, longer boolean, letters int, word string, n long"
    ))
    left = lists.where("not longer").select("list", "letters", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = lists.select("list", F.col("letters").alias("others"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    # of two words of equal length, each pair once; the shorter one of others is always a
    meet = (left["list"] == right["list"]) & (
        (F.col("others") > F.col("letters")) | ((F.col("others") == F.col("letters")) & (F.col("a") < F.col("b")))
    )
    return left.join(right, meet & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of every word of ``forms`` (``word``, ``form``): where its forms lead to in the end.

    Ways double from round to round; forms grow in number from step to step, so there are no circles.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        new = stored(ways.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
        ))
        ways = new.select("word", "root")
        if not new.where("_moved").limit(1).count():
            return ways


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    letters: int = LEAST_LETTERS,
    least: int = 5,
    times: int = 5,
) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    A word is a run of letters, A-Z in lower case, of which some have lost a letter (see ``misspelt``), that has
    at least ``letters`` letters (6 or more) and occurs ``least`` times in all texts. Two words are near if one letter more,
    less or other makes one of the other. ``form`` is the near word that occurs most often (of equal ones
    the first by code point), if it does so ``times`` times as often as the word; else null, as is ``form_n``.
    ``root`` is the last one on the way from word to form, or the word itself.

    Null and empty texts have no words, a null id counts as an empty one; rows with equal ids, also repeated
    rows, count each. Further columns have no effect. No rows give no rows.
    """
    if letters < LEAST_LETTERS:
        raise ValueError(f"words must have at least {LEAST_LETTERS} letters")
    words = stored(word_counts(docs, doc_id, text, letters, least))
    pairs = stored(near_pairs(words, frequent_grams(words)))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n_of")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n_of"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_of")).alias("less"), F.col("near"))).alias("top")
    )
    named = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.less") >= times * F.col("n"), F.struct(
            F.col("top.near").alias("form"), (-F.col("top.less")).alias("n")
        )).alias("form"),
    ))
    ends = roots(named.where("form is not null").select("word", F.col("form.form").alias("form")))
    return named.join(ends, "word", "left").select(
        "word", F.col("form.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.col("form.n").alias("form_n"),
    )
