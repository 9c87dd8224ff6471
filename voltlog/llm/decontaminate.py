"""Benchmark passages in documents, found by spaced seeds and verified word by word.

A seed mask names the positions of a window that count; words at the other positions may differ. The
benchmark's window hashes are broadcast (in parts, if there are very many) and met by those of the
documents in one pass without a shuffle; each hit is verified in the same stage by aligning the whole
item with the words of the document that it lies over. Documents are looked at in pieces, as Spark holds all hits of
a row at a time. Only verified findings are shuffled, to name each once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlog.llm.common import let, stored

#: Four of eight words count. Every stretch that scores 8, however long and wherever words are substituted,
#: holds eight neighbouring words that meet in one of the masks (a test goes through all such stretches).
MASKS = ("10110001", "10011100", "01011100", "00101101")
#: Seeds broadcast at a time: two long numbers and an int each, so below 100 MB.
MOST_SEEDS = 1_000_000
#: Windows of a piece of a document, or more if items are longer.
PIECE = 1024
#: Everything in ASCII that is no letter or digit, one by one (a set of single characters is fast).
BREAKS = "[" + "".join(f"\\x{c:02x}" for c in range(128) if not chr(c).isalnum()) + "]+"


def words_of(text: Column) -> Column:
    """The lower-cased words between ASCII punctuation and white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAKS), lambda w: w != "")


def _words_fast(text: Column) -> Column:
    """As ``words_of``, without a pass over the words; only the last one may be empty."""
    words = F.split(F.trim(F.lower(F.coalesce(text, F.lit("")))), BREAKS)
    return let(words, lambda w: F.when(F.get(w, F.lit(0)) == "", F.slice(w, 2, F.size(w))).otherwise(w))


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def _windows(rows: DataFrame, words: str, masks: tuple[str, ...], at: str, first: Column, many: Column) -> DataFrame:
    """A row for each mask and each of ``many`` windows from ``first`` on: its place and the hash of the words that count."""
    span = max(map(len, masks))
    kept = rows.columns
    shifted = rows.where(many > 0).select(
        *kept, *[F.slice(words, first + (k + 1), many).alias(f"_w{k}") for k in range(span)]
    )
    zipped = F.arrays_zip(*[f"_w{k}" for k in range(span)])
    each = shifted.select(*kept, F.posexplode(zipped).alias("_pos", "_z")).withColumn(at, first + F.col("_pos"))
    hashes = F.array(
        *[F.xxhash64(*[F.col("_z")[f"_w{k}"] for k in _offsets(m)], F.lit(i)) for i, m in enumerate(masks)]
    )
    return each.select(*kept, at, F.explode(hashes).alias("_seed"))


def _pieces(words: Column, span: int, longest: int) -> Column:
    """The words in pieces, with ``longest`` words to either side of a piece's own windows.

    ``begin`` is the place of a piece's first word, ``first`` that of its first own window within it, ``many`` their number.
    """
    step = max(PIECE, 2 * longest)

    def piece(w: Column, at: Column) -> Column:
        begin = F.greatest(at - longest, F.lit(0))
        return F.struct(
            F.slice(w, begin + 1, at - begin + step + span + longest).alias("words"), begin.alias("begin"),
            (at - begin).alias("first"), F.least(F.lit(step), F.size(w) - (span - 1) - at).alias("many"),
        )

    none = F.expr("cast(array() as array<int>)")
    return let(words, lambda w: F.transform(
        F.when(F.size(w) >= span, F.sequence(F.lit(0), F.size(w) - span, F.lit(step))).otherwise(none),
        lambda at: piece(w, at),
    ))


def _best_overlap(doc: Column, item: Column, shift: Column) -> Column:
    """(matched, score) of the best stretch of the item laid over the document.

    Equal words count 1, different ones -1; ``matched`` is the number of equal words in all.
    """

    def step(state: Column, j: Column) -> Column:
        same = F.coalesce(F.get(doc, shift + j) == F.get(item, j), F.lit(False))
        run = F.greatest(F.lit(0), state["run"] + F.when(same, 1).otherwise(-1))
        return let(
            run,
            lambda r: F.struct(
                r.alias("run"),
                F.greatest(state["score"], r).alias("score"),
                (state["matched"] + F.when(same, 1).otherwise(0)).alias("matched"),
            ),
        )

    begin = F.struct(F.lit(0).alias("run"), F.lit(0).alias("score"), F.lit(0).alias("matched"))
    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), begin, step)


def find(
    docs: DataFrame,
    items: DataFrame,
    least_score: int = 8,
    masks: tuple[str, ...] = MASKS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item found in it: ids, ``text_hash``, ``start``, ``matched``, ``score``.

    An item is found where, laid over the document, its best stretch scores ``least_score``: so many
    words in a row, or more with some substituted in between. ``start`` is the document's word
    number at which the item's first word would stand, at its best place: the one with the highest score, of equal
    ones that with more equal words, then the first. Equal items count as the
    one with the smallest id. Equal rows (same id and text) give one finding; ``text_hash`` tells
    documents with the same id apart. ``MASKS`` lose no finding at a ``least_score`` of 8 or more. Null and
    empty texts, and items with fewer words than a mask is long, find nothing; no rows on either side
    give no rows.
    """
    span = max(map(len, masks))
    bench = items.select(F.col(item_id).alias("item_id"), words_of(F.col(item_text)).alias("item"))
    bench = bench.groupBy("item").agg(F.min("item_id").alias("item_id"))
    bench = stored(bench.withColumn("item_no", F.monotonically_increasing_id()).withColumn("n", F.size("item")))
    windows = _windows(bench, "item", masks, "item_at", F.lit(0), F.col("n") - (span - 1))
    seeds = stored(windows.select("_seed", "item_no", "item_at", "n").distinct())
    parts = max(1, -(-seeds.count() // MOST_SEEDS))
    longest = bench.agg(F.max("n")).first()[0] or 0
    source = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.explode(_pieces(_words_fast(F.col(text)), span, longest)).alias("_piece"),
    ).select("doc_id", "text_hash", "_piece.*")
    windows = _windows(source, "words", masks, "_at", F.col("first"), F.col("many"))
    # of a hit only the words that the item lies over go on, and where its first word stands among these
    local = F.col("_at") - F.col("item_at")
    over = F.slice("words", F.greatest(local, F.lit(0)) + 1, F.col("n") + F.least(local, F.lit(0)))
    found = []
    for part in range(parts):
        of_part = [t if parts == 1 else t.where(F.pmod(F.xxhash64("item_no"), F.lit(parts)) == part) for t in (seeds, bench)]
        hits = windows.join(F.broadcast(of_part[0]), "_seed").select(
            "doc_id", "text_hash", "item_no", (F.col("begin") + local).alias("start"), over.alias("_over"),
            F.least(local, F.lit(0)).alias("_shift"),
        ).join(F.broadcast(of_part[1].drop("n")), "item_no")
        best = _best_overlap(F.col("_over"), F.col("item"), F.col("_shift"))
        found.append(
            hits.select("doc_id", "text_hash", "item_id", "start", best.alias("_best"))
            .where(F.col("_best.score") >= least_score)
        )
    every = reduce(DataFrame.unionByName, found)
    top = F.max(F.struct("_best.score", "_best.matched", (-F.col("start")).alias("before")))
    return every.groupBy("doc_id", "text_hash", "item_id").agg(top.alias("_top")).select(
        "doc_id", "text_hash", "item_id", (-F.col("_top.before")).alias("start"),
        F.col("_top.matched").alias("matched"), F.col("_top.score").alias("score"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark item is found, with their columns."""
    leaks = stored(find(docs, items, **options).select("doc_id", "text_hash").distinct())
    same = docs["doc_id"].eqNullSafe(leaks["doc_id"]) & (F.xxhash64(docs["text"]) == leaks["text_hash"])
    return docs.join(leaks, same, "left_anti")
