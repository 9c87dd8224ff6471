"""Operators that bring rows together: shards, packing, Jaccard join, leaks, neighbours."""

import random
import sys
import time
import types
import zlib
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlog.llm import components, decontaminate, jaccard, neighbours, packing, shards
from voltlog.llm.common import stored
from voltlog.session import scratch_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
DOCS = "doc_id long, text string"


# --- shards


def sharded(rows, **options):
    return shards.shard(
        rows, weight=F.col("size"), group=F.col("text"),
        dimensions={"size": F.col("size"), "place": F.col("place")}, **options,
    )


def test_shards_have_equal_bytes_keep_groups_and_number_rows(spark):
    rng = random.Random(4)
    rows = [(i, f"t{rng.randrange(3000)}", rng.randrange(1, 2000), rng.choice([0.0, 1.0, 2.0, None]), i) for i in range(6000)]
    rows += [(9000 + i, "hot", 50, 1.0, 0) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, size long, place double, shard long")
    got = sharded(docs, shards=16).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    of_text, totals, slots = {}, [0] * 16, {}
    for r in got:
        of_text.setdefault(r.text, set()).add(r.shard)
        totals[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in of_text.values())
    assert max(totals) - min(totals) < 0.06 * sum(totals) / 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_odd_rows(spark):
    schema = "doc_id long, text string, size long, place double"
    rows = [(None, None, None, None), (1, "", 0, None), (1, "", 0, None), (2, "x", 10**12, 5.0)]
    got = sharded(spark.createDataFrame(rows, schema), shards=3).collect()
    assert len(got) == 4 and all(0 <= r.shard < 3 for r in got)
    assert sharded(spark.createDataFrame([], schema), shards=3).collect() == []
    by_bytes = sharded(spark.createDataFrame([(i, str(i), 100, 1.0 * i) for i in range(100)], schema), target_bytes=2500)
    assert {r.shard for r in by_bytes.collect()} == {0, 1, 2, 3}


# --- packing


def test_pieces_rebuild_the_token_ids(spark):
    rng = random.Random(6)
    texts = [None, "", " ", "Don't STOP, won't! é É I\u0307 ﬁ <|endoftext|> x<|ENDOFTEXT|>", "naïve... a,b.c 12,5 #!?", "word " * 9000]
    letters = "abcdeABC .,!'éÉßñİſﬁςΣΣ日本क्षдЖ\u0327\u0301\n\t12-"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(3000))) for _ in range(60)] * 2
    docs = spark.createDataFrame([(i % 100, t) for i, t in enumerate(texts)], DOCS)
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    want = sorted(
        (i % 100, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, t in enumerate(texts)
    )
    got = packing.pack(docs, path, length=512, group_tokens=20_000).collect()
    sequences, pieces = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert sum(r.length for r in got) / (512 * len(sequences)) > 0.9
    parts = {}
    for r in got:
        parts.setdefault((r.doc_id, r.start), []).append(r.ids)
    assert sum(len(v) for v in parts.values()) == len(got)
    assert sorted(b for k, v in pieces.items() for b in [x[1] for x in v]) == sorted(
        ids[4 * a : 4 * (a + 512)] for _, ids in want for a in range(0, len(ids) // 4, 512)
    )
    assert packing.pack(docs.limit(0), path).collect() == []


def test_first_fit_decreasing_against_a_plain_scan():
    rng = random.Random(1)
    for _ in range(50):
        lengths = [rng.randrange(1, 65) for _ in range(rng.randrange(1, 80))]
        room, want = [], [None] * len(lengths)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            place = next((p for p, r in enumerate(room) if r >= lengths[i]), len(room))
            if place == len(room):
                room.append(64)
            want[i] = (place, 64 - room[place])
            room[place] -= lengths[i]
        assert packing.first_fit_decreasing(lengths, 64) == want


def test_words_that_a_worker_keeps_are_bounded_in_bytes():
    rng = random.Random(9)
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    long = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(2000)).encode() for _ in range(12_000)]
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    most = 0
    for i, word in enumerate([*long, b"z" * 200_000, b"the"]):
        ids = words.of(word)
        if i % 1000 == 0 or i >= len(long):
            assert ids == np.array(plain.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            most = max(most, sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in words.items()))
    assert most <= 64_000_000 and max(map(len, words)) < 200_000


def test_a_group_leaves_a_task_in_small_batches(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "word and more words " * 400) for i in range(700)], DOCS)
    runs = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run))
    packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(packing.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 3))
    rows = pa.record_batch({"_id": pa.array(range(700)), "_text": pa.array([b"word and more words " * 400] * 700)})
    got = list(runs[0](iter([rows])))
    assert max(b.nbytes for b in got) <= 2_000_000
    whole = pa.Table.from_batches(got).to_pylist()
    assert [r["doc_id"] for r in whole] == list(range(700)) and len({r["ids"] for r in whole}) == 1
    used = {}
    for r in whole:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    per = 4096 // whole[0]["length"]
    assert len(used) == -(-700 // per) and min(used) == 3 << 40
    assert all(sorted(v) == [(i * n, n) for i, (_, n) in enumerate(v)] for v in used.values())


def test_crc_of_ids_is_that_of_little_endian_numbers(spark):
    docs = spark.createDataFrame([(1, "hello there")], DOCS)
    row = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).select("*", F.crc32("ids").alias("crc")).first()
    assert row.crc == zlib.crc32(row.ids)


# --- Jaccard join


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 8, 12, 20, 40, 120, 300]))] for _ in range(60)]
    passage = [rng.choice(words) for _ in range(30)]
    texts = {}
    for i in range(900):
        w = list(rng.choice(base[:20] if i % 2 else base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = rng.choice(words)
        if i % 7 == 0:
            w = w[:40] + passage
        if i % 11 == 0:
            w += [rng.choice(words) for _ in range(3)]
        texts[i] = " ".join(w)
    return texts | {2000: "", 2001: " \t", 2002: "a b", 2003: "A  B", 2004: "a b c", 2005: None, 2006: "é " * 9, 2007: "É " * 9}


@pytest.mark.parametrize("k, percent, classes, shingles", [(4, 85, 1024, 1 << 18), (5, 80, 7, 1_000)])
def test_components_against_all_pairs(spark, monkeypatch, k, percent, classes, shingles):
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", classes)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", shingles)
    texts = near_copies(k)
    rows = [(i, t, "x") for i, t in texts.items()]
    docs = spark.createDataFrame([*rows, *rows[:5], (None, "w1 w2", "x")], f"{DOCS}, n string")
    got = jaccard.join(docs, k, percent).collect()
    want, links = brute.components(texts, k, percent), brute.class_links(texts, k, percent)
    assert len(got) == len(texts) + 6
    for r in got:
        if r.id is None:
            assert r.component_id is None
        else:
            assert (r.component_id, r.n_shingles) == (want[r.id], len(brute.shingles(texts[r.id], k)))
            assert r.n_links == links[r.id]
    kept = jaccard.without_near_copies(docs, k, percent).collect()
    assert {r.doc_id for r in kept} == set(want.values()) | {None}


def test_overlaps_by_products_are_those_of_sets(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 50)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 900, rng.integers(1, 200), dtype=np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets[25:]] for a in sets[:25]]
    assert jaccard.overlaps(sets[:25], sets[25:]).tolist() == want


def test_few_candidates_for_many_classes_of_large_nodes(spark):
    """A group of near copies gives about as many candidates as classes, not as many as nodes of classes."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    many = {}
    for size in (300, 1200):
        texts = []
        for i in range(size):
            w = list(base)
            for _ in range(1 + i % 6):
                w[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
            texts.append((i, " ".join(w)))
        source = spark.createDataFrame(texts, "_id long, _text string").repartition(8)
        signed = jaccard.stored(jaccard._signatures(source, 4, 85, np.zeros(0, dtype=np.uint64), "bigint"))
        classes = signed.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.max("n").alias("n"))
        many[size] = jaccard._candidates(signed, classes, 85).count()
    assert many[300] < 8 * 300 and many[1200] < 5 * many[300]


def test_rounds_of_nodes_meet_like_all_nodes_at_once(spark, monkeypatch):
    texts = near_copies(3)
    docs = spark.createDataFrame(list(texts.items()), DOCS).repartition(3)
    whole = sorted(jaccard.join(docs, 5, 80).collect(), key=lambda r: r.id)
    written, shuffled = [], []
    scratch = Path(scratch_folder(spark).removeprefix("file:")).parent
    before = {f.name for f in scratch.iterdir()}

    def one_round(signed, turns, meetings=jaccard._meetings):
        shuffled.append(turns)
        written.append(any("keys_" in c for f in scratch.iterdir() if f.name not in before for c in columns(f)))
        return meetings(signed, turns)

    def columns(folder):
        return [c for f in sorted(folder.glob("*.parquet"))[:1] for c in pq.read_schema(f).names]

    monkeypatch.setattr(jaccard, "ROUND_SHINGLES", 1)
    monkeypatch.setattr(jaccard, "_meetings", one_round)
    assert sorted(jaccard.join(docs, 5, 80).collect(), key=lambda r: r.id) == whole
    assert sorted(shuffled) == [[t] for t in range(8)] and all(written)
    assert not any("keys_" in c for f in scratch.iterdir() if f.name not in before for c in columns(f))


def test_what_is_stored_leaves_no_shuffle_files(spark):
    folders = Path(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()[0])
    shuffles = lambda: {f.name for f in folders.rglob("shuffle_*.data")}
    before = shuffles()
    out = stored(spark.range(10_000).groupBy((F.col("id") % 99).alias("k")).count())
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert out.count() == 99
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_components_of_no_rows(spark):
    assert jaccard.join(spark.createDataFrame([], DOCS)).collect() == []


def test_linked_sets_share_enough_nodes(spark):
    """The pigeonhole bound: sets at the limit meet as often as required, whatever counts as frequent."""
    rng = np.random.default_rng(2)
    rows = []
    for percent in (80, 85):
        for _ in range(300):
            n = int(rng.integers(5, 400))
            union = np.unique(rng.integers(0, 2**64, 2 * n, dtype=np.uint64))[rng.permutation(2 * n)[:n]]
            apart = n - -(-percent * n // 100)
            split = int(rng.integers(0, apart + 1))
            a, b = np.sort(union[split:]), np.sort(np.concatenate([union[:split], union[apart:]]))
            frequent = np.sort(rng.choice(union, int(rng.integers(0, n)), replace=False))
            keys, owner = jaccard.node_keys(np.concatenate([a, b]), np.cumsum([len(a), len(b)]), percent, frequent)
            if len(np.union1d(a, b)) * percent <= 100 * len(np.intersect1d(a, b)) and apart:
                shared = np.array(sorted(set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())), dtype=np.uint64)
                parts = np.unique(shared & np.uint64(63), return_counts=True)
                assert len(shared)
                rows.append((percent, len(a) + len(b), [(int(p), int(c)) for p, c in zip(*parts, strict=True)]))
    assert len(rows) > 400
    df = spark.createDataFrame(rows, "percent int, n long, parts array<struct<part:int,shared:int>>")
    for percent in (80, 85):
        enough = df.where(f"percent = {percent}").select("n", F.explode("parts").alias("p")).where(
            F.col("p.shared") < jaccard.least_shared(percent, F.col("p.part"), F.col("n"))
        )
        assert enough.count() == 0


def test_components_of_links(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(components.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- leaks


def plain_leaks(docs, items, least=8):
    out, known = set(), {}
    for i, t in sorted(items, key=lambda x: (x[0] is None, x[0])):
        known.setdefault(tuple(words_of(t)), i)
    spans = [[j for j, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    size = max(map(len, decontaminate.MASKS))
    for d, text in docs:
        w = words_of(text)
        for item, i in known.items():
            best = (0, 0, 0)
            for p in range(len(w) - size + 1):
                for q in range(len(item) - size + 1):
                    if any(all(w[p + o] == item[q + o] for o in m) for m in spans):
                        run = top = equal = 0
                        for j in range(len(item)):
                            same = 0 <= p - q + j < len(w) and w[p - q + j] == item[j]
                            run, equal = max(0, run + (1 if same else -1)), equal + same
                            top = max(top, run)
                        best = max(best, (top, equal, q - p))
            if best[0] >= least:
                out.add((d, i, *best))
    return out


def words_of(text):
    import re

    return [w for w in re.split(decontaminate.BREAKS, (text or "").lower()) if w]


def test_leaks_against_all_alignments(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(5, 40)))) for i in range(25)]
    items += [(90, items[3][1]), (91, None), (92, ""), (93, "too short")]
    docs = [(500, None), (501, ""), (502, "!?")]
    for i in range(150):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            passage = words_of(rng.choice(items[:25])[1])
            passage = [rng.choice(words) if rng.random() < 0.12 else x for x in passage]
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(4):]
        docs.append((i, rng.choice(["", '"', "(", "- ", "\n\u2014 "]) + rng.choice([" ", ", ", "\n"]).join(w).title() + rng.choice(["", '."'])))
    docs.append(docs[-1])
    monkeypatch.setattr(decontaminate, "MOST_SEEDS", 400)
    d = spark.createDataFrame([(*r, 1) for r in docs], f"{DOCS}, score int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.score, r.matched, -r.start) for r in decontaminate.find(d, b).collect()}
    want = plain_leaks(docs, items)
    assert got == want and len(want) > 20
    leaky = {x[0] for x in want}
    kept = decontaminate.without_leaks(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in leaky)
    assert decontaminate.find(d.limit(0), b).collect() == [] == decontaminate.find(d, b.limit(0)).collect()


def test_leaks_in_pieces_of_documents_against_all_alignments(spark, monkeypatch):
    """Pieces shorter than most documents; items reach over the ends of pieces and of documents."""
    monkeypatch.setattr(decontaminate, "PIECE", 8)
    rng = random.Random(31)
    words = [f"v{i}" for i in range(50)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(8, 14)))) for i in range(12)]
    docs = []
    for i in range(60):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 120))]
        for _ in range(3):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(items)[1].split()
        docs.append((i, " ".join(w[rng.randrange(4) : len(w) - rng.randrange(4)])))
    found = decontaminate.find(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"))
    want = plain_leaks(docs, items)
    assert {(r.doc_id, r.item_id, r.score, r.matched, -r.start) for r in found.collect()} == want and len(want) > 100


def test_hits_of_a_long_document_hold_few_words(spark):
    """50,000 hits in a document of 12,000 words; with the document's words in each it would take gigabytes."""
    rng = random.Random(41)
    item = [f"p{rng.randrange(10**6)}" for _ in range(100)]
    text = " ".join(" ".join([*item, *[f"r{rng.randrange(10**6)}" for _ in range(20)]]) for _ in range(100))
    docs = spark.createDataFrame([(i, text) for i in range(4)], DOCS)
    found = decontaminate.find(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.matched, r.score) for r in found) == [(i, 7, 0, 100, 100) for i in range(4)]


def test_masks_meet_every_stretch_that_scores_eight():
    """All stretches whose sums stay over zero until they reach 8, as states of a walk: last words, sum."""
    span = max(map(len, decontaminate.MASKS))
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    todo, known = [((1,), 1)], set()
    while todo:
        last, total = todo.pop()
        for same in (1, 0):
            words, score = (*last, same)[-span:], total + (1 if same else -1)
            if score <= 0 or (len(words) == span and any(all(words[i] for i in m) for m in masks)):
                continue
            assert score < 8, "a stretch without a hit"
            if (words, score) not in known:
                known.add((words, score))
                todo.append((words, score))


def test_leaks_against_all_alignments_without_seeds(spark):
    rng = random.Random(21)
    items = {i: [f"q{i}x{j}" for j in range(rng.randrange(15, 21))] for i in range(40)}
    docs = {}
    for d in range(400):
        item = items[d % 40]
        if d < 40:  # eight words in a row and no more
            at = rng.randrange(len(item) - 7)
            part = item[at : at + 8]
        else:
            part = [f"z{d}x{j}" if rng.random() < 0.25 else w for j, w in enumerate(item)]
        docs[d] = [f"n{rng.randrange(10**6)}" for _ in range(5)] + part + [f"n{rng.randrange(10**6)}" for _ in range(5)]
    want = set()
    for d, w in docs.items():
        for i, item in items.items():
            best = 0
            for shift in range(-len(item) + 1, len(w)):
                run = 0
                for j, word in enumerate(item):
                    run = max(0, run + (1 if 0 <= shift + j < len(w) and w[shift + j] == word else -1))
                    best = max(best, run)
            if best >= 8:
                want.add((d, i, best))
    found = decontaminate.find(
        spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], DOCS),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"),
    )
    assert {(r.doc_id, r.item_id, r.score) for r in found.collect()} == want and len(want) > 150


# --- neighbours


def test_neighbours_against_all_products(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, size=(1500, 1))
    x[200:500] = x[200]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [None] * 16), (5004, [float("nan")] * 16),
           (5005, [float("inf")] * 16), (None, x[0].tolist()), (5006, [1.0, 2.0])]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    vectors = spark.createDataFrame([*rows, *odd, rows[7]], schema)
    got = neighbours.search(vectors, vectors.where("vec_id % 20 = 0"), k=20, shard_size=200, query_block=16).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by_query) == set(range(0, 1500, 20))
    hits = 0
    for q, found in by_query.items():
        scores = x @ x[q]
        best = [i for i in np.lexsort((np.arange(1500), -np.round(scores, 9))) if i != q][:20]
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in found) and q not in [v for _, v, _ in found]
        hits += len({v for _, v, _ in found} & set(best))
    assert hits / (20 * len(by_query)) >= 0.95
    assert neighbours.search(vectors.limit(0), vectors, k=3).collect() == []
    few = vectors.where("vec_id < 3")
    assert len(neighbours.search(few, few, k=20).collect()) == 6


@pytest.mark.parametrize("clustered", [False, True])
def test_neighbours_at_the_production_shard_size(spark, clustered):
    """One whole shard of the production size, of vectors without any structure, or of a few tight clusters."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(4000, 64))
    if clustered:
        x = rng.normal(size=(20, 64))[rng.integers(0, 20, 4000)] + 0.2 * x
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.search(vectors, vectors.where("vec_id % 20 = 0"), k=20, least_shards=1).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 4000, 20):
        best = [i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20]
        hits += len(by_query[q] & set(best))
    assert hits / (20 * 200) >= 0.95


def test_neighbours_in_many_shards_with_unequal_norms(spark):
    """Far more shards than a dozen: the best vectors of a query may lie in any of them."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 16)) * rng.lognormal(sigma=0.8, size=(1500, 1))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.search(vectors, vectors.where("vec_id % 20 = 0"), k=20, shard_size=30, query_block=16).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 1500, 20):
        best = [i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:20]
        hits += len(by_query[q] & set(best))
    assert hits / (20 * 75) >= 0.99
