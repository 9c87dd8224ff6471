"""Operators that work on whole tables: Merkle manifest, mixing, spelling variants."""

import hashlib
import itertools
import os
import random
import zlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from voltlog.llm import merkle, mixing, queries, ranks, spelling

SF_DIR = os.environ.get("VOLTLOG_TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- places in groups


def test_places_have_no_gaps_in_groups_of_any_size(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), rng.randrange(50)) for _ in range(3000)]
    rows += [("same", 1)] * 500
    df = spark.createDataFrame(rows, "g string, v long").repartition(7)
    got = ranks.numbered(df, "g", ["v"]).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append(r)
    assert Counter(r.g for r in got) == Counter(r[0] for r in rows)
    for members in by_group.values():
        members.sort(key=lambda r: r.pos)
        assert [r.pos for r in members] == list(range(len(members)))
        assert {r.total for r in members} == {len(members)}
        assert [r.v for r in members] == sorted(r.v for r in members)


# --- Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain_manifest(rows, received):
    """(doc_id, leaf, subroot, root, siblings, proof_sha256, folded_root, verified) of every row, sorted."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for members in groups.values():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: levels([leaf(r, r[1]) for r in groups[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps = []
            for tree, place in ((trees[s], i), (top, k)):
                for row in tree[:-1]:
                    begin = place - place % 3
                    steps.append((row[begin:place], row[place + 1 : begin + 3]))
                    place //= 3
            end = leaf(r, received(r))
            for before, after in steps:
                end = digest(*before, end, *after)
            siblings = [d for before, after in steps for d in before + after]
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], top[-1][0], siblings, digest(*siblings), end, end == top[-1][0]))
    return sorted(out, key=repr)


def without_breaks(row):
    even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
    return row[1].replace("\n", "") if even and row[1] is not None else row[1]


def received_without_breaks():
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


@pytest.mark.parametrize("at_a_time", [1, 2, 6])
def test_manifest_against_a_plain_tree(spark, at_a_time):
    rng = random.Random(at_a_time)
    texts = [None, "", "a\nb", "ä\n", "\n", "long " * 20_000 + "\n"]
    rows = [
        (i, rng.choice(texts), rng.choice(["en", None]), rng.choice(["hot", "hot", "ü", "", None, f"s{i % 40}"]), i)
        for i in range(500)
    ]
    rows += [(7, "a\nb", "en", "hot", None)] * 5 + [(None,) * 5] * 2 + [(2**60 + 1, "x", None, "hot", 1)]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS), received=received_without_breaks(), levels=at_a_time).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_manifest(rows, without_breaks)
    assert 0 < sum(not r.verified for r in got) < len(rows) / 2


def test_manifest_of_few_rows_and_of_odd_columns(spark):
    none = spark.createDataFrame([], DOCS)
    assert merkle.manifest(none).collect() == []
    odd = spark.createDataFrame([(1, "x", "en", "s", 1, 2, 3, 4, 5)], DOCS + ", tree long, pos long, `a.b` long, ROOT long")
    (row,) = merkle.manifest(odd).collect()
    assert row.leaf == row.root == row.subroot == row.folded_root and row.verified
    assert (row.proof, row.proof_sha256) == ([], digest())


@needs_data
def test_manifest_query_against_a_plain_tree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    expected = [r[:4] + r[5:] for r in plain_manifest([tuple(r) for r in docs.collect()], without_breaks)]
    got = queries.op11_merkle_manifest(spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected, key=repr)


# --- mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Shares handed out again and again until no source has too much."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        parts = sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else left * weight[s] / parts for s in names}
        more = {s for s in names if s not in full and out[s] > most * sizes[s]}
        if not more:
            return out
        full |= more


def check_mix(rows, got):
    sizes = Counter()
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    target = plain_targets(sizes)
    taken = Counter()
    partly = Counter()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r[0], r[2], len((r[1] or "").split())) for r in rows)
    for r in got:
        taken[r.source] += r.copies * r.size + r.part
        partly[r.source] += r.part > 0
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert int(rate) <= r.copies <= -(-rate // 1) and 0 <= r.part <= r.size
        assert r.copies * r.size + r.part <= 2 * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1 and partly[s] <= 1


def test_mix_meets_targets_and_reruns_agree(spark):
    rng = random.Random(3)
    rows = [
        (i, " ".join("w" * rng.choice([0, 1, 5, 90])), rng.choice(["hot"] * 9 + ["a", "b", None, f"s{i % 30}"]))
        for i in range(2500)
    ]
    rows += [(1, "same row\there", "hot")] * 90 + [(None, None, None)] * 3 + [(5, "", "empty")] * 2
    rows.append((9_999, "very long " * 30_000, "hot"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size = mixing.size_in_words(F.col("text"))
    got = mixing.mix(docs, size, fan=16).collect()
    check_mix(rows, got)
    again = mixing.mix(docs.repartition(5), size, fan=16).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    other = mixing.mix(docs, size, fan=16, seed=99).collect()
    assert sorted(map(repr, got)) != sorted(map(repr, other))


def test_mix_keeps_the_mean_of_documents_of_every_size(spark):
    """Many sources of the same documents: small and large ones are taken equally often."""
    rows = [(8 * s + i, "w " * (1 + 3 * i), f"s{s:03d}") for s in range(399) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, rates = {}, Counter()
    for r in mixing.mix(docs, mixing.size_in_words(F.col("text")), fan=4).collect():
        rate = round(r.target / r.source_size, 3)
        taken.setdefault((rate, r.size), []).append((r.copies * r.size + r.part) / r.size)
        rates[rate] += 1
    assert rates == {2.0: 133 * 8, 0.833: 133 * 8, 1.667: 133 * 8}
    assert all(abs(sum(v) / len(v) - rate) < 0.12 for (rate, _), v in taken.items())


def test_mix_of_few_rows_and_of_odd_columns(spark):
    schema = "doc_id long, text string, source string, _order long, full long, `a.b` long, SIZE long"
    size = mixing.size_in_words(F.col("text"))
    assert mixing.mix(spark.createDataFrame([], schema), size).collect() == []
    (row,) = mixing.mix(spark.createDataFrame([(1, "a b c", "s", 1, 2, 3, 4)], schema), size).collect()
    assert (row.size, row.target, row.copies * 3 + row.part) == (3, 4.5, 4) or row.copies * 3 + row.part == 5
    nothing = mixing.mix(spark.createDataFrame([(1, None, None, 1, 2, 3, 4)], schema), size).collect()
    assert [(r.size, r.target, r.copies, r.part) for r in nothing] == [(0, 0.0, 0, 0)]


@needs_data
def test_mix_query_meets_targets(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()
    got = queries.op12_pivotal_mix(spark, SF_DIR)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    source, taken, target = {r.doc_id: r.source for r in docs}, Counter(), {}
    for r in got.collect():
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_mix_stays_in_the_jvm(spark):
    docs = spark.createDataFrame([(i, "a b", "s") for i in range(9)], "doc_id long, text string, source string")
    plan = mixing.mix(docs, mixing.size_in_words(F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


# --- spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(rows, least=5, times=5):
    """(word, form, root, n, n_near, form_n) of every word, from all pairs that share a word less one letter."""
    counts = Counter()
    for doc_id, text in rows:
        for run in spelling.runs_of((text or "").encode()):
            word = spelling.misspelt("" if doc_id is None else str(doc_id), run)
            if len(word) >= 6:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= least}
    shared, near = {}, {w: set() for w in counts}
    for w in counts:
        for part in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            shared.setdefault(part, []).append(w)
    for group in shared.values():
        for a, b in itertools.combinations(group, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(
        ((w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()), key=repr
    )


def test_no_near_pair_misses_a_common_list():
    """The affected-gram bounds leave a common rarest gram for every edit, whatever grams are frequent."""
    rng = random.Random(8)
    tried = 0
    while tried < 4000:
        letters = rng.choice(["ab", "abc", "abcdefgh", "aé"])
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 18)))
        at, kind = rng.randrange(len(word)), rng.choice("dir")
        other = word[:at] + rng.choice(letters) * (kind != "d") + word[at + (kind != "i") :]
        if len(other) < 6 or not one_edit(word, other):
            continue
        tried += 1
        frequent = {
            "".join(rng.choice(letters) for _ in range(rng.randrange(2, 6))): rng.randrange(64, 99)
            for _ in range(rng.choice([0, 5, 30, 200]))
        }
        short, long = sorted((word, other), key=len)
        longest = min(spelling.LONGEST, len(short) // 2)
        lists = {(p, g) for p, g in spelling.rarest(short, frequent, longest)}
        if len(short) < len(long):
            lists |= {(p + 1, g) for p, g in lists}
        assert lists & set(spelling.rarest(long, frequent, longest)), (word, other, frequent)


def test_variants_against_all_pairs(spark):
    rng = random.Random(6)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 12))) for _ in range(60)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(60):
            w = stems[min(int(rng.expovariate(0.1)), 59)]
            if rng.random() < 0.2:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "b" + w[at]]) + w[at + 1 :]
            words.append(w.title() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1", "…"]).join(words)))
    rows += [(None, "nullid " * 9), (1, None), (2, ""), (3, "×÷×÷×÷ " * 6), (3, "×÷×÷×÷ " * 6), (4, "x" * 50_000)]
    rows.append((5, " ".join(["doublé", "double"] * 5 + ["doubles"] * 60)))
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    expected = plain_variants(rows)
    assert sorted((tuple(r) for r in got), key=repr) == expected
    assert any(r[1] for r in expected) and any(r[1] and r[2] != r[1] for r in expected)


def test_variants_of_few_rows_and_of_odd_columns(spark):
    schema = "doc_id long, text string, word long, n long, `a.b` long, TEXT_ long"
    assert spelling.variants(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "colour " * 30 + "color " * 9 + "colours " * 5, 1, 2, 3, 4)]
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"colour", "colours"}
    assert (got["colours"].form, got["colours"].root, got["colours"].form_n) == ("colour", "colour", 30)
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], schema), letters=5)


@needs_data
def test_variants_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_spelling_variants(spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_variants([tuple(r) for r in docs])
