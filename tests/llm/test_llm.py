"""Each operator against a brute-force version on a small corpus, and on tables with nulls, ties, repeats and no rows."""

import hashlib
import os
import random
import re
import time
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import html_extract, licenses, lines, linking, minhash, mixing, neighbours, phrases, pieces, quality, queries, suffixes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, bucket int, id string, size int"


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def corpus():
    """Random prose with exact copies, near copies, shared passages, repeated lines, and awkward rows."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfg" for b in ("an", "él", "or", "u") for c in ("", "t", "ing", "s.")]
    prose = lambda n: " ".join(rng.choice(vocabulary) + ("\n" if rng.random() < 0.05 else "") for _ in range(n))
    passage, line = prose(80), "a common line of several words that many documents hold"
    texts = [prose(rng.choice([3, 12, 60, 150])) for _ in range(30)]
    texts += [texts[2], texts[3], texts[3]]
    for t in texts[4:10]:
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(6)]
    texts += [f"{line}\n{prose(20)}\n{line}.\nReleased under the MIT License." for _ in range(5)]
    texts += [passage + " " + passage, "x" * 900, "one two", "one two", "", None, "  \n\t ", "日本語 " * 70, "a" * 250 + " b", prose(3000)]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None]), 0, "x", 1, "y", 2) for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, texts[5], "en", "s1", 0, "x", 1, "y", 2)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def union(parent, a, b):
    a, b = find(parent, a), find(parent, b)
    if a != b:
        parent[max(a, b)] = min(a, b)


def test_minhash_groups(docs, corpus, empty):
    shingles = {}
    for i, t, *_ in corpus:
        w = word_list(t)
        if i is not None:
            shingles[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in shingles}
    for a in shingles:
        for b in shingles:
            if a < b and shingles[a] and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                union(parent, a, b)
    got = minhash.groups(docs).collect()
    assert len(got) == len(corpus)
    assert all(r["group_id"] == (find(parent, r["doc_id"]) if r["doc_id"] is not None else None) for r in got)
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == sorted({find(parent, i) for i in parent})
    assert minhash.groups(empty).count() == 0 and minhash.keep_first(empty).count() == 0


def test_dart_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    for want in (0.3, 0.8):
        n = 200
        common = round(2 * n * want / (1 + want))
        e = rng.integers(1, 2**63, 2 * n - common).astype(np.uint64)
        agree = []
        for _ in range(20):
            e = rng.permutation(e)
            s = minhash.dart_minhash(np.repeat([0, 1], n), np.concatenate([e[:n], e[n - common :]]), np.ones(2 * n), 2, 100)
            agree.append((s[0] == s[1]).mean())
            e = rng.integers(1, 2**63, len(e)).astype(np.uint64)
        assert abs(np.mean(agree) - want) < 0.06
    # weights: the share of the larger multiset that the smaller one covers
    s = [minhash.dart_minhash(np.array([0, 1]), np.array([k, k], np.uint64), np.array([1.0, 4.0]), 2, 64) for k in range(1, 40)]
    assert abs(np.mean([(x[0] == x[1]).mean() for x in s]) - 0.25) < 0.1


def test_large_buckets(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        w = list(base)
        for _ in range(rng.choice([2, 4, 6])):
            w[rng.randrange(200)] = rng.choice(words)
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(196)} for i, t in rows}
    parent = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                union(parent, a, b)
    got = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["group_id"] for r in got} == {i: find(parent, i) for i in parent}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["id"]: r["label"] for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_mixing(docs, corpus, empty):
    got = mixing.mix_digest(docs).collect()
    assert len(got) == len(corpus) and sorted(map(str, got)) == sorted(map(str, mixing.mix_digest(docs.repartition(3)).collect()))
    size = Counter()
    for _, t, _, source, *_ in corpus:
        size[source] += len(word_list(t))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(size.values()), set()
    while True:
        rest = {s: weight[s] * (total - sum(3 * size[x] for x in full)) / sum(weight[x] for x in order if x not in full) for s in order if s not in full}
        over = {s for s in rest if rest[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    target = {s: 3.0 * size[s] if s in full else rest[s] for s in order}
    by_id = {r["doc_id"]: r for r in got}
    for i, t, _, source, *_ in corpus:
        r = by_id[i]
        assert (r["size"], r["source_size"]) == (len(word_list(t)), size[source]) and r["target"] == pytest.approx(target[source])
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixing.mix_digest(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16))
    x[700:1000] = x[700]
    rows = [(i, [float(v) for v in x[i]]) for i in range(1500)] + [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [1.0, 2.0]), (2080, [None] * 16)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.search(vectors, k=20).collect()
    scores = x @ x.T
    hit = total = 0
    for q in range(0, 1500, 20):
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(r["score"] == pytest.approx(scores[q, r["vec_id"]]) and r["vec_id"] != q for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        s = scores[q].copy()
        s[q] = -np.inf
        best = set(np.lexsort((np.arange(1500), -s))[:20].tolist())
        hit, total = hit + len(best & {r["vec_id"] for r in mine}), total + 20
    assert len(got) == 75 * 20 and hit / total >= 0.9
    # repeated rows and clashing columns: a repeated query is asked once, a repeated candidate is found twice
    wide = vectors.unionByName(vectors.filter("vec_id IN (0, 3)")).withColumns({c: F.lit("x") for c in ("list", "codes", "v", "score", "rank", "chunk", "block", "q")})
    again = neighbours.search(wide.filter("vec_id < 5"), k=20).collect()
    assert [r["rank"] for r in again if r["query_id"] == 0] == [1, 2, 3, 4, 5] and sorted(r["vec_id"] for r in again) == [1, 2, 3, 3, 4]
    few = neighbours.search(vectors.filter("vec_id < 5"), k=20)
    assert [r["vec_id"] for r in few.collect()] == np.argsort(-scores[0, 1:5]).__add__(1).tolist()
    assert neighbours.search(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["tails", "clusters", "others", "huge"])
def test_neighbours_of_other_rows(spark, shape):
    """Every nearest vector is found where the sample doesn't stand for the rows, nor for the queries."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16))
    if shape == "tails":
        x *= np.exp(1.5 * rng.normal(size=(3000, 1)))
    elif shape == "clusters":
        x = 0.05 * x + 3 * rng.normal(size=(60, 16))[rng.integers(60, size=3000)]
    elif shape == "others":
        x[1::2], x[::20] = 4 * np.eye(16)[rng.integers(16, size=1500)] + 0.3 * x[1::2], 1 + 0.1 * x[::20]
    else:
        x[5::7] *= 1e30
    vectors = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(vectors, k=20, sample=500).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    assert got == {q: set(np.argsort(-scores[q], kind="stable")[:20].tolist()) for q in range(0, 3000, 20)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_fuzzy_lines(docs, corpus, empty, spark):
    """Against all pairs of distinct lines by edit similarity alone: no group joins what isn't similar, few pairs are lost."""
    more = [(900 + i, f"Lines that differ in number {i} only, but are long enough to be taken as one by their words and signs", *corpus[0][2:]) for i in range(12)]
    frame = docs.unionByName(spark.createDataFrame(more, DOCS))
    got = {(r["doc_id"], r["line"]): (r["group_doc"], r["group_line"], r["kept"]) for r in lines.line_groups(frame).collect()}
    norms = {(r["doc_id"], r["line"]): r["norm"] for r in lines.normal_lines(frame).select("doc_id", "line", "norm").collect()}
    assert set(got) == set(norms) and set(norms) == {(i, k) for i, t, *_ in corpus + more if i is not None for k, x in enumerate((t or "").split("\n")) if any(len(w) > 3 or any(c.isalnum() for c in w) for w in re.split(r"[ \t\r]+", x))}
    classes = lines.line_classes(lines.normal_lines(frame))
    sims = {r["norm"]: r["sim"] for r in lines.simhashes(classes).join(classes.select("id", "norm"), "id").collect()}
    names = sorted(set(norms.values()))
    assert sorted(sims) == names
    parent, pairs = {n: n for n in names}, []
    for i, a in enumerate(names):
        for b in names[:i]:
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                union(parent, a, b)
                pairs.append((a, b))
    group = {norms[k]: v[:2] for k, v in got.items()}
    first = {}
    for k in sorted(norms):
        first.setdefault(group[norms[k]], k)
    # a group is one set of linked lines, equal lines are in one, and its first line stands for it
    assert all(group[norms[k]] == v[:2] and v[2] == (k == v[:2]) for k, v in got.items()) and all(first[g] == g for g in first)
    assert all(find(parent, norms[k]) == find(parent, norms[v[:2]]) for k, v in got.items())
    joined = [group[a] == group[b] for a, b in pairs]
    assert len(pairs) > 60 and sum(joined) >= 0.95 * len(pairs)
    near = [group[a] == group[b] for a, b in pairs if ((sims[a] ^ sims[b]) & (2**64 - 1)).bit_count() <= 3]
    assert near and all(near)
    kept = lines.keep_first(frame)
    assert kept.columns == frame.columns and lines.keep_first(empty).count() == 0 and lines.line_groups(empty).count() == 0
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts[0] == corpus[0][1] and texts.get(3) is not None and 31 not in texts


def test_long_lines_use_all_their_words(spark):
    """Lines on both sides of a part's size: the SimHash is the majority of all words, and near copies are linked."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(5, 9)))
    base = [word() for _ in range(lines.PART - 1)]
    texts = [" ".join(base), " ".join([*base, word(), word(), word()]), " ".join(word() for _ in range(3 * lines.PART)), "one short line of words"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sims = {r["size"]: r["sim"] & (2**64 - 1) for r in lines.simhashes(lines.line_classes(lines.normal_lines(frame))).collect()}
    for t in texts:
        words = [w for w in t.split() if len(w) > 4]
        hashes = [h & (2**64 - 1) for h in np.array(spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).toPandas()).ravel().tolist()]
        want = sum(1 << b for b in range(64) if 2 * (n := sum(h >> b & 1 for h in hashes)) > len(hashes) and n > len(hashes) // 2)
        assert sims[len(t)] == want
    assert [r["group_doc"] for r in lines.line_groups(frame).orderBy("doc_id").collect()] == [0, 0, 2, 3]


def test_fuzzy_lines_by_edit_similarity_alone(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(2, 11)))
    rows = []
    for i in range(60):
        base = [word() for _ in range(rng.randrange(20, 50))]
        changed = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            changed[rng.randrange(len(base))] = word()
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(changed))]
    near = {b for a, b in zip(range(0, 120, 2), range(1, 120, 2), strict=True) if distance(rows[a][1], rows[b][1]) <= 0.2 * max(len(rows[a][1]), len(rows[b][1]))}
    got = {r["doc_id"]: r["group_doc"] for r in lines.line_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = {i for i, first in got.items() if first != i}
    assert linked <= near and all(got[i] == i - 1 for i in linked) and len(near) > 50 and len(linked) >= 0.95 * len(near)


def test_fuzzy_lines_that_share_few_words(spark):
    """Lines of equal SimHashes and high edit similarity, in buckets of two and of many."""
    rng = random.Random(6)
    long = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(60))
    short = lambda: " ".join("".join(rng.sample("abcdefgh", 2)) for _ in range(5))
    rows = []
    for n in (2, 2, 2, 12):
        same = long()
        rows += [(len(rows) + i, f"{short()} {same}") for i in range(n)]
    got = {r["doc_id"]: r["group_doc"] for r in lines.line_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(distance(rows[a][1], rows[b][1]) <= 0.2 * 75 for a, b in ((0, 1), (2, 3), (4, 5), (6, 17)))
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, **dict.fromkeys(range(6, 18), 6)}


def test_fuzzy_lines_drop_their_tables(docs, spark):
    """Once groups are known, what led to them is off the disk; the result is read from one table."""
    folder = os.path.join(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"), "tables")
    held = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = held()
    found = lines.line_groups(docs)
    assert len(held() - before) == 1 and found.count() == lines.normal_lines(docs).count()


def test_near_copies_meet_in_one_bucket(spark):
    """Near copies share most of their buckets: a pair of classes comes from the first of them alone, and none is lost."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(7)) for _ in range(60)]
    copies = [" ".join("other" if k == i else w for k, w in enumerate(words)) for i in range(20)]
    frame = spark.createDataFrame(list(enumerate(copies)), "id long, norm string").withColumn("size", F.length("norm"))
    classes = lines.simhashes(frame).select(F.explode(F.array(*lines._keys())).alias("bucket"), "id", *lines.MARKS)
    met = classes.join(linking.renamed(classes, lines.MARKS), "bucket").filter("id < lead_id")
    every, once = met.count(), met.filter(lines._first_common(F.col, linking.led))
    pairs = met.select("id", "lead_id").distinct().count()
    assert once.count() == once.select("id", "lead_id").distinct().count() == pairs < every / 3


def test_lines_are_compared_by_their_ends(spark):
    """Ends rule out only what the whole distance does, most pairs that share a passage, and the anchored sum stops early."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 8)))
    some = lambda n: [word() for _ in range(n)]
    rows, shared = [], 0
    for n in range(240):
        a = some(rng.randint(1, 30))
        if n % 3 == 0:  # a few edits
            b = [w if rng.random() > 0.15 else word() for w in a]
            b = b[rng.randint(0, 2) :] + some(rng.randint(0, 2))
        elif n % 3 == 1:  # a passage, at other places
            shared += 1
            a, b = some(12) + a[:12] + some(3), some(10) + a[:12] + some(4)
        else:
            b = some(len(a))
        a, b = " ".join(a), " ".join(b)
        rows.append((n, a, b, int(0.2 * max(len(a), len(b)))))
    # texts of which one begins, or ends, as the other goes on
    rows += [(240, "xab" * 9, "abx" * 9, 2), (241, "abcd" * 5, "b" + "abcd" * 5, 1), (242, "é" * 30, "é" * 30 + "abcde", 5), (243, "", "abc", 3), (244, "", "abc", 2)]
    frame = spark.createDataFrame(rows, "n int, na string, nb string, most int")
    frame = frame.withColumn("any", F.lit(1 << 20))
    got = frame.select("n", lines._ends_apart("na", "nb", "most").alias("apart"), lines._anchored("na", "nb", "most").alias("bound"), lines._anchored("na", "nb", "any").alias("sum")).collect()
    real = {n: distance(a, b) for n, a, b, _ in rows}
    most = {r[0]: r[3] for r in rows}
    assert all(real[r["n"]] > most[r["n"]] for r in got if r["apart"])
    assert all(real[r["n"]] <= most[r["n"]] for r in got if r["bound"] <= most[r["n"]])
    assert sum(r["apart"] for r in got if r["n"] % 3 == 1 and r["n"] < 240) > shared / 2
    assert all((r["bound"] <= most[r["n"]]) == (r["sum"] <= most[r["n"]]) for r in got) and any(r["bound"] < r["sum"] for r in got)


def test_components_of_chains_and_stars(spark):
    """Long chains, stars, rings and pairs in any order of ids get their least id, also when rounds go on from stars."""
    rng = random.Random(10)
    ids = rng.sample(range(10_000), 900)
    edges = [(ids[i], ids[i + 1]) for i in range(299)] + [(ids[300], ids[i]) for i in range(301, 500)] + [(ids[500 + i], ids[500 + (i + 1) % 100]) for i in range(100)]
    edges += [(ids[i], ids[i + 1]) for i in range(600, 900, 2)]
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    calls, cut = [], linking.cut
    linking.cut = lambda df: calls.append(df) or cut(df)
    try:
        got = {r["id"]: r["label"] for r in linking.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {i: top(i) for i in ids}
        calls.clear()
        stars = spark.createDataFrame([(label, i) for i, label in got.items() if i != label], "a long, b long")
        assert {r["id"]: r["label"] for r in linking.components(stars).collect()} == got and len(calls) == 2
    finally:
        linking.cut = cut


def test_repeated_phrases(docs, corpus, empty):
    first = {}
    for i, t, *_ in sorted((r for r in corpus if r[0] is not None), key=lambda r: r[0]):
        w = word_list(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    got = phrases.dedup_digest(docs).collect()
    assert len(got) == len(corpus)
    by_id = {r["doc_id"]: r for r in got}
    for i, t, *_ in corpus:
        w = word_list(t)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (by_id[i]["n_words"], by_id[i]["n_removed"], by_id[i]["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert phrases.dedup_digest(empty).count() == 0


@pytest.mark.parametrize("bucket_texts", [20_000, 2])
def test_suffix_dedup(docs, corpus, empty, bucket_texts):
    count = Counter(b[k : k + 200] for _, t, *_ in corpus for b in [(t or "").encode()] for k in range(len(b) - 199))
    got = suffixes.dedup(docs, bucket_texts=bucket_texts).drop("kept").collect()
    assert len(got) == len(corpus)
    by_id = {r["doc_id"]: r for r in got}
    for i, t, *_ in corpus:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                gone[k : k + 200] = [True] * 200
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert tuple(by_id[i])[1:] == (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()), i
    assert suffixes.dedup_digest(empty).count() == 0


def test_difference_cover():
    for period in (7, 16, 32):
        d = suffixes.difference_cover(period)
        assert {(a - b) % period for a in d for b in d} == set(range(period))


def best_path(word, table, model):
    best = [(0.0, 0, [])]
    for e in range(1, len(word) + 1):
        ways = []
        for b in range(max(0, e - model.longest), e):
            part = word[b:e]
            if part in table:
                ways.append((best[b][0] + table[part][1], -b, [table[part][0]]))
            elif e - b == 1:
                ways.append((best[b][0] + pieces.BYTE_SCORE * len(part.encode()), -b, [model.bytes[x] for x in part.encode()]))
        best.append(max(ways))
    ids, e = [], len(word)
    while e:
        ids, e = best[e][2] + ids, -best[e][1]
    return ids


@pytest.mark.parametrize("dictionary", [1 << 22, 20])
def test_pieces(docs, corpus, empty, dictionary):
    model = pieces.Model()
    table = {p: (i, s) for p, i, s in model.pieces}
    encoded = pieces.encode(docs, dictionary=dictionary, verify=True)
    assert encoded.columns == [*docs.columns, "ids", "round_trip"]
    got = {r["doc_id"]: r for r in encoded.collect()}
    for i, t, *_ in corpus:
        assert got[i]["round_trip"]
        assert got[i]["ids"] == (None if t is None else [x for w in pieces.words(t) for x in best_path(w, table, model)])
        assert t is None or ("".join(pieces.words(t)) == t and model.decode(got[i]["ids"]) == t)
    assert all(r["decoded"] == r["text"] for r in pieces.decode(encoded).collect())
    assert pieces.encode(empty, dictionary=dictionary).count() == 0


def test_pieces_across_words(spark):
    model = pieces.Model()
    assert [p for p, _, _ in model.pieces if len(pieces.words(p)) > 1] == []
    table = {p: (i, s) for p, i, s in model.pieces}
    rng = random.Random(2)
    texts = ["".join(rng.choice("ABCDEFabcdef") for _ in range(150)), "of" * 40, "日本語の文章は空白を置かない。" * 8, "1" * 70, "def f():\n        return  1;\r\n" + " " * 40 + "x «é».", "-" * 100, "   \n "]
    got = pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), verify=True).collect()
    best = lambda ids: sum({i: s for i, s in table.values()}.get(i, pieces.BYTE_SCORE) for i in ids)
    for r in got:
        # the lattice of the whole text, uncut
        assert r["round_trip"] and best(r["ids"]) == pytest.approx(best(best_path(r["text"], table, model))), r["text"]


def test_dictionary_comes_in_parts(spark, docs):
    """The driver's Python has one part of a dictionary at a time, and parts encode as the whole does."""
    words = spark.range(400_000).select(F.xxhash64("id").alias("hash"), F.array(F.col("id").cast("int") % 7, F.col("id").cast("int") % 90_000).alias("ids"))
    tracemalloc.start()
    parts = pieces._parts(words, 400_000, 20_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = [p.value for p in parts]
    assert len(parts) == 32 and peak < sum(p.hashes.nbytes + p.ids.nbytes + p.bounds.nbytes for p in whole) / 3
    hashes = np.concatenate([p.hashes for p in whole])
    assert len(hashes) == 400_000 and (np.diff(hashes.astype(object)) > 0).all()
    rows = {r["hash"] % 2**64: r["ids"] for r in words.limit(500).collect()}
    for p in whole:
        at, found = p.find(np.sort(np.array(list(rows), np.uint64)))
        for k, h in zip(at[found], np.sort(np.array(list(rows), np.uint64))[found], strict=True):
            assert p.ids[p.bounds[k] : p.bounds[k + 1]].tolist() == rows.pop(int(h))
    assert not rows
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    one, many = (sorted(pieces.encode(docs, verify=True, dictionary=n, part_words=w).select("doc_id", "text", "ids", "round_trip").collect(), key=key) for n, w in ((1 << 22, 1 << 18), (60, 7)))
    assert one == many and all(r["round_trip"] for r in one)


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/x">Menu {n}</a></li></ul></nav>
<div class="notice">We use &amp; like cookies</div><div id="wrap"><h2>Head {n}</h2><div class="body"><p>First &lt;{n}&gt;   block<br>goes on<p>Second {n}</p><ul><li>one {n}</li><li>two</li></ul></div></div>
<p>Read it all, every day</p><form><p>search {n}</p></form><div class="comments"><p>Nice {n}</p></div><footer>&copy; {n}</footer></body></html>"""


def test_html(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.replace("{n}", str(i))) for i in range(8)]
    rows += [(50, None, None), (51, "x", ""), (52, "http://solo.example/", "<article><h1>A</h1><p>b &amp; c</p></article><aside>no</aside>"), (53, "http://solo.example/2", "plain <b>text")]
    want = {i: f"Head {i}\n\nFirst <{i}> block goes on\n\nSecond {i}\n\none {i}\n\ntwo" for i in range(8)}
    want |= {50: "", 51: "", 52: "A\n\nb & c", 53: "plain text"}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for tokens in (200_000, 0):
        got = html_extract.extract(frame, broadcast_tokens=tokens).collect()
        # "two" is the same on all pages, yet in a list of the article; the line below the article is the template's
        assert {r["page_id"]: r["text"] for r in got} == want
        assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(frame.limit(0)).count() == 0


def bare_site(rng, host, pages):
    """Pages without a telling element, class or word: a menu, an advert on most, a text, a line below it; and the texts."""
    words = lambda n: " ".join("".join(rng.choice("abdeilmnorst") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    menu, rows = [words(1) for _ in range(5)], []
    for i in range(pages):
        blocks = [words(6), *[words(rng.randrange(15, 60)) for _ in range(rng.randrange(2, 7))], "The same closing sentence."]
        items = "".join(f"<li>{m}{'' if k else words(1)}</li>" for k, m in enumerate(menu))
        body = "".join(f"<p>{b}</p>" for b in blocks[1:])
        html = f"<html><body><div><ul>{items}</ul></div><div>{words(9)}</div><div><h1>{blocks[0]}</h1>{body}</div><div>All rights {words(3)}</div></body></html>"
        rows.append((f"https://{host}/{i}", html, "\n\n".join(blocks)))
    return rows


def test_html_by_template_alone(spark):
    rng = random.Random(9)
    rows = [(i, *r) for i, r in enumerate(bare_site(rng, "a.example", 30) + bare_site(rng, "b.example", 12))]
    # copies of a page and repeated rows count once in the template
    rows += [rows[0]] * 40
    frame = spark.createDataFrame([(i, u, h, "x") for i, u, h, _ in rows], "page_id long, url string, html string, text string")
    for tokens in (200_000, 0):
        got = html_extract.extract(frame, broadcast_tokens=tokens).collect()
        assert len(got) == len(rows) and all(r["text"] == rows[r["page_id"]][3] for r in got)
    # without templates, menus, adverts and feet stay
    got = html_extract.extract(frame, least_pages=1000).collect()
    assert all(r["text"] != rows[r["page_id"]][3] and rows[r["page_id"]][3] in r["text"] for r in got)


def test_html_template_before_tags(spark):
    """Pages whose ``main`` has the menu, the advert and the foot too: the template parts them, tags alone wouldn't."""
    rows = bare_site(random.Random(11), "c.example", 20)
    whole = [(i, u, h.replace("<body>", "<body><main>").replace("</body>", "</main></body>")) for i, (u, h, _) in enumerate(rows)]
    # one page is made otherwise: what the template takes for the article isn't there, and its tags tell
    odd = (99, "https://c.example/odd", "<html><body><section>Login</section><article><p>Alone here.</p></article></body></html>")
    frame = spark.createDataFrame([*whole, odd], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(frame).collect()}
    assert got == {i: r[2] for i, r in enumerate(rows)} | {99: "Alone here."}
    tags = {r["page_id"]: r["text"] for r in html_extract.extract(frame, least_pages=1000).collect()}
    assert tags[99] == got[99] and all(tags[i] != got[i] and got[i] in tags[i] for i in range(len(rows)))


def test_html_classes_by_brute_force(spark):
    """The tokens on most pages, their vectors and gaps, from the pages' trees one by one."""
    rng = random.Random(10)
    rows = [r[:2] for r in bare_site(rng, "a.example", 9)]
    rows += [("https://a.example/odd", "<div>one<p>two</p></div><div><ul><li>three</ul></div>")]
    pages = [html_extract.Page(h, 5) for _, h in rows]
    on = {}
    for k, p in enumerate(pages):
        for t in {*p.ids, *p.text_ids()}:
            on.setdefault(t, set()).add(k)
    often = {t: len(s) for t, s in on.items() if len(s) >= 8}
    gaps = {}
    for p in pages:
        texts, seen, done = p.text_ids(), {}, set()
        for x in (0, *p.order):
            t, above = (p.ids[x], p.parents[x]) if x >= 0 else (texts[-x - 1], p.blocks[-x - 1][0])
            if t in often and t not in done:
                done.add(t)
                better = [s for s in seen.setdefault(above, []) if often[s] >= often[t]]
                gaps.setdefault(t, set()).add(better[-1] if better else 0)
                seen[above].append(t)
    size = Counter()
    elements = {t for p in pages for t in p.ids}
    for t in often:
        size[frozenset(on[t])] += 2 if t in elements else 1
    want = {t for t in often if len(gaps[t]) == 1 and size[frozenset(on[t])] >= 2}
    frame = spark.createDataFrame(rows, "url string, html string")
    root = frame.select(html_extract._root().alias("r")).first()["r"]
    again = lambda t: {x: y for p, q in zip(pages, [html_extract.Page(h, root) for _, h in rows], strict=True) for x, y in zip([*p.ids, *p.text_ids()], [*q.ids, *q.text_ids()], strict=True)}[t]
    got = html_extract.templates(frame)
    assert {r["token"] for r in got.collect()} == {again(t) for t in want} and got.filter("main").count() == 1


def test_html_odd_pages(spark):
    texts = ["<a " * 20_000, "<p " + "x" * 100_000, '<a href="' * 20_000, "<div>" * 20_000 + "deep", "</b>" * 20_000 + "x", "<!-- " * 20_000, "<p>a</p><", "<p title='1 > 0'>b", "a < b, <c> <3", "<script>if (a<b) {}", "<p>x<a href=\"y>z</p>w", "<>" * 1000]
    want = {6: "a\n\n<", 7: "b", 8: "a < b, <3", 9: "", 3: "deep", 4: "x"}
    began = time.time()
    found = [html_extract.article(html_extract.Page(t), None) for t in texts] + [html_extract.article(html_extract.Page("<a " * 350_000), None)]
    assert time.time() - began < 5
    assert all(found[k] == w for k, w in want.items())
    assert found[0] == ("<a " * 20_000).strip() and "z" in found[10] and "w" in found[10]
    rows = [(1, None, t, t) for t in [*texts, texts[3]]]
    assert html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).count() == len(rows)


def test_quality_base_rules(docs, corpus, empty):
    got = {r["doc_id"]: r for r in quality.verdicts(docs).collect()}
    for i, t, *_ in corpus:
        w, r = word_list(t), got[i]
        seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
        full = [x for x in (t or "").split("\n") if word_list(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(full) - len(set(full)), len(covered))
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r["base_failed"] and r["kept"])
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["kept"]}
    assert quality.verdicts(empty).count() == 0 and quality.keep_quality(empty).count() == 0


def test_kneser_ney_is_a_distribution():
    text = np.frombuffer(b"the cat sat on the mat and the rat sat on the hat ", np.uint8)
    codes, bounds = quality.ngram_codes(text, np.array([0, 20, len(text)]))
    assert bounds.tolist() == [0, 21, len(codes)]
    model = quality.KneserNey(*np.unique(codes, return_counts=True))
    for context in (codes[5] // quality.ALPHABET, 17 * quality.ALPHABET + 3, 0):
        assert model.probability(context * quality.ALPHABET + np.arange(quality.ALPHABET)).sum() == pytest.approx(1.0)


def test_quality_bits_by_brute_force(spark):
    """Bits per character from a Kneser-Ney model of dictionaries, one n-gram at a time."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(2, 6))) for _ in range(25)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(12, 60))) for _ in range(40)]
    order = quality.ORDER
    padded = [[0] * (order - 1) + list(t.encode()) + [0] for t in texts]
    grams = [[tuple(p[i : i + order]) for i in range(len(p) - order + 1)] for p in padded]
    counts = {order: {g: n - 1 for g, n in Counter(g for x in grams for g in x).items() if n > 1}}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts, totals, left = {}, {}, {}
    for k, table in counts.items():
        n = [max(sum(c == i for c in table.values()), 0.5) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        discounts[k] = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), 0.95 * i) for i in range(1, 4)]
        totals[k], left[k] = Counter(), Counter()
        for g, c in table.items():
            totals[k][g[:-1]] += c
            left[k][g[:-1]] += discounts[k][min(c, 3) - 1]

    def probability(g):
        k = len(g)
        if not k:
            return 1 / quality.ALPHABET
        total, c = totals[k][g[:-1]], counts[k].get(g, 0)
        if not total:
            return probability(g[1:])
        return (c - discounts[k][min(c, 3) - 1] if c else 0) / total + left[k][g[:-1]] / total * probability(g[1:])

    rows = [(i, t, "en") for i, t in enumerate(texts)]
    got = quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    for r in got:
        own = grams[r["doc_id"]]
        assert r["bits_per_char"] == pytest.approx(sum(-np.log2(probability(g)) for g in own) / len(own), rel=1e-4)
        assert r["kept"] == (not r["base_failed"] and r["lowest_bits"] <= r["bits_per_char"] <= r["highest_bits"] and 10 * r["n_symbols"] <= r["n_words"])


def test_quality_cuts_large_models(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["ab", "cd", "ef", "gh"]) for _ in range(30)) for _ in range(30)]
    frame = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    sizes = [len(quality.fit_models(frame, ["en"], most).held[0].value.levels[0][0]) for most in (1 << 24, 60, 1)]
    assert sizes[0] > 60 >= sizes[1] > 0 and sizes[2] > 0


def test_quality_parts_of_large_models(spark, monkeypatch):
    """Models in parts give every text the bits that whole ones give."""
    rng = random.Random(12)
    texts = [(i, " ".join("".join(rng.choice(f"abcdé{'xyzuvw'[i % 6]}") for _ in range(rng.randrange(2, 6))) for _ in range(rng.randrange(12, 60))), f"l{i % 6}") for i in range(120)]
    frame = spark.createDataFrame([*texts, (500, "", "l0"), (501, None, "l5")], "doc_id long, text string, lang string").repartition(3)
    whole = {r["doc_id"]: r for r in quality.verdicts(frame).collect()}
    monkeypatch.setattr(quality.fit_models, "__defaults__", (150,))
    got = {r["doc_id"]: r for r in quality.verdicts(frame).collect()}
    assert set(got) == set(whole) and all(got[i]["bits_per_char"] == pytest.approx(whole[i]["bits_per_char"], rel=1e-5) and got[i]["kept"] == whole[i]["kept"] for i in whole)
    kept = quality.keep_quality(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {i for i in whole if whole[i]["kept"]}


def test_quality_finds_noise(spark):
    rng = random.Random(1)
    words = "the of and to in is that it was for on are as with they be at one have this from by hot but some what there we can out other were all your when up use word how said an each she".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60, 200))), "en") for i in range(400)]
    rows += [(1000 + i, "".join(rng.choice("xqzjkvw#$%0123 ") for _ in range(600)), "en") for i in range(4)]
    got = {r["doc_id"]: r["kept"] for r in quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not any(got[1000 + i] for i in range(4)) and sum(got[i] for i in range(400)) >= 399


def test_quality_finds_signs_and_keeps_languages_apart(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abdeilmnorst") for _ in range(rng.randrange(2, 8))) for _ in range(60)]
    text = lambda end: " ".join(rng.choice(words) + end for _ in range(rng.randrange(60, 200)))
    rows = [(i, text(""), f"l{i % 30:02}") for i in range(600)]
    rows += [(1000 + i, " ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in text("").split()), "l00") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in quality.verdicts(frame).collect()}
    assert not any(got[1000 + i] for i in range(60)) and sum(got[i] for i in range(600)) >= 590
    assert len(quality.language_slots(frame)) == 30
    one, two = (quality.ngram_codes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0].tolist() for t in ("a#b", "a$b"))
    assert one != two


def test_licenses(docs, corpus, empty, spark):
    templates = [(name, licenses.bigrams(text)) for name, text in licenses.TEMPLATES]
    bsd, rest = licenses.TEMPLATES[9][1], corpus[0][2:]
    wrapped = lambda t, n: "\n".join(" ".join(t.split()[k : k + n]) for k in range(0, len(t.split()), n))
    rows = [(700, licenses.TEMPLATES[0][1].replace(" ", "\n", 9), *rest), (701, licenses.TEMPLATES[2][1].upper().replace("WARRANTY", "GUARANTEE"), *rest)]
    rows += [(702, "some code\n" + wrapped(bsd, 7) + "\nmore code\nand more", *rest), (703, "x = 1\n\n  * " + wrapped(licenses.TEMPLATES[1][1], 3).replace("\n", "\n\n  * ") + "\ny = 2", *rest), (703, wrapped(bsd, 1), *rest)]
    more = spark.createDataFrame(rows, DOCS)
    got = {(r["doc_id"], r["license"], r["n_units"], r["dice"]) for r in licenses.document_licenses(docs.unionByName(more)).collect()}
    most = max(len(g) for _, g in templates) * 1.5 + 1
    want = Counter()
    best = {}

    def scores(words):
        grams = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}
        out = {}
        for name, g in templates:
            if grams and 2 * len(grams & g) / (len(grams) + len(g)) >= 0.8:
                out[name] = max(out.get(name, 0), 2 * len(grams & g) / (len(grams) + len(g)))
        return out

    for i, t, *_ in [*corpus, *map(tuple, more.collect())]:
        text = re.sub(r"(?:[^\w\n]|_)+", " ", (t or "").lower())
        units = text.split("\n") + [b.replace("\n", " ") for b in re.split(r"\n *\n[ \n]*", text) if "\n" in b.strip(" ")]
        mine = [scores(u.split()) for u in units]
        lines = [x.split() for x in text.split("\n") if x.split()]
        runs = {}
        for a in range(len(lines)):
            for b in range(a + 2, len(lines) + 1):
                words = sum(lines[a:b], [])
                if len(words) > most:
                    break
                for name, s in scores(words).items():
                    runs[name] = max(runs.get(name, 0), s)
        known = {name for s in mine for name in s}
        for s in [*mine, {n: x for n, x in runs.items() if n not in known}]:
            for name, x in s.items():
                want[i, name] += 1
                best[i, name] = max(best.get((i, name), 0), x)
    assert got == {(*k, n, round(best[k], 6)) for k, n in want.items()} and {k[:2] for k in got} >= {(700, "MIT"), (701, "MIT"), (702, "BSD-3-Clause"), (703, "MIT"), (703, "BSD-3-Clause")}
    assert licenses.document_licenses(empty).count() == 0
    with pytest.raises(ValueError, match="two words"):
        licenses.document_licenses(docs, [("X", "word")])


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf, name):
    for t in ("documents", "embeddings", "pages", "conversations"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, sf), duckdb.sql(queries.ORACLE_SQL[name])
    columns = sorted(got.columns)
    rows = lambda found: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in found)
    assert columns == sorted(want.columns)
    assert rows([[r[c] for c in columns] for r in got.collect()]) == rows(want.project(", ".join(columns)).fetchall())


def run_odd(spark, tmp_path, rows):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "documents.parquet"))
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_pipeline_takes_odd_tables(corpus, spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, ties and no rows, from end to end."""
    out = run_odd(spark, tmp_path / "odd", [(*r[:4], len(r[1] or "")) for r in corpus])
    assert out and all(r["text"] and r["ids"] for r in out) and {r["doc_id"] for r in out} <= {r[0] for r in corpus}
    assert run_odd(spark, tmp_path / "none", []) == []


def test_pipeline_keeps_lengths(corpus, spark, tmp_path):
    out = run_odd(spark, tmp_path, [(*r[:4], len(r[1] or "")) for r in corpus])
    assert [(r["doc_id"], r["n_chars"], len(r["text"])) for r in out if r["n_chars"] != len(r["text"])] == []


def test_pipeline(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "source_mixing", "encoding"]
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"] and out.count() > 50
    assert all(f"op{i}_" in " ".join(entry.queries()) for i in range(1, 14)) and "pipeline" in entry.queries()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    clean = docs.join(labels.filter("quality = 1"), "doc_id").filter(F.size(F.split("text", r"\s+")) >= 12)
    lost = clean.select("doc_id").exceptAll(first.select("doc_id")).count()
    assert lost <= 0.05 * clean.count()


def test_near_texts_of_all_widths(spark):
    """The same pairs as by their distance alone, also of periodic texts above the width; each part of a text is compared once."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(60)]
    rows = []
    for i in range(60):
        period = rng.choices(words, k=rng.choice((1, 7, 30)))
        a = period * (rng.choice((600, 1100)) // len(period) if i % 6 == 0 else rng.randint(1, 9))
        b = [rng.choice(words) if rng.random() < (i % 5) * 0.08 else w for w in a][i % 3 :]
        a, b = " ".join(a), " ".join(b)
        rows.append((i, a, b, int(0.2 * max(len(a), len(b)))))
    pairs = spark.createDataFrame(rows, "id int, na string, nb string, most int")
    assert pairs.filter(F.length("na") > lines.WIDE).count() > 2
    got = {r["id"] for r in lines._near(pairs).collect()}
    expected = {r["id"] for r in pairs.filter("levenshtein(na, nb, most) >= 0").collect()}
    assert got == expected and 0 < len(got) < len(rows)
    assert str(lines._anchored("na", "nb", "most")).count("levenshtein(") == 1
