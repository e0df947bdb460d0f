"""Manifest, ranked search and mixing against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendmill.llm import lexical, merkle, mixing

# --- manifest ---------------------------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(nodes):
    """(root, path of every node: per level the texts left and right)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for leaf, at in enumerate(places):
            run = runs[at // 16]
            paths[leaf].append(("".join(run[:at % 16]), "".join(run[at % 16 + 1:])))
        places = [at // 16 for at in places]
        nodes = [sha("".join(run)) for run in runs]
    return (nodes[0] if nodes else None), paths


def brute_manifest(rows):
    """[(doc_id, source, leaf)] -> {(doc_id, source, leaf): (subroot, root, path)}."""
    groups = {}
    for d, s, h in rows:
        groups.setdefault(s, []).append((d is not None, d or 0, h))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort()
        trees[s] = brute_tree([h for *_, h in groups[s]])
    root, over = brute_tree([trees[s][0] for s in order])
    out = {}
    for k, s in enumerate(order):
        subroot, paths = trees[s]
        for (named, d, h), path in zip(groups[s], paths):
            out.setdefault((d if named else None, s, h), []).append((subroot, root, path + over[k]))
    return out


def check_manifest(spark, rows):
    leaves = spark.createDataFrame(rows, "doc_id long, source string, leaf string")
    got = {}
    for r in merkle.prove(leaves, "source", "doc_id").collect():
        got.setdefault((r.doc_id, r.source, r.leaf), []).append((r.subroot, r.root, [(s.left, s.right) for s in r.proof]))
        own = r.leaf
        for s in r.proof:
            own = sha(s.left + own + s.right)
        assert own == r.root
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in brute_manifest(rows).items()}


@pytest.mark.parametrize("sizes", [(1,), (2,), (16,), (17,), (256,), (257, 1, 3), (4100, 273, 16)])
def test_manifest_equals_brute_force(spark, sizes):
    names = ["b", None, "ü"]
    rows = [(7 * i % 100_003, names[g], sha(f"{g} {i}")) for g, n in enumerate(sizes) for i in range(n)]
    random.Random(3).shuffle(rows)
    check_manifest(spark, rows)


def test_manifest_of_many_groups_ties_and_nulls(spark):
    rows = [(i, f"s{i}", sha(str(i))) for i in range(300)]
    rows += [(5, "s5", sha("again")), (5, "s5", sha("again")), (None, "s5", sha("n")), (None, None, sha("m")), (2, "", sha("e"))]
    check_manifest(spark, rows)
    assert merkle.prove(spark.createDataFrame([], "doc_id long, source string, leaf string"), "source", "doc_id").count() == 0


def test_leaves_and_changed_rows(spark, clashing):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = clashing.withColumn("leaf", merkle.digest([F.col(c) for c in fields])).withColumn("root", F.lit("old"))
    proven = merkle.prove(rows.drop("text"), "source", "doc_id")
    assert set(proven.columns) == {*rows.columns, "subroot", "root", "proof"} - {"text"}
    want = Counter()
    for r in clashing.collect():
        want[sha("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in fields))] += 1
    assert Counter(r.leaf for r in proven.collect()) == want
    changed = F.when(F.col("doc_id") == 1, F.sha2(F.lit("other"), 256)).otherwise(F.col("leaf"))
    folded = proven.select("doc_id", (merkle.fold(changed, F.col("proof")) == F.col("root")).alias("ok")).collect()
    assert all(r.ok == (r.doc_id != 1) for r in folded)


# --- search -----------------------------------------------------------------------------------------------------------


def brute_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_search(docs, items, top=20):
    found = [(d, Counter(brute_terms(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for name, text in items:
        scores = []
        for d, c in found:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // total
            s = sum(w[t] * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in brute_terms(text) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(name, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def texts(n, seed, long=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "The", "THE", "é", "É", "中文", "x_y", "a-b", "1,2"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(long))) for _ in range(n)]


@pytest.mark.parametrize("values", [50, 2_000_000])
@pytest.mark.parametrize("block", [1, 400, 4_000_000])
def test_search_equals_brute_force(spark, documents, monkeypatch, values, block):
    monkeypatch.setattr(lexical, "_VALUES_AT_ONCE", values)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    docs = [*enumerate(texts(70, 1)), (3, "the w1"), (3, "the w1"), (None, "the w1 w2"), (900, None), (901, ""), (902, "w5 " * 5000)]
    n_items = 6 if block == 1 else 15
    items = [*enumerate(texts(n_items, 2, 15)), (50, None), (51, "..."), (52, "unheard of"), (53, "w5 w5 w5 the The"), (None, "w9 é")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    got = lexical.search(documents(docs), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items)


def test_search_of_odd_tables(spark, clashing):
    items = spark.createDataFrame([("a", "same text here"), ("a", "NAME number"), (None, "words")], "item_id string, text string")
    rows = [(r.doc_id, r.text) for r in clashing.collect()]
    want = brute_search(rows, [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, lexical.search(clashing, items).collect()), key=str) == want
    assert lexical.search(clashing.limit(0), items).count() == 0
    assert lexical.search(clashing, items.limit(0)).count() == 0


def test_shared_sets_are_added_up_once():
    shared = " ".join(f"s{i}" for i in range(8))
    queries = [f"{shared} own{i} s0" for i in range(10)] + ["alone", "", None]
    graph = lexical.plan(queries)
    assert graph.additions < 7 + 3 + 3 * 10 < sum(max(0, len(lexical.terms(q)) - 1) for q in queries)
    # Every query's nodes come down to its terms, each as often as it occurs.
    down = {i: Counter({t: 1}) for t, i in graph.vocabulary.items()}
    at = len(graph.vocabulary)
    for left, right in graph.levels:
        for a, b in zip(left.tolist(), right.tolist()):
            down[at] = down[a] + down[b]
            at += 1
    for q, a, b in zip(queries, graph.starts, graph.starts[1:]):
        assert sum((down[n] for n in graph.parts[a:b].tolist()), Counter()) == Counter(lexical.terms(q))


# --- mixing -----------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    """{source: words} -> {source: target}: shares by weight, whoever is above three times its size is held there."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    held = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in held)
        weight = sum(w[s] for s in order if s not in held)
        want = {s: 3 * sizes[s] if s in held else left * w[s] / weight for s in order}
        over = {s for s in order if s not in held and want[s] > 3 * sizes[s]}
        if not over:
            return want
        held |= over


@pytest.fixture
def corpus(spark):
    rng = random.Random(8)
    rows = []
    for s, n in (("a", 5), ("b", 400), ("c", 300), ("d", 40), ("é", 200), (None, 150), ("z", 2)):
        rows += [(len(rows) + k, " ".join(["word"] * rng.choice((1, 5, 20, 100, rng.randrange(900)))), s) for k in range(n)]
    rows += [(9999, None, "b"), (9998, " \t", "b"), (None, "no name here", "c"), (None, "no name here", "c"), (1, "a b c", "d"), (1, "a b c", "d")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("mine")).withColumn("k", F.lit(0))


def test_mix_meets_its_targets(corpus):
    mixed = mixing.mix(corpus)
    rows = mixed.collect()
    assert len(rows) == corpus.count() and [c for c in mixed.columns if c != "copies"][:3] == ["doc_id", "source", "k"]
    sizes = Counter()
    for r in corpus.collect():
        sizes[r.source] += len((r.text or "").split())
    want = brute_targets(dict(sizes))
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * want[r.source] + 1e-9
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6
    for s, target in want.items():
        assert abs(taken[s] - target) <= max(0.01 * target, 1 if s in ("a", "z") else 10)
    again = mixing.mix(corpus.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.repeated(mixed).count() == sum(r.copies for r in rows)


def test_copies_are_whole_parts_and_a_fraction_by_odds(spark):
    rows = [(i, " ".join(["w"] * 10), "s" if i < 1000 else "t") for i in range(1600)]
    mixed = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for source, ids in (("s", range(1000)), ("t", range(1000, 1600))):
        expected = mixed[ids[0]].target / mixed[ids[0]].source_size
        copies = Counter(mixed[i].copies for i in ids)
        assert set(copies) <= {math.floor(expected), math.floor(expected) + 1}
        assert abs(sum(k * n for k, n in copies.items()) - expected * len(ids)) <= 1  # the sample's size is fixed


def test_weights_within_a_source(spark):
    rows = [(i, " ".join(["w"] * 10), "abc"[i % 3], (0.0, 1.0, 3.0, None, 50.0)[i % 5]) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    got = mixing.mix(df, weight="weight").collect()
    assert all(r.copies == 0 for r in got if not r.weight) and all(r.copies == 3 for r in got if r.weight == 50 and r.source == "a")
    for source in "abc":
        mine = [r for r in got if r.source == source]
        bound = 3 * sum(r["size"] for r in mine if r.weight)
        assert abs(sum(r.taken for r in mine) - min(mine[0].target, bound)) <= 10
        one, three = (np.mean([r.copies for r in mine if r.weight == w]) for w in (1.0, 3.0))
        assert three >= min(2.5 * one, 3) - 0.25


def test_mix_of_odd_tables(clashing):
    mixed = mixing.mix(clashing)
    assert mixed.count() == clashing.count()
    assert mixing.mix(clashing.limit(0)).count() == 0
    empty = mixing.mix(clashing.withColumn("text", F.lit(None).cast("string")))
    assert {(r["size"], r.target, r.taken) for r in empty.collect()} == {(0, 0.0, 0)}
