"""Operators that work row by row: quality rules, licence scan, BPE, toxicity."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendmill.llm import bpe, license_scan, quality_rules, toxicity
from trendmill.llm.common import vocabulary
from trendmill.llm.license_texts import KNOWN

from llm.conftest import PROSE, prose

BYTES = vocabulary("byte_bpe_50k.json")


# --- quality rules ---------------------------------------------------------------------------------------------------

def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(k for i in places for k in range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(documents):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "one", "a b c d e f g h a b c d e f g h", "x " * 40, "a\n\na\n a\nb\nb"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(40)]
    texts += ["\n".join(rng.choice(("line one", "#two", "")) for _ in range(9)) for _ in range(9)]
    rows = quality_rules.measure(documents(enumerate(texts))).collect()
    for r in rows:
        q = r.quality
        n_words, n_repeat = q.n_words, q.n_repeat_words
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute_measures(r.text), r.text
        assert q.base_failed == (n_words < 20 or 100 * n_repeat > 30 * n_words)


def test_divergence_keeps_prose_and_rejects_other_histograms(documents):
    odd = " ".join(f"{w}%%%$$" for w in prose(200).split())
    rows = quality_rules.measure(documents([(1, prose(200)), (2, odd), (3, odd[:150])])).orderBy("doc_id").collect()
    assert [r.quality.kept for r in rows][:2] == [True, False]
    assert rows[2].quality.class_divergence is None  # too short to judge
    assert rows[0].quality.class_divergence < 0.1


def test_js_divergence_is_that_of_the_definition(spark):
    p, q = (0.5, 0.5, 0.0), (0.25, 0.25, 0.5)
    got = spark.range(1).select(quality_rules.js_divergence([F.lit(x) for x in p], [F.lit(x) for x in q])).first()[0]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    assert got == pytest.approx((kl(p) + kl(q)) / 2)


def test_other_languages_and_gibberish_go(spark):
    import random

    rng = random.Random(5)
    def prose_of(lang, n=200):  # noqa: E306
        words, weights = zip(*quality_rules.WORD_REFERENCE[lang].items())
        return " ".join(rng.choices(words, weights)[0] if rng.random() < 0.25 else f"{lang}{rng.choice('abcdefgh')}{rng.choice('klmnop')}o"
                        for _ in range(n))
    gibberish = " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=6)) for _ in range(200))
    rows = [(k, prose_of(k), k, True) for k in quality_rules.WORD_REFERENCE] + [
        ("salad", gibberish, "en", False), ("spanish", prose_of("es"), "en", False), ("english", prose_of("en"), "es", False),
        ("short", " ".join(gibberish.split()[:80]), "en", True), ("unknown", gibberish, "xx", True)]
    got = quality_rules.measure(spark.createDataFrame([r[:3] for r in rows], "doc_id string, text string, lang string")).collect()
    assert [(r.doc_id, r.quality.kept) for r in got] == [(r[0], r[3]) for r in rows]


def test_quality_of_odd_rows(clashing):
    judged = quality_rules.measure(clashing, into="verdict")
    assert judged.columns == [*clashing.columns, "verdict"] and judged.count() == clashing.count()
    assert judged.filter("verdict.kept is null").count() == 0
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns and kept.count() <= 2
    assert quality_rules.keep_good(clashing.limit(0)).count() == 0


# --- licence scan ----------------------------------------------------------------------------------------------------

def found(df):
    return sorted((r.doc_id, r.scope, r.unit, r.license_id) for r in df.collect())


def test_known_texts_have_an_anchor_and_are_found(documents):
    assert all(re.search(license_scan.ANCHOR, text) for _, text in KNOWN)
    texts = [text.upper().replace(" ", "  ").replace("LICENSE", "LICENCE") for _, text in KNOWN]
    rows = license_scan.scan(documents(enumerate(texts))).filter("scope = 'document'").collect()
    assert {r.doc_id: r.license_id for r in rows} == {i: name for i, (name, _) in enumerate(KNOWN)}


def test_copyright_lines_and_spellings_do_not_matter(documents):
    mit = dict(KNOWN[::-1])["MIT"]
    head, body = mit.split(" ", 2)[:2], mit.split(" ", 2)[2]
    text = f"{' '.join(head)}\n\nCopyright (c) 2024 Someone\n(C) 1999 Another\n\n{body.replace('sublicense', 'sub-licence')}"
    rows = found(license_scan.scan(documents([(1, text), (2, text + " More."), (3, "see the license")])))
    assert [r for r in rows if r[1] == "document"] == [(1, "document", 0, "MIT")]
    assert {r[0] for r in rows} <= {1}


def test_scopes_of_a_notice_inside_a_document(documents):
    text = "First line\n\nReleased under the MIT License.\n\nLast, with no licence."
    assert found(license_scan.scan(documents([(1, text)]))) == [(1, "block", 1, "MIT"), (1, "line", 2, "MIT")]


def whole_text(key):
    return max((text for name, text in KNOWN if name == key), key=len)


LONG = ["Apache-2.0", "CC0-1.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-1.1", "MPL-2.0"]


def test_long_licences_are_found_whole_and_as_comments(documents):
    assert all(len(whole_text(key)) > 5000 for key in LONG)
    texts = []
    for key in LONG:
        text = whole_text(key)
        texts += [text, "/*\n" + "\n".join(f" * {line}" for line in text.split("\n")) + "\n */", text + "\nMore terms."]
    rows = license_scan.scan(documents(enumerate(texts)))
    got = {r.doc_id: r.license_id for r in rows.filter("scope = 'document'").collect()}
    assert got == {3 * k + form: key for k, key in enumerate(LONG) for form in (0, 1)}


@pytest.mark.parametrize("line", [
    "Copyright (c) 2020 Foo", "Copyright 2020 The Authors", "Copyright Foo Corp. 2020", "Copyright <YEAR> <HOLDER>",
    "Copyright [yyyy] [name]", "Portions Copyright (c) 1999 Bar", "(C) 1999 Another", "All rights reserved."])
@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", ";; "])
def test_copyright_lines_go_whatever_stands_before(line, mark):
    mit = dict(KNOWN)["MIT"]
    assert license_scan.canonical(f"{mark}{line}\n{mark}{mit}") == license_scan.canonical(mit)
    assert "copyright" in license_scan.canonical("copyright notice and this list of conditions")


def test_titles_bullets_and_identifiers(documents):
    by_name = dict(KNOWN[::-1])
    body = by_name["BSD-3-Clause"]
    bullets = body.replace("1. ", "\n  - ").replace("2. ", "\n  - ").replace("3. ", "\n  - ")
    grant = next(text for name, text in KNOWN if name == "MIT" and text.startswith("Permission"))
    texts = [
        f"The MIT License (MIT)\n\nCopyright (c) 2020 Foo\n\n{grant}",
        f"BSD 3-Clause License\n\nCopyright (c) 2020, Foo\nAll rights reserved.\n\n{bullets}",
        "// SPDX-License-Identifier: MIT", "# SPDX-License-Identifier: GPL-2.0-or-later",
        "Released under the GNU General Public License, version 3 or any later version.",
        "#!/bin/sh\n\n# MIT License\n#\n# Copyright (c) 2020 Foo\n#\n# " + grant.replace(". ", ".\n#\n# ") + "\n\necho done",
    ]
    rows = found(license_scan.scan(documents(enumerate(texts))))
    assert {r[0]: r[3] for r in rows if r[1] == "document"} == {
        0: "MIT", 1: "BSD-3-Clause", 2: "MIT", 3: "GPL-2.0-or-later", 4: "GPL-3.0-or-later"}
    assert (5, "block", 1, "MIT") in rows


def test_scan_of_odd_rows(clashing):
    assert license_scan.scan(clashing).count() == 0
    assert license_scan.scan(clashing.limit(0)).columns == ["doc_id", "scope", "unit", "license_id", "digest"]


# --- BPE -------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_ids_and_texts_equal_the_library(odd, library):
    rows = bpe.decode(bpe.encode(odd, BYTES), BYTES).collect()
    want = sorted((t or "" for t in (r.text for r in odd.collect())))
    assert sorted(r.text for r in rows) == want
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode(r.text, add_special_tokens=False).ids
        assert r.text == library.decode(ids, skip_special_tokens=False)


def test_random_texts_equal_the_library(library):
    rng = random.Random(5)
    alphabet = "ab'sS t\t ́İ \x1c\x85\xe9\xc91²\xbd\xaa!?<|endoftext|>Σ中가\U0001f642_ \n\n  "
    coder = bpe.Coder(BYTES)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["aaaaaaaaaaaaa", "it's", "don't <|endoftext|>x", "ab" * 5000, "=" * 999]
    for text, ids in zip(texts, coder.encode_all(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_share_the_trie(library):
    words = [b"token", b"tokens", b"tokenizer", b"to", b"t", b"zebra"]
    assert bpe.Vocabulary(BYTES).encode_words(words) == {
        w: library.encode(w.decode(), add_special_tokens=False).ids for w in words}


def test_bpe_passes_null_numbers_and_empty_tables(clashing):
    assert bpe.encode(clashing, BYTES).filter("doc_id is null").count() == 2
    assert bpe.decode(bpe.encode(clashing.limit(0), BYTES), BYTES).count() == 0


# --- toxicity --------------------------------------------------------------------------------------------------------

def labelled(documents, n):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        words = prose(60, rng.randrange(1000)).split()
        for _ in range(rng.randint(2, 5) if i % 5 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(("vileword", "nastyword", "foulword")))
        rows.append((i, " ".join(words)))
    return documents(rows)


def test_held_out_accuracy(spark, documents):
    docs = labelled(documents, 400)
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels.filter("doc_id < 300"), F.col("toxic"), 4, refine=True)
    assert model.thresholds == sorted(model.thresholds)
    rows = toxicity.predict(docs.filter("doc_id >= 300"), model).collect()
    assert all(r.toxic == (r.doc_id % 5 == 0) for r in rows)
    assert all(0 <= r.severity <= 3 and 0 <= r.p_toxic <= 1 and 0 <= r.grade <= 3 for r in rows)


def test_fit_orders_grades():
    rows = [(g, [0, 1], [1.0, float(g) + 0.1 * (i % 3)]) for i in range(60) for g in (0, 1, 2)]
    weights, cuts = toxicity.fit(rows, 2, 3)
    scores = [weights[0] + weights[1] * g for g in (0, 1, 2)]
    assert scores[0] < cuts[0] < scores[1] < cuts[1] < scores[2]


def loss(theta, rows, n_features, ridge=0.2):
    """The regularised loss of weights, first threshold and logarithms of gaps, row by row from its definition."""
    weights, cuts = theta[:n_features], [theta[n_features]]
    for gap in theta[n_features + 1:]:
        cuts.append(cuts[-1] + math.exp(gap))
    total = 0.0
    for grade, places, values in rows:
        score = sum(weights[p] * v for p, v in zip(places, values))
        above = [1.0, *(1 / (1 + math.exp(c - score)) for c in cuts), 0.0]
        total -= math.log(above[grade] - above[grade + 1])
    return (total + ridge / 2 * sum(w * w for w in weights)) / len(rows)


def test_fit_finds_the_least_loss():
    rng = random.Random(11)
    rows = []
    for _ in range(150):
        values = [rng.gauss(0, 1) for _ in range(3)]
        latent = 1.5 * values[0] - values[1] + rng.gauss(0, 1)
        rows.append((sum(latent > c for c in (-0.5, 0.8, 2.0)), [0, 1, 2], values))
    weights, cuts = toxicity.fit(rows, 3, 4)
    assert list(cuts) == sorted(cuts)
    theta = [*weights, cuts[0], *(math.log(b - a) for a, b in zip(cuts, cuts[1:]))]
    least = loss(theta, rows, 3)
    for i in range(len(theta)):
        up, down = ([t + (h if j == i else 0) for j, t in enumerate(theta)] for h in (1e-4, -1e-4))
        assert abs(loss(up, rows, 3) - loss(down, rows, 3)) / 2e-4 < 2e-3
    for _ in range(200):
        near = [t + rng.gauss(0, 0.3) for t in theta]
        assert loss(near, rows, 3) >= least - 1e-6


def test_severity_of_graded_labels(documents):
    rng = random.Random(3)
    rows, graded = [], []
    for i in range(600):
        words = prose(60, rng.randrange(1000)).split()
        for _ in range(3 * (i % 4)):
            words.insert(rng.randrange(len(words)), rng.choice(("vileword", "nastyword", "foulword")))
        rows.append((i, " ".join(words)))
    docs = documents(rows)
    labels = docs.select("doc_id", (F.col("doc_id") % 4).cast("int").alias("grade"))
    model = toxicity.train(docs, labels.filter("doc_id < 400"), F.col("grade"), 4)
    for r in toxicity.predict(docs.filter("doc_id >= 400"), model).collect():
        assert abs(r.severity - r.doc_id % 4) < 1 and r.toxic == (r.doc_id % 4 > 0)


def test_grades_of_toxic_texts():
    assert toxicity.refined([1, 0, 1, 1], [2.0, 9.0, 1.0, 3.0], 4) == [2, 0, 1, 3]
    assert toxicity.refined([1, 1, 1, 1, 1, 1], [1.0, 1.0, 5.0, 5.0, 5.0, 7.0], 4) == [1, 1, 2, 2, 2, 3]
    assert toxicity.refined([0, 0], [1.0, 2.0], 4) == [0, 0] and toxicity.refined([], [], 4) == []


def test_evidence_comes_from_the_other_half():
    # Feature 1 marks toxic texts in half 0, feature 2 in half 1: neither half's model knows the other's.
    rows = [([0, 1 + half], [1.0, float(toxic)]) for half in (0, 1) for toxic in (0, 1) for _ in range(20)]
    toxic = [t for _ in (0, 1) for t in (0, 1) for _ in range(20)]
    half = [h for h in (0, 1) for _ in range(40)]
    blind = toxicity.unseen_evidence(toxic, half, rows, [{1}, {2}], 3)
    assert max(blind) - min(blind) < 1e-6
    shared = [([0, 1], [1.0, float(t)]) for t in toxic]
    told = toxicity.unseen_evidence(toxic, half, shared, [{1}, {1}], 3)
    assert all((e > 0) == (t > 0) for t, e in zip(toxic, told))


def test_without_labels_nothing_is_toxic(clashing, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(clashing, labels, F.col("toxic"), 4, refine=True)
    rows = toxicity.predict(clashing, model).collect()
    assert len(rows) == clashing.count() and not any(r.toxic for r in rows)
    one = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(clashing, one, F.col("toxic"), 4, refine=True)
    assert not any(r.toxic for r in toxicity.predict(clashing, model).collect())
    assert toxicity.predict(clashing.limit(0), model).count() == 0


def test_sample_is_bounded(documents):
    docs = labelled(documents, 50)
    labels = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert toxicity.labelled_sample(docs.union(docs), labels, F.col("toxic"), "text", "doc_id", 20).count() == 20


def test_prose_fixture_is_prose():
    assert len(PROSE) > 100 and hashlib.sha256(PROSE.encode()).hexdigest()
