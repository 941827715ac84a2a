import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from arborlens.llm import langid, licences, quality, toxicity
from pyspark.sql import functions as F

LANGUAGES = {"aa": "the of and ing tion er on", "bb": "der ein ich sch und ung keit", "cc": "les que eau oi ment ère"}


def sentence(r, lang, n):
    parts = LANGUAGES[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def labelled():
    r = random.Random(1)
    rows = []
    for i in range(400):
        words = sentence(r, "aa", r.randint(5, 120)).split()
        toxic = i % 5 == 0
        for _ in range(r.randint(1, 8) if toxic else 0):
            words.insert(r.randrange(len(words) + 1), r.choice(["vile", "rotten"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def model_of(spark, rows, **settings):
    """rows: id, text, grade."""
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, y int")
    return toxicity.fit(toxicity.sample(docs, labels, F.col("y"), 10_000), **settings)


def test_toxicity_on_held_out_rows(spark):
    rows = labelled()
    model = model_of(spark, [(i, t, y * (1 + (i % 10 == 0))) for i, t, y in rows if i % 4])
    assert (np.diff(model.thresholds) >= 0).all() and len(model.thresholds) == 2 and {"vile", "rotten"} <= set(model.weights)
    df = spark.createDataFrame([*rows, (900, None, 0), (901, "", 0), (902, "VILE!", 1), (902, "VILE!", 1), (903, "vile " + "of " * 200_000, 1)], "doc_id long, text string, toxic int")
    got = toxicity.score(df, model).collect()
    assert got[0].__fields__[-3:] == ["expected_severity", "severity_grade", "_toxic"]
    held = [r for r in got if r.doc_id % 4 == 0 or 900 <= r.doc_id < 903]
    assert all(r["_toxic"] == (r.toxic > 0) for r in held)
    assert all(0 <= r.expected_severity <= 2 for r in got)
    both = {r.doc_id: r.expected_severity for r in got}
    assert both[902] > both[901] == both[900] and len(got) == len(rows) + 5
    assert toxicity.score(df.limit(0), model).count() == 0


def test_toxicity_of_a_language_with_few_labels(spark):
    """Five toxic rows of a second language, each with another form of one stem, and unseen forms of it."""
    r = random.Random(6)
    rows = [(t, y) for _, t, y in labelled()]
    forms = [f"schlimm{x}" for x in ("er", "es", "ste", "en", "em")]
    rows += [(sentence(r, "bb", 40) + f" {forms[i]}", 1) for i in range(5)] + [(sentence(r, "bb", 40), 0) for _ in range(60)]
    model = model_of(spark, [(i, *x) for i, x in enumerate(rows)])
    assert all(model.exceed(sentence(r, "bb", 40) + f" schlimm{x}")[0] >= 0.5 for x in ("ung", "keit", "ich"))
    assert all(model.exceed(sentence(r, "bb", 40))[0] < 0.5 for _ in range(50))


def test_severity_needs_no_python_workers_of_a_second_kind(spark, monkeypatch):
    """A list made into rows by parallelize() goes through workers that stay beside those of mapInArrow."""
    docs = spark.createDataFrame([(i, "vile rotten" if i % 3 == 0 else "fine day") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, labels, F.col("toxic"), 4000)
    counted = toxicity.count_terms(rows)
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a, **b: pytest.fail("a list went through parallelize()"))
    assert {r.doc_id for r in toxicity.severity(rows, counted).where("grade > 0").select("doc_id").collect()} == set(range(0, 60, 3))


def test_severity_of_yes_or_no_labels(spark):
    """Grades against a count of the words that tell, in rows of which each half teaches the same ones."""
    rows = labelled()
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, y int")
    rows_of = lambda y: toxicity.sample(docs, y, F.col("y"), 1000)
    got = {r.doc_id: r.grade for r in toxicity.severity(rows_of(labels), toxicity.count_terms(rows_of(labels))).collect()}
    hits = {i: len({"vile", "rotten"} & set(t.split())) for i, t, y in rows if y}
    middle = np.median(list(hits.values()))
    assert got == {i: 1 + (hits[i] > middle) if y else 0 for i, _, y in rows}
    assert toxicity.severity(rows_of(labels.limit(0)), toxicity.count_terms(rows_of(labels.limit(0)))).count() == 0


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y x"), (2, None), (3, "zz")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, 0), (7, 1), (3, None)], "doc_id long, toxic int")
    got = sorted(tuple(x) for x in toxicity.sample(df, labels, F.col("toxic"), 5).collect())
    assert got[:2] == [(1, 1, "x"), (1, 1, "y")] and got[2:] == [(2, 0, None)]
    assert not toxicity.score(df, toxicity.fit(toxicity.sample(df, labels.limit(0), F.col("toxic"), 5))).first()["toxic"]
    assert not toxicity.score(df, toxicity.fit(toxicity.sample(df.limit(0), labels, F.col("toxic"), 5))).first()["toxic"]


def test_likelihood_and_its_gradient():
    """The likelihood against its definition, the gradient against differences."""
    r = np.random.default_rng(5)
    n, m, k = 40, 6, 3
    x = r.random((n, m)) < 0.4
    grades = r.integers(0, k + 1, n)
    row, col = np.nonzero(x)
    w, theta = r.normal(size=m), np.sort(r.normal(size=k))

    def plain(w, theta):
        edges = [-np.inf, *theta, np.inf]
        sig = lambda v: 1 / (1 + np.exp(-v))
        return sum(np.log(sig(edges[g + 1] - v @ w) - sig(edges[g] - v @ w)) for v, g in zip(x, grades, strict=True)) - 0.15 * (w @ w)

    value, gradient = toxicity.loss(w, theta, row, col, grades, 0.3)
    assert value == pytest.approx(plain(w, theta))
    both = np.concatenate([w, theta])
    for i in range(m + k):
        step = np.zeros(m + k)
        step[i] = 1e-6
        up, down = both + step, both - step
        assert gradient[i] == pytest.approx((plain(up[:m], up[m:]) - plain(down[:m], down[m:])) / 2e-6, rel=1e-4, abs=1e-5)


def slow_bits(training, data, order):
    """PPM code length with escapes, one byte at a time."""
    counts = {}
    for o in range(order + 1):
        for i in range(o, len(training)):
            counts.setdefault(training[i - o : i], Counter())[training[i]] += 1
    total = 0.0
    for i, b in enumerate(data):
        p = 1.0
        for o in range(order, -1, -1):
            seen = counts.get(data[i - o : i]) if i >= o else None
            if not seen:
                continue
            n = sum(seen.values())
            if b in seen:
                p *= seen[b] / (n + len(seen))
                break
            p *= len(seen) / (n + len(seen))
        else:
            p /= 256
        total -= np.log2(p)
    return total


def test_ppm_code_lengths_are_exact():
    training, data = b"abracadabra abraca the cat", b"the abracat zz"
    tables = langid.PpmTables.train({"x": training, "y": b"zzz yyy"}, order=3)
    assert tables.lengths(data)[0] == pytest.approx(slow_bits(training, data, 3), rel=1e-4)
    assert tables.lengths(b"")[0] == 0


def test_all_bytes_and_orders_have_exact_code_lengths():
    r = random.Random(8)
    training = bytes(r.choice([r.randrange(256), 65, 66, 200]) for _ in range(3000))
    data = bytes(r.choice([r.randrange(256), 65, 66, 200]) for _ in range(200)) + training[:100]
    few = "日本語 и русский é".encode() * 5
    for order in (0, 1, 2, 3):
        tables = langid.PpmTables.train({"x": training, "y": few, "z": b""}, order=order)
        got = tables.lengths(data)
        assert got[0] == pytest.approx(slow_bits(training, data, order), rel=1e-4)
        assert got[1] == pytest.approx(slow_bits(few, data, order), rel=1e-4)
        assert got[2] == pytest.approx(8 * len(data))


def test_many_languages_share_the_bytes(spark):
    r = random.Random(3)
    alphabets = {f"l{k:03}": [chr(0x400 + r.randrange(2000)) for _ in range(12)] for k in range(300)}
    text = lambda k: "".join(r.choice(alphabets[k]) for _ in range(60))
    df = spark.createDataFrame([(i, text(k), k) for i, k in enumerate(list(alphabets) * 2)] + [(10_000, text("l007"), "l007")] * 3, "doc_id long, text string, lang string")
    got = langid.training_texts(df, F.lit(True), 1000, max_total=30_000)
    assert set(got) == set(alphabets) and all(50 < len(v) <= 100 and v.decode() for v in got.values())
    tables = langid.PpmTables.train(got)
    assert np.mean([tables.predict(text(k))[0] == k for k in alphabets]) > 0.95


def test_long_texts_are_scored_whole(monkeypatch):
    tables = langid.PpmTables.train({"x": b"abracadabra", "y": b"zzz"}, order=2)
    whole = tables.lengths(b"abracadabra" * 50)
    monkeypatch.setattr(langid, "PIECE", 37)
    assert tables.lengths(b"abracadabra" * 50) == pytest.approx(whole)


def test_language_on_held_out_rows(spark):
    r = random.Random(2)
    rows = [(i, sentence(r, lang, r.randint(3, 60)), lang) for i, lang in enumerate(list(LANGUAGES) * 60)]
    df = spark.createDataFrame([*rows, (1000, None, "aa"), (1001, "123 !", "bb"), (1002, "", None)], "doc_id long, text string, lang string")
    tables = langid.PpmTables.train(langid.training_texts(df, F.col("doc_id") % 4 != 2, 3000))
    got = {x.doc_id: x for x in langid.predict(df, tables).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows if i % 4 == 2]) > 0.97
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002))
    assert all(0 <= x.score <= 1 for x in got.values())
    assert langid.predict(df.limit(0), tables).count() == 0
    assert langid.PpmTables.train({}).predict("abc") == ("und", 0.0)


def test_a_language_of_one_long_document_is_learnt(spark):
    import hashlib

    late = [i for i in range(100, 200) if int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16) / 2**52 > 0.5]
    rows = [(i, "the of and ing", "aa") for i in range(100)] + [(late[0], "der ein ich sch " * 5000, "bb")]
    got = langid.training_texts(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), 3000)
    assert got["bb"] == (b"der ein ich sch " * 5000)[:3000] and len(got["aa"]) > 1300


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_statistics(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_statistics_equal_brute_force():
    r = random.Random(3)
    texts = [None, "", " ", "a b c d e a b c d e", "x\x1cy\x85z w", "l\nl\n\nl \n", "é" * 10 + "\r\n#<|>"]
    texts += ["".join(r.choice("ab \n#é") for _ in range(r.randint(0, 400))) for _ in range(300)] + ["To " * 20 + "of " * 20 + "to " * 20]
    assert [tuple(x) for x in quality.statistics(texts).tolist()] == [slow_statistics(t) for t in texts]


def test_forest_keeps_good_rows_and_finds_odd_ones(spark):
    r = random.Random(4)
    good = [(i, "\n".join(sentence(r, "aa", r.randint(5, 30)) for _ in range(r.randint(2, 6)))) for i in range(300)]
    odd = [(1000 + i, " ".join("#$%&" * 3 for _ in range(400 + i)) + "\n" + "\n".join(str(k) for k in range(50))) for i in range(3)]
    df = spark.createDataFrame([*good, *odd, (2000, None), (2001, "too short")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 300, 2)], "doc_id long, quality int")
    forest = quality.fit(df, labels)
    got = {x.doc_id: x for x in quality.with_statistics(df, forest=forest).collect()}
    assert sum(not got[i].kept for i, _ in good) <= 6
    assert all(not got[i].kept for i, _ in odd)
    assert got[2000].base_failed and not got[2000].kept and not got[2001].kept
    assert quality.with_statistics(df.limit(0), forest=forest).count() == 0
    assert quality.fit(df.limit(0), labels).threshold == 1.0


def dice(a, b):
    x, y = licences.grams(licences.normalise(a)), licences.grams(licences.normalise(b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0


def test_licences_equal_brute_force(spark):
    r = random.Random(5)
    texts = [None, "", "MIT", "some prose\nReleased under the MIT License.\nmore", "LICENSED UNDER the apache license version 2.0!!", "Licensed under CC BY-NC 4.0.\n\nReleased under the MIT License."]
    texts += ["Copyright 2020 Example Authors. This work is licensed under the GNU\nGeneral Public License, version 3. See the file COPYING for details.", "Copyright (c) 2001, Someone\n\n" + licences.TEMPLATES["BSD-3-Clause"][0].replace("\n", "\n\n"), "Copyright 2001. All rights reserved. Then some more prose."]
    flat = [(n, t) for n, ts in licences.TEMPLATES.items() for t in ts]
    for _ in range(60):
        words = r.choice(flat)[1].split()
        for _ in range(r.randint(0, 4)):
            words.insert(r.randrange(len(words)), "noise")
        texts.append("intro line here\n" + " ".join(words))
    got = {x.doc_id: x for x in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    matcher = licences.LicenceMatcher(licences.TEMPLATES)
    for i, t in enumerate(texts):
        want = {n for u in matcher.units(t or "") for n, x in flat if dice(" ".join(u), x) >= 0.8}
        words = licences.normalise(t or "")
        for n, x in flat:
            size, pairs = len(licences.normalise(x)), licences.grams(licences.normalise(x))
            for k in range(len(words) - 1):
                if (words[k], words[k + 1]) in pairs and size <= len(words):
                    start = min(k, len(words) - size)
                    want |= {n} if dice(" ".join(words[start : start + size]), x) >= 0.8 else set()
        assert set(got[i].license_ids) == want
        assert (got[i].license_id in want) if want else got[i].license_id is None
    assert got[3].license_id == "MIT" and not got[3].restrictive
    assert got[6].license_id == "GPL-3.0" and got[6].restrictive and got[7].license_id == "BSD-3-Clause" and got[8].license_ids == ["LicenseRef-All-Rights-Reserved"]
    assert licences.scan(spark.createDataFrame([], "doc_id long, dice int, text string")).columns[:4] == ["doc_id", "dice", "text", "license_id"]
    twice = licences.scan(spark.createDataFrame([(1, "x " * 100_000 + texts[6])] * 2, "doc_id long, text string")).collect()
    assert twice[0] == twice[1] and twice[0].license_id == "GPL-3.0"
    assert got[5].license_ids == ["CC-BY-NC-4.0", "MIT"] and got[5].restrictive


def test_terms_found_are_those_of_the_text():
    r = random.Random(12)
    texts = ["", "Vile! rotten-vile ÉTÉ\x1cété x1y", "a" * 500 + " Vile"] + ["".join(r.choice("aV1_-. \n é") for _ in range(60)) for _ in range(200)]
    every = {f for t in texts for w in toxicity.terms(t) for f in toxicity.features(w)}
    model = toxicity.OrdinalModel(dict.fromkeys(sorted(every)[::2], 1.0), np.array([0.0]))
    for t in texts * 2:
        assert model.found(t) == {f for w in toxicity.terms(t) for f in toxicity.features(w)} & model.weights.keys()


def test_bad_rows_raise_the_threshold_and_are_still_found(spark):
    r = np.random.default_rng(3)
    good, bad = r.normal(0.5, 0.05, (400, 2)), r.uniform(0.9, 1.0, (30, 2))
    forest = quality.IsolationForest.grow(good[::2])
    alone = forest.calibrate(good[1::2], bad[:0], 0.02).threshold
    both = forest.calibrate(good[1::2], bad, 0.02).threshold
    caught = forest.score(bad) > alone
    assert both > alone and ((forest.score(bad) > both) == caught).all() and caught.mean() > 0.9
    # one labelled id on many rows is one row of the sample; only bad labels drop nothing
    docs = spark.createDataFrame([(1, "word " * k) for k in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, quality int")
    assert quality.fit(docs, labels).threshold == 1.0
    clash = spark.createDataFrame([(1, "a b", 3), (1, "a b", 3)], "doc_id long, text string, kept int")
    got = quality.with_statistics(clash, forest=quality.fit(docs, labels)).collect()
    assert got[0] == got[1] and got[0].kept == 3 and got[0]["_kept"] is False


def test_forest_and_threshold_count_all_labelled_rows(spark):
    """10,000 labelled ids: more than any bound of a sample; counts of parts are those of the whole."""
    rows = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit(False).alias("base_failed"), F.lit(100).cast("long").alias("n_words"), (400 + F.col("id") % 300).alias("word_chars"), *[(F.col("id") % k).alias(n) for n, k in (("n_symbols", 7), ("n_dup_lines", 3), ("n_repeat_words", 11))])
    labels = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    forest = quality.fit_statistics(rows, labels)
    at = rows.toPandas()
    odd = np.array([zlib.crc32(str(i).encode()) % 2 for i in at.doc_id]) == 1
    x = quality.features(at[list(quality.BASE)].to_numpy())
    assert forest.size == (~odd).sum() > 4000
    alone = quality.IsolationForest.grow(x[~odd]).calibrate(x[odd], x[:0], 0.005)
    assert forest.threshold == alone.threshold and (forest.score(x) == alone.score(x)).all()
    shape = quality.IsolationForest.unfitted(4)
    assert (shape.counts(x[:77]) + shape.counts(x[77:]) == shape.counts(x)).all()
