import random
import re

from arborlens.llm import pii
from pyspark.sql import functions as F

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

TEXTS = [
    None,
    "",
    "nothing here",
    "a@b.com_x@c.com and .x@y.z.w, bad@host, é@ü.de q%+-@a-b.c-d.e",
    "ip 1.2.3.4 1.2.3.256 1.2.3.4.5 0001.02.3.4 999999999999999999999999.1.1.1 1..2.3.4 1.2.3",
    "card 4111 1111-1111 1111, 4111111111111111 4111111111111112 41111111111111111111",
    "call +1 (523) 555-1055 or +12345678, +1-2 +1234567890123456 ++1 2345678 +1(5)",
    "日本 x@y.zz 語 10.0.0.1 🙂 +44 20 7946 0958",
    "a" * 5000 + "@" + "b" * 5000 + ".c",
    "1" * 30000 + " 1.2.3.4" + "x" * 30000,
    "0000.0.0.0 12.34.56.78",
    "4111111111111111 4111111111111111",
    "a@b" + ".c" * 100_000,
    "0" * 28 + "300.1.1.1 " + "0" * 28 + "999.1.1.1 " + "0" * 40 + "255.0.00.1 256.1.1.1",
    "x@y.z 1.2.3.4 " * 3000,
]


def brute(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
                if not 16 <= len(d) <= 19 or s % 10:
                    continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(found)


def test_base_spans_equal_plain_patterns(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = rows.select("doc_id", pii.spans_text(pii.base_spans(F.coalesce("text", F.lit("")))).alias("s")).collect()
    assert {r.doc_id: r.s for r in got} == {i: brute(t) for i, t in enumerate(TEXTS)}


def bootstrapped(spark):
    good = ["4111111111111111", "4012888888881881", "4222222222222220", "4532015112830366", "4556737586899855", "4916338506082832", "4929252676080870"]
    good = [g for g in good if brute(g)]
    rows = [(i, f"please pay with card {g} today at once") for i, g in enumerate(good)]
    rows += [(50, "please pay with card 4111111111111112 today at once"), (51, "the serial 20240101 was built"), (52, None), (53, ""), (50, "please pay with card 4111111111111112 today at once")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_patterns_of_seeds_find_an_unseen_number_and_nothing_else(spark):
    got = {r.doc_id: r for r in pii.find(bootstrapped(spark)).collect()}
    assert got[50].base_spans == []
    assert [(s.kind, s.start, s.end) for s in got[50].pii_spans] == [("card", 21, 37)]
    assert got[51].pii_spans == [] and got[52].pii_spans == [] and got[53].pii_spans == []
    assert all(got[i].pii_spans == got[i].base_spans != [] for i in range(5))


def test_a_base_finding_is_found_in_its_bare_form_elsewhere(spark):
    rows = [(1, "ring +1 (555) 123-4567 now"), (2, "or 1 (555) 123-4567 then"), (3, "x1234567@mail.example.com"), (4, "part 1234567 there")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].base_spans == [] and [(s.kind, s.start, s.end) for s in got[2].pii_spans] == [("phone", 3, 19)]
    assert all(got[i].pii_spans == got[i].base_spans for i in (1, 3, 4))


def test_contexts_find_other_shapes_and_secrets(spark):
    rows = [(i, f"you can call Anna on +1 (523) 555-10{i:02d} until noon") for i in range(20)]
    rows += [(30, "you can call Anna on 523-555-1099 until noon"), (31, "order number 523-555-1099-77 is late"), (32, "until 2024 they call Anna"), (40, 'token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" x'), (41, "seen f33e61083db5dbdf4bd2369d2f80176e57f7fda2 here"), (42, "the build abcdef0123456789abcdef is fine, password: required"), (43, "mail a.b@mail.example.com")]
    got = {r.doc_id: [(s.kind, s.value) for s in r.pii_spans] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[30] == [("phone", "523-555-1099")]
    assert got[31] == got[32] == got[42] == []
    assert got[40] == got[41] == [("secret", "f33e61083db5dbdf4bd2369d2f80176e57f7fda2")]
    assert got[43] == [("email", "a.b@mail.example.com")]


def discovered(rows, rounds=3, accept=0.6, least_support=5):
    """Brute force of the pattern graph, for texts whose findings are cards alone and whose instances are numbers of one group."""
    graph, seeds = set(), set()
    for text in rows:
        base = [tuple(map(int, x.split(":")[1:])) for x in brute(text).split(",") if x]
        for m in re.finditer(r"[0-9]{7,}", text):
            left, right = re.findall(r"\w+", text[: m.start()])[::-1] + ["", ""], re.findall(r"\w+", text[m.end() :]) + [""]
            v, sh = m.group(), f"N{len(m.group())}"
            graph |= {(v, p) for p in (("L", left[0], sh), ("R", sh, right[0]), ("S", sh), ("C", left[1], left[0]), ("D", left[0], right[0]))}
            if any(a < m.end() and m.start() < b for a, b in base):
                seeds.add(v)
    values = {v for v, _ in graph}
    belief = {v: float(v in seeds) for v in values}
    of = lambda k, x: [g for g in graph if g[k] == x]
    for _ in range(rounds):
        conf = {p: sum(belief[v] for v, _ in of(1, p)) / (len(of(1, p)) + 1) for p in {p for _, p in graph}}
        mean = lambda ps: sum(conf[p] for p in ps) / len(ps)
        belief = {v: 1.0 if v in seeds else max(mean([p for _, p in of(0, v) if (p[0] in "CD") == x]) for x in (True, False)) for v in values}
    supported = {p for _, p in graph if sum(v in seeds for v, _ in of(1, p)) >= least_support}
    return seeds | {v for v in values if round(belief[v], 9) >= accept and any(p in supported for _, p in of(0, v))}


def test_discovery_equals_brute_force(spark):
    r = random.Random(8)
    words = ["pay", "card", "with", "the", "and"]

    def number(n, good):
        while True:
            x = "".join(r.choice("123456789") for _ in range(n))
            if bool(brute(x)) == good:
                return x

    texts = [f"{r.choice(words)} {r.choice(words)} {number(16, r.random() < 0.8)} {r.choice(words)}" for _ in range(150)]
    texts += [f"{r.choice(words)} {r.choice(words)} {number(r.choice([8, 12]), False)} {r.choice(words)}" for _ in range(30)]
    found = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("_seeds", pii.base_spans(F.col("t")))
    got = {x.value for x in pii.discover(found, "t", accept=0.55).collect()}
    want = discovered(texts, accept=0.55)
    assert got == want and len(want) > sum(bool(brute(t)) for t in texts)


def test_redaction_keeps_everything_else(spark):
    rows = spark.createDataFrame([(1, "mail a@b.cc or +12345678 end"), (2, "clean"), (3, None)], "doc_id long, text string")
    found = pii.find(rows)
    got = {r.doc_id: r.t for r in found.select("doc_id", pii.redact(F.col("text"), F.col("pii_spans")).alias("t")).collect()}
    assert got == {1: "mail [EMAIL] or [PHONE] end", 2: "clean", 3: None}


def test_redaction_covers_overlapping_spans_whole(spark):
    rows = spark.createDataFrame([(1, "at 10.0.0.0 4111 1111 1111 1111 end")], "doc_id long, text string")
    spans = pii.base_spans(F.col("text"))
    assert rows.select(pii.redact(F.col("text"), spans)).first()[0] == "at [IP][CARD] end"


def test_empty_table_and_clashing_names(spark):
    rows = spark.createDataFrame([], "doc_id long, text string, pii_spans int")
    assert pii.find(rows).columns == ["doc_id", "text", "pii_spans", "base_spans", "_pii_spans"]
    assert pii.find(rows).count() == 0
