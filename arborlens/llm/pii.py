"""Personal data by patterns and by bootstrapped contextual extraction, with DataFrame functions only.

Base kinds, each leftmost and without overlaps: e-mail addresses, IP addresses, card numbers
(Luhn) and phone numbers, with their places in code points. Beside them, values that are
assigned to a name of a secret (``token = "..."``) are seeds of the kind secret.

Bootstrapping: instances are numbers of 7 digits or more and long tokens of letters and digits.
An instance that overlaps a base finding or a secret is a seed. Each instance has lexical
patterns: its shape (digit groups and what stands between them, or the length of a token) with
the word on its left, with the word on its right and by itself; and its context without its
shape: the two words on its left, and the words on both sides. In each round a pattern's
confidence is the mean belief in its values, drawn towards 0 by one value, and an unseeded
value's belief is the mean confidence of its patterns with shape or of those of context alone,
whichever is higher. After some rounds, values believed at ``accept`` or more, through patterns
with the support of ``least_support`` different seeds, are added with the kind of the seeds of
their best supported pattern, equal ones of the kind that comes last by name. A value that
is a finding in one place is added with its kind wherever else it stands, unless it overlaps a
base finding there. Patterns and values are aggregated before they are joined, so one that a third
of all texts have is a row like others; patterns and values of many rows of the graph are
joined by a broadcast of at most HOT rows.

Null texts count as empty and have no findings. Rows are independent in the base search;
repeated rows get equal results, and copies count once for support, as values are distinct.
An empty table gives an empty result. Long runs of digits or letters are read in linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlens.llm.common import cut, cut_small, fresh

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
# \G and the look-behind start a match only where a run of its characters begins or the last match ended: what the plain
# pattern finds, without trying each place of a long run. Possessive groups are loops, not recursion, in Java.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Names that secrets are assigned to.
SECRET_NAMES = "token|secret|password|passwd|api_key|apikey|api-key|access_key|private_key"
NAMED = rf"(?i)(?:{SECRET_NAMES})[\"']?\s{{0,3}}[:=]"
ASSIGNED = rf"(?<=[:=\s\"'])(?<=(?i:{SECRET_NAMES})[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?)[A-Za-z0-9_+/=.-]{{8,}}+"
NUMBER = r"[(]?[0-9](?:[\x20().:/-]{0,2}[0-9])++"
# a run that has both a digit and a letter
MIXED = r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])"
TOKEN = MIXED + r"[A-Za-z0-9][A-Za-z0-9_+/=-]{15,}+"
LEAST_DIGITS = 7
HAS_INSTANCE = r"[0-9](?:[\x20().:/-]{0,2}[0-9]){6}|" + MIXED + r"[A-Za-z0-9][A-Za-z0-9_+/=-]{15}"
WORD_AFTER = r"^[^\p{L}\p{N}_]*+([\p{L}\p{N}_]++)"
TWO_BEFORE = WORD_AFTER + r"(?:[^\p{L}\p{N}_]++([\p{L}\p{N}_]++))?+"

SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
#: Keys that are joined by broadcast hold more than one in HOT of all rows, so there are HOT at most.
HOT = 500
#: Numbers added up at once.
CHUNK = 128


def running(of: Column) -> Column:
    """The sums of the first 1, 2, ... of an array of ints, by chunks, so that a text of very many matches takes no square time."""
    fold = lambda a: F.aggregate(a, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x)))
    chunked = lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int")), lambda i: fold(F.slice(a, i * CHUNK + 1, CHUNK)))
    before = lambda chunks: fold(F.concat(F.array(F.lit(0)), F.transform(chunks, lambda c: F.coalesce(F.get(c, F.size(c) - 1), F.lit(0)))))
    whole = lambda chunks: F.flatten(F.zip_with(F.slice(before(chunks), 1, F.size(chunks)), chunks, lambda b, c: F.transform(c, lambda x: x + b)))
    return let(of, lambda a: F.when(F.size(a) <= CHUNK, fold(a)).otherwise(let(chunked(a), whole)))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, pattern: str, kind: str, context: bool = False) -> Column:
    """Places and values of all matches: array of (kind, start, end, value), end exclusive, in code points; with context also the words before and after. Null where there are none."""

    def placed(p: Column) -> Column:
        n = F.size(p["v"])
        sizes = F.zip_with(F.slice(p["b"], 1, n), p["v"], lambda b, v: F.char_length(b) + F.char_length(v))
        words = []
        if context:
            word = lambda c, x, k: F.lower(F.regexp_extract(c, x, k))
            around = F.zip_with(F.slice(p["b"], 1, n), F.slice(p["b"], 2, n), lambda b, a: F.struct(F.reverse(b).alias("b"), a.alias("a")))
            words = [F.transform(around, lambda s: F.struct(F.reverse(word(s["b"], TWO_BEFORE, 1)).alias("left"), F.reverse(word(s["b"], TWO_BEFORE, 2)).alias("left2"), word(s["a"], WORD_AFTER, 1).alias("right")))]
        each = F.arrays_zip(p["v"].alias("v"), running(sizes).alias("end"), *[w.alias("w") for w in words])
        at = lambda x: [F.lit(kind).alias("kind"), (x["end"] - F.char_length(x["v"])).alias("start"), x["end"].alias("end"), x["v"].alias("value")]
        return F.when(n > 0, F.transform(each, lambda x: F.struct(*at(x), *[x["w"][c].alias(c) for c in ("left", "left2", "right") if words])))

    return let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("v"), F.split(text, pattern, -1).alias("b")), placed)


def _or_none(spans: Column, when: Column | None = None) -> Column:
    some = spans if when is None else F.when(when, spans)
    return F.coalesce(some, F.array().cast(SPAN))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    d = F.filter(F.split(F.reverse(number), ""), lambda x: x != "")
    doubled = F.transform(d, lambda x, i: x.cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    total = F.aggregate(doubled, F.lit(0), lambda acc, x: acc + F.when(x > 9, x - 9).otherwise(x))
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """All base findings, by kind as listed and then by place."""
    # parts are compared without leading zeros, so that no number can be too long for the cast
    part_ok = lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
    ip_ok = lambda x: F.forall(F.split(x["value"], r"\."), part_ok)
    card_ok = lambda x: F.char_length(digits(x["value"])).between(16, 19) & luhn(digits(x["value"]))
    phone_ok = lambda x: F.char_length(digits(x["value"])).between(8, 15)
    # a cheap look first: most texts hold none of these signs
    number = text.rlike(r"[0-9]")
    return F.concat(
        _or_none(matches(text, PATTERNS["email"], "email"), F.contains(text, F.lit("@"))),
        _or_none(F.filter(matches(text, PATTERNS["ip"], "ip"), ip_ok), number),
        _or_none(F.filter(matches(text, PATTERNS["card"], "card"), card_ok), number),
        _or_none(F.filter(matches(text, PATTERNS["phone"], "phone"), phone_ok), F.contains(text, F.lit("+"))),
    )


def secret_spans(text: Column) -> Column:
    """Values with a digit that are assigned to a name of a secret."""
    return _or_none(F.filter(matches(text, ASSIGNED, SECRET), lambda s: s["value"].rlike("[0-9]")), text.rlike("[0-9]") & text.rlike(NAMED))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def shape(value: Column) -> Column:
    """Of a number, digit groups as N and their length with what stands between them; of a token, its length and whether it is hexadecimal."""
    groups = F.array_join(F.transform(F.regexp_extract_all(value, F.lit(r"[0-9]+|[^0-9]+"), F.lit(0)), lambda g: F.when(g.rlike("^[0-9]"), F.concat(F.lit("N"), F.char_length(g).cast("string"))).otherwise(g)), "")
    token = F.concat(F.when(value.rlike("^[0-9A-Fa-f]+$"), "X").otherwise("W"), F.char_length(value).cast("string"))
    return F.when(value.rlike("[A-Za-z]"), token).otherwise(groups)


def instance_spans(text: Column, context: bool = False) -> Column:
    """Numbers of LEAST_DIGITS or more, and tokens with letters and digits; null where there are none."""
    numbers = F.filter(matches(text, NUMBER, "number", context), lambda s: F.char_length(digits(s["value"])) >= LEAST_DIGITS)
    tokens = matches(text, TOKEN, "token", context)
    return F.when(has_instance(text), F.flatten(F.array_compact(F.array(numbers, tokens))))


def has_instance(text: Column) -> Column:
    return text.rlike("[0-9]") & text.rlike(HAS_INSTANCE)


def _meets(spans: Column, s: Column) -> Column:
    return F.filter(spans, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def instances(found: DataFrame, text: str) -> DataFrame:
    """A row per instance: value, shape, left, left2, right, the kind of the finding that it overlaps (seed) or null, and that of the one that it is in another form (whole) or null. found has base findings and secrets in ``_seeds``."""
    each = found.select("_seeds", F.explode(instance_spans(F.col(text), True)).alias("_s"))
    s = F.col("_s")
    seed = _meets(F.col("_seeds"), s)
    same = lambda b: F.when(b["kind"] == SECRET, b["value"] == s["value"]).otherwise((b["kind"] != "email") & (digits(b["value"]) == digits(s["value"])))
    return each.select(
        s["value"].alias("value"), shape(s["value"]).alias("shape"), s["left"].alias("left"), s["left2"].alias("left2"), s["right"].alias("right"),
        F.get(seed, F.lit(0))["kind"].alias("seed"), F.get(F.filter(seed, same), F.lit(0))["kind"].alias("whole"),
    )


def _hot(graph: DataFrame, key: str, rows: int) -> DataFrame | None:
    """The keys of more than one in HOT of the rows, if any."""
    hot = cut_small(graph.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(1000, rows / HOT)).select(key))
    return None if hot.isEmpty() else hot


def _lookup(big: DataFrame, small: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """big joined with small's one row of each key; the rows of hot keys (HOT at most) stay where they are."""
    if hot is None:
        return big.join(small, key)
    marked = big.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    few = F.broadcast(small.join(F.broadcast(hot), key, "left_semi"))
    return marked.where("_hot is null").drop("_hot").join(small, key).unionByName(marked.where("_hot").drop("_hot").join(few, key))


def discover(found: DataFrame, text: str, rounds: int = 3, accept: float = 0.6, least_support: int = 5) -> DataFrame:
    """(value, kind) of instances that are findings somewhere, and of those that stand in the patterns of findings."""
    seen = instances(found, text)
    name = lambda *parts: F.concat_ws("|", *[F.lit(p) if len(p) == 1 else F.col(p) for p in parts])
    patterns = F.array(name("L", "left", "shape"), name("R", "shape", "right"), name("S", "shape"), name("C", "left2", "left"), name("D", "left", "right"))
    graph = cut(seen.select("value", "seed", "whole", F.explode(patterns).alias("pattern")).groupBy("value", "pattern").agg(F.max("seed").alias("seed"), F.max("whole").alias("whole")))
    rows = graph.count()
    hot_patterns, hot_values = _hot(graph, "pattern", rows), _hot(graph, "value", rows)
    plain = F.substring("pattern", 1, 1).isin("C", "D")
    # kinds of the seeds of each pattern, and how many different ones there are
    support = cut_small(graph.groupBy("pattern").agg(F.count("seed").alias("support"), F.mode("seed", True).alias("kind")).where(F.col("support") >= least_support))
    values = cut_small(graph.groupBy("value").agg(F.max(F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0)).alias("belief"), F.max("seed").alias("known")))
    for _ in range(rounds):
        scored = cut_small(_lookup(graph, values, "value", hot_values).groupBy("pattern").agg((F.sum("belief") / (F.count(F.lit(1)) + 1)).alias("confidence")))
        means = [F.round(F.avg(F.when(x, F.col("confidence"))), 9) for x in (plain, ~plain)]
        held = _lookup(graph, scored, "pattern", hot_patterns).groupBy("value").agg(F.greatest(*means).alias("mean"), F.max("seed").alias("known"))
        values = cut_small(held.select("value", F.when(F.col("known").isNotNull(), 1.0).otherwise(F.col("mean")).alias("belief"), "known"))
    sure = graph.where(F.col("whole").isNotNull()).groupBy("value").agg(F.max("whole").alias("kind"))
    new = values.where(F.col("known").isNull() & (F.col("belief") >= accept)).select("value")
    ranked = _lookup(graph.join(new, "value", "left_semi"), support, "pattern", hot_patterns)
    return ranked.groupBy("value").agg(F.max(F.struct("support", "kind")).getField("kind").alias("kind")).where(F.col("kind").isNotNull()).unionByName(sure)


def find(docs: DataFrame, text: str = "text", spans: str = "pii_spans", **settings: object) -> DataFrame:
    """docs with base_spans and all spans (base, secrets and discovered), each an array of (kind, start, end, value) by kind and place. Names that clash get a leading underscore.

    The discovered values meet the texts again by a join on the instances, not by a broadcast.
    """
    names = docs.columns
    base_name, span_name = fresh(names, "base_spans"), fresh(names, spans)
    secret, key, hit = (fresh(names, x) for x in ("_secrets", "_row", "_hits"))
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = docs.select(t.alias("_text")).where(has_instance(F.col("_text"))).withColumn("_seeds", F.concat(base_spans(F.col("_text")), secret_spans(F.col("_text"))))
    new = cut_small(discover(found, "_text", **settings))
    base = docs.withColumn(base_name, base_spans(t)).withColumn(secret, secret_spans(t))
    # only the instances of texts that have any are looked up, and only these texts meet the finds again; the others never move
    some, digest = has_instance(t), F.sha2(t, 256)
    # those that overlap a finding are found already
    clear = lambda s: F.size(_meets(F.concat(base_name, secret), s)) == 0
    each = base.where(some).select(digest.alias(key), F.explode(F.filter(instance_spans(t), clear)).alias("s")).select(key, "s", F.col("s.value").alias("value")).distinct()
    hits = each.join(new, "value").groupBy(key).agg(F.collect_set(F.struct(F.col("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("value"))).alias(hit))
    joined = base.where(some).withColumn(key, digest).join(hits, key, "left").drop(key)
    every = joined.unionByName(base.where(~some).withColumn(hit, F.lit(None).cast(SPAN)))
    place = lambda k: reduce(lambda acc, x: acc.when(k == x[1], x[0]), list(enumerate((*KINDS, SECRET)))[1:], F.when(k == KINDS[0], 0))
    ranked = F.transform(F.concat(base_name, secret, F.coalesce(hit, F.array().cast(SPAN))), lambda s: F.struct(place(s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    ordered = F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    return every.withColumn(span_name, ordered).drop(secret, hit)


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first, or the longer of two that begin together, and then what the others reach beyond it."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        beyond = -s["minus"] > acc["at"]
        added = F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(beyond, -s["minus"]).otherwise(acc["at"]).alias("at"), F.when(beyond, added).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(by_place, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
