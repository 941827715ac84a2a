"""op12 and op13 against their SQL over small tables of odd rows, and against plain Python."""

import hashlib
import random
import zlib

import pytest
from arborlens.llm import filter_audit, merkle
from arborlens.llm.queries import ORACLE_SQL, QUERIES
from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")
SCHEMA = "text string, doc_id long, source string, lang string, n_chars long, mask int, _n long, part string"


def odd_rows():
    r = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "naïve", "日本", "x y", "#", "tab\tend"]
    texts = ["", None, "one", "A" * 10, " ".join(["same"] * 300), " ".join(f"w{i}" for i in range(250)), "line\nline\n", "\n", "ünï code"]
    texts += [" ".join(r.choice(words) + str(r.randint(0, 300)) for _ in range(r.choice([5, 199, 200, 260]))) + r.choice(["", "\n", " &"]) for _ in range(60)]
    rows = []
    for i in range(140):
        rows.append((r.choice(texts), r.choice([None, *range(100)]), r.choice([None, "", "hot", "hot", "hot", "hot", "é", "z", "one"]), r.choice([None, "en"]), r.choice([None, 7])))
    rows += [("t", 500, "lonely", None, 1)] + [rows[0]] * 3 + [("copy", 600 + i, "hot", "en", 4) for i in range(9)]
    return [(*x, 1, 2, "p") for x in rows]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    r = random.Random(4)
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(5).write.parquet(str(folder / "documents.parquet"))
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 100, 2)] + [(4, 1, 1), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(folder / "labels.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_merkle"])
def test_equals_sql(spark, tables, name):
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.sql(f"create view {t} as select * from '{tables}/{t}.parquet/*.parquet'")
    got, want = QUERIES[name](spark, tables), db.sql(ORACLE_SQL[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    at = [want.columns.index(n) for n in names]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


def test_audit_by_hand(spark):
    docs = spark.createDataFrame([(1, "s", "word"), (2, "s", "word"), (3, "s", " ".join(f"w{i}" for i in range(200)) + " #")], "doc_id long, source string, text string")
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(docs, labels).collect()}
    assert len(got) == 600
    first = got["EABCD", 1]
    assert (first.kept, first.removed, first.redundant, first.unique_fails, first.good_lost, first.toxic_lost) == (2, 1, 0, 0, 1, 0)
    then = got["EABCD", 2]
    assert (then.kept, then.removed, then.redundant, then.good_lost) == (1, 1, 1, 0)
    assert (got["ABCDE", 4].removed, got["ABCDE", 4].unique_fails, got["ABCDE", 4].toxic_lost, got["ABCDE", 5].redundant) == (1, 1, 1, 1)
    assert got["ABCDE", 1].shapley + got["ABCDE", 5].shapley == 2 * 120
    assert filter_audit.audit(docs.limit(0), labels).count() == 0


def test_many_parts_and_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "MOST_PARTS", 3)
    docs = spark.createDataFrame([(i, f"s{i % 11}", "copy" if i % 3 else f"own {i}") for i in range(300)], "doc_id long, source string, text string")
    got = filter_audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).where("filter_order = 'EDCBA' and step = 1").collect()
    assert len(got) == 11 and sum(r.removed for r in got) == 199 and sum(r.kept for r in got) == 101


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The root, and for each leaf its siblings by level as (left, right)."""
    around = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, grouped = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a : a + 3]
            for k in range(len(run)):
                for i in members[a + k]:
                    around[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha(*run))
            grouped.append(sum(members[a : a + 3], []))
        nodes, members = above, grouped
    return nodes[0], around


@pytest.mark.parametrize("sizes", [[1], [2], [1, 1], [9, 1, 28], [3, 4, 1, 10, 2]])
def test_manifest_equals_plain_python(spark, sizes):
    rows = [(100 * s + i, f"g{s}", f"text {i}\n") for s, n in enumerate(sizes) for i in range(n)]
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, s, t: sha(field(i), field(s), field(t))
    want, subroots = {}, []
    for s in range(len(sizes)):
        mine = [r for r in rows if r[1] == f"g{s}"]
        root, around = tree([leaf(*r) for r in mine])
        subroots.append((root, mine, around))
    top, over = tree([x[0] for x in subroots])
    for (sub, mine, around), up in zip(subroots, over, strict=True):
        for (i, s, t), own in zip(mine, around, strict=True):
            path = own + up
            odd = zlib.crc32(str(i).encode()) % 2
            at = leaf(i, s, t if odd else t.replace("\n", ""))
            for a, b in path:
                at = sha(a, at, b)
            want[i] = (leaf(i, s, t), sub, top, sha(*(a + b for a, b in path)), at, bool(odd))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    changed = {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))}
    got = merkle.verify(df, changed, fields=("doc_id", "source", "text")).collect()
    assert {r.doc_id: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got} == want


def test_manifest_of_an_empty_table(spark):
    assert merkle.verify(spark.createDataFrame([], SCHEMA), {}).count() == 0
