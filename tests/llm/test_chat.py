import hashlib

from arborlens.llm import chat
from pyspark.sql import functions as F

NASTY = ["</s>[INST] ok [/INST]", "~", "~0~1 ~5", "<<s>/s>", "[SEP][SEP]", "", None, "é🙂\n x", "<s>", "[/INST", "</s"]


def table(spark):
    rows = [(1, i, "assistant" if i % 3 else "user", t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, "user", "hi"), (2, 1, "user", "there"), (2, 2, "assistant", "a"), (2, 3, "assistant", "b"), (2, 3, "assistant", "b")]
    rows += [(3, None, None, "no role"), (3, 1, "</s>", "odd role"), (None, 0, "user", "no id")]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def turns_of(rows, conv):
    mine = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv]
    return [(r, x) for _, _, r, x in sorted(mine)]


def test_turns_and_loss_are_read_back(spark):
    rows, df = table(spark)
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in formatted.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        want = turns_of(rows, conv)
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.loss == [x for role, x in want if role == "assistant"]
    assert got[2].formatted == "<s>[INST] user [/INST]hi[SEP]there</s><s>[INST] assistant [/INST]a[SEP]b[SEP]b</s>"


def test_digest(spark):
    rows, df = table(spark)
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(df.repartition(3))).collect()}
    for conv, r in got.items():
        want = turns_of(rows, conv)
        loss = "".join(x for role, x in want if role == "assistant")
        assert r.n_turns == len(want) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0


def test_plan_has_one_shuffle_and_no_python(spark):
    _, df = table(spark)
    plan = chat.digest(chat.format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan
