import random

import corpus_pipeline
import pyarrow as pa
from arborlens.llm.bpe import ForcedBoundaryBpe
from arborlens.llm.common import BATCH_BYTES
from arborlens.llm.queries import vocabulary


def write(spark, folder, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_and_run(spark, tmp_path):
    r = random.Random(9)
    words = [f"word{k}" for k in range(500)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs = []
    for i in range(120):
        body = text(40)
        docs.append((i, body + (" vile rotten vile" if i % 6 == 0 else ""), "en", f"src{i % 3}", 0))
    docs[10] = (10, "reach me at someone@mail.example.com " + docs[10][1], "en", "src0", 0)
    copied = docs[13][1]
    docs += [(200, copied, "en", "src1", 0), (201, copied + " extra", "en", "src2", 0), (200, copied, "en", "src1", 0), (None, "no id " + text(20), None, None, None), (300, None, "en", "src0", None), (301, "", "en", "src0", 0)]
    write(spark, str(tmp_path), docs, [(i, 1, int(i % 6 == 0)) for i in range(120)])
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = frame.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == columns, name
        kept[name] = frame.collect()
        frame = spark.createDataFrame(kept[name], "doc_id long, text string, lang string, source string, n_chars long")
    clean = {i for i in range(120) if i % 6} | {200, 201, 300, 301, None}
    assert {x.doc_id for x in kept["toxicity"]} == clean
    ids = [x.doc_id for x in kept["ngram_join"]]
    assert set(ids) == clean - {200, 201} and len(ids) == len(set(ids))
    redacted = {x.doc_id: x.text for x in kept["pii"]}
    assert "[EMAIL]" in redacted[10] and "@" not in redacted[10] and redacted[13] == copied and redacted[300] is None
    assert {x.doc_id for x in kept["mixing"]} <= set(ids)
    last = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).collect()
    bpe = ForcedBoundaryBpe(vocabulary())
    assert sorted((x.doc_id is None, x.doc_id or 0, x.token_ids) for x in last) == sorted((x.doc_id is None, x.doc_id or 0, bpe.encode(x.text or "").tolist()) for x in kept["mixing"])
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((x.doc_id is None, x.doc_id or 0, x.n_tokens) for x in whole) == sorted((x.doc_id is None, x.doc_id or 0, x.n_tokens) for x in last)


def test_every_stage_bounds_the_bytes_of_batches(spark, tmp_path):
    write(spark, str(tmp_path), [(i, f"w{i} " * 50, "en", f"src{i % 2}", 0) for i in range(40)], [(i, 1, i % 2) for i in range(40)])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    wide = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('text ', 1000) AS text")
    size = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes]}) for b in batches)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for stage, run in corpus_pipeline.STAGES:
            spark.conf.unset(name)
            run(spark, docs, str(tmp_path))
            found = wide.mapInArrow(size, "n long, bytes long").collect()
            assert sum(r.n for r in found) == 3000 and max(r.bytes for r in found) < 1.1 * BATCH_BYTES, stage
    finally:
        spark.conf.set(name, before)
