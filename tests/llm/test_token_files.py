import json
import os
import zlib

import numpy as np
import pytest
from arborlens.llm import token_files as tf
from arborlens.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
ROWS = [(5, "Hello, world!"), (None, "no id"), (3, None), (3, ""), (3, "same id, other text"), (9, "x" * 5000 + " end"), (9, "x" * 5000 + " end"), (-4, "naïve café 日本 <|endoftext|> a")]


def expected(rows):
    library = tokenizers.Tokenizer.from_file(vocabulary())
    library.no_truncation(), library.no_padding()
    return {(i, t): [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("records") / "set")
    df = spark.createDataFrame([(t, i, 1) for i, t in ROWS], "text string, doc_id long, record int").repartition(3)
    keep, tf.PART_BYTES = tf.PART_BYTES, 2000  # several parts
    try:
        tf.write(df, path, vocabulary())
    finally:
        tf.PART_BYTES = keep
    return path


def test_reads_back_what_the_library_says(spark, folder):
    ids = expected(ROWS)
    got = sorted(tf.read(spark, folder).collect(), key=lambda r: r.record)
    assert [r.record for r in got] == list(range(len(ROWS)))
    assert [r.doc_id for r in got] == [None, -4, 3, 3, 3, 5, 9, 9]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert sorted((r.doc_id is not None, r.doc_id or 0, list(r.token_ids)) for r in got) == sorted((i is not None, i or 0, ids[i, t]) for i, t in ROWS)
    assert all(r.n_tokens == len(r.token_ids) and r.ids_crc32 == zlib.crc32(np.array(r.token_ids, "<u4").tobytes()) for r in got)
    assert len(json.load(open(f"{folder}/manifest.json"))["parts"]) > 1


def test_any_piece_size_and_permutations(spark, folder):
    whole = {r.record: tuple(r.token_ids) for r in tf.read(spark, folder).collect()}
    for size in (1, 100, 10_000):
        df = tf.read(spark, folder, "record long, token_ids array<int>", piece_bytes=size)
        assert {r.record: tuple(r.token_ids) for r in df.collect()} == whole
    orders = []
    for seed in (1, 2, 1):
        got = tf.read(spark, folder, "record long, token_ids array<int>", seed=seed, piece_bytes=3000).collect()
        assert {r.record: tuple(r.token_ids) for r in got} == whole and len(got) == len(ROWS)
        orders.append([r.record for r in got])
    assert orders[0] == orders[2] != orders[1]
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        assert sorted(tf.permuted(np.arange(n), n, 5).tolist()) == list(range(n))


def test_damage_is_found(spark, folder, tmp_path):
    import shutil

    for at, what in ((0, "length"), (14, "payload")):
        copy = str(tmp_path / f"copy{at}")
        shutil.copytree(folder, copy)
        name = f"{copy}/{json.load(open(f'{copy}/manifest.json'))['parts'][0]['name']}.rec"
        data = bytearray(open(name, "rb").read())
        data[at] ^= 1
        os.chmod(name, 0o644)
        open(name, "wb").write(data)
        with pytest.raises(Exception, match=f"{what} of the record at 0 is damaged"):
            tf.read(spark, copy).collect()


def test_leftovers_of_failed_attempts_are_not_read(spark, folder):
    before = tf.read(spark, folder).count()
    open(f"{folder}/part-00000000-dead.rec", "wb").write(tf.frame(b"\x01\x00"))
    assert tf.read(spark, folder).count() == before


def test_empty_table(spark, tmp_path):
    tf.write(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), vocabulary())
    assert tf.read(spark, str(tmp_path / "none")).count() == 0


def test_frames():
    assert tf.payload_of(tf.frame(b"abc"), 0, "") == b"abc"
    crc = zlib.crc32(b"abc")
    assert tf.masked(b"abc") == ((crc >> 15 | crc << 17) + 0xA282EAD8) % 2**32
