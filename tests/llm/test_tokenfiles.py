"""Files of token ids against the tokenizers library."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, patched, queries, tokenfiles
from millrace.session import scratch

from .conftest import rows

PATH = public_tokenizers.path("word_bpe_49k.json")
SPEC = bpe.vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.mark.parametrize("n", [0, 1, 63, 1023, 1024, 1025, 70_000])
@pytest.mark.parametrize("most", [1, 2, 50_000, 2**32])
def test_blocks_round_trip(n, most):
    values = np.random.default_rng(n).integers(0, most, n).astype(np.uint32)
    values[::97] = most - 1
    blocks = patched.encode(values)
    starts = np.cumsum([0] + [len(b) for b in blocks])[:-1]
    assert len(blocks) == -(-n // patched.BLOCK)
    assert (patched.decode(b"".join(blocks), starts) == values).all()


def test_outliers_are_exceptions():
    values = np.full(1024, 7, np.uint32)
    values[[3, 700]] = 49_000
    assert len(patched.encode(values)[0]) == patched._HEAD_SIZE + 2 * 6


def test_strings_like_the_library(library):
    r = random.Random(5)
    letters = "aé'stREvelld ÀİΣσς,.;!?1²٣<|>\x1c\x1f\xa0　 \n\t東京ЁїǅՀ-_\x85﻿​́"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += ["a<|endoftext|>b.", "<|startoftext|>", "don't, they'll. I'VE!", "x" * 5000, "'s's 'S.", "Word$$$ (word) word's,"]
    encoder = tokenfiles.WordEncoder(SPEC)
    for _ in range(2):
        assert encoder.ids(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_only_strings_of_other_characters_go_through_the_whole_library(library):
    r = random.Random(6)
    stems = ["".join(r.choice("abcdeéèüßñςΣЁї") for _ in range(r.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(r.choice(stems + [s.upper() for s in stems]) + r.choice(["", ".", "!?"]) for _ in range(200)) for _ in range(20)]
    texts += ["x" * 49 + " Ü" + "ü" * 60, "ʹ Aʹb, ʹ", "word 76.244.80.188"]
    encoder = tokenfiles.WordEncoder(SPEC)
    whole, sent = tokenfiles.Known.whole, []
    tokenfiles.Known.whole = lambda self, strings: sent.extend(strings) or whole(self, strings)
    try:
        got = encoder.ids(texts)
    finally:
        tokenfiles.Known.whole = whole
    assert got == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert set(sent) == {".", "!?", ",", "x" * 49, "Ü" + "ü" * 60, "76.244.80.188"}
    assert not any(len(w) > tokenfiles.LONGEST_REMEMBERED for w in encoder.known)


def test_strings_come_back_from_the_older_half(library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 8)
    encoder = tokenfiles.WordEncoder(SPEC)
    texts = ["One two, three. Fünf!", "two, Three 1.5", "fünf one ONE! 1.5 x", "two, three fünf"]
    for t in texts * 2:
        assert encoder.ids([t]) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()]


def test_writer_closes_files_and_index_opens_any_range(monkeypatch):
    monkeypatch.setattr(tokenfiles, "FILE_IDS", 5_000)
    monkeypatch.setattr(tokenfiles, "SEGMENT", 2 * patched.BLOCK)
    r = np.random.default_rng(2)
    docs = [(k, r.integers(0, 49_408, n).astype("<u4")) for k, n in enumerate([0, 1, 4000, 3, 900, 100, 12_000, 7, 0])]
    writer = tokenfiles.Writer(4)
    bodies = [b for k, ids in docs if (b := writer.add(k, ids.tobytes()))] + [writer.close()]
    files = [tokenfiles.Reader(b + b"\n") for b in bodies]
    assert [(f.part, f.number) for f in files] == [(4, 0), (4, 1), (4, 2)] and writer.close() is None
    assert [k for f in files for k in f.keys] == list(range(9))
    flat = np.concatenate([ids for _, ids in docs])
    assert (np.concatenate([f.ids(0, f.n_ids) for f in files]) == flat).all()
    one = files[1].ids(0, files[1].n_ids)
    for a, b in [(0, 1), (1023, 1025), (2048, 2048), (5000, 9999), (3, 3), (12_000, 99_999)]:
        assert (files[1].ids(a, b) == one[a:b]).all()


def expected(library, docs):
    start, out = 0, []
    for k, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_is_brute_force(spark, sf_dir, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op12_token_files(spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(library, docs)


def test_edges(spark, edge, empty, library):
    path = scratch(spark, "ids")
    tokenfiles.write(edge, SPEC, path)
    got = [tuple(r) for r in tokenfiles.positions(spark, path).collect()]
    assert collections.Counter(g[0] for g in got) == collections.Counter(r[0] for r in rows())
    by_start = sorted(got, key=lambda g: g[1])
    assert [g[0] for g in by_start] == sorted((r[0] for r in rows()), key=lambda k: (k is None, k))
    assert all(a[1] + a[2] == b[1] for a, b in zip(by_start, by_start[1:])) and by_start[0][1] == 0
    want = collections.Counter((k, n, crc) for k, _, n, crc in expected(library, [(r[0], r[1]) for r in rows()]))
    assert collections.Counter((g[0], g[2], g[3]) for g in got) == want
    ids = {r.key: r.ids for r in tokenfiles.read(spark, path, ids=True).where("key in (4, 8)").collect()}
    assert ids == {4: [1], 8: library.encode("one two", add_special_tokens=False).ids + [1]}
    path = scratch(spark, "ids")
    tokenfiles.write(empty, SPEC, path)
    assert tokenfiles.positions(spark, path).count() == 0


def test_one_repeated_row_is_dealt_to_many_tasks(spark):
    docs = spark.range(4000).select(F.lit(5).alias("doc_id"), F.lit("the same words").alias("text")).repartition(6)
    path = scratch(spark, "ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokenfiles.write(docs, SPEC, path, end_id=None)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = tokenfiles.read(spark, path)
    assert found.select("part").distinct().count() >= 6
    starts = [r.start for r in tokenfiles.positions(spark, path).orderBy("start").collect()]
    assert starts == [3 * k for k in range(4000)]
