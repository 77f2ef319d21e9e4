import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import simple8b as s8
from tillroll.llm import token_counts, words

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"
ODD = [
    "", " ", "a  b", " a", "a ", "\n\nx", "it's don't I'LL we've", "<|endoftext|>", "x <|endoftext|> y",
    "<|ENDOFTEXT|> <|startoftext|>a", "naïve Ünder ß ſ İstanbul Σας ΣΑΣ", "1234 56.7 ²³ ½", "日本語 テキスト",
    "a b \x1c x\x85y", "tab\tx \t y", "x\r\ny z\r", "a b👩‍👩", "''s 's's", "ªº µ", "a\x00b", "Zé" * 3000,
]


ODD += ["a\n", "a\n\n", "a\n\nb", "a\n\n\nb", "\n", "\n\n", "\na", "\n\na", "a \nb", "a\n b", "a\n'sb", "\n!\n?", "x,y, \"z\".", "a\r\n\r\nb"]


def mixed(n, seed):
    rng = random.Random(seed)
    parts = ["a", "Zé", " ", "  ", "\n", "\t", "'", "s", "1", "²", "!", "<|", "|>", "endoftext", "ß", "日", "́", "."]
    return ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(n)]


def test_words_encode_as_the_library_does():
    texts = ODD + mixed(60_000, 1)
    library = Tokenizer.from_file(BYTES)
    ids = words.ByteLevelIds(BYTES)
    for text in texts * 2:  # the second time from memory
        assert ids.of(text).tolist() == library.encode(text, add_special_tokens=False).ids, text
    library, counts = Tokenizer.from_file(WORDS), words.WordCounts(WORDS)
    for text in texts * 2:
        assert counts.of(text) == len(library.encode(text, add_special_tokens=False).ids), text
    assert ids.of(None).size == 0 and counts.of(None) == 0


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": {"dropout": 0.0, "end_of_word_suffix": "z"}},
    {"added_tokens": [{"id": 262, "content": "the", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}]},
])
def test_other_tokenizers_go_through_the_library(tmp_path, change):
    with open(BYTES) as file:
        own = json.load(file)
    for name, value in change.items():
        own[name] = own[name] | value if name == "model" else value
    path = tmp_path / "own.json"
    path.write_text(json.dumps(own))
    assert not words._is_as(str(path), "byte_level") and words._is_as(BYTES, "byte_level")
    assert words._is_as(WORDS, "word_end") and not words._is_as(BYTES, "word_end")
    library, ids, counts = Tokenizer.from_file(str(path)), words.ByteLevelIds(str(path)), words.WordCounts(str(path))
    for text in [*ODD, "The theory of the THE", *mixed(300, 7)]:
        found = library.encode(text, add_special_tokens=False).ids
        assert ids.of(text).tolist() == found and counts.of(text) == len(found)


def test_a_full_memory_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(words, "CACHE_WORDS", 3)
    library, ids = Tokenizer.from_file(BYTES), words.ByteLevelIds(BYTES)
    text = "one two three four five six seven one two three, one! two. three eight. nine, ten"
    for _ in range(5):
        assert ids.of(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(ids._words) <= 3 and len(ids._tokens) <= 3 and len(ids._openings) <= 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**60 - 1)), max_size=300))
def test_packing_is_undone(ids):
    given_ids = np.array(ids, np.uint64)
    packed, counts = s8.pack(given_ids)
    assert counts.sum() == len(ids) and s8.unpack(packed, len(ids)).tolist() == ids


def test_packing_is_dense_and_escapes():
    assert s8.pack(np.zeros(600, np.uint64))[0].size == 10
    assert s8.pack(np.full(300, 20_000))[0].size == 75
    escape, _ = s8.pack(np.array([2**59]))
    assert int(escape[0]) >> 60 == s8.ESCAPE
    with pytest.raises(ValueError):
        s8.pack(np.array([2**60], np.uint64))


def test_blocks_read_in_ranges():
    rng = np.random.default_rng(2)
    documents = [rng.integers(0, 50_000, n).astype(np.uint64) for n in (0, 3, 5000, 1, 4000)]
    block = s8.write_block(documents)
    ids, sizes = s8.read_block(block)
    assert ids.tolist() == np.concatenate(documents).tolist() and sizes.tolist() == [0, 3, 5000, 1, 4000]
    for first, last in ((0, 1), (1530, 1540), (5000, 9004), (9003, 9999), (7, 7)):
        assert s8.read_range(block, first, last).tolist() == ids[first:last].tolist()
    assert s8.read_block(s8.write_block([]))[0].size == 0
    with pytest.raises(ValueError):
        s8.read_block(b"x" * 64)


def expected(rows):
    library, start, out = Tokenizer.from_file(BYTES), 0, []
    for name, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_hold_the_ids_in_order(spark, make, tmp_path):
    rows = [(k, t) for k, t in enumerate(ODD + mixed(200, 3))] + [(1000, None)]
    frame = make.frame(rows, SCHEMA).orderBy(F.rand(1)).withColumn("id", F.lit("clash"))
    path = s8.write_ids(frame, BYTES, str(tmp_path / "ids"), block_ids=500)
    got = sorted(tuple(r) for r in s8.read_ids(spark, path).collect())
    assert got == expected(rows)


def test_repeated_and_missing_ids_and_empty_tables(spark, make, tmp_path):
    rows = [(None, "b"), (5, "x"), (5, "x"), (5, "a"), (None, "a b")]
    path = s8.write_ids(make.frame(rows, SCHEMA), BYTES, str(tmp_path / "ids"))
    got = sorted((tuple(r) for r in s8.read_ids(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 5, 5, 5] and got[-1][1] + got[-1][2] == sum(r[2] for r in got)
    path = s8.write_ids(make.frame([], SCHEMA), BYTES, str(tmp_path / "none"))
    assert s8.read_ids(spark, path).count() == 0


def test_ids_query_equals_the_library(spark):
    from tillroll.llm.queries import op2_simple8b_ids

    folder = f"{TESTDATA}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    assert sorted(map(tuple, op2_simple8b_ids(spark, folder).collect())) == expected(map(tuple, docs))


def test_counts_come_from_the_store(spark, make, tmp_path, rows):
    store = str(tmp_path / "store")
    docs = [(1, "A b  c"), (2, " a b c\n"), (3, "A b c"), (4, None), (5, ""), (5, "")]
    frame = make.frame(docs, SCHEMA).withColumns({"digest": F.lit(1), "n_tokens": F.lit(2)})
    first = rows(token_counts.token_counts(frame, WORDS, store))
    assert first == [(1, 6, 3), (2, 7, 3), (3, 5, 3), (4, 0, 0), (5, 0, 0), (5, 0, 0)]
    stored = spark.read.parquet(store).count()
    assert stored == 3  # "A b c", "a b c" and the empty text
    assert rows(token_counts.token_counts(frame, WORDS, store)) == first
    assert spark.read.parquet(store).count() == stored
    more = frame.union(frame.limit(1).selectExpr("9L", "'new text'", "1", "2"))
    assert (9, 8, 2) in rows(token_counts.token_counts(more, WORDS, store))
    assert spark.read.parquet(store).count() == stored + 1
    assert token_counts.token_counts(frame.limit(0), WORDS, store).count() == 0


def test_a_marked_count_in_the_store_is_used(spark, make, tmp_path, rows):
    store = str(tmp_path / "store")
    frame = make.frame([(1, "a b")], SCHEMA)
    token_counts.token_counts(frame, WORDS, store)
    spark.read.parquet(store).withColumn("n_tokens", F.lit(77).cast("long")).write.parquet(store + "-marked")
    assert rows(token_counts.token_counts(frame, WORDS, store + "-marked")) == [(1, 3, 77)]


def test_counts_query_equals_the_library(spark):
    from tillroll.llm.queries import op9_digest_counts

    folder, library = f"{TESTDATA}/sf0.001", Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = []
    for i, text in docs:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted.append((i, len((text or "").encode()), n, n > 2048))
    assert sorted(map(tuple, op9_digest_counts(spark, folder).collect())) == sorted(wanted)
