"""Token blocks against the tokenizers library, and exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickframe.llm import registry, token_binary
from tickframe.session import new_path

from ..conftest import SMALL
from .helpers import awkward, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50), st.integers(0, 31))
@settings(max_examples=150, deadline=None)
def test_coding_round_trip(numbers, shift):
    array = np.array(numbers, np.uint64).astype(np.uint32) >> np.uint32(shift)
    control, data = token_binary.pack(array)
    assert len(control) == -(-len(array) // 4)
    assert len(data) == sum(max(1, -(-int(x).bit_length() // 8)) for x in array)
    assert np.array_equal(token_binary.unpack(control, data, len(array)), array)


def test_texts_equal_the_library(library):
    pick = random.Random(2)
    texts = ["", " ", "  ", "a  b\n\n c", "it's we'll 'sx", "x" * 5000, "\n \n", "日本 a", "<|endoftext|> a", "a\x85b", "a\xa0b",
             "x \n \n y", "a\n  b", "a \n", None, "é ñ 12³ ½ ©®"]
    for alphabet in ("ab 'stre\n\t\r .,!12é³ªº÷×­ ", "ab  c\n", "aé日🙂  \x1c\x85"):
        texts += ["".join(pick.choice(alphabet) for _ in range(pick.randint(1, 40))) for _ in range(2000)]
    got = token_binary.Tokens(PATH).encode(pa.array(texts))
    wanted = library.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in wanted]


def test_other_vocabularies_go_to_the_library_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokens = token_binary.Tokens(path)
    assert not tokens.by_words
    wanted = Tokenizer.from_file(path).encode("Some words, here", add_special_tokens=False).ids
    assert tokens.encode(pa.array(["Some words, here"]))[0].tolist() == wanted


def check(library, df, rows):
    out = {}
    for d, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
    got = sorted(df.collect(), key=lambda r: r.start)
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got)])[:-1]) if got else True
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    seen = {}
    for r in got:
        seen.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in out.items()}


def test_query_over_the_table(spark, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(library, registry.op1_token_binary(spark, SMALL), rows)


def test_awkward_rows_and_clashing_columns(spark, library):
    docs, rows = awkward(spark)
    clashing = docs.selectExpr("*", "1 AS ids", "2 AS start", "3 AS shard")
    check(library, token_binary.digests(clashing, PATH), [(r[0], r[1]) for r in rows])


def test_empty_table(spark):
    assert token_binary.digests(empty(spark), PATH).count() == 0


def test_small_blocks_read_back(spark):
    rows = [(i, np.arange(i, dtype="<u4").tobytes()) for i in range(40)]
    path = new_path(spark, "blocks")
    token_binary.write(spark.createDataFrame(rows, "doc_id long, ids binary"), path, block_ids=16)
    got = {r.doc_id: bytes(r.ids) for r in token_binary.read(spark, path).collect()}
    assert got == dict(rows)
    assert spark.read.parquet(f"{path}/blocks.parquet").count() > 20
