"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tickframe.llm import registry, sentencepiece_bpe

from ..conftest import SMALL
from .helpers import awkward, empty

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return sentencepiece_bpe.Encoder(PATH)


ODD = ["", " ", "  ", "a", "a ", "  a  b", " " * 7, "aaaa aaaaaaa", " " * 50 + "x", "\n\n\t x\ny", "日本語のテキスト", "🙂🙂 é́ ▁x ▁▁", None,
       "<s> </s> <unk> <0x41>", "\x00a", "12345 67890", "....... ------- =====", " ⁇ ", "▁", "x" + " " * 5000 + "y", " " * 3333,
       "a" * 4000 + "=" * 2500 + "the" * 1500, "-" * 7001, "ab\r\ncd"]


def test_ids_and_texts_equal_the_library(library, encoder):
    pick = random.Random(1)
    texts = list(ODD)
    for alphabet, n in (("ab ▁n.-=*#_/\\ \n\tteinérsß1234日語🙂", 4000), ("  -=*#_./\\", 4000), ("the and in ▁", 2000)):
        texts += ["".join(pick.choice(alphabet) for _ in range(pick.randint(1, 60))) for _ in range(n)]
    for text, ids in zip(texts, encoder.encode(pa.array(texts))):
        wanted = library.encode(text or "")
        assert ids.tolist() == wanted, repr(text)
        assert encoder.vocabulary.decode(wanted) == library.decode(wanted), repr(text)


def test_any_ids_decode_like_the_library(library, encoder):
    pick = random.Random(3)
    for _ in range(5000):
        ids = [pick.choice([pick.randint(0, 31999), pick.randint(0, 260), pick.randint(0, 3)]) for _ in range(pick.randint(1, 8))]
        assert encoder.vocabulary.decode(ids) == library.decode(ids), ids


def test_long_parts_equal_rounds(encoder):
    ids, bounds = encoder.vocabulary.encode_words(["=" * 300, "-" * 900])
    flat = [encoder.vocabulary._merge_long(*args)[0].tolist() for args in (
        (encoder.vocabulary.encode_words(["="])[0].repeat(300).astype("int64"), 0),
        (encoder.vocabulary.encode_words(["-"])[0].repeat(900).astype("int64"), 0))]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == flat


def digests(library, text):
    ids = library.encode(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query_over_the_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in registry.op10_sentencepiece(spark, SMALL).collect()}
    assert got == {d: digests(library, t) for d, t in texts.items()}


def test_awkward_rows(spark, library):
    docs, rows = awkward(spark)
    got = sentencepiece_bpe.digests(docs.selectExpr("*", "1 AS n_tokens", "2 AS ids"), PATH).collect()
    order = lambda x: sorted(x, key=str)
    assert order((r.doc_id, (r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in got) == order((r[0], digests(library, r[1])) for r in rows)
    assert sentencepiece_bpe.digests(empty(spark), PATH).count() == 0


def test_frames_round_trip(spark):
    docs, _ = awkward(spark)
    coded = sentencepiece_bpe.encode(docs.selectExpr("doc_id", "text", "source AS ids"), PATH)
    assert coded.columns == ["doc_id", "text", "ids"]
    back = sentencepiece_bpe.decode(coded, PATH, out="decoded").collect()
    assert all(r.decoded == (r.text or "") for r in back)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto
    model = proto.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        sentencepiece_bpe.Vocabulary(str(tmp_path / "m"))
