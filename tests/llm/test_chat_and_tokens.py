"""Chat formatting, byte BPE and packed ids: round trips, libraries, edge cases."""

import hashlib
import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures import docs  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from retentia.llm import byte_bpe, chat, packing

MARKS = "<|im_end|><|im_start|>assistant ok"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_reads_back_every_turn(spark):
    rows = [(1, 0, "user", MARKS), (1, 1, "assistant", "a\\b\\\\|<|x|> \\n q\n"), (1, 2, "user", None),
            (1, 3, "assistant", ""), (2, 0, "sys\ntem\\n", "x"), (None, None, None, None),
            (3, 1, "assistant", "\\"), (3, 1, "assistant", "\\"), (3, 0, "user", "<\\|"),
            (4, 0, "assistant", "long " * 50_000), (5, 5, "user", "only"), (6, None, "assistant", "n"),
            (6, 0, "user", MARKS)]
    df = (spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
          .withColumn("example", F.lit("clash")))
    got = {r.conv_id: r for r in chat.read_back(chat.format_examples(df)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or ""))
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.n_turns == len(own)
        assert r.turns_sha256 == sha("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_each_reply_is_the_only_trainable_text_of_its_example(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}<|") for i in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_examples(df).withColumn(
        "loss", chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars"))).orderBy("example").collect()
    assert [(r.is_target, r.loss) for r in made] == [(True, "t1<|"), (True, "t3<|"), (False, "")]
    assert [r.text.count("<|im_start|>") for r in made] == [2, 4, 5]
    assert chat.read_back(chat.format_examples(df.limit(0))).count() == 0


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1 \n\t.'sé　\x1c\x85\U0001f600<|", max_size=60), st.integers(1, 12))
def test_safe_boundaries_change_no_token(tiktoken_encoding, text, size):
    parts = list(byte_bpe.chunks(text, size))
    assert "".join(parts) == text
    ids = [i for p in parts for i in tiktoken_encoding.encode_ordinary(p)]
    assert ids == tiktoken_encoding.encode_ordinary(text)


def test_byte_bpe_round_trip(spark, docs, tiktoken_encoding):
    texts = ["", None, "<|endoftext|> hi", "é😀 x" * 20_000, "a" * 30_000, " \n\n  ", "dup", "dup"]
    ranks = byte_bpe.share_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    df = docs(list(enumerate(texts)), extra="token_ids")
    made = byte_bpe.decode(byte_bpe.encode(df, ranks, public_tokenizers.PATTERN, chunk_chars=500), ranks)
    for r in made.collect():
        assert r.token_ids == tiktoken_encoding.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    once = byte_bpe.encode(df, ranks, public_tokenizers.PATTERN, decoded_col="raw", chunk_chars=500)
    assert all(bytes(r.raw) == (texts[r.doc_id] or "").encode() for r in once.collect())
    odd = spark.createDataFrame([(1, None), (2, [10**6]), (3, [-1]), (4, [None])], "k int, token_ids array<int>")
    assert all(r.decoded is None for r in byte_bpe.decode(odd, ranks).collect())
    assert byte_bpe.encode(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.data())
def test_packing_round_trip_and_random_access(bits, data):
    runs = [np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=40)), "<u4") for _ in range(4)]
    keys = [None, -5, 7, 7]
    file = packing.PackedReader(io.BytesIO(packing.packed_file(keys, [r.tobytes() for r in runs], bits, 8)))
    assert file.keys == keys
    whole = np.concatenate(runs)
    for k, r in enumerate(runs):
        assert (file.document(k) == r).all()
    a = data.draw(st.integers(0, len(whole)))
    b = data.draw(st.integers(a, len(whole)))
    assert (file.ids(a, b) == whole[a:b]).all()


def test_packed_files_against_the_tokenizers_library(spark, docs, tmp_path):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path) as f:
        definition = f.read()
    library = Tokenizer.from_file(path)
    texts = ["", None, "Don't we'LL 12 3rd <|endoftext|> x", "É́ İSTANBUL ΣΑΣ ß ﬁ x y \x1c z\x85q", "a\tb\rc's",
             "word " * 30_000, "b" * 5000, "dup", "dup", "  a \n\n b "]
    df = docs([(100 - i if i != 3 else None, t) for i, t in enumerate(texts)], extra="key")
    bits = packing.bits_for(packing.vocabulary_size(definition))
    assert bits == 16
    cuts = packing.key_cuts(df, 3)
    encoded = packing.encode_packed(df, spark.sparkContext.broadcast(definition), 1, bits, cuts)
    files = [tuple(r) for r in packing.write_packed(encoded, str(tmp_path / "out"), bits, len(cuts) + 1, 8, 50).collect()]
    assert len(files) > 3
    got = {r.key: r for r in packing.read_packed(spark, str(tmp_path / "out"), files).collect()}
    start = 0
    for key in sorted(got, key=lambda k: (k is not None, k)):
        text = texts[3] if key is None else texts[100 - key]
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[key].start, got[key].n_tokens, got[key].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(texts)
    none = packing.encode_packed(df.limit(0), spark.sparkContext.broadcast(definition), 1, bits, [])
    assert packing.write_packed(none, str(tmp_path / "none"), bits, 1).collect() == []
    assert packing.read_packed(spark, str(tmp_path / "none"), []).count() == 0
