import numpy as np
import pytest
import zlib
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from agroframe.llm import dac, packing
from agroframe.llm.tokens import byte_bpe, encode_in_chunks, encoder, word_bpe

ODD = ["", "İ ǅ ŉ ΣΑΣ", "İ ǅ ŉ ß SS Ÿ", "J̌ A", " ", "a", " a", "a ", "a\t\n\nb", "x y  z", "it's  <|endoftext|> ok", "\n\n\nq\r\nz  ",
       "É é ﬁ ΣΑΣ", "İstanbul İ", "\x1c\x1d a", "日本語 テスト 🎉🎉 x", "I'm  we'll don't", " ́ a", "éx",
       "abc² ²3 x1y", "word, word. (word) a_b and/or", "%%% a%%% $$$", "≠ a≠"]
ROWS = [(3, "b b, bb  end"), (1, None), (2, ""), (None, "no id"), (5, "word " * 3000), (3, "b b, bb  end")] + \
       [(10 + i, t) for i, t in enumerate(ODD)]


@pytest.mark.parametrize("file", [byte_bpe(), word_bpe()], ids=["byte", "word"])
def test_same_ids_as_the_tokenizer(file):
    plain = encoder(file).tokenizer
    for t, got in zip(ODD, encode_in_chunks(file, ODD)):
        assert np.frombuffer(got, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,<|>_aZéß²1́"), st.characters(codec="utf-8")),
                        max_size=40), max_size=6))
def test_same_ids_property(texts):
    for file in (byte_bpe(), word_bpe()):
        plain = encoder(file).tokenizer
        got = [np.frombuffer(b, "<u4").tolist() for b in encode_in_chunks(file, texts, chars=50)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


LONGER = "".join(c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and len(c.lower()) > 1)


def test_dotted_capital_i_beside_other_scripts():
    plain = Tokenizer.from_file(word_bpe().path)
    texts = ["Москва İ, x", "中 aİ-b", "İİ", "x İ", "ΣİΣ ок", "Москва i̇, x"]
    for t, got in zip(texts, encode_in_chunks(word_bpe(), texts)):
        assert np.frombuffer(got, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(LONGER + " -,.aбМ中Σςé\u0307\u0301ßŉǰΐ"), st.characters(codec="utf-8")), max_size=25), max_size=5))
def test_letters_with_longer_lower_case(texts):
    for file, plain in PLAIN.items():
        got = [np.frombuffer(b, "<u4").tolist() for b in encode_in_chunks(file, texts, chars=40)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


PLAIN = {f: Tokenizer.from_file(f.path) for f in (byte_bpe(), word_bpe())}  # fresh tokenizers

ADDED = ["it's <|endoftext|> ok", "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|> c", "It's <|ENDOFTEXT|> ok",
         "A <|EndOfText|> and <|endoftext|>", "<|endoftext|", "日本 <|STARTOFTEXT|> x<|startoftext|>", "  <|endoftext|>\n\n q",
         "<|start oftext|> <| endoftext|>", "é<|endoftext|>É"]


@pytest.mark.parametrize("file", [byte_bpe(), word_bpe()], ids=["byte", "word"])
def test_added_tokens_as_the_plain_library(file):
    """Against a fresh tokenizer, also when the other letter case was learned before."""
    plain, texts = Tokenizer.from_file(file.path), ADDED[::-1] + ADDED + ODD
    for t, got in zip(texts, encode_in_chunks(file, texts, chars=30)):
        assert np.frombuffer(got, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
    assert len(plain.encode(ADDED[0], add_special_tokens=False).ids) == (4 if file.spaces == "dropped" else 5)


def test_added_tokens_in_store_and_pieces(spark, tmpdir_path):
    rows = [(i, t) for i, t in enumerate(ADDED)]
    path, start = f"{tmpdir_path}/store", 0
    dac.write_store(_docs(spark, rows), path, word_bpe(), segment_tokens=20)
    plain = Tokenizer.from_file(word_bpe().path)
    for doc, at, n, crc in sorted(map(tuple, dac.read_documents(dac.open_store(spark, path)).collect())):
        ids = plain.encode(ADDED[doc], add_special_tokens=False).ids + [1]
        assert (at, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += n
    plain = Tokenizer.from_file(byte_bpe().path)
    got = {}
    for r in sorted(packing.pack(_docs(spark, rows), byte_bpe()).collect(), key=lambda r: (r.doc_id, r.start)):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == {i: plain.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), st.data())
def test_codes_round_trip(ids, data):
    codes = dac.Codes(dac.Codes.build(np.array(ids, dtype="<u4")))
    assert codes.slice(0, len(ids)).tolist() == ids
    if ids:
        at = data.draw(st.lists(st.integers(0, len(ids) - 1), max_size=20))
        assert codes.get(at).tolist() == [ids[i] for i in at]
        a, b = sorted(data.draw(st.tuples(st.integers(0, len(ids)), st.integers(0, len(ids)))))
        assert codes.slice(a, b).tolist() == ids[a:b]


def _docs(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, start string, length string")


def _expected(file, rows):
    plain = encoder(file).tokenizer
    return [(i, plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]


def test_store_round_trip(spark, tmpdir_path):
    path = f"{tmpdir_path}/store"
    dac.write_store(_docs(spark), path, word_bpe(), segment_tokens=50)
    store = dac.open_store(spark, path)
    got = sorted(map(tuple, dac.read_documents(store).collect()), key=lambda r: r[1])
    order = sorted(_expected(word_bpe(), ROWS), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert len(got) == len(order)
    for (doc, at, n, crc), (want, ids) in zip(got, order):
        assert (doc, at, n) == (want, start, len(ids))
        assert crc == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += n
    wanted = spark.createDataFrame([(5, 0), (5, 2999), (5, 3000), (5, 9000), (1, 0), (999, 0)], "doc_id long, k long")
    ids = dict(order)
    assert sorted(map(tuple, dac.tokens_at(store, wanted).collect())) == \
        [(1, 0, 1), (5, 0, ids[5][0]), (5, 2999, ids[5][2999]), (5, 3000, 1)]


def test_empty_store(spark, tmpdir_path):
    path = f"{tmpdir_path}/store"
    dac.write_store(_docs(spark, []), path, word_bpe())
    assert dac.read_documents(dac.open_store(spark, path)).count() == 0


def test_packing(spark):
    rows = packing.pack(_docs(spark), byte_bpe(), max_len=64).collect()
    want = sorted((repr(i), ids) for i, ids in _expected(byte_bpe(), ROWS))
    assert len({r.sequence_id for r in rows}) == len(rows)
    whole = {}
    for r in sorted(rows, key=lambda r: (repr(r.doc_id), r.start)):
        assert r.offset == 0 and r.length == 1 << r.bucket <= 64 and len(r.ids) == 4 * r.length
        whole.setdefault(repr(r.doc_id), []).append((r.start, r.doc_tokens, np.frombuffer(r.ids, "<u4").tolist()))
    for doc, ids in want:
        copies = sum(d == doc for d, _ in want)
        pieces = whole[doc]
        assert all(n == len(ids) for _, n, _ in pieces)
        starts = sorted(s for s, _, _ in pieces)[::copies]
        by_start = {s: p for s, _, p in pieces}
        assert sum((by_start[s] for s in starts), []) == ids
        assert len(starts) == len(packing.piece_lengths(len(ids), 64))
    assert packing.pack(_docs(spark, []), byte_bpe()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(_docs(spark), byte_bpe(), max_len=48)


@given(st.integers(0, 10**6))
def test_piece_lengths(n):
    got = packing.piece_lengths(n)
    assert sum(got) == n and all(x & (x - 1) == 0 and x <= 2048 for x in got)
    assert len(set(x for x in got if x < 2048)) == sum(x < 2048 for x in got)
