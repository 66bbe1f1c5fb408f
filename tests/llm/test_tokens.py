"""Token operators against the libraries and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import piece_codec, queries, simple8b, token_counts

WORD_FILE, PIECE_FILE = str(public_tokenizers.path("word_bpe_49k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"

ODD = [
    None,
    "",
    " ",
    "\n\t x  y z   q",
    "It's we'll they'd ''s a.b,c d., e.'s café. naïve, é. é, ́x",
    "<|endoftext|> a<|startoftext|>b <|endoftext|>. x<|endo ftext|>",
    "ΑΣ ΣΑΣ. İstanbul ǅ ﬁ １２ ①",
    "日本語のテキスト 한국어 😀😀 👨‍👩‍👧 ‍",
    "\x00\x01\x1c\x85 \x7f",
    "a" * 3000 + " " + "b." * 2000,
    "x̸ ≠ .̸ ,́ word,́ word.̸",
    "one " * 9000,
]


@pytest.fixture(scope="module")
def texts():
    import duckdb

    got = duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return [t for (t,) in got] + ODD


def frame(spark, texts):
    rows = [(k, t, "clash", 7) for k, t in enumerate(texts)] + [(0, texts[0], "again", 8)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string, n_tokens int")


def library_ids(text):
    return token_counts.words(WORD_FILE).library.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_librarys_ids(texts, monkeypatch):
    it = token_counts.words(WORD_FILE)
    for part in (300, 5000, 2_000_000):
        monkeypatch.setattr(token_counts, "PART", part)
        for t, got in zip(texts, it.ids([t or "" for t in texts]), strict=True):
            assert np.frombuffer(got, dtype="<u4").tolist() == library_ids(t), t[:80]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abA.,' \n'sté́<|>1Σσ 日̸\"\x1c\x85\xa0\u2000\u3000İÉ×")), max_size=40))
def test_words_give_the_librarys_ids_for_any_text(text):
    it = token_counts.words(WORD_FILE)
    assert np.frombuffer(next(it.ids([text])), dtype="<u4").tolist() == library_ids(text)


def test_special_strings_count_only_as_written(spark):
    texts = ["<|EndOfText|>", "<|ENDOFTEXT|>. x<|endoftext|>Y<|STARTOFTEXT|>,", "<|startoftext|> <|StartOfText|> <|endoftext|>"]
    it = token_counts.words(WORD_FILE)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in it.ids(texts)] == [library_ids(t) for t in texts]
    got = token_counts.count_tokens(frame(spark, texts), WORD_FILE).collect()
    assert all(r.n_tokens == len(library_ids(texts[r.doc_id])) for r in got)
    for r in simple8b.round_trip(frame(spark, texts), WORD_FILE).collect():
        ids = [*library_ids(texts[r.doc_id]), 2]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))


def test_texts_taken_in_parts_give_the_librarys_ids(monkeypatch, texts):
    it = token_counts.Words(WORD_FILE)
    for part in (400, 20_000):
        monkeypatch.setattr(token_counts, "PART", part)
        for t, got in zip(texts, it.ids([t or "" for t in texts]), strict=True):
            assert np.frombuffer(got, dtype="<u4").tolist() == library_ids(t)


def test_letters_are_normalised_by_lowering_them():
    it = token_counts.words(WORD_FILE)
    letters = [chr(c) for c in range(0x41, 0x250) if re.fullmatch(f"[{token_counts._LETTERS}]", chr(c))]
    assert len(letters) > 400
    for a, b in zip(letters, letters[7:] + letters[:7]):
        for word in (a, f"x{a}{b}y", a + b):
            assert np.frombuffer(next(it.ids([word])), dtype="<u4").tolist() == library_ids(word), word


def test_words_of_all_kinds_give_the_librarys_ids():
    bits = ["Hello", "it's", "IT'S", "$$$", "...", ",", "İx", "é", "E\u0301", "H\u0331", "e\u0301", "<|endoftext|>", "<|EndOfText|>", "\x1c", "\xa0", "\x85", "\u2003"]
    bits += [" ", "\n", "\t", "\x0b", "a-b", "x_", "123", "4.5", "Straße", "ΣΑΣ", "日本", "😀", "ab<|", "|>", "'", "don't.", "Word.", "WORD,", "word", "(x)", "^~", "\u212a"]
    rng, it = random.Random(4), token_counts.words(WORD_FILE)
    for _ in range(800):
        some = ["".join(rng.choice(bits) + rng.choice(["", " ", "  "]) for _ in range(rng.randrange(12))) for _ in range(5)]
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in it.ids(some)] == [library_ids(t) for t in some], some


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 8), (200, 40), (1024, 64)])
def test_splicing_gives_the_librarys_ids(texts, chunk, overlap):
    it = token_counts.words(WORD_FILE)
    for t in texts:
        t = (t or "")[:1200]
        assert [i for part in token_counts.spliced(t, it.with_offsets, chunk, overlap) for i in part] == library_ids(t), t[:60]


@pytest.mark.parametrize(
    "text",
    [
        "日本語の" * 60_000,
        "".join(random.Random(1).choices("abcXYZ019+/", k=300_000)),
        "one two " * 4000 + "x1" * 60_000 + " three four" * 4000,
        " " * 200_000 + "end of it",
    ],
    ids=["script", "base64", "within words", "blanks"],
)
def test_texts_without_spaces_are_encoded_in_proportion(text):
    it, done = token_counts.words(WORD_FILE), []

    def encode(t):
        done.append(len(t))
        assert sum(done) < 20 * len(text)
        return it.with_offsets(t)

    assert [i for part in token_counts.spliced(text, encode) for i in part] == library_ids(text)


def test_splicing_of_rare_spaces():
    it, r = token_counts.words(WORD_FILE), random.Random(7)
    for _ in range(300):
        t = "".join("ab1.X"[r.randrange(5)] * r.randrange(1, 4) + " " * (r.random() < r.choice((0.01, 0.1, 0.5))) for _ in range(r.randrange(400)))
        assert [i for part in token_counts.spliced(t, it.with_offsets, 64, 8) for i in part] == library_ids(t)


def test_count_query(spark, texts):
    got = token_counts.count_tokens(frame(spark, texts), WORD_FILE, limit=100).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        n = len(library_ids(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 100)


def test_piece_query(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    got = piece_codec.encode_documents(frame(spark, texts), PIECE_FILE, keep_ids=True)
    for r in got.collect():
        text = texts[r.doc_id] or ""
        ids = sp.encode(text)
        assert r.ids == ids and r.n_tokens == len(ids) == r.n_aligned
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        data, ends = text.encode(), [0, *r.span_ends]
        assert ends == sorted(ends) and ends[-1] == len(data)
        for piece, a, b in zip(ids, ends, ends[1:], strict=False):
            if not sp.is_byte(piece) and (a, b) != (0, 0):
                assert sp.id_to_piece(piece).replace("▁", " ").strip(" ").encode() == data[a:b].strip(b" ")
    back = piece_codec.decode_ids(got.select("doc_id", "ids"), PIECE_FILE).collect()
    assert all(r.decoded == sp.decode(list(r.ids)) for r in back)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf", "identity"])
def test_normalisation_matches_the_library(texts, rule):
    import sentencepiece

    own = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = piece_codec.Normalizer(next(v for k, v in piece_codec.wire_fields(own.serialized_model_proto()) if k == 3))
    for t in [*texts, "ＡＢＣ ①x　 ｶﾞ ㍿", "  two  spaces  ", "a  ", "éé ẛ̣"]:
        t = (t or "")[:3000]
        if "\x00" in t:
            continue
        out, source = spec(t)
        assert out.decode() == own.normalize(t), t[:60]
        assert len(source) == len(out) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(t.encode())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=600))
def test_packing_round_trip(ids):
    words, exceptions, before = simple8b.pack(np.array(ids, dtype=np.uint64))
    assert simple8b.unpack(words, exceptions, len(ids)).tolist() == ids
    assert len(before) == len(words)


def test_packing_is_dense_and_marks_start_words():
    assert len(simple8b.pack(np.zeros(1200, dtype=np.uint64))[0]) == 10
    assert len(simple8b.pack(np.full(400, 30_000, dtype=np.uint64))[0]) == 100
    r = random.Random(5)
    ids = [np.array([r.randrange(49_408) for _ in range(n)], dtype=np.uint64) for n in (0, 1, 5000, 70_000)]
    names, ends, flat = simple8b.read_block(simple8b.write_block([None, -4, 7, 2**60], ids))
    assert names == [None, -4, 7, 2**60] and ends.tolist() == [0, 1, 5001, 75_001] and flat.tolist() == np.concatenate(ids).tolist()


def test_file_round_trip(spark, texts, monkeypatch):
    monkeypatch.setattr(simple8b, "BLOCK_IDS", 500)
    df = frame(spark, texts).union(spark.createDataFrame([(None, "null id", "", 0)], "doc_id long, text string, a string, b int"))
    got = simple8b.round_trip(df, WORD_FILE).collect()
    assert len(got) == len(texts) + 2
    got.sort(key=lambda r: r.start)
    assert got[0].doc_id is None and [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in got[1:])
    at = 0
    for r in got:
        ids = [*library_ids("null id" if r.doc_id is None else texts[r.doc_id]), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, WORD_FILE).count() == 0
    assert piece_codec.encode_documents(none, PIECE_FILE).count() == 0
    assert simple8b.round_trip(none, WORD_FILE).count() == 0


def test_registered_queries(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op4_piece_offsets", "op6_overlap_counts", "op10_simple8b"):
        assert queries.QUERIES[name](spark, SF).count() == n
