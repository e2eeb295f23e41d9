import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ringledger.llm import bpe, queries
from tests.llm import plain

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    " ",
    "a  b <|endoftext|> c<|startoftext|>d < |endoftext|>",
    "Don't STOP 12ab ÉÈ é é \x00 ​ x",
    "İ ǅ ΑΣ Σ a b c\u0085d ́x\ńy",
    "x" * 3_000,
    "abcdé" * 700 + " tail\n" * 50,
    "they'll we've I'm 's 'S 'LL",
    "🙂🙃 日本語 テスト 한국어",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(got, library, texts):
    for (packed, decoded), text in zip(got, texts, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(packed, np.int32).tolist() == ids, text[:80]
        assert decoded == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("mean", [1, 3, 40, 512])
def test_chunks_of_any_size(library, mean):
    codec = bpe.Codec(PATH, mean)
    texts = [*TEXTS, " ".join(t or "" for t in TEXTS)]
    for _ in range(2):  # the second time from what is kept
        check(codec.encode(texts), library, texts)


def test_equal_passages_give_equal_chunks():
    codec = bpe.Codec(PATH, 64)
    passage = plain.LONG[1_000:6_000]
    a, b = codec.parts("start " + passage), codec.parts("some other start " + passage)
    assert len(set(a) & set(b)) >= len(a) - 3


def test_forgetting(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 2)
    codec = bpe.Codec(PATH, 16)
    for _ in range(3):
        check(codec.encode(TEXTS), library, TEXTS)


@pytest.mark.parametrize("mean", [5, 40, 512])
def test_spans_agree_where_white_space_counts(spark, mean):
    path = public_tokenizers.path("byte_bpe_50k.json")
    other, codec = Tokenizer.from_file(path), bpe.Codec(path, mean)
    assert not codec.by_words and bpe.Codec(PATH).by_words
    texts = [*TEXTS, " ".join(t or "" for t in TEXTS), "  two  blanks " * 90, "\n\n \t a1b22 " * 60, "no" * 2_000 + " end"]
    texts += [t for _, t in plain.texts(spark)][:60]
    for _ in range(2):
        check(codec.encode(texts), other, texts)


def test_words_through_spans_are_the_same(library):
    codec = bpe.Codec(PATH, 30)
    codec.by_words = False
    check(codec.encode(TEXTS), library, TEXTS)


def test_query_against_the_library(spark, library):
    rows = [*plain.texts(spark), *plain.ODD, *[(900 + i, t) for i, t in enumerate(TEXTS)]]
    got = queries.encoded_digests(bpe.encode_documents(plain.documents(spark, rows), PATH))
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(back)))
    assert plain.rows(got) == sorted(want, key=repr)


def test_decode_column(spark, library):
    df = spark.createDataFrame([([320, 49407, 322],), ([],), (None,)], "ids array<int>")
    got = [r[0] for r in df.select(bpe.decoded(PATH)("ids")).collect()]
    assert got == [library.decode([320, 49407, 322], skip_special_tokens=False), "", None]


def test_empty(spark):
    assert bpe.encode_documents(plain.documents(spark, []), PATH).collect() == []


def test_latin_characters_among_others(library):
    latin = [chr(c) for c in range(256)]
    texts = ["".join(latin), " ".join(latin), *[f"a{c}B 's{c}'S 1{c}{c}. x" for c in latin]]
    texts += ["Été'S naïve<|EndOfText|>x <|endoftext|> don’t µß €5 É ét ́a"]
    codec = bpe.Codec(PATH, 40)
    for _ in range(2):
        check(codec.encode([*texts, " ".join(texts)]), library, [*texts, " ".join(texts)])


def test_words_that_differ_in_case_and_stops_are_learned_once(library):
    codec = bpe.Codec(PATH)
    stems = ["zyxwv" + chr(97 + k) for k in range(26)]
    texts = [" ".join(f"{w} {w.title()}, ({w}). {w.upper()}!" for w in stems)]
    check(codec.encode(texts), library, texts)
    assert len(codec.words) < 2 * len(stems)


def test_words_of_the_table_before_are_taken_over(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    codec, encoded = bpe.Codec(PATH), []
    encode = codec._encode_words
    codec._encode_words = lambda words: (encoded.extend(words), encode(words))[1]
    for texts in (["first fight of many rounds"], ["first fight"], ["many new fights"]):
        check(codec.encode(texts), library, texts)
    assert sorted(encoded) == sorted(["first", "fight", "of", "many", "rounds", "new", "fights"])
