import random

import public_tokenizers

from ringledger.llm import token_counts as T
from tests.llm import plain

PATH = public_tokenizers.path("piece_bpe_32k.model")


def greedy(pieces, word):
    count = at = 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:
                at, count = end, count + 1
                break
        else:
            return -1
    return count


def test_random_vocabularies():
    rng = random.Random(2)
    for _ in range(300):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        automaton = T.Automaton(pieces)
        for _ in range(30):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(0, 12)))
            assert automaton.count(word) == greedy(pieces, word), (pieces, word)


def plain_counts(pieces, text):
    words = (text or "").split()
    counts = [greedy(pieces, T.WORD_START + w) for w in words]
    return len(words), sum(c if c >= 0 else 1 for c in counts), sum(c < 0 for c in counts)


def test_against_greedy(spark):
    pieces = set(T.vocabulary(PATH))
    rows = [*plain.texts(spark)[:80], *plain.ODD, (70, "日本 亜 x")]
    got = T.count_tokens(plain.documents(spark, rows), PATH)
    assert plain.rows(got) == sorted(((i, *plain_counts(pieces, t)) for i, t in rows), key=repr)


def test_empty(spark):
    assert T.count_tokens(plain.documents(spark, []), PATH).collect() == []
