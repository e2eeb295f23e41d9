"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie whose nodes have failure links. The link of a node leads to where matching goes on after the
pieces that greedy longest match would take from the node's string are popped; how many they are is stored with the link.
A word is then counted in one pass over its characters, without building a piece or going back.
"""

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import bounded_batches

WORD_START = "▁"
#: What a worker keeps of words met before; longer ones are counted each time.
KEPT_WORDS, KEPT_WORD_CHARS = 400_000, 64


class Automaton:
    """Counts greedy longest-match pieces; -1 where some place of the word has no piece."""

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                step = self.next[node].get(c)
                if step is None:
                    step = self.next[node][c] = len(self.next)
                    self.next.append({})
                    final.append(False)
                node = step
            final[node] = node > 0
        size = len(self.next)
        #: where matching goes on, -1 for nowhere, and how many pieces are popped on the way
        self.link, self.popped = [-1] * size, [0] * size
        queue = [0]
        for node in queue:  # by depth: links lead to shorter strings, which are done
            for c, child in self.next[node].items():
                queue.append(child)
                if final[child]:
                    self.link[child], self.popped[child] = 0, 1
                    continue
                at, count = self.link[node], self.popped[node]
                while at >= 0 and c not in self.next[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[child], self.popped[child] = self.next[at][c], count

    def count(self, word: str) -> int:
        following, link, popped = self.next, self.link, self.popped
        node = count = 0
        for c in word:
            step = following[node].get(c)
            while step is None:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return -1
                step = following[node].get(c)
            node = step
        while node > 0:
            count += popped[node]
            node = link[node]
        return count if node == 0 else -1


class Counts:
    """Counts of whole texts, with the counts of words met before."""

    def __init__(self, pieces: Iterable[str]):
        self.automaton = Automaton(pieces)
        self.known: dict[str, int] = {}

    def text(self, text: str) -> tuple[int, int, int]:
        """Words, pieces, and words with no full match, which count as one unknown piece."""
        words = Counter(text.split())
        known, total, unknown = self.known, 0, 0
        if len(known) > KEPT_WORDS:
            known.clear()
        for word, times in words.items():
            n = known.get(word)
            if n is None:
                n = self.automaton.count(WORD_START + word)
                if len(word) <= KEPT_WORD_CHARS:
                    known[word] = n
            if n < 0:
                unknown += times
                n = 1
            total += n * times
        return words.total(), total, unknown


def vocabulary(path: str) -> list[str]:
    """The pieces of a sentencepiece model that stand for text: no control, unknown, unused or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = (model.is_control, model.is_unknown, model.is_unused, model.is_byte)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(kind(i) for kind in kinds)]


@cache
def counts(path: str) -> Counts:
    """One for each worker and vocabulary, built when it is first needed."""
    return Counts(vocabulary(path))


def piece_counts(path: str) -> Column:
    """A function of a text column: struct of `n_words`, `n_tokens` and `n_unknown`."""

    @F.pandas_udf("struct<n_words:long,n_tokens:long,n_unknown:long>")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = counts(path)
        for texts in batches:
            rows = [own.text(t) if t else (0, 0, 0) for t in texts]
            yield pd.DataFrame(np.array(rows, np.int64).reshape(-1, 3), columns=["n_words", "n_tokens", "n_unknown"])

    return counted


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of each row's whole text.

    Words are runs without white space (as Python's `str.split`), each begun by the word mark; pieces are taken greedily,
    the longest first; a word that cannot be matched whole is one unknown piece. Null and empty texts count zero. Ids may
    be null or repeated; other columns are ignored; an empty table gives an empty result. `path` must name the same
    sentencepiece model on every machine.
    """
    bounded_batches(docs.sparkSession)
    counted = piece_counts(path)(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), counted.alias("n")).select("doc_id", "n.*")
