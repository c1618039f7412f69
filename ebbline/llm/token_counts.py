"""Token counts of a unigram tokenizer by dynamic programming over a shared trie.

A text's pre-tokens are its maximal runs without ASCII white space (space, tab to carriage return), each with the
word mark in front. Of all ways to cut a pre-token into pieces the one with the highest sum of piece scores counts,
on equal sums the one with the fewest tokens. The distinct pre-tokens of a batch are inserted in a trie
in depth-first (sorted) order, so the forward scores of a prefix are computed once for all pre-tokens that share it;
what is stored for later rows is the count at each terminal node.

The vocabulary is a public one and is never trained here. Its file ranks the pieces; by Zipf's law the score of
the piece of rank r is -ln(r + 1), held in whole micronats so that sums are exact. A character that no piece
covers costs UNKNOWN_NATS more than the rarest piece and counts one token per UTF-8 byte (byte fallback).

Only the states of the prefix that a pre-token shares with the next one are kept, so a pre-token of millions of characters needs no more memory than its own
text. Null and empty texts have no pre-token and count 0. Rows are independent: repeated rows and null ids are
kept as they are, columns other than the named two are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, functions as F

from ebbline.llm.common import bounded, map_batches, texts_of

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_NATS = 10
#: A score and a token count share one integer: score * SHIFT - count. Larger is better, then fewer tokens.
SHIFT = 1 << 40


def piece_scores(path: str) -> dict[str, int]:
    """Score in micronats of every ordinary piece of a sentencepiece file, by its rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    ordinary.sort(key=lambda i: (-model.get_score(i), i))
    return {model.id_to_piece(i): -round(1e6 * math.log(rank + 1)) for rank, i in enumerate(ordinary, 1)}


class TrieCounter:
    """Counts the tokens of pre-tokens that arrive in sorted order."""

    def __init__(self, scores: dict[str, int]) -> None:
        self.root: dict = {}
        for piece, score in scores.items():
            node = self.root
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = score * SHIFT - 1
        self.unknown = (min(scores.values()) - 1_000_000 * UNKNOWN_NATS) * SHIFT
        self.start = self._extend([(self.root, 0)], 0, MARK)

    def _extend(self, active: list, value: int, char: str) -> tuple[list, int]:
        """Go down one character. ``active`` holds, for every start of an unfinished piece, its vocabulary node and the
        score before it. Returns the same for the longer prefix, with that prefix's own forward score."""
        best = None
        if "" not in self.root.get(char, ()):
            best = value + self.unknown - len(char.encode("utf-8", "surrogatepass"))
        alive = []
        for node, before in active:
            child = node.get(char)
            if child is not None:
                alive.append((child, before))
                if "" in child:
                    score = before + child[""]
                    if best is None or score > best:
                        best = score
        alive.append((self.root, best))
        return alive, best

    def count(self, sorted_words: Iterable[str]) -> Iterator[tuple[str, int]]:
        path: list[tuple[list, int]] = [self.start]  # the states of the prefixes that the last word shares with the next
        shared = 0
        for word, after in itertools.pairwise(itertools.chain(sorted_words, [""])):
            del path[shared + 1 :]
            state, needed = path[-1], _shared(word, after)
            for char in word[shared:needed]:
                state = self._extend(*state, char)
                path.append(state)
            for char in word[max(shared, needed) :]:
                state = self._extend(*state, char)
            shared = needed
            yield word, -state[1] % SHIFT


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    most = min(len(a), len(b))
    n = 0
    while n < most and a[n] == b[n]:
        n += 1
    return n


@functools.lru_cache(maxsize=1)
def _counter(path: str) -> tuple[TrieCounter, dict[bytes, int]]:
    return TrieCounter(piece_scores(path)), {}


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_pretokens`` and ``n_tokens`` of every row. ``path``: vocabulary file, readable on every executor."""

    def make(batch):
        counter, known = _counter(path)
        texts = texts_of(batch, "_text")
        fresh: set[bytes] = set()
        for text in texts:
            fresh.update(text.split())
        bounded(known)
        fresh.difference_update(known)
        for word, n in counter.count(sorted(w.decode() for w in fresh)):
            known[word.encode()] = n
        split = [text.split() for text in texts]
        return {"_id": batch.column("_id"), "n_pretokens": [len(x) for x in split], "n_tokens": [sum(map(known.__getitem__, x)) for x in split]}

    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    out = map_batches(rows, make, "_id long, n_pretokens long, n_tokens long")
    return out.select(F.col("_id").alias(id_col), "n_pretokens", "n_tokens")
