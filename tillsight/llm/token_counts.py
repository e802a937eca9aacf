"""Token counts of a unigram model, shared over common prefixes of pre-tokens.

A text falls into pre-tokens at white space; each gets the word mark in front.
Distinct pre-tokens go into a trie of characters. The best score of a prefix and
the number of pieces on the best path depend on the prefix alone, so they are
computed when its node is made and serve every pre-token through it; the node of
a whole pre-token holds its count. A document's count is the sum over its words.

The vocabulary file has merge ranks, not probabilities. A piece of rank r gets
the log probability -log(r + ``OFFSET``) of Zipf's law, up to a constant that is
the same for all. A character outside the vocabulary falls back to its UTF-8
bytes, one token each. Of paths with equal score the one with fewer tokens wins.

Tries and counts live in the worker and start anew at a bounded size, which
changes no result. Nothing is shuffled or collected.

Defined results: a null or empty text has no tokens. Rows with null or repeated
``doc_id`` are counted one by one. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Flattening of Zipf's law; cost of a byte beyond that of the rarest piece.
OFFSET, BYTE_COST = 2.7, 10.0
#: Nodes and counts kept by a worker; pre-tokens beyond so many characters bypass the trie.
NODES, COUNTS, LONGEST = 1_000_000, 1_000_000, 200
CHARACTERS = 0x110000


class Unigram:
    """Pieces with log probabilities, and the trie of pre-tokens seen so far."""

    def __init__(self, pieces: dict[str, float], nodes: int = NODES):
        self.pieces, self.most = pieces, nodes
        self.longest = max(map(len, pieces), default=1)
        self.byte = min(pieces.values(), default=0.0) - BYTE_COST
        self.counts: dict[str, int] = {}
        self._forget()

    @classmethod
    def of_file(cls, path: str) -> Unigram:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [model.id_to_piece(i) for i in range(model.vocab_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                          or model.is_unused(i))]
        return cls({piece: -math.log(rank + OFFSET) for rank, piece in enumerate(usable, 1)})

    def _forget(self) -> None:
        #: Child of a node by a character, under node * CHARACTERS + character.
        self.edges: dict[int, int] = {}
        self.scores, self.used = [0.0], [0]

    def _forward(self, word: str, end: int, scores: list[float], used: list[int]) -> tuple[float, int]:
        """Best score and number of tokens of the first ``end`` characters, from those of fewer."""
        pieces, most, least = self.pieces, -math.inf, 0
        for start in range(max(0, end - self.longest), end):
            piece = word[start:end]
            if piece in pieces:
                score = scores[start] + pieces[piece]
                if score > most or score == most and used[start] + 1 < least:
                    most, least = score, used[start] + 1
        if word[end - 1] not in pieces:
            n = len(word[end - 1].encode())
            score = scores[end - 1] + n * self.byte
            if score > most or score == most and used[end - 1] + n < least:
                most, least = score, used[end - 1] + n
        return most, least

    def count(self, word: str) -> int:
        """Tokens of a pre-token, its mark included."""
        scores, used = [0.0], [0]  # of the prefixes, along the path
        if len(word) > LONGEST:
            for end in range(1, len(word) + 1):
                score, tokens = self._forward(word, end, scores, used)
                scores.append(score)
                used.append(tokens)
            return used[-1]
        if len(self.scores) > self.most:
            self._forget()
        edges, node = self.edges, 0
        for end, char in enumerate(word, 1):
            edge = node * CHARACTERS + ord(char)
            child = edges.get(edge)
            if child is None:
                child = edges[edge] = len(self.scores)
                score, tokens = self._forward(word, end, scores, used)
                self.scores.append(score)
                self.used.append(tokens)
            scores.append(self.scores[child])
            used.append(self.used[child])
            node = child
        return used[-1]

    def text(self, text: str | None) -> tuple[int, int]:
        """Pre-tokens and tokens of a text."""
        words = (text or "").split()
        counts = self.counts
        try:
            return len(words), sum([counts[w] for w in words])
        except KeyError:
            if len(counts) > COUNTS:
                counts.clear()
            total = 0
            for word in words:
                found = counts.get(word)
                if found is None:
                    found = counts[word] = self.count(MARK + word)
                total += found
            return len(words), total


_loaded: dict[str, Unigram] = {}
_OUT = pa.schema([("doc_id", pa.int64()), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64())])


def count(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every document."""
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _loaded:
            _loaded[vocabulary] = Unigram.of_file(vocabulary)
        model = _loaded[vocabulary]
        for batch in batches:
            found = [model.text(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array([f[k] for f in found], pa.int64()) for k in (0, 1))],
                schema=_OUT)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        counted, "doc_id long, n_pretokens long, n_tokens long")
