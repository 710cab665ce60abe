"""Greedy longest-match token counts by a linear automaton (no pieces are built).

The vocabulary is a trie with two roots: word starts and word continuations. Each node has a failure
link to the node that the scan continues from when no child fits, and the number of pieces that are
thereby complete ("popped"). A word is read once, letter by letter; its count is the sum of the
popped counts. A word that the vocabulary cannot cover is one unknown token.

Words are the runs between blanks (\\x20, \\x09-\\x0D). The vocabulary is that of a public
SentencePiece model: pieces with the word mark start words, the others continue them; control and
byte pieces are left out.

Defined results: a null or blank text has 0 words and tokens. Repeated rows each get their row. Word
counts are remembered per task for the latest ``CACHED_WORDS`` words only.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import in_batches

CACHED_WORDS = 200_000
WORD_MARK = "▁"
VOCABULARY = "piece_bpe_32k.model"


def default_vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def read_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Word-start pieces and continuation pieces of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    starts, inner = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        marked = piece.startswith(WORD_MARK)
        text = piece[len(WORD_MARK) :] if marked else piece
        if text and WORD_MARK not in text:
            (starts if marked else inner).append(text)
    return starts, inner


class LongestMatch:
    """The automaton; node 0 is the root for word starts, node 1 that for continuations."""

    def __init__(self, starts: list[str], inner: list[str]):
        self.children: list[dict[str, int]] = [{}, {}]
        piece = [False, False]
        for root, texts in ((0, starts), (1, inner)):
            for text in texts:
                node = root
                for letter in text:
                    child = self.children[node].get(letter)
                    if child is None:
                        child = len(self.children)
                        self.children.append({})
                        piece.append(False)
                        self.children[node][letter] = child
                    node = child
                piece[node] = True
        n = len(self.children)
        self.failure = [-1] * n  # -1: none
        self.popped = [0] * n
        queue = [0, 1]
        for node in queue:  # breadth first: a failure link always points at a shorter string
            for letter, child in self.children[node].items():
                if piece[child]:
                    self.failure[child], self.popped[child] = 1, 1
                else:
                    back, pops = self.failure[node], self.popped[node]
                    while back >= 0 and letter not in self.children[back]:
                        pops += self.popped[back]
                        back = self.failure[back]
                    if back >= 0:
                        self.failure[child] = self.children[back][letter]
                        self.popped[child] = pops
                queue.append(child)
        # Tokens still to be popped when the word ends at a node; -1: the rest cannot be covered.
        self.at_end = [0] * n
        for node in queue:
            if node != 1:
                back = self.failure[node]
                rest = 0 if back == 1 else -1 if back < 0 else self.at_end[back]
                self.at_end[node] = -1 if rest < 0 else self.popped[node] + rest

    def count(self, word: str) -> int:
        """Number of pieces of a word; -1 if the vocabulary cannot cover it."""
        children, failure, popped = self.children, self.failure, self.popped
        node = tokens = 0
        for letter in word:
            child = children[node].get(letter)
            while child is None:
                tokens += popped[node]
                node = failure[node]
                if node < 0:
                    return -1
                child = children[node].get(letter)
            node = child
        if node <= 1:
            return tokens if word else 0
        return -1 if self.at_end[node] < 0 else tokens + self.at_end[node]


@cache
def automaton(path: str) -> LongestMatch:
    """One per Python worker and vocabulary file."""
    return LongestMatch(*read_vocabulary(path))


_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def token_counts(docs: DataFrame, vocabulary_path: str, text_column: str = "text") -> DataFrame:
    """Words, tokens, unknown words and the most tokens of one word, per document."""

    def start():
        machine = automaton(vocabulary_path)
        known: dict[str, int] = {}

        def one(text):
            words = _WORDS.findall(text or "")
            tokens = unknown = most = 0
            for word in words:
                n = known.get(word)
                if n is None:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    n = known[word] = machine.count(word)
                if n < 0:
                    unknown += 1
                    n = 1
                tokens += n
                if n > most:
                    most = n
            return len(words), tokens, unknown, most

        def work(columns):
            found = [one(text) for text in columns["text"]]
            names = ("n_words", "n_tokens", "n_unknown", "longest_word_tokens")
            return {"doc_id": columns["doc_id"]} | {
                name: [row[k] for row in found] for k, name in enumerate(names)
            }

        return work

    return in_batches(
        docs.select(F.col("doc_id").cast("long"), F.col(text_column).alias("text")),
        "doc_id long, n_words long, n_tokens long, n_unknown long, longest_word_tokens long",
        start,
    )


def token_count_query(docs: DataFrame) -> DataFrame:
    return token_counts(docs, default_vocabulary_path())
