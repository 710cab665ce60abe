import random

import cases
from tokenizers import Tokenizer, models

from tillpanel.llm.token_counts import (
    LongestMatch,
    default_vocabulary_path,
    read_vocabulary,
    token_count_query,
)


def greedy(word, starts, inner):
    """Longest match first, by trying every length."""
    n = at = 0
    while at < len(word):
        pieces = starts if at == 0 else inner
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return -1
        at += size
        n += 1
    return n


def test_matches_greedy_search_on_random_vocabularies():
    pick = random.Random(4)
    for _ in range(60):
        some = lambda n: {"".join(pick.choices("abc", k=pick.randint(1, 5))) for _ in range(n)}
        starts, inner = some(8), some(8)
        machine = LongestMatch(sorted(starts), sorted(inner))
        for _ in range(120):
            word = "".join(pick.choices("abc", k=pick.randint(1, 12)))
            assert machine.count(word) == greedy(word, starts, inner), (word, starts, inner)


def test_matches_a_public_word_piece_encoder():
    starts, inner = read_vocabulary(default_vocabulary_path())
    machine = LongestMatch(starts, inner)
    names = ["[UNK]", *starts, *("##" + x for x in inner)]
    reference = Tokenizer(
        models.WordPiece({n: i for i, n in enumerate(names)}, unk_token="[UNK]", max_input_chars_per_word=10**6)
    )
    pick = random.Random(5)
    words = [*cases.VOCABULARY, "internationalisation", "Übergrößenträger", "日本語", "x" * 300, "áb", "<s>"]
    words += ["".join(pick.choices("etaoinshrdlu.,-ÄéñZ1", k=pick.randint(1, 14))) for _ in range(3000)]
    for word in words:
        expected = reference.encode(word).tokens
        assert machine.count(word) == (-1 if expected == ["[UNK]"] else len(expected)), word


def test_long_words_are_read_once():
    # Quadratic work would take minutes here.
    machine = LongestMatch(["a" * k for k in range(1, 40)], ["a" * k for k in range(1, 40)])
    assert machine.count("a" * 1_000_000) == -(-1_000_000 // 39)


def test_query_takes_odd_rows(spark):
    rows = token_count_query(cases.frame(spark)).collect()
    assert len(rows) == len(cases.odd_rows())
    found = {r.doc_id: r for r in rows}
    assert tuple(found[1])[1:] == tuple(found[3])[1:] == (0, 0, 0, 0)
    assert found[9].n_unknown >= 1
    assert found[7].n_words == 30_000
    assert token_count_query(cases.frame(spark, [])).count() == 0


def test_query_matches_greedy_search(spark):
    """Words, tokens, unknown words and the longest word of each document, summed in plain Python."""
    starts, inner = map(set, read_vocabulary(default_vocabulary_path()))
    rows = [(k, cases.prose(k, 40 + k) + " Übergröße, 日本語 x1.5 \U0010fffd") for k in range(20)] + [(50, None), (51, " ")]
    found = {r.doc_id: tuple(r)[1:] for r in token_count_query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        counts = [greedy(w, starts, inner) for w in (text or "").split()]
        tokens = [1 if n < 0 else n for n in counts]
        assert found[doc_id] == (len(counts), sum(tokens), sum(n < 0 for n in counts), max(tokens, default=0))
