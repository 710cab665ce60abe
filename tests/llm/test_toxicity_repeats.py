"""Passages made of words that stood earlier in the text."""

import cases
import numpy as np
from test_toxicity import LABELS, corpus

from tillpanel.llm.toxicity import DRIFT, counted_once, maximal_segments, score, train

PASSAGE = "grumtosh vilekk snarbogged"


def test_a_passage_of_known_words_is_told(spark):
    rows, labels = corpus()
    model = train(spark.createDataFrame(rows, cases.SCHEMA), spark.createDataFrame(labels, LABELS))
    clean = [cases.prose(seed, 40) for seed in (1, 2, 3)]
    scattered = " ".join(f"{word} {part}" for word, part in zip(PASSAGE.split(), clean, strict=True))
    texts = [f"{clean[0]} {PASSAGE} {clean[1]} {PASSAGE} {clean[2]}", f"{scattered} {PASSAGE}"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], cases.SCHEMA)
    for r in score(docs, model).collect():
        words = texts[r.doc_id].split()
        told = {i for a, b in zip(r.passage_starts, r.passage_ends) for i in range(a, b)}
        dense = [i for i in range(len(words) - 2) if " ".join(words[i : i + 3]) == PASSAGE]
        assert dense and all({i, i + 1, i + 2} <= told for i in dense)


def test_pooled_segments_count_a_word_once_in_the_best():
    tokens = "bad fine fine fine bad worse fine bad bad".split()
    values = {"bad": 3.0, "worse": 2.0, "fine": -5.0}
    scores = np.array([values[t] for t in tokens])
    segments = maximal_segments(scores)
    assert [s[:2] for s in segments] == [(0, 1), (4, 6), (7, 9)]
    # The best, 'bad bad' (6), counts one 'bad'; 'bad worse' (5) has 'worse' left; 'bad' nothing.
    assert counted_once(tokens, scores, segments).tolist() == [3.0 - DRIFT, 2.0 - DRIFT]
