import random
import re
from collections import Counter

import cases
import numpy as np
import pytest

from tillpanel.llm import ranked_search
from tillpanel.llm.ranked_search import (
    Batch,
    Corpus,
    TermKeys,
    bounds,
    exact_score,
    search,
    sketches,
    terms_of,
    weight,
)

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def plain_terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(TERM, lower)


def brute(docs, items, k=10):
    """{item: [(doc, score)]} with every document scored for every item."""
    found = [(d, Counter(plain_terms(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    held = Counter(t for _, c in found for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(plain_terms(text))
    ranking = {}
    for i, terms in wanted.items():
        scores = []
        for d, c in found:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                weight(n_docs, held[t]) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c
            )
            if score > 0:
                scores.append((-score, d is None, d or 0))
        ranking[i] = [(None if no_id else d, -s) for s, no_id, d in sorted(scores)[:k]]
    return {i: rows for i, rows in ranking.items() if rows}


def ranked(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(found.setdefault(r.item_id, [])) + 1
        found[r.item_id].append((r.doc_id, r.score))
    return found


def corpus(seed, n=300):
    pick = random.Random(seed)
    passages = [cases.prose(700 + k, 25) for k in range(8)]
    docs = []
    for i in range(n):
        text = cases.prose(pick.randrange(10**6), pick.choice([1, 5, 40, 200]))
        if pick.random() < 0.2:
            text += ". " + pick.choice(passages).upper()
        docs.append((i * 3, text if pick.random() > 0.05 else None))
    docs += [(10_000 + i, docs[5][1]) for i in range(40)]
    return docs, [(k, p) for k, p in enumerate(passages)] + [(90, ""), (91, "nowhere"), (92, None)]


def frames(spark, docs, items, parts=5):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert ranked(search(*frames(spark, docs, items))) == brute(docs, items)


def test_small_tables_batches_and_seeds_change_nothing(spark, monkeypatch):
    """Few exact weights, few slots, several batches and a first scan give the same rows."""
    docs, items = corpus(3)
    for name, value in (("FREQUENT", 8), ("SEED_ROWS", 40), ("BATCH_TERMS", 60)):
        monkeypatch.setattr(ranked_search, name, value)
    assert ranked(search(*frames(spark, docs, items, 3), k=4)) == brute(docs, items, 4)


@pytest.mark.parametrize("text", [r[1] for r in cases.odd_rows()] + ["Ä-b_C\x7fd9 e", "İI"])
def test_terms(text):
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def test_bounds_are_never_below_the_score():
    pick = random.Random(5)
    texts = [cases.prose(pick.randrange(10**6), pick.choice([1, 30, 600])) for _ in range(60)]
    held = Counter(t for text in texts for t in set(terms_of(text)))
    slots = np.full(ranked_search.SLOTS, weight(len(texts), 1))
    some = {t: weight(len(texts), n) for t, n in held.items() if n > 2}
    known = Corpus(len(texts), sum(len(terms_of(t)) for t in texts), some, slots)
    keys = TermKeys(known)
    queries = [[(t, weight(len(texts), held[t])) for t in dict.fromkeys(terms_of(texts[k]))] for k in range(5)]
    batch = Batch(list(range(5)), queries, [1] * 5)
    counts = [Counter(terms_of(t)) for t in texts]
    norms = [known.norm(sum(c.values())) for c in counts]
    above = bounds(batch, sketches(counts, norms, keys)).T
    exact = np.array([[exact_score(q, c, m) for c, m in zip(counts, norms, strict=True)] for q in queries])
    assert (above >= exact).all()
    # Bytes are rounded up; terms that a document lacks hardly count.
    assert (above <= 1.1 * exact + exact.max() / 50).mean() > 0.9


def test_odd_rows(spark):
    docs = cases.frame(spark)
    rows = [(r[0], r[1]) for r in cases.odd_rows()]
    items = [(1, cases.prose(2, 30)), (1, "one"), (None, cases.prose(3, 10)), (2, "日本語 é"), (3, "A b")]
    found = ranked(search(docs, spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")))
    assert found == brute(rows, items)
    assert [d for d, _ in found[1]].count(6) == 2
    none = search(cases.frame(spark, []), spark.createDataFrame(items, "item_id long, text string"))
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert search(docs, spark.createDataFrame([], "item_id long, text string")).collect() == []
