"""The pipeline's near-copy stage: five words to a shingle, 80 percent in common."""

import cases
import corpus_pipeline
import pytest
from test_ngram_join import corpus


def shingles(text, size):
    words = text.lower().split()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute(rows, size, percent):
    """Ids that stay, by comparing all texts."""
    sets = [(doc_id, shingles(text, size)) for doc_id, text in rows]
    parent = {doc_id: doc_id for doc_id, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for doc_id, _ in rows:
        least[root(doc_id)] = min(least.get(root(doc_id), doc_id), doc_id)
    return sorted(set(least.values()))


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], cases.SCHEMA)
    return sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect())


def test_texts_are_shuffled_once_and_lone_ones_not_at_all(spark):
    rows = [*((i, cases.prose(i, 60)) for i in range(30)), (40, cases.prose(3, 60)), (5, cases.prose(99, 60))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], cases.SCHEMA)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = corpus_pipeline.one_of_each_group(spark, docs, "")
        plan = found._jdf.queryExecution().executedPlan()
        assert sorted(r.doc_id for r in found.collect()) == list(range(30))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")

    def shuffles(node):
        """Of each shuffle whose rows hold the text."""
        children = [node.children().apply(k) for k in range(node.children().size())]
        own = node.nodeName() == "Exchange" and "text#" in node.output().toString()
        return own + sum(map(shuffles, children))

    while plan.nodeName() != "Union":
        plan = plan.children().head()
    assert shuffles(plan) == 1
    assert shuffles(plan.children().head()) == 0


def test_two_changed_words_in_a_hundred_make_a_near_copy(spark):
    words = [f"w{'x' * i}" for i in range(100)]
    other = [{30: "one", 70: "two"}.get(i, w) for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(other))]
    assert brute(rows, 3, 90) == [1, 2] and brute(rows, 5, 80) == [1]
    assert kept(spark, rows) == [1]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_match_brute_force(spark, seed):
    rows = corpus(seed)
    assert kept(spark, rows) == brute(rows, 5, 80)
