import hashlib
import re
from collections import Counter

import cases
import pytest

from tillpanel.llm import fingerprints
from tillpanel.llm.fingerprints import SAMPLES, fingerprint_query


def weights(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text))


def jaccard(one, other):
    a, b = weights(one), weights(other)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def expected(rows):
    """(id, characters, digest of the edited text, both similarities), in order."""
    ordered = sorted(rows)
    out = []
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    jaccard(text, edited), jaccard(text, after)))
    return out


@pytest.mark.parametrize("per_bucket", [3, 500])
def test_order_edits_and_estimates(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", per_bucket)
    rows = [(k * k * 7 - 900, cases.prose(k, 20 + 9 * k)) for k in range(40)]
    rows += [(10**12, cases.prose(3, 47)), (10**12 + 1, cases.prose(3, 47) + " end"), (10**12 + 2, "äöü 😀 short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(fingerprint_query(docs).collect())
    plan = expected(rows)
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in found] == [p[:3] for p in plan]
    for column, at in (("near_edited", 3), ("near_next", 4)):
        error = [getattr(r, column) - p[at] for r, p in zip(found, plan)]
        assert abs(sum(error) / len(error)) < 0.05
        assert sum(abs(e) < 3.5 * (0.25 / SAMPLES) ** 0.5 for e in error) >= 0.97 * len(error)


def test_collisions_estimate_generalised_jaccard(spark):
    # Weights count: the same words, ever more often.
    base = [f"w{k}" for k in range(60)]
    pairs = [(2 * k, " ".join(base * (k + 1))) for k in range(20)] + [(2 * k + 1, " ".join(base)) for k in range(20)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    found = {r.doc_id: r for r in fingerprint_query(docs).collect()}
    for k in range(20):
        assert abs(found[2 * k].near_next - 1 / (k + 1)) < 4 * (0.25 / SAMPLES) ** 0.5


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_BUCKET", 2)
    rows = fingerprint_query(cases.frame(spark)).collect()
    assert len(rows) == len(cases.odd_rows())
    prints = {}
    for r in rows:
        prints.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert prints[5][0].fingerprint == prints[6][0].fingerprint == prints[6][1].fingerprint
    assert prints[5][0].near_next == 1.0
    assert prints[1][0].fingerprint == prints[2][0].fingerprint == prints[3][0].fingerprint
    assert (prints[1][0].n_chars, prints[1][0].near_next) == (0, 1.0)
    assert fingerprint_query(cases.frame(spark, [])).count() == 0


def test_a_single_row_follows_itself(spark):
    docs = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    (row,) = fingerprint_query(docs).collect()
    assert row.near_next == 1.0


def test_no_python_on_the_main_path(spark):
    docs = spark.createDataFrame([(5, "a b")], "doc_id long, text string")
    plan = fingerprint_query(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
