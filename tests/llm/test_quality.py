import re
from collections import Counter

import cases
import pytest

from tillpanel.llm import quality
from tillpanel.llm.quality import ablations, ledger, measure, passes, quality_query


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if count[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
        len(lines) - len(set(lines)), len(repeated),
        len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text)),
    )


TEXTS = [r[1] for r in cases.odd_rows()] + [
    "a b c a b c", "a a a a a", "a b a b a b x", "p q\np q\n \np q r", "A# B* |c|\x0bd", "a b", "é ü ß a",
]


@pytest.mark.parametrize("text", TEXTS)
def test_measurements_match_brute_force(text):
    assert measure(text) == brute(text)


def test_ledger_has_a_row_per_row(spark):
    rows = quality_query(cases.frame(spark)).collect()
    assert len(rows) == len(cases.odd_rows())
    found = {r.doc_id: r for r in rows}
    assert (found[1].n_words, found[1].base_failed, found[1].kept) == (0, True, False)
    assert (found[5].n_words, found[5].base_failed, found[5].kept) == (80, False, True)
    assert quality_query(cases.frame(spark, [])).count() == 0


def test_policies_and_ablations_read_the_ledger_only(spark):
    texts = [cases.prose(k, 60) for k in range(6)]
    texts += [cases.prose(9, 20), "### " * 30 + cases.prose(10, 60), cases.prose(11, 60).upper()]
    rows = ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).cache()
    assert rows.filter(passes(2)).count() == 6
    assert rows.filter(passes(1)).count() == 7  # the first version has no rule on case
    assert rows.filter(passes(2, without="upper_case")).count() == 7
    found = {r.rule: r for r in ablations(rows, 2).collect()}
    for rule in quality.POLICIES[2]:
        assert found[rule].n_kept_without == rows.filter(passes(2, without=rule)).count()
    assert (found["upper_case"].n_failed, found["upper_case"].n_alone) == (1, 1)
