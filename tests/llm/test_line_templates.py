import random
import re
from collections import defaultdict
from pathlib import Path

import cases
import pytest

from tillpanel.llm.line_templates import DEPTH, SIMILARITY, drop_recurring_lines, line_query, recurring_lines


def masked_tokens(line):
    """The tokens that a line is compared by, and whether it can have a general template."""
    tokens = re.findall(r"[^\x20\x09-\x0D]+", line)
    words = [t for t in tokens if not re.search("[0-9]", t) and re.search("[A-Za-z\x80-\U0010ffff]", t)]
    if re.search(r"[0-9]|<\*>", line) and 100 * len(words) < SIMILARITY * len(tokens):
        return tuple(tokens), False
    return tuple("<*>" if re.search("[0-9]", t) else t for t in tokens), len(tokens) > DEPTH


def brute(rows):
    """Kept text per (id, text), by building the tree in memory."""
    parsed = []
    for doc_id, text in rows:
        for number, line in enumerate(text.split("\n")):
            parsed.append((doc_id, text, number, line, *masked_tokens(line)))
    leaves = defaultdict(set)
    for *_, tokens, in_tree in parsed:
        if in_tree:
            leaves[len(tokens), tokens[:DEPTH]].add(tokens)
    template = {}
    for leaf, lines in leaves.items():
        held = defaultdict(int)
        for line in lines:
            for cell in enumerate(line):
                held[cell] += cell[1] != "<*>"
        for line in lines:
            rank = -(-SIMILARITY * len(line) // 100)
            counts = sorted((held[c] for c in enumerate(line)), reverse=True)
            support = counts[rank - 1]
            if support > 1:
                template[line] = (leaf, tuple(c for c in enumerate(line) if 2 * held[c] > support))
    first = {}
    for doc_id, _, _, _, tokens, _ in parsed:
        for key in {tokens, template.get(tokens, tokens)}:
            first[key] = min(first.get(key, doc_id), doc_id)
    kept = defaultdict(list)
    for doc_id, text, _, line, tokens, _ in parsed:
        if not tokens or doc_id <= min(first[tokens], first[template.get(tokens, tokens)]):
            kept[doc_id, text].append(line)
    return {key: "\n".join(lines) for key, lines in kept.items()} | {
        (d, t): "" for d, t in rows if (d, t) not in kept
    }


def corpus(seed):
    pick = random.Random(seed)
    shared = [cases.prose(900 + k, pick.choice([3, 8, 15, 60])) for k in range(6)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(pick.randint(1, 6)):
            kind = pick.random()
            if kind < 0.3:
                line = pick.choice(shared)
            elif kind < 0.45:
                words = pick.choice(shared).split()
                words[pick.randrange(len(words))] = pick.choice(["id7", "x9y", "rare" + "abcdefg"[i % 7]])
                line = " ".join(words)
            elif kind < 0.6:
                line = f"posted by user{pick.randrange(99)} on 2021-0{pick.randrange(1, 9)} at home"
            elif kind < 0.65:
                line = pick.choice(["", "  ", "\t"])
            else:
                line = cases.prose(pick.randrange(10**6), pick.randint(1, 30))
            lines.append(line)
        rows.append((i * 5, "\n".join(lines)))
    return rows


def cleaned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id: r.text for r in line_query(docs).collect()}


def plain(rows):
    return {doc_id: text for (doc_id, _), text in brute(rows).items()}


@pytest.mark.parametrize("seed", range(6))
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.text for r in line_query(docs).collect()}
    assert found == {doc_id: text for (doc_id, _), text in brute(rows).items()}


def test_variable_fields(spark):
    line = "request from client {} took {} ms"
    long = "the committee met at noon and agreed to send {} a letter about the new plan today"
    rows = [
        (1, line.format("c17", 30) + "\nmine one"),
        (2, line.format("c99", 4) + "\nmine two"),
        (3, long.format("anna") + "\nmine three"),
        (4, long.format("bert") + "\nmine four"),
        (5, "request from client nobody took no ms"),
    ]
    found = {r.doc_id: r.text for r in line_query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: rows[0][1], 2: "mine two", 3: rows[2][1], 4: "mine four", 5: rows[4][1]}


def test_tables_of_lines_go_before_the_result_is_used(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "tillpanel"
    before = set(folder.glob("*"))
    found = line_query(spark.createDataFrame([(1, "a b\nc"), (2, "a b\nd")], "doc_id long, text string"))
    assert [p.name.rpartition("-")[0] for p in set(folder.glob("*")) - before] == ["dropped-lines"]
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [(1, "a b\nc"), (2, "d")]


def test_odd_rows(spark):
    cleaned = drop_recurring_lines(cases.frame(spark))
    assert set(cleaned.columns) == set(cases.frame(spark).columns)
    rows = cleaned.collect()
    assert len(rows) == len(cases.odd_rows())
    texts = defaultdict(list)
    for r in rows:
        texts[r.doc_id].append(r.text)
    assert texts[1] == [None] and texts[2] == [""] and texts[3] == [" \t\n \r\n"]
    assert texts[6] == ["", ""] and texts[5] != [""]
    assert texts[11] == ["a\nb\n\na"]
    assert drop_recurring_lines(cases.frame(spark, [])).count() == 0


def test_rows_without_an_id_come_last(spark):
    rows = [(None, "same line here\nown"), (8, "same line here"), (None, "only here\nother")]
    found = {r.text for r in line_query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {"own", "same line here", "only here\nother"}


def test_a_long_token_is_read_once(spark):
    # Backtracking over it would not end.
    rows = [(1, "x" * 300_000 + " y"), (2, "z")]
    assert recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).count() == 2


def test_no_python_on_the_main_path(spark):
    docs = spark.createDataFrame([(5, "a b")], "doc_id long, text string")
    plan = line_query(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize(("n_tokens", "places"), [(24, (5, 12, 20)), (60, (10, 30, 50))])
def test_scattered_names_are_fields(spark, n_tokens, places):
    """Three names in three different places leave 87.5 and 95 percent of the tokens constant."""

    def line(name):
        return " ".join(f"{name}{'abc'[places.index(i)]}" if i in places else f"w{'x' * i}" for i in range(n_tokens))

    rows = [(1, line("anna") + "\nmine one"), (2, line("bert") + "\nmine two")]
    assert cleaned(spark, rows) == {1: rows[0][1], 2: "mine two"}


NUMBERS = "10 20 30 40 50 60 70 80 90 11 21"


@pytest.mark.parametrize(
    ("one", "two"),
    [
        ("10 20 30", "11 21  31"),
        ("https://a.example/1", "https://b.example/2"),
        ("2021-03-04", "2021-03-05"),
        ("第3章では天気を述べる。", "価格は100円である。"),
        (NUMBERS, NUMBERS.replace("2", "3")),
        (NUMBERS + " 5", NUMBERS + " 6"),
        (NUMBERS + " anna", NUMBERS + " bert"),
        ("| 12 | 34 | 56 |", "| 99 | 7 | 2024 |"),
        ("- 3.14", "- 2.71"),
        ("Total 4 5 6 7 8 9", "Total 1 2 3 3 3 3"),
        ("page 3", "page \t4"),
    ],
)
def test_fields_alone_are_no_template(spark, one, two):
    rows = [(1, one + "\nmine"), (2, two + "\nhers"), (3, one + "\nours")]
    assert cleaned(spark, rows) == plain(rows) == {1: rows[0][1], 2: rows[1][1], 3: "ours"}


def test_words_make_a_template(spark):
    rows = [(1, "you are on page 3\nmine"), (2, "you are  on page \t4\nhers")]
    assert cleaned(spark, rows) == plain(rows) == {1: rows[0][1], 2: "hers"}


def test_values_that_come_back_stay_fields(spark):
    """Each of four names and four cities stands in several lines; only the first line is kept."""
    line = "please send all your comments to {} in {} well before the final deadline"
    pairs = [(n, c) for n in ("anna", "bert", "carl", "dora") for c in ("lyon", "bonn", "riga", "graz")]
    rows = [(k, line.format(*pair) + f"\nmine {'x' * k}") for k, pair in enumerate(pairs, start=1)]
    found = cleaned(spark, rows)
    assert found == plain(rows) and found[1] == rows[0][1]
    assert all(found[k] == f"mine {'x' * k}" for k in range(2, 17))
    # More lines change nothing about the first ones.
    more = rows + [(100 + k, line.format(*pairs[k % 16])) for k in range(200)]
    assert {k: v for k, v in cleaned(spark, more).items() if k < 100} == found


def test_two_templates_of_one_leaf(spark):
    one = "the committee met at noon and sent {} a letter about plans"
    two = "the committee met at home and gave {} some money for books"
    names = "anna bert carl dora emil fred gina".split()
    rows = [(k, (one if k % 3 else two).format(n)) for k, n in enumerate(names)]
    assert cleaned(spark, rows) == plain(rows) == {k: rows[k][1] if k < 2 else "" for k in range(7)}


def test_rows_of_null_texts_and_of_dropped_lines(spark):
    rows = [(1, "the same line"), (2, "the same line"), (3, None), (4, "")]
    found = {r.doc_id: (r.n_kept_lines, r.n_dropped_lines, r.text)
             for r in line_query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (1, 0, "the same line"), 2: (0, 1, ""), 3: (0, 0, None), 4: (1, 0, "")}


@pytest.mark.parametrize(
    "line", ["please send your comments to {} before the deadline", "kind regards from all {}"]
)
def test_short_lines_have_fields(spark, line):
    rows = [(i, line.format(name) + f"\nmine {name}") for i, name in enumerate(["anna", "bert", "carla"])]
    assert cleaned(spark, rows) == plain(rows) == {0: rows[0][1], 1: "mine bert", 2: "mine carla"}


def test_short_lines_with_few_constant_words_stay(spark):
    rows = [(1, "one two three four five six"), (2, "one two three four nine ten")]
    assert cleaned(spark, rows) == plain(rows) == dict(rows)
