"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and one integer whose
bit ``r`` is set when rule ``r`` failed; a policy is a mask of the rules it applies, so a new policy
version, or the question what one rule costs, is bitwise work on the ledger and never reads a text.

Defined results: a null text has no words (and fails the word count); repeated rows each get their
row; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import in_batches

MEASUREMENTS = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
    "n_repeat_words long, n_upper long, n_lower long"
)
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"

#: Rule name -> failure condition over the measurements; the position is the bit. Whole numbers only,
#: so every engine decides alike. Append rules, never reorder them: stored ledgers hold the bits.
RULES = {
    "too_few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "n_lines >= 4 AND 10 * n_dup_lines > 3 * n_lines",
    "upper_case": "n_upper > n_lower",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
}
BASE_RULES = ("too_few_words", "repeated_windows")

#: Policy versions: the rules each applies.
POLICIES = {
    1: ("too_few_words", "repeated_windows", "symbols"),
    2: tuple(RULES),
}
CURRENT_POLICY = 2


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(rule) for rule in rules)


def repeated_words(ids: np.ndarray, n_distinct: int, window: int = 3) -> int:
    """Words that lie in a window found at least twice; ``ids`` number the words of one text."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = ids[:n]
    size = n_distinct
    for step in range(1, window):
        if size * n_distinct >= 2**62:  # renumber before the product leaves 64 bits
            distinct, key = np.unique(key, return_inverse=True)
            size = len(distinct)
        key = key * n_distinct + ids[step : step + n]
        size *= n_distinct
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(n, dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for step in range(window):
        covered[step : step + n] |= repeated
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASUREMENTS``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split on exactly the blanks \x20 and \x09-\x0D
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    blanks = sum(text.count(c) for c in BLANKS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    octets = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(octets, minlength=256)
    return (
        len(words),
        len(text) - blanks,
        int(sum(kinds[ord(c)] for c in SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(ids, max(1, len(numbers))),
        int(kinds[65:91].sum()),
        int(kinds[97:123].sum()),
    )


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, measurements, and ``fail_bits``."""
    names = [part.split()[0] for part in MEASUREMENTS.split(", ")]

    def start():
        def work(columns):
            rows = [measure(text) for text in columns["text"]]
            out = dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in names}
            return {"doc_id": columns["doc_id"], **out}

        return work

    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    measured = in_batches(slim, "doc_id long, " + MEASUREMENTS, start)
    bits = sum(
        (F.when(F.expr(rule), F.lit(1 << bit)).otherwise(0) for bit, rule in enumerate(RULES.values())),
        F.lit(0),
    )
    return measured.withColumn("fail_bits", bits.cast("int"))


def passes(policy: int = CURRENT_POLICY, without: str | None = None) -> Column:
    """True for ledger rows that a policy version keeps, optionally with one rule left out."""
    mask = mask_of(POLICIES[policy])
    if without is not None:
        mask &= ~mask_of((without,))
    return F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0


def ablations(rows: DataFrame, policy: int = CURRENT_POLICY) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and kept without it.

    One aggregate over the distinct bit patterns (at most 2^rules), then a sum over those.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    mask = mask_of(POLICIES[policy])
    names = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(mask_of((rule,))).alias("bit"))
        for rule in POLICIES[policy]
    ])
    failing = F.col("fail_bits").bitwiseAND(F.lit(mask))
    return (
        patterns.select(failing.alias("failing"), "n", F.inline(names))
        .groupBy("rule")
        .agg(
            F.sum(F.when(F.col("failing").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0))
            .alias("n_failed"),
            F.sum(F.when(F.col("failing") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_alone"),
            F.sum(F.when(F.col("failing").isin(0) | (F.col("failing") == F.col("bit")), F.col("n"))
                  .otherwise(0)).alias("n_kept_without"),
        )
    )


def quality_query(docs: DataFrame) -> DataFrame:
    """The ledger of every document with the base verdict and that of the current policy."""
    base_failed = F.col("fail_bits").bitwiseAND(F.lit(mask_of(BASE_RULES))) != 0
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & passes()).alias("kept"),
        "n_lines", "n_upper", "n_lower", "fail_bits",
    )


def quality_sql() -> str:
    """The same in DuckDB SQL."""
    bits = " + ".join(
        f"CASE WHEN {rule} THEN {1 << bit} ELSE 0 END" for bit, rule in enumerate(RULES.values())
    )
    base, policy = mask_of(BASE_RULES), mask_of(POLICIES[CURRENT_POLICY])
    return rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT *, list_transform(range(1, greatest(len(words) - 1, 1)),
                           lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS grams,
         list_filter(string_split(text, chr(10)),
                     lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), grams AS (
  SELECT *, CASE WHEN len(grams) > 0 THEN histogram_of END AS counts
  FROM windows LEFT JOIN (
    SELECT doc_id AS gram_doc, map_from_entries(list((gram, n))) AS histogram_of FROM (
      SELECT doc_id, gram, count(*) AS n
      FROM (SELECT doc_id, unnest(grams) AS gram FROM windows) GROUP BY doc_id, gram
    ) GROUP BY doc_id
  ) ON gram_doc = doc_id
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(list_filter(range(1, len(words) + 1), lambda i:
             (i <= len(grams) AND counts[grams[i]] > 1)
             OR (i > 1 AND i - 1 <= len(grams) AND counts[grams[i - 1]] > 1)
             OR (i > 2 AND i - 2 <= len(grams) AND counts[grams[i - 2]] > 1)))::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(text, '[^a-z]', '', 'g'))::BIGINT AS n_lower
  FROM grams
), bits AS (SELECT *, ({bits})::INTEGER AS fail_bits FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & {base}) <> 0 AS base_failed, (fail_bits & {base | policy}) = 0 AS kept,
       n_lines, n_upper, n_lower, fail_bits
FROM bits"""
