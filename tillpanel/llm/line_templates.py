"""Line deduplication by a log-template tree, in DataFrame operations only.

Lines are parsed like log messages. A token with a digit is a variable field ``<*>`` from the start,
if at least ``SIMILARITY`` percent of the line's tokens are words (letters and no digit); a line with
fewer words, like a row of numbers, is compared by its exact tokens and goes no further.

The tree has a fixed depth: the number of tokens, then the ``DEPTH`` leading tokens. In a leaf, every
token other than a field is held at its place by some number of different lines. The lines of a
template share its words, so at least ``SIMILARITY`` percent of a line's tokens are held by as many
lines as the template has: the count at that rank is the line's support. Tokens held by more than
half of the support are constant, all others are variable fields. Values of a field that come back
stay fields that way, however many lines there are; a count that only had to be above one would call
every value constant in a large corpus. A line stands for its constant tokens and their places, if its
support is two lines or more.

A template in the lines of several documents recurs: its lines stay in the document with the least
id and are dropped from all others. Repeats within one document are left.

Every text is parsed once. Copies of a line become one row before templates are made, and tokens are
only looked at in leaves with several different lines; the leading tokens, which a whole leaf shares,
are counted once per leaf. Templates travel as pairs of 64-bit hashes.

Defined results: blank lines and null texts are left as they are. Rows that repeat an id are one
document. Rows without an id come after all others. A token ``<*>`` in a text is a field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import discard, stored

DEPTH = 4
SIMILARITY = 70

_BLANK = r"\x20\x09-\x0D"
# Possessive, and only at the start of a token: linear for tokens of any length.
_DIGIT_TOKEN = rf"(?<![^{_BLANK}])[^{_BLANK}0-9]*+[0-9][^{_BLANK}]*+"
_FIELD = "<*>"
# A token with a letter, in text with one blank between tokens; letters are A-Z, a-z and all beyond ASCII.
_LETTERS = r"A-Za-z\x{80}-\x{10FFFF}"
_WORD = rf"(?<![^ ])[^ {_LETTERS}]*+[{_LETTERS}][^ ]*+"
_SECOND = 7


def _single(text: Column, line: Column) -> Column:
    """``text``, made of the tokens of ``line``, with one blank between tokens."""
    # Most lines have no odd blanks; the pattern runs on the others only.
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    for blank in "\t\r\x0b\x0c":
        odd = odd | line.contains(blank)
    return F.when(odd, F.trim(F.regexp_replace(text, rf"[{_BLANK}]+", " "))).otherwise(text)


def masked(line: Column) -> Column:
    """Tokens of a line, one blank apart, with ``<*>`` for each that has a digit."""
    # Most lines have no digits either.
    fields = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _DIGIT_TOKEN, _FIELD)).otherwise(line)
    return _single(fields, line)


def _lines(docs: DataFrame) -> DataFrame:
    """Every line that is not blank, with its leaf and hashes; masked, if it can have a general template."""
    line = F.col("col")
    blanks = F.octet_length("masked") - F.octet_length(F.replace("masked", F.lit(" "), F.lit("")))
    # Only lines with a field need their words counted.
    few_words = F.col("masked").contains(_FIELD) & (
        F.regexp_count("masked", F.lit(_WORD)) * 100 < F.col("n_tokens") * SIMILARITY
    )
    return (
        docs.filter(F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")))
        .filter(line.rlike(rf"[^{_BLANK}]"))
        .select("doc_id", "text_hash", F.col("pos").alias("line_no"), "col", masked(line).alias("masked"))
        .select("*", (blanks + 1).alias("n_tokens"))
        .select("*", few_words.alias("few_words"))
        .withColumn("masked", F.when(F.col("few_words"), _single(line, line)).otherwise(F.col("masked")))
        .select(
            "doc_id", "text_hash", "line_no", "n_tokens",
            F.when(
                ~F.col("few_words") & (F.col("n_tokens") > DEPTH),
                F.xxhash64("n_tokens", F.substring_index("masked", " ", DEPTH)),
            ).alias("leaf"),
            F.xxhash64("masked").alias("h1"), F.xxhash64(F.lit(_SECOND), "masked").alias("h2"), "masked",
        )
        .withColumn("masked", F.when(F.col("leaf").isNotNull(), F.col("masked")))
    )


def _general(lines: DataFrame, distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(h1, h2, first): the least id over the general template of a line, where it has one.

    Also the stored table that the result reads.
    """
    leaves = (
        distinct.filter(F.col("leaf").isNotNull()).groupBy("leaf").agg(F.count("*").alias("leaf_lines"))
        .filter("leaf_lines > 1")
    )
    several = (
        lines.filter(F.col("leaf").isNotNull()).select("leaf", "h1", "h2", "n_tokens", "masked")
        .join(leaves, "leaf").dropDuplicates(["leaf", "h1", "h2"])
    )
    # A row per line, which stands for its leading tokens (pos -1), and a row per other token.
    token = F.when(F.col("col") != _FIELD, F.xxhash64("col"))
    leading = F.size(F.filter(F.slice("split", 1, DEPTH), lambda t: t != _FIELD))
    cells = stored(
        several.select("leaf", "h1", "h2", "n_tokens", "leaf_lines", F.split("masked", " ").alias("split"))
        .select(
            "leaf", "h1", "h2", "n_tokens", leading.alias("leading"), "leaf_lines",
            F.posexplode(F.concat(F.array(F.lit("")), F.slice("split", DEPTH + 1, 1 << 30))),
        )
        .select(
            "leaf", "h1", "h2", (F.col("pos") - 1).alias("pos"),
            F.when(F.col("pos") > 0, token).alias("token"),
            *[F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in ("n_tokens", "leading", "leaf_lines")],
        )
        .filter("pos < 0 OR token IS NOT NULL"),
        "line-tokens",
    )
    tokens = cells.filter("pos >= 0").select("leaf", "h1", "h2", "pos", "token")
    # What one line alone holds is below half of any support.
    held = tokens.groupBy("leaf", "pos", "token").agg(F.count("*").alias("held")).filter("held > 1")
    shared = tokens.join(held, ["leaf", "pos", "token"]).unionByName(
        cells.filter("pos < 0").drop("token"), allowMissingColumns=True
    )
    of_line = shared.groupBy("leaf", "h1", "h2").agg(
        F.max("n_tokens").alias("n"), F.max("leading").alias("leading"), F.max("leaf_lines").alias("leaf_lines"),
        F.collect_list(F.when(F.col("pos") >= 0, F.struct("pos", "token", "held"))).alias("shared"),
    )
    # The rank of the support among the tokens that are not leading; those come before all others.
    rank = F.expr(f"(n * {SIMILARITY} + 99) div 100 - leading")
    support = F.when(F.col("rank") <= 0, F.col("leaf_lines")).otherwise(
        F.try_element_at(F.sort_array(F.transform("shared", lambda c: c["held"]), False), F.col("rank").cast("int"))
    )
    # The support as a lambda's variable: worked out once per line, not once per token.
    constant = F.transform(F.array(support), lambda enough: F.sort_array(F.transform(
        F.filter("shared", lambda c: c["held"] * 2 > enough), lambda c: F.struct(c["pos"], c["token"])
    )))[0]
    templates = (
        of_line.select("*", rank.alias("rank")).filter(support > 1)
        .select("leaf", "h1", "h2", constant.alias("constant"))
        .select("leaf", "h1", "h2", F.xxhash64("constant").alias("t1"), F.xxhash64(F.lit(_SECOND), "constant").alias("t2"))
        .join(distinct.select("h1", "h2", "first"), ["h1", "h2"])
    )
    named = stored(templates.select("leaf", "t1", "t2", "h1", "h2", "first"), "line-templates")
    first = named.groupBy("leaf", "t1", "t2").agg(F.min("first").alias("first"))
    discard(cells)
    return named.drop("first").join(first, ["leaf", "t1", "t2"]).select("h1", "h2", "first"), named


def recurring_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, dropped) of every line that is not blank."""
    return _recurring_lines(docs)[0]


def _recurring_lines(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The recurring lines, and the stored tables that they are read from."""
    lines = stored(_lines(docs), "lines")
    distinct = stored(
        lines.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("first"), F.max("leaf").alias("leaf"), F.max("n_tokens").alias("n_tokens")
        ),
        "distinct-lines",
    )
    general, named = _general(lines, distinct)
    general = general.withColumnRenamed("first", "general_first")
    firsts = distinct.select("h1", "h2", "first").join(general, ["h1", "h2"], "left").select(
        "h1", "h2", F.least("first", "general_first").alias("first")
    )
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.col("first").isNotNull())
    found = lines.select("doc_id", "text_hash", "line_no", "h1", "h2").join(firsts, ["h1", "h2"]).select(
        "doc_id", "text_hash", "line_no", later.alias("dropped")
    )
    return found, [lines, distinct, named]


def drop_recurring_lines(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the lines of recurring templates dropped, and ``n_dropped_lines``.

    Every other column is kept; an input column of that name is replaced.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.col(text_column).alias("text"))
    lines, read = _recurring_lines(slim)
    # Only line numbers are kept on disk beside the texts; the tables of lines go before those are shuffled.
    touched = stored(
        lines.filter("dropped")
        .groupBy(F.col("doc_id").alias("line_doc"), F.col("text_hash").alias("line_text"))
        .agg(F.sort_array(F.collect_set("line_no")).alias("drops")),
        "dropped-lines",
    )
    discard(*read)
    # By frame, so that columns of these names in the input do no harm.
    text, drops = docs[text_column], touched["drops"]
    joined = docs.drop("n_dropped_lines").join(
        touched,
        docs["doc_id"].cast("long").eqNullSafe(touched["line_doc"])
        & (F.xxhash64(text) == touched["line_text"]),
        "left",
    )
    # Flags by line number, in one pass each: kept numbers are those that drops lacks.
    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    kept = F.filter(
        F.arrays_zip(numbered.alias("numbered"), _flags(text, drops).alias("flags")),
        lambda z: ~z["flags"],
    )
    cleaned = F.array_join(F.transform(kept, lambda z: z["numbered"]["line"]), "\n")
    return joined.select(
        *[
            F.when(drops.isNull(), text).otherwise(cleaned).alias(text_column)
            if name == text_column else docs[name]
            for name in docs.columns if name != "n_dropped_lines"
        ],
        F.coalesce(F.size(drops), F.lit(0)).alias("n_dropped_lines"),
    )


def _flags(text: Column, drops: Column) -> Column:
    """True per dropped line number: the gaps between drops are filled run by run."""
    n = F.size(F.split(text, "\n"))
    ends = F.concat(drops, F.array(n))
    starts = F.concat(F.array(F.lit(-1)), drops)
    runs = F.zip_with(starts, ends, lambda a, b: F.concat(
        F.array_repeat(F.lit(False), b - a - 1), F.when(b < n, F.array(F.lit(True))).otherwise(F.array())
    ))
    return F.flatten(runs)


def line_query(docs: DataFrame) -> DataFrame:
    counted = docs.select("doc_id", "text", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    counted = counted.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")))
    return drop_recurring_lines(counted).select(
        "doc_id", (F.col("n_lines") - F.col("n_dropped_lines")).alias("n_kept_lines"), "n_dropped_lines", "text"
    )


def line_sql() -> str:
    """The same in DuckDB SQL, on the tokens themselves instead of hashes."""
    return rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no
  FROM documents WHERE text IS NOT NULL
), parsed AS (
  SELECT doc_id, line_no, line, regexp_extract_all(line, '[^{_BLANK}]+') AS own FROM lines
), judged AS (
  SELECT *, len(own) AS n,
         regexp_matches(line, '[0-9]|<[*]>') AND 100 * len(list_filter(own, lambda x: NOT regexp_matches(x, '[0-9]') AND regexp_matches(x, '[{_LETTERS}]')))
             < {SIMILARITY} * len(own) AS few_words
  FROM parsed
), filled AS (
  SELECT *, CASE WHEN few_words THEN own ELSE
           list_transform(own, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) END AS tokens
  FROM judged WHERE n > 0
), uniq AS (
  SELECT tokens, n, bool_or(NOT few_words) AND n > {DEPTH} AS in_tree, tokens[1:{DEPTH}] AS lead, min(doc_id) AS first
  FROM filled GROUP BY tokens, n
), cells AS (
  SELECT tokens, n, lead, pos, tokens[pos] AS token
  FROM (SELECT *, unnest(range(1, n + 1)) AS pos FROM uniq WHERE in_tree)
), held AS (
  SELECT n, lead, pos, token, count(*) AS held FROM cells WHERE token <> '<*>' GROUP BY n, lead, pos, token
), of_line AS (
  SELECT c.tokens, c.n, c.lead, list(h.held ORDER BY h.held DESC)[(c.n * {SIMILARITY} + 99) // 100] AS support,
         list(struct_pack(pos := c.pos, token := c.token, held := h.held) ORDER BY c.pos) AS shared
  FROM cells c JOIN held h ON c.n = h.n AND c.lead = h.lead AND c.pos = h.pos AND c.token = h.token
  GROUP BY c.tokens, c.n, c.lead
), templates AS (
  SELECT tokens, n, lead,
         list_transform(list_filter(shared, lambda x: 2 * x.held > support), lambda x: struct_pack(pos := x.pos, token := x.token)) AS constant
  FROM of_line WHERE support > 1
), general AS (
  SELECT t.tokens, min(u.first) OVER (PARTITION BY t.n, t.lead, t.constant) AS first
  FROM templates t JOIN uniq u ON u.tokens = t.tokens
), firsts AS (
  SELECT u.tokens, least(u.first, coalesce(g.first, u.first)) AS first
  FROM uniq u LEFT JOIN general g ON g.tokens = u.tokens
), flagged AS (
  SELECT p.doc_id, p.line_no, p.line, coalesce(p.doc_id > f.first, false) AS dropped
  FROM parsed p LEFT JOIN filled q ON q.doc_id = p.doc_id AND q.line_no = p.line_no
  LEFT JOIN firsts f ON f.tokens = q.tokens
), cleaned AS (
  SELECT doc_id, (count(*) FILTER (NOT dropped))::INTEGER AS n_kept_lines,
    (count(*) FILTER (dropped))::INTEGER AS n_dropped_lines,
    array_to_string(coalesce(list(line ORDER BY line_no) FILTER (NOT dropped), []), chr(10)) AS text
  FROM flagged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_kept_lines, 0)::INTEGER AS n_kept_lines,
  coalesce(c.n_dropped_lines, 0)::INTEGER AS n_dropped_lines, c.text
FROM documents d LEFT JOIN cleaned c ON c.doc_id = d.doc_id"""
