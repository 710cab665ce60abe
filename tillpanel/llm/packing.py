"""Best-fit packing of token sequences, planned on the histogram of their lengths.

Only lengths decide a packing, and there are at most ``capacity`` of them, so the plan is made on
(length, count) pairs, whatever the number of documents:

* Lengths above a third of the capacity fit at most twice in a sequence. From the longest down, each
  is matched with the longest partner that still fits.
* Shorter lengths, longest first, go to the smallest gap that takes them, as often as it does.

Sequences with equal contents are runs in the plan, so its size is bounded by the capacity, not by
the corpus. A piece finds its place by its rank among the pieces of its length. Ranks are counted in
salted parts, since one length (a full sequence) may hold most pieces.

Defined results: a null text has no ids but the end id, as an empty one has. Rows that repeat an id
are packed each. Only longer documents are cut; pieces of the full capacity are sequences of their
own.
"""

from __future__ import annotations

import bisect
import json
import re
from collections import defaultdict
from functools import cache
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import in_batches, stored

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
CACHED_CHUNKS = 800_000
CACHED_PARTS = 400_000
#: Pieces ranked together.
RANKED_TOGETHER = 100_000


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


# ---- token ids ----------------------------------------------------------------------------------


@cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _prepared_tokenizer(path: str):
    """The same vocabulary and merges for text that ``_prepared`` has brought into their form.

    Also which ids end a part, if every part has one such id, its last; else None.
    """
    from tokenizers import Tokenizer

    parts = json.loads(Path(path).read_text(encoding="utf-8"))
    changes = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
    vocab, suffix = parts["model"]["vocab"], parts["model"].get("end_of_word_suffix")
    ends = None
    if suffix and all(f"{letter}{end}" in vocab for letter in _BYTE_FORMS for end in ("", suffix)):
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[k for token, k in vocab.items() if token.endswith(suffix)]] = True
    return Tokenizer.from_str(json.dumps(parts | changes)), ends


# The part pattern of this tokenizer, here for ASCII and the Latin-1 letters, and the
# letters that byte-level vocabularies use for bytes: printable bytes are themselves, the others
# follow from U+0100.
_LETTER = "a-zß-öø-ÿ"
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+")
_PARTS_AND_ENDS = re.compile(rf"{_PARTS.pattern}|\n")
_ALL_SIMPLE = re.compile(r"[\n!-~À-ÖØ-öø-ÿ]+")
_SPECIAL = "<|"  # how this tokenizer's special tokens begin
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {
    byte: 0x100 + k for k, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)
} | {0x20: 0x20}
_BYTE_FORMS = [chr(_BYTE_LETTERS.get(byte, byte)) for byte in range(256) if byte != 0x20]
_MARKS = "\u2665\u2605\u2713\u266b\u2192\u2022"
_AS_BYTES = [
    (c, c.encode("utf-8").decode("latin-1").translate(_BYTE_LETTERS))
    for c in _MARKS + "".join(map(chr, (*range(0xDF, 0xF7), *range(0xF8, 0x100))))
]


def _prepared(text: str) -> str:
    """Lower case, parts with blanks between them, bytes as letters; for simple chunks and marks."""
    parts = " ".join(_PARTS.findall(text.lower()))
    # A letter's bytes may look like letters that are still to come, so each goes by way of a number.
    for k, (letter, _) in enumerate(_AS_BYTES):
        parts = parts.replace(letter, chr(0xE000 + k))
    for k, (_, form) in enumerate(_AS_BYTES):
        parts = parts.replace(chr(0xE000 + k), form)
    return parts


def _cut(ids: np.ndarray, ends: np.ndarray, between: int, members: list, known: dict) -> None:
    """Ids of each member into ``known``; so many ids stand ``between`` one's end and the next."""
    raw, at = ids.tobytes(), 0
    for member, end in zip(members, (4 * ends).tolist(), strict=True):
        known[member] = raw[at:end]
        at = end + 4 * between


class ChunkIds:
    """Token ids of whole texts from those of their blank-separated chunks.

    This tokenizer drops white space and never joins across it, so a text's ids are those of its chunks
    in turn; the ids of frequent chunks are remembered. Most chunks are of ASCII and Latin-1 letters; for them
    lower case and parts are found here at once, and as parts are encoded apart, a chunk's ids are those of its
    parts. There are far fewer parts than chunks, and their ids are remembered too. New parts are encoded many at
    a time; the last id of each tells that it is one. All other chunks take the tokenizer's own way, many at
    a time too, with a mark of one id between them that none of them holds.
    """

    TOGETHER = 256
    END = 2**32 - 1  # no id; stands for the end of a chunk
    PROBE = "It's A test,  of\tÉCOLES naïve't 42nd!! \u65e5\u672c x.y\n\u2665"

    def __init__(self, path: str):
        self.tokenizer, (self.prepared, self.ends) = _tokenizer(path), _prepared_tokenizer(path)
        self.known: dict[bytes, bytes] = {b"": b""}
        self.parts: dict[str, bytes] = {}
        # A tokenizer of another kind gets its chunks one by one.
        single = ((m, self._ids(m)) for m in _MARKS if self.ends is not None)
        self.mark, self.mark_id = next(((m, ids[0]) for m, ids in single if len(ids) == 1), ("", -1))
        found = np.frombuffer(self([self.PROBE])[0], "<u4").tolist()
        if found != self._ids(self.PROBE):
            raise ValueError(f"the tokenizer at {path} does not treat blank-separated chunks apart")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, chunks: list[bytes]) -> None:
        simple, other = [], []
        for i in range(0, len(chunks), self.TOGETHER):
            group = chunks[i : i + self.TOGETHER]
            joined = b"\n".join(group).decode("utf-8")
            if self.mark and _ALL_SIMPLE.fullmatch(joined) and _SPECIAL not in joined:
                simple.append((group, joined))
                continue
            plain, odd = [], []
            for chunk, text in zip(group, joined.split("\n"), strict=True):
                if not self.mark or self.mark in text:
                    self.known[chunk] = np.array(self._ids(text), "<u4").tobytes()
                elif _ALL_SIMPLE.fullmatch(text) and _SPECIAL not in text:
                    plain.append(chunk)
                else:
                    odd.append(chunk)
            simple += [(plain, b"\n".join(plain).decode("utf-8"))] if plain else []
            other += [(odd, b"\n".join(odd).decode("utf-8"))] if odd else []
        self._join_parts(simple)
        between = f" {self.mark} "
        texts = [joined.replace("\n", between) for _, joined in other]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for (group, _), found in zip(other, encoded, strict=True):
            ids = np.array(found.ids, "<u4")
            _cut(ids, np.append(np.flatnonzero(ids == self.mark_id), len(ids)), 1, group, self.known)

    def _join_parts(self, groups: list[tuple[list[bytes], str]]) -> None:
        """Ids of groups of simple chunks, each also as one text with a line per chunk."""
        if len(self.parts) > CACHED_PARTS:
            self.parts.clear()
        self.parts["\n"] = np.array([self.END], "<u4").tobytes()
        split = [_PARTS_AND_ENDS.findall(f"{joined.lower()}\n") for _, joined in groups]
        new = list(set().union(*split).difference(self.parts))
        together = [new[i : i + self.TOGETHER] for i in range(0, len(new), self.TOGETHER)]
        encoded = self.prepared.encode_batch_fast(
            [_prepared(" ".join(some)) for some in together], add_special_tokens=False
        )
        for some, found in zip(together, encoded, strict=True):
            ids = np.array(found.ids, "<u4")
            _cut(ids, np.flatnonzero(self.ends[ids]) + 1, 0, some, self.parts)
        for (group, _), parts in zip(groups, split, strict=True):
            ids = np.frombuffer(b"".join(map(self.parts.__getitem__, parts)), "<u4")
            _cut(ids, np.flatnonzero(ids == self.END), 1, group, self.known)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > CACHED_CHUNKS:
            self.known = {b"": b""}
        whole = pa.array([t or "" for t in texts], pa.large_string())
        # ascii_lower() changes A-Z alone, which the tokenizer would do; special tokens are told by case.
        lower = pc.if_else(pc.match_substring(whole, _SPECIAL), whole, pc.ascii_lower(whole))
        split = pc.ascii_split_whitespace(lower)
        # Each chunk is looked up once for all its places in the batch.
        chunks = split.values.dictionary_encode()
        distinct = chunks.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, distinct))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            self._learn([distinct[i] for i in missing])
            for i in missing:
                found[i] = self.known[distinct[i]]
        placed = pa.array(found, pa.large_binary()).take(chunks.indices)
        _, bounds, ids = placed.buffers()
        ends = np.frombuffer(bounds, np.int64)[split.offsets.to_numpy()].tolist()
        raw = memoryview(ids or b"")
        return [bytes(raw[a:b]) for a, b in pairwise(ends)]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids and the end id, cut only where longer."""
    end = np.array([end_id], "<u4").tobytes()

    def start():
        encode = ChunkIds(tokenizer_path)

        def work(columns):
            rows = [
                (doc_id, k, k * capacity, ids[4 * k * capacity : 4 * (k + 1) * capacity])
                for doc_id, ids in zip(columns["doc_id"], encode(columns["text"]), strict=True)
                for ids in [ids + end]
                for k in range((len(ids) // 4 + capacity - 1) // capacity)
            ]
            return {
                "doc_id": [r[0] for r in rows], "piece": [r[1] for r in rows],
                "start": [r[2] for r in rows], "length": [len(r[3]) // 4 for r in rows],
                "ids": [r[3] for r in rows],
            }

        return work

    slim = docs.select(F.col("doc_id").cast("long"), F.col(text_column).alias("text"))
    return in_batches(
        slim, "doc_id long, piece int, start long, length long, ids binary", start, chunk_rows=512
    )


# ---- the plan -----------------------------------------------------------------------------------


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit plan of a length histogram.

    Each entry (length, first rank, per sequence, first sequence, offset) places the pieces of that length
    from that rank on: ``per sequence`` of them side by side from ``offset``, in consecutive sequences.
    """
    if any(length < 1 or length > capacity for length in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    left = {length: n for length, n in counts.items() if n > 0}
    rank: dict[int, int] = defaultdict(int)
    plan: list[tuple[int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, how many)
    sequences = 0

    def place(length, n, per_sequence, first, offset):
        plan.append((length, rank[length], per_sequence, first, offset))
        rank[length] += n
        left[length] -= n

    large = sorted(length for length in left if 3 * length > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, capacity - length) - 1
            while at >= 0 and left[large[at]] < 1 + (large[at] == length):
                at -= 1
            if at < 0:
                n, partner = left[length], 0
                place(length, n, 1, sequences, 0)
            elif large[at] == length:
                partner, n = length, left[length] // 2
                place(length, 2 * n, 2, sequences, 0)
            else:
                partner = large[at]
                n = min(left[length], left[partner])
                place(length, n, 1, sequences, 0)
                place(partner, n, 1, sequences, length)
            runs[capacity - length - partner].append((sequences, n))
            sequences += n

    gaps = sorted(gap for gap, found in runs.items() if found and gap)
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, n = runs[gap].pop()
                if not runs[gap]:
                    del gaps[at]
            else:
                gap, first = capacity, sequences
                n = -(-left[length] // (capacity // length))
                sequences += n
            per = gap // length
            used = min(n, left[length] // per)  # sequences that take as many as fit
            fresh = [(first + used, n - used, gap)]
            if used:
                place(length, used * per, per, first, capacity - gap)
                fresh.append((first, used, gap - per * length))
            if left[length] and n > used:  # the rest shares one more sequence
                rest = left[length]
                if rest < per:
                    place(length, rest, rest, first + used, capacity - gap)
                    fresh[0] = (first + used + 1, n - used - 1, gap)
                    fresh.append((first + used, 1, gap - rest * length))
            for start, many, free in fresh:
                if many and free:
                    if not runs[free]:
                        bisect.insort(gaps, free)
                    runs[free].append((start, many))
    return plan


# ---- placing ------------------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, any more) with ``sequence_id`` and ``offset``."""
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = stored(pieces.select(*names), "pieces")
    # At most ``capacity`` lengths.
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(counts, capacity)

    salts = F.ceil(F.col("of_length") / RANKED_TOGETHER)
    spark = pieces.sparkSession
    of_length = spark.createDataFrame(list(counts.items()) or [(1, 0)], "length long, of_length long")
    # Bounded by the capacity: one row per length.
    salted = pieces.join(F.broadcast(of_length), "length").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece"), F.greatest(salts, F.lit(1)))
    )
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    )
    firsts = parts.select("length", "salt", F.coalesce(before, F.lit(0)).alias("first_rank"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    ranked = (
        salted.withColumn("within", within)
        .join(firsts, ["length", "salt"])
        .withColumn("rank", (F.col("first_rank") + F.col("within") - 1).cast("long"))
        .select(*names, "rank")
    )
    return _placed(ranked, plan, names)


def _placed(ranked: DataFrame, plan: list[tuple], names: list[str]) -> DataFrame:
    """Rank to sequence and offset by binary search in the plan."""
    table = np.array(sorted(plan), np.int64).reshape(-1, 5)
    shared = ranked.sparkSession.sparkContext.broadcast(table)
    kinds = {f.name: f.dataType.simpleString().replace("bigint", "long") for f in ranked.schema}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", sequence_id long, offset long"

    def start():
        table = shared.value
        first = {}
        for row, length in enumerate(table[:, 0].tolist()):
            first.setdefault(length, row)
        span = int(table[:, 1].max(initial=0)) + 1
        keys = [length * span + rank for length, rank in table[:, :2].tolist()]

        def work(columns):
            if not columns["rank"]:
                return None
            wanted = [
                length * span + min(rank, span - 1)
                for length, rank in zip(columns["length"], columns["rank"], strict=True)
            ]
            rows = table[[bisect.bisect_right(keys, w) - 1 for w in wanted]]
            step = np.array(columns["rank"], np.int64) - rows[:, 1]
            out = {n: columns[n] for n in names}
            out["sequence_id"] = rows[:, 3] + step // rows[:, 2]
            out["offset"] = rows[:, 4] + step % rows[:, 2] * rows[:, 0]
            return out

        return work

    return in_batches(ranked, schema, start)


def packed_sequences(pieces: DataFrame) -> DataFrame:
    """Packed pieces (with ``ids``) as whole sequences: ids and the starts of the pieces in them.

    A sequence has at most ``capacity`` pieces, which bounds what is gathered per group.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
        F.col("parts.offset").alias("starts"),
    )


def packing_query(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(docs, default_tokenizer_path())
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(digests).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
