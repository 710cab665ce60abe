"""Alignment of two tokenizers over a corpus, by inverted pair bitmaps.

Both tokenizers cut the same bytes: a blank and the text. Where a token of A and one of B end at the
same byte they are linked, and those places cut the tokens into groups. How often two ids are linked
in the whole corpus is counted in an inverted index:

1. Documents are numbered within segments of at most ``SEGMENT_ROWS`` rows, which never cross a task.
   Per pair of ids a segment has a bitmap of the documents that link it, and a bitmap for each bit of
   the further links (number of links less one) of these documents: the multiplicity planes. Bitmaps
   are compressed: sorted numbers where sparse, bits where dense. A segment's bitmap is the union of
   those of its batches.
2. Popcounts, summed over segments, give each pair its documents and links, and each id of B the
   links of its most frequent pair.
3. Counts go back along the postings: a segment asks for the counts of its own pairs (a pair has at
   most one row per segment, so no pair is hot), and its bitmaps add them up per document.

Tokenizing: texts are cut at single blanks between letters or signs, where tokens of both kinds always
end. Each part is tokenized and aligned once per task, as long as it is remembered; many new parts are
tokenized as one string. Parts whose tokens do not spell them, or which have odd blanks at an end, are
tokenized alone.

Defined results: a text that is null, empty, or not spelled by its tokens (a literal word mark) has no
tokens: zeros and an empty string. Rows that repeat an id, or have none, are documents of their own.
Texts of any length are aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpanel.llm.common import arrow_fields, in_batches, ship_package, stored

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
MARK = "▁"

_PLACE_BITS = 14
SEGMENT_ROWS = 1 << _PLACE_BITS
#: A segment ends early when it holds so many links.
SEGMENT_LINKS = 1 << 22
_ID_BITS = 24
#: Bytes of a bitmap; fewer documents are kept as sorted 16-bit numbers.
_BITMAP = SEGMENT_ROWS // 8
#: Parts and letters of them that a task remembers.
HELD_PARTS, HELD_LETTERS = 400_000, 1 << 24
CHUNK_PARTS = 512

# Whatever some tokenizer may take for a blank, and the mark that stands for one.
_ODD_RANGES = (
    (0x00, 0x20), (0x7F, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F), (0x2028, 0x202F),
    (0x205F, 0x2064), (0x2581, 0x2581), (0x3000, 0x3000), (0xFEFF, 0xFEFF),
)
_ODD = frozenset(chr(c) for low, high in _ODD_RANGES for c in range(low, high + 1))
_NOT_ODD = "[^" + "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in _ODD_RANGES) + "]"
_CUT = re.compile(f"(?<={_NOT_ODD}) (?={_NOT_ODD})")
# Parts of such letters and signs, of no great length, go through the quicker of two equal encoders.
_PLAIN = re.compile("[!-~\\n\\u00a1-\\u024f]{1,200}")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL)


def is_part(part: str) -> bool:
    """Whether a piece between two blanks has letters or signs at both ends."""
    return part != "" and part[0] not in _ODD and part[-1] not in _ODD


def parts_of(text: str) -> list[str]:
    """The text cut at single blanks between letters or signs."""
    return _CUT.split(text)


# ---- tokens of parts -----------------------------------------------------------------------------


def _byte_level_alphabet() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = _byte_level_alphabet()
        size = self.a.get_vocab_size()
        self.a_bytes = [bytes(map(letters.__getitem__, self.a.id_to_token(i))) for i in range(size)]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        # The same merges, where their order is that of the ids.
        model = json.loads(Path(byte_path).read_text(encoding="utf-8"))["model"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = [model["vocab"][x + y] for x, y in pairs]
        self.plain_a = None
        if made == list(range(len(letters), len(letters) + len(made))):
            ranks = {self.a_bytes[i]: i for i in range(len(letters) + len(made))}
            self.plain_a = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_size = np.array(list(map(len, self.a_bytes)))
        self.b_size = np.array(list(map(len, self.b_bytes)))
        # Ids as text with what follows them: by twice the id, plus one at the end of a group; then those of B.
        self.texts = [f"{i}{end}" for i in range(size) for end in ",|"]
        self.texts += [f"{i}{end}" for i in range(len(self.b_bytes)) for end in ",;"]

    def encode(self, chunks: list[list[str]]) -> list[tuple[list[int], list[int]]]:
        """Ids of both kinds for each chunk: its parts with a blank before each."""
        texts = [" ".join(c) for c in chunks]
        plain = [self.plain_a is not None and all(map(_PLAIN.fullmatch, c)) for c in chunks]
        rest = [f" {t}" for t, quick in zip(texts, plain, strict=True) if not quick]
        found = iter(self.a.encode_batch_fast(rest, add_special_tokens=False) if rest else [])
        a = [
            self.plain_a.encode_ordinary(f" {t}") if quick else next(found).ids
            for t, quick in zip(texts, plain, strict=True)
        ]
        return list(zip(a, self.b.encode(texts, num_threads=1), strict=True))

    def spells(self, chunk: list[str], a: list[int], b: list[int]) -> bool:
        expected = "".join([f" {p}" for p in chunk]).encode("utf-8", "surrogatepass")
        return (
            b"".join(map(self.a_bytes.__getitem__, a)) == expected
            and b"".join(map(self.b_bytes.__getitem__, b)) == expected
        )


_tokenizers = cache(Tokenizers)


class Parts:
    """Alignments of parts, numbered; forgotten when there are many."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self._clear()

    def _clear(self):
        self.number: dict[str, int] = {}
        self.between: set[str] = set()  # those with letters or signs at both ends
        self.letters = 0
        self.groups: list[str | None] = []  # text of the groups; None where tokens do not spell the part
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A and B, links, first link
        self.links = np.zeros(0, np.int64)

    def numbers(self, parts: list[str]) -> np.ndarray:
        new = set(parts).difference(self.number)
        if len(self.number) + len(new) > HELD_PARTS or self.letters > HELD_LETTERS:
            self._clear()
            new = set(parts)
        if new:
            self._learn(new)
        return np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))

    def _learn(self, new: set[str]) -> None:
        alone = [p for p in new if not is_part(p)]
        together = new.difference(alone)
        self.between |= together
        plain = [p for p in together if _PLAIN.fullmatch(p)]
        chunks = [
            ps[k : k + CHUNK_PARTS]
            for ps in (plain, list(together.difference(plain))) for k in range(0, len(ps), CHUNK_PARTS)
        ]
        chunks = self._learn_chunks(chunks + [[p] for p in alone])
        # Chunks that do not come out right; single parts among them are not spelled by their tokens.
        for part in (c[0] for c in self._learn_chunks([[p] for c in chunks for p in c])):
            self._add([part], [None], np.zeros((1, 3), np.int64), np.zeros(0, np.int64))

    def _add(self, parts, groups, sizes, links):
        first = len(self.links) + np.concatenate(([0], np.cumsum(sizes[:, 2])[:-1]))
        self.number.update(zip(parts, range(len(self.groups), len(self.groups) + len(parts)), strict=True))
        self.letters += sum(map(len, parts))
        self.groups += groups
        self.sizes = np.concatenate((self.sizes, np.column_stack((sizes, first))))
        self.links = np.concatenate((self.links, links))

    def _learn_chunks(self, chunks: list[list[str]]) -> list[list[str]]:
        """Align the parts of each chunk as one string; returns the chunks for which that fails."""
        encoded = self.tokenizers.encode(chunks) if chunks else []
        right = [self.tokenizers.spells(c, *ids) for c, ids in zip(chunks, encoded, strict=True)]
        kept = [(c, ids) for c, ids, ok in zip(chunks, encoded, right, strict=True) if ok]
        failed = [c for c, ok in zip(chunks, right, strict=True) if not ok]
        return failed + (self._align(kept) if kept else [])

    def _align(self, kept) -> list[list[str]]:
        t = self.tokenizers
        parts = [p for c, _ in kept for p in c]
        a = np.concatenate([np.array(ids[0], np.int64) for _, ids in kept])
        b = np.concatenate([np.array(ids[1], np.int64) for _, ids in kept])
        a_ends, b_ends = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])
        ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts])
        # By byte: the token of B that ends there, and how many ends of groups come up to it.
        b_at = np.full(ends[-1] + 1, -1, np.int64)
        b_at[b_ends] = np.arange(len(b))
        at_a = np.flatnonzero(b_at[a_ends] >= 0)
        common, at_b = a_ends[at_a], b_at[a_ends[at_a]]
        is_end = np.zeros(ends[-1] + 1, np.int64)
        is_end[common] = 1
        if not is_end[ends].all():
            # Tokens reach over a cut somewhere; with one part per chunk they cannot.
            return [c for c, _ in kept]
        n_ends = np.cumsum(is_end)
        links = a[at_a] << _ID_BITS | b[at_b]
        last = np.searchsorted(a_ends, ends, side="right"), np.searchsorted(b_ends, ends, side="right"), n_ends[ends]
        sizes = np.column_stack([np.diff(x, prepend=0) for x in last])
        # Ids as text in the order of groups: those of A, then those of B.
        a_group, b_group = n_ends[a_ends] - is_end[a_ends], n_ends[b_ends] - is_end[b_ends]
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.concatenate(([0], at_b + 1))[a_group]] = 2 * a + is_end[a_ends]
        codes[np.arange(len(b)) + at_a[b_group] + 1] = 2 * (len(t.a_bytes) + b) + is_end[b_ends]
        text = list(map(t.texts.__getitem__, codes.tolist()))
        cuts = (last[0] + last[1]).tolist()
        groups = ["".join(text[lo:hi]) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        self._add(parts, groups, sizes, links)
        return []


@cache
def _parts(*paths: str) -> Parts:
    """One memory for all tasks of a worker."""
    return Parts(_tokenizers(*paths))


# ---- bitmaps -------------------------------------------------------------------------------------


def containers(keys: np.ndarray, links: np.ndarray):
    """Bitmaps of one segment from sorted keys (pair and place) and their numbers of links.

    Plane 0 holds the documents of a pair, plane k those whose further links have bit k - 1.
    Returns pair, plane, popcount and bitmap of each row.
    """
    pairs, planes, counts, bits = [], [], [], []
    more, plane = links - 1, 0
    while plane == 0 or (more >> (plane - 1)).any():
        own = keys if plane == 0 else keys[(more >> (plane - 1)) & 1 == 1]
        pair, place = own >> _PLACE_BITS, (own & (SEGMENT_ROWS - 1)).astype(np.uint16)
        start = np.flatnonzero(np.diff(pair, prepend=-1))
        count = np.diff(start, append=len(pair))
        pairs.append(pair[start])
        planes.append(np.full(len(start), plane))
        counts.append(count)
        bits.append(compressed(place, start, count))
        plane += 1
    return np.concatenate(pairs), np.concatenate(planes), np.concatenate(counts), pa.concat_arrays(bits)


def compressed(place: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.Array:
    """One value per run of sorted places: the places themselves, or bits where these are fewer bytes."""
    dense = 2 * count >= _BITMAP
    size = np.where(dense, _BITMAP // 2, count)
    offset = np.concatenate(([0], np.cumsum(size)))
    data = np.zeros(offset[-1], np.uint16)
    kept = np.repeat(~dense, count)
    data[(np.repeat(offset[:-1] - start, count) + np.arange(len(place)))[kept]] = place[kept]
    for i in np.flatnonzero(dense):
        marked = np.zeros(SEGMENT_ROWS, np.uint8)
        marked[place[start[i] : start[i] + count[i]]] = 1
        data[offset[i] : offset[i + 1]] = np.packbits(marked, bitorder="little").view(np.uint16)
    buffers = [None, pa.py_buffer((2 * offset).astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(start), buffers)


def places(bits: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of all bitmaps one after the other, and how many each has."""
    offset = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1] // 2
    data = np.frombuffer(bits.buffers()[2], np.uint16) if offset[-1] else np.zeros(0, np.uint16)
    found = []
    at = offset[0]
    count = np.diff(offset)
    for i in np.flatnonzero(count == _BITMAP // 2):
        marked = np.flatnonzero(np.unpackbits(data[offset[i] : offset[i + 1]].view(np.uint8), bitorder="little"))
        found += [data[at : offset[i]], marked.astype(np.uint16)]
        at, count[i] = offset[i + 1], len(marked)
    return np.concatenate([*found, data[at : offset[-1]]]), count


# ---- the index -----------------------------------------------------------------------------------

_SCHEMA = (
    "segment long,place int,doc_id long,n_a long,n_b long,n_links long,groups_sha256 string,"
    "pair long,plane int,n_docs long,bits binary"
)


class _Segments:
    """Documents and bitmaps of a task, segment by segment."""

    def __init__(self, paths):
        self.parts = _parts(*paths)
        self._begin()

    def _begin(self):
        # Tasks that are repeated take new numbers; only committed rows are read.
        self.segment = uuid.uuid4().int >> 65
        self.rows: list[tuple] = []
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_links = 0

    def __call__(self, columns):
        done = None
        if len(self.rows) + len(columns["doc_id"]) > SEGMENT_ROWS or self.n_links > SEGMENT_LINKS:
            done = self._ended()
        texts = [t.split(" ") if t else [] for t in columns["text"]]
        # Pieces with odd ends belong to their neighbours.
        for row, pieces in enumerate(texts):
            if not all(map(is_part, set(pieces).difference(self.parts.between))):
                texts[row] = parts_of(columns["text"][row])
        flat = self.parts.numbers([p for parts in texts for p in parts])
        groups = self.parts.groups
        sizes = np.zeros((len(texts), 3), np.int64)
        taken, owner = [], []
        at = 0
        for row, (doc_id, parts) in enumerate(zip(columns["doc_id"], texts, strict=True)):
            own = flat[at : at + len(parts)]
            at += len(parts)
            text = [groups[i] for i in own.tolist()]
            spelled = bool(text) and None not in text
            digest = hashlib.sha256("".join(text)[:-1].encode()).hexdigest() if spelled else ""
            if spelled:
                sizes[row] = self.parts.sizes[own, :3].sum(axis=0)
                taken.append(own)
                owner.append(np.full(len(own), len(self.rows)))
            self.rows.append((doc_id, *sizes[row].tolist(), digest))
        if taken:
            self._hold(np.concatenate(taken), np.concatenate(owner))
        return done

    def _hold(self, parts, place):
        """Links of these parts, which stand in the documents at these places."""
        n, first = self.parts.sizes[parts, 2], self.parts.sizes[parts, 3]
        before = np.cumsum(n) - n
        links = self.parts.links[np.repeat(first - before, n) + np.arange(n.sum())]
        keys, counts = np.unique(links << _PLACE_BITS | np.repeat(place, n), return_counts=True)
        self.held.append((keys, counts))
        self.n_links += len(keys)

    def _ended(self):
        rows, n = self.rows, len(self.rows)
        keys = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in self.held)])
        links = np.concatenate([np.zeros(0, np.int64), *(c for _, c in self.held)])
        order = np.argsort(keys, kind="stable")
        pair, plane, n_docs, bits = containers(keys[order], links[order])
        rest = len(pair)

        def padded(values, kind):
            return pa.concat_arrays([pa.array(values, kind), pa.nulls(rest, kind)])

        def shifted(values, kind):
            return pa.concat_arrays([pa.nulls(n, kind), pa.array(values, kind) if kind != pa.binary() else values])

        columns = {"segment": [self.segment] * (n + rest), "place": padded(list(range(n)), pa.int32())}
        kinds = [pa.int64()] * 4 + [pa.string()]
        for k, name in enumerate(("doc_id", "n_a", "n_b", "n_links", "groups_sha256")):
            columns[name] = padded([r[k] for r in rows], kinds[k])
        columns |= {
            "pair": shifted(pair, pa.int64()), "plane": shifted(plane, pa.int32()),
            "n_docs": shifted(n_docs, pa.int64()), "bits": shifted(bits, pa.binary()),
        }
        self._begin()
        return columns

    def finish(self):
        if self.rows:
            yield self._ended()


def index(docs: DataFrame, paths: tuple[str, str], text_column: str = "text") -> DataFrame:
    """Rows of two kinds: documents by segment and place; bitmaps by segment, pair and plane."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col(text_column).alias("text"))
    return stored(in_batches(docs, _SCHEMA, lambda: _Segments(paths), "finish", 256), "pair-bitmaps")


def pair_counts(indexed: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, n_docs, n_links, is_best): popcounts over all segments."""
    unit = F.when(F.col("plane") == 0, F.lit(1).cast("long")).otherwise(
        F.expr("shiftleft(CAST(1 AS BIGINT), plane - 1)")
    )
    counts = (
        indexed.filter("pair IS NOT NULL").groupBy("pair")
        .agg(F.sum(F.when(F.col("plane") == 0, F.col("n_docs"))).alias("n_docs"),
             F.sum(F.col("n_docs") * unit).alias("n_links"))
    )
    b_id = F.col("pair").bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    # An id of B has at most as many pairs as A has ids.
    most = F.max("n_links").over(Window.partitionBy("b_id"))
    return counts.select("pair", F.shiftright("pair", _ID_BITS).alias("a_id"), b_id.alias("b_id"), "n_docs", "n_links").withColumn(
        "is_best", F.col("n_links") == most
    )


def scores(indexed: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents, with the counts of their links added up along the bitmaps."""
    bitmaps = indexed.filter("pair IS NOT NULL")
    asked = bitmaps.filter("plane = 0").select("segment", "pair").join(
        pairs.select("pair", F.col("n_links").alias("links"), "is_best"), "pair"
    )
    together = indexed.drop("n_docs").unionByName(asked, allowMissingColumns=True)
    schema = (
        "doc_id long,n_a long,n_b long,n_groups long,n_links long,n_best long,count_sum long,groups_sha256 string"
    )
    fields = arrow_fields(schema)
    ship_package(indexed.sparkSession)

    def of_segment(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        docs = rows.filter(pc.is_valid(rows["place"]))
        counts = rows.filter(pc.is_valid(rows["links"])).sort_by("pair")
        bitmaps = rows.filter(pc.is_valid(rows["plane"]))
        total, best = np.zeros(SEGMENT_ROWS, np.int64), np.zeros(SEGMENT_ROWS, np.int64)
        if len(bitmaps):
            place, n = places(bitmaps["bits"].combine_chunks())
            at = np.searchsorted(counts["pair"].to_numpy(), bitmaps["pair"].to_numpy())
            unit = np.left_shift(1, np.maximum(bitmaps["plane"].to_numpy().astype(np.int64) - 1, 0))
            np.add.at(total, place, np.repeat(unit * counts["links"].to_numpy()[at], n))
            is_best = counts["is_best"].to_numpy().astype(np.int64)[at]
            np.add.at(best, place, np.repeat(unit * is_best, n))
        own = docs["place"].to_numpy()
        values = {name: docs[name] for name in ("doc_id", "n_a", "n_b", "n_links", "groups_sha256")}
        # Every place where tokens of both kinds end has one link and ends one group.
        values |= {"n_groups": docs["n_links"], "count_sum": pa.array(total[own]), "n_best": pa.array(best[own])}
        return pa.table([values[f.name] for f in fields], schema=fields).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            segment = batch.column("segment").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(segment)) + 1).tolist(), len(segment)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if held and segment[lo] != current:
                    yield from of_segment(pa.Table.from_batches(held)).to_batches()
                    held = []
                current = segment[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from of_segment(pa.Table.from_batches(held)).to_batches()

    return together.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, schema)


def alignment(docs: DataFrame, paths: tuple[str, str] | None = None, text_column: str = "text") -> DataFrame:
    """Per document: tokens, groups, links, and the corpus-wide counts of its links."""
    indexed = index(docs, paths or default_paths(), text_column)
    return scores(indexed, pair_counts(indexed))


def alignment_query(docs: DataFrame) -> DataFrame:
    return alignment(docs)
