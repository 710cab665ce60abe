"""SentencePiece merge models: encoding with seeded merge-dropout, and lossless decoding.

A merge-type model turns a text into letters and merges neighbours, best score first. Here each
candidate (two neighbouring symbols that make a piece) is taken from the agenda in that order, the
leftmost first among equals, and is skipped for good when a keyed hash of (seed, document, word,
place in the word, the two symbols) falls below the dropout rate. A seed thus gives one
segmentation, another seed another, and rate 0 the model's own. Letters without a piece become byte
pieces, so every text decodes exactly.

Words: pieces hold the word mark only at their start or consist of it, so a text is cut before each
run of marks and every part is an agenda of its own. Parts of one length are processed together, one
candidate of each part per round; long parts have a heap each. Without dropout equal parts share
their result. A word mark that stands in the text itself is kept apart from blanks by its bytes'
pieces.

Defined results: a null text encodes like an empty one, to no pieces, and decodes to ''. Rows that
repeat an id encode alike where their texts are equal. Texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import re
import zlib
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import in_batches

MODEL = "piece_bpe_32k.model"
MARK = "▁"
DROPOUT = 0.1
SEED = 20
#: Symbols handled together.
BATCH_SYMBOLS = 1 << 19
#: Longer parts have an agenda (heap) by themselves.
LONG = 48
#: Stands for a word mark in the text; Spark's strings never hold a lone surrogate.
_OWN_MARK = "\udfff"
_NONE = np.int32(2**30)
_PLACE_BITS = 6


_C = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _slot(keys: np.ndarray, factor: np.uint64, bits: int) -> np.ndarray:
    return ((keys * factor) >> np.uint64(64 - bits)).astype(np.int64)


class MergeModel:
    """Pieces and merges of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.size = size
        pieces = [model.id_to_piece(i) for i in range(size)]
        byte = {i for i in range(size) if model.is_byte(i)}
        plain = [
            i for i in range(size)
            if i not in byte and not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.id_of = {pieces[i]: i for i in plain}
        for piece in self.id_of:
            if MARK in piece.lstrip(MARK) or (piece.startswith(MARK * 2) and piece.strip(MARK)):
                raise ValueError(f"piece {piece!r} joins words; this model cannot be cut into words")
        self.byte_ids = np.zeros(256, np.int64)
        self.bytes_of = [b""] * size
        for i in byte:
            value = int(pieces[i][3:5], 16)  # <0x41>
            self.byte_ids[value] = i
            self.bytes_of[i] = bytes([value])
        for i in plain:
            self.bytes_of[i] = pieces[i].replace(MARK, " ").encode("utf-8")
        # A merge's rank: best score first. Letters are pieces too, with the worst scores.
        scores = np.array([model.get_score(i) for i in range(size)])
        order = np.lexsort((np.arange(size), -scores))
        rank = np.empty(size, np.int64)
        rank[order] = np.arange(size)
        merges: dict[int, int] = {}
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                left, right = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if left is not None and right is not None:
                    merges[left * size + right] = i
        self.pair_ids_by_key = merges
        self.pair_keys = np.array(sorted(merges), np.int64)
        self.pair_ids = np.array([merges[k] for k in self.pair_keys.tolist()], np.int32)
        # A candidate's place in the agenda: rank, then place in the part; -1 (no merge) comes last.
        self.rank = np.append(rank.astype(np.int32) << _PLACE_BITS, _NONE).astype(np.int32)
        self._build_table()
        letters = np.arange(0x10000)
        self.letters = (-1 - letters).astype(np.int32)
        for piece, i in self.id_of.items():
            if len(piece) == 1 and ord(piece) < 0x10000:
                self.letters[ord(piece)] = i

    def _build_table(self) -> None:
        """Pairs in two hash tables without collisions: what collides in the first is in the second."""
        keys, ids = self.pair_keys.astype(np.uint64), self.pair_ids
        bits = max(10, int(8 * len(keys)).bit_length())
        first = _slot(keys, _C[0], bits)
        single = np.zeros(len(keys), bool)
        single[np.unique(first, return_index=True)[1]] = True
        rest, more = keys[~single], bits - 3
        while len(np.unique(_slot(rest, _C[1], more))) < len(rest):
            more += 1
        self.bits = bits, more
        self.table_keys = np.full((1 << bits) + (1 << more) + 1, -1, np.int32)
        self.table_ids = np.full(len(self.table_keys), -1, np.int32)  # the last: no such pair
        for at, of in ((first[single], single), ((1 << bits) + _slot(rest, _C[1], more), ~single)):
            self.table_keys[at], self.table_ids[at] = self.pair_keys[of], ids[of]

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two neighbours make, -1 for none."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = 0  # the unknown piece merges with nothing
        number, (bits, more) = keys.view(np.uint64), self.bits
        at = _slot(number, _C[0], bits)
        miss = np.flatnonzero(self.table_keys[at] != keys)
        if len(miss):
            second = (1 << bits) + _slot(number[miss], _C[1], more)
            at[miss] = np.where(self.table_keys[second] == keys[miss], second, len(self.table_keys) - 1)
        return self.table_ids[at]

    # ---- encoding -------------------------------------------------------------------------------

    def agenda(self, parts: list[str], keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all parts in turn, and how many each has; ``keys`` seed the dropout of each part.

        A symbol is a piece id, or -1 - c for a letter c without a piece.
        """
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        limit = np.uint64(min(int(dropout * 2**64), 2**64 - 1))
        counts = np.zeros(len(parts), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            step = max(1, BATCH_SYMBOLS // max(1, size)) if size <= LONG else 1
            for begin in range(0, len(rows), step):
                some = rows[begin : begin + step]
                points = np.frombuffer(
                    "".join([parts[i] for i in some.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32
                )
                symbols = self._letters(points)
                if size <= LONG:
                    found, n = self._matrix(symbols.reshape(-1, size).T.copy(), keys[some], limit)
                else:
                    found = self._heap(symbols.tolist(), int(keys[some[0]]), int(limit))
                    n = np.array([len(found)])
                done.append((some, found))
                counts[some] = n
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        for some, found in done:
            n = counts[some]
            first = np.repeat(ends[some] - n, n)
            out[first + np.arange(len(found)) - np.repeat(np.cumsum(n) - n, n)] = found
        return out, counts

    def _letters(self, points: np.ndarray) -> np.ndarray:
        symbols = self.letters[np.minimum(points, 0xFFFF)]
        for at in np.flatnonzero(points > 0xFFFF).tolist():
            symbols[at] = self.id_of.get(chr(points[at]), -1 - int(points[at]))
        return symbols

    def _drawn(self, keys, place, left, right):
        """The hash that decides on a candidate."""
        pair = left.astype(np.uint64) * np.uint64(self.size) + right.astype(np.uint64)
        return _mixed(keys + place.astype(np.uint64) * _C[0] + pair * _C[1])

    def _matrix(self, symbols: np.ndarray, keys: np.ndarray, limit: np.uint64):
        """Parts of one length as columns; a cell is where a symbol starts, linked to its neighbours."""
        size, n = symbols.shape
        if size < 2:
            return symbols.T.reshape(-1), np.full(n, size)
        made = np.full((size, n), -1, np.int32)
        for j in range(size - 1):
            made[j] = self.merged(symbols[j], symbols[j + 1])
        order = self.rank[made] + np.arange(size, dtype=np.int32)[:, None]
        after = np.broadcast_to(np.arange(1, size + 1, dtype=np.int32)[:, None], (size, n)).copy()
        before = after - 2
        alive = np.ones((size, n), bool)
        active = np.arange(n)  # columns of ``work`` arrays that are still open
        work = order
        while len(active):
            best = work.min(axis=0)
            open_ = np.flatnonzero(best < _NONE)
            if not len(open_):
                break
            if len(open_) < 0.7 * len(active):  # finished columns need no more rounds
                work, best, active = work[:, open_], best[open_], active[open_]
                open_ = np.arange(len(active))
            cols, place = active[open_], best[open_] & np.int32((1 << _PLACE_BITS) - 1)
            right = after[place, cols]
            if limit:
                drawn = self._drawn(keys[cols], place, symbols[place, cols], symbols[right, cols])
                keep = drawn >= limit
                work[place[~keep], open_[~keep]] = _NONE
                open_, cols, place, right = open_[keep], cols[keep], place[keep], right[keep]
            new = made[place, cols]
            symbols[place, cols] = new
            alive[right, cols] = False
            work[right, open_] = _NONE
            beyond = after[right, cols]
            after[place, cols] = beyond
            inside = beyond < size
            before[beyond[inside], cols[inside]] = place[inside]
            neighbour = symbols[np.minimum(beyond, size - 1), cols]
            neighbour[~inside] = -1
            found = self.merged(new, neighbour)
            made[place, cols] = found
            work[place, open_] = self.rank[found] + place
            left = before[place, cols]
            inside = np.flatnonzero(left >= 0)
            left, cols, open_ = left[inside], cols[inside], open_[inside]
            found = self.merged(symbols[left, cols], new[inside])
            made[left, cols] = found
            work[left, open_] = self.rank[found] + left
        return symbols.T[alive.T], alive.sum(axis=0)

    def _heap(self, symbols: list[int], key: int, limit: int) -> np.ndarray:
        """One long part."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, rank = self.pair_ids_by_key, self.rank
        heap: list[tuple[int, int, int, int]] = []

        def propose(place):
            right = after[place]
            if right < n and symbols[place] >= 0 and symbols[right] >= 0:
                made = pairs.get(symbols[place] * self.size + symbols[right])
                if made is not None:
                    heapq.heappush(heap, (int(rank[made]), place, symbols[place], symbols[right]))

        for place in range(n - 1):
            propose(place)
        dead = [False] * n
        while heap:
            _, place, left, right_symbol = heapq.heappop(heap)
            right = after[place]
            if dead[place] or right >= n or symbols[place] != left or symbols[right] != right_symbol:
                continue
            if limit:
                one = (np.array([x], np.uint64) for x in (key, place, left, right_symbol))
                if int(self._drawn(*one)[0]) < limit:
                    continue
            symbols[place] = pairs[left * self.size + right_symbol]
            dead[right] = True
            after[place] = after[right]
            if after[place] < n:
                before[after[place]] = place
                propose(place)
            if before[place] >= 0:
                propose(before[place])
        return np.array([s for s, gone in zip(symbols, dead, strict=True) if not gone], np.int64)

    def with_bytes(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters without a piece as their bytes' pieces; ``counts`` (symbols per part) follow."""
        bare = np.flatnonzero(symbols < 0)
        if not len(bare):
            return symbols, counts
        raw = [_letter_bytes(-1 - s) for s in symbols[bare].tolist()]
        lengths = np.ones(len(symbols), np.int64)
        lengths[bare] = [len(r) for r in raw]
        out = np.repeat(symbols, lengths)
        out[out < 0] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))]
        return out, np.diff(ends)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; the blank that encoding puts in front is taken off."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "surrogatepass").removeprefix(" ")


@cache
def merge_model(path: str) -> MergeModel:
    """One per Python worker and model file."""
    return MergeModel(path)


def _letter_bytes(letter: int) -> bytes:
    return (MARK if letter == ord(_OWN_MARK) else chr(letter)).encode("utf-8", "surrogatepass")


_PARTS = re.compile(f"{MARK}+[^{MARK}]*")


def parts_of(text: str) -> list[str]:
    """A text with the leading blank of this model, cut before every run of marks."""
    if not text:
        return []
    text = text.replace(MARK, _OWN_MARK)
    if "  " in text or text[0] == " ":
        return _PARTS.findall(MARK + text.replace(" ", MARK))
    return [MARK + word for word in text.split(" ")]


def document_key(seed: int, doc_id: int | None) -> np.uint64:
    return np.uint64(zlib.crc32(f"{seed}/{doc_id}".encode()) << 32 | zlib.crc32(f"{doc_id}/{seed}".encode()))


def part_keys(seed: int, doc_id: int | None, n: int) -> np.ndarray:
    """Keys of the n parts of a document."""
    return _mixed(np.arange(n, dtype=np.uint64) * _C[2] + document_key(seed, doc_id))


class Encoder:
    """Encodes batches of texts; without dropout, equal parts of a batch are encoded once."""

    def __init__(self, model: MergeModel, dropout: float, seed: int):
        self.model, self.dropout, self.seed = model, dropout, seed

    def __call__(self, doc_ids: list[int | None], texts: list[str | None]) -> list[np.ndarray]:
        split = [parts_of(text or "") for text in texts]
        parts = [part for found in split for part in found]
        if not parts:
            return [np.zeros(0, np.int64) for _ in texts]
        if self.dropout > 0:
            keys = [part_keys(self.seed, d, len(found)) for d, found in zip(doc_ids, split, strict=True)]
            symbols, counts = self.model.agenda(parts, np.concatenate(keys), self.dropout)
        else:
            numbers: dict[str, int] = {}
            index = np.array([numbers.setdefault(p, len(numbers)) for p in parts])
            each, n = self.model.agenda(list(numbers), np.zeros(len(numbers), np.uint64), 0.0)
            counts = n[index]
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            symbols = each[np.repeat((np.cumsum(n) - n)[index], counts) + within]
        symbols, counts = self.model.with_bytes(symbols, counts)
        ends = np.concatenate(([0], np.cumsum(counts)))[np.cumsum([0, *map(len, split)])]
        return [symbols[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encode(
    docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED, text_column: str = "text"
) -> DataFrame:
    """(doc_id, ids): the piece ids of each text as little-endian unsigned 32-bit numbers."""

    def start():
        encoder = Encoder(merge_model(model_path), dropout, seed)

        def work(columns):
            found = encoder(columns["doc_id"], columns["text"])
            return {"doc_id": columns["doc_id"], "ids": [ids.astype("<u4").tobytes() for ids in found]}

        return work

    slim = docs.select(F.col("doc_id").cast("long"), F.col(text_column).alias("text"))
    return in_batches(slim, "doc_id long, ids binary", start, chunk_rows=256)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, text): the text of ``ids``."""

    def start():
        model = merge_model(model_path)

        def work(columns):
            texts = [model.decode(np.frombuffer(ids, "<u4")) for ids in columns["ids"]]
            return {"doc_id": columns["doc_id"], "ids": columns["ids"], "text": texts}

        return work

    return in_batches(encoded, "doc_id long, ids binary, text string", start, chunk_rows=256)


def codec_query(docs: DataFrame) -> DataFrame:
    """Every text encoded with dropout and decoded again: sizes and digests of both."""
    path = default_model_path()
    decoded = decode(encode(docs, path), path)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"), F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )
