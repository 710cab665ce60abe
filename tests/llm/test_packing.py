import random
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from tillpanel.llm.packing import (
    ChunkIds,
    _tokenizer,
    default_tokenizer_path,
    pack,
    packed_sequences,
    packing_query,
    plan_packing,
    token_pieces,
)


def placed(counts, plan):
    """Every piece's (sequence, offset, length) under a plan."""
    entries = defaultdict(list)
    for length, rank, per, first, offset in plan:
        entries[length].append((rank, per, first, offset))
    out = []
    for length, n in counts.items():
        found = sorted(entries[length])
        for rank in range(n):
            at, per, first, offset = [e for e in found if e[0] <= rank][-1]
            step = rank - at
            out.append((first + step // per, offset + step % per * length, length))
    return out


def check(pieces, capacity):
    filled = defaultdict(list)
    for sequence, offset, length in pieces:
        filled[sequence].append((offset, length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


def first_fit_decreasing(lengths, capacity):
    free = []
    for length in sorted(lengths, reverse=True):
        for i, gap in enumerate(free):
            if gap >= length:
                free[i] -= length
                break
        else:
            free.append(capacity - length)
    return len(free)


@pytest.mark.parametrize("seed", range(40))
def test_plans_are_gapless_and_tight(seed):
    pick = random.Random(seed)
    capacity = pick.choice([7, 30, 100])
    top = pick.choice([capacity, capacity // 2, capacity // 3, capacity // 5 + 1])
    lengths = [pick.randint(1, top) for _ in range(pick.randint(1, 300))]
    if seed % 4 == 0:
        lengths += [pick.randint(1, capacity)] * 400  # one length holds most pieces
    counts = Counter(lengths)
    used = check(placed(counts, plan_packing(counts, capacity)), capacity)
    assert used <= first_fit_decreasing(lengths, capacity) + 1
    assert used >= -(-sum(lengths) // capacity)


def test_large_lengths_are_matched_as_well_as_can_be():
    # 60 pairs only with 40, 55 with 45: greedy by the longest partner keeps both pairs.
    counts = {60: 2, 55: 2, 45: 2, 40: 2}
    assert check(placed(counts, plan_packing(counts, 100)), 100) == 4
    for seed in range(30):
        pick = random.Random(seed)
        lengths = [pick.randint(34, 100) for _ in range(9)]

        def best(rest):
            if not rest:
                return 0
            head, others = rest[0], rest[1:]
            options = [1 + best(others)]
            options += [
                1 + best(others[:i] + others[i + 1 :]) for i, x in enumerate(others) if head + x <= 100
            ]
            return min(options)

        counts = Counter(lengths)
        assert check(placed(counts, plan_packing(counts, 100)), 100) == best(sorted(lengths))


def test_plan_size_does_not_follow_the_corpus():
    pick = random.Random(1)
    small = {length: pick.randint(1, 50) for length in range(1, 1025)}
    large = {length: n * 1_000_003 for length, n in small.items()}
    assert len(plan_packing(large, 1024)) < 3 * len(plan_packing(small, 1024)) + 5000


TEXTS = [
    None, "", "  ", "it's they'll 12 á É x y", "<|endoftext|> <|startoftext|>x", "Σας ΣΑΣ İ",
    "x" * 5000, "tab\tnew\nline\x0b\x0c\r\x1cz\x85", "ﬁ ½ ℌ 日本 😀😀", cases.prose(1, 500),
]


def test_chunks_give_the_ids_of_whole_texts():
    path = default_tokenizer_path()
    found = ChunkIds(path)(TEXTS)
    for text, ids in zip(TEXTS, found, strict=True):
        expected = _tokenizer(path).encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected


def test_a_tokenizer_that_keeps_blanks_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="chunks apart"):
        ChunkIds(public_tokenizers.path("byte_bpe_50k.json"))


def test_a_part_is_encoded_once(monkeypatch):
    encode = ChunkIds(default_tokenizer_path())
    own, sent = encode.prepared, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            sent.extend(word for text in texts for word in text.split())
            return own.encode_batch_fast(texts, **options)

    encode.prepared = Counted()
    chunks = [f"{word}{end}" for word in ("naive", "quux", "Éther", "it's") for end in ("", ",", ".", "!?", ",42", "</w>")]
    texts = [" ".join(chunks), " ".join(f"({c}" for c in chunks)]
    for _ in range(2):
        for text in texts:
            ids = np.frombuffer(encode([text])[0], "<u4").tolist()
            assert ids == encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert sent and len(sent) == len(set(sent))


def test_full_caches_are_begun_anew(monkeypatch):
    from tillpanel.llm import packing

    monkeypatch.setattr(packing, "CACHED_CHUNKS", 5)
    monkeypatch.setattr(packing, "CACHED_PARTS", 5)
    test_chunks_give_the_ids_of_whole_texts()
    encode = ChunkIds(default_tokenizer_path())
    for text in (cases.prose(2, 50), cases.prose(3, 50), cases.prose(2, 50)):
        ids = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == ids


def test_query_matches_a_plain_version(spark):
    docs = cases.frame(spark)
    rows = packing_query(docs).collect()
    tokenizer = _tokenizer(default_tokenizer_path())
    expected = Counter()
    for doc_id, text, *_ in cases.odd_rows():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4")
            expected[doc_id, k // 4096, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    used = check([(r.sequence_id, r.offset, r.length) for r in rows], 4096)
    assert used == -(-sum(r.length for r in rows) // 4096)
    assert packing_query(cases.frame(spark, [])).count() == 0


def test_ranks_of_a_frequent_length_are_salted(spark, monkeypatch):
    from tillpanel.llm import packing

    monkeypatch.setattr(packing, "RANKED_TOGETHER", 7)
    frame = spark.createDataFrame([(i, 0, 3 if i % 4 else 5) for i in range(300)], "doc_id long, piece int, length long")
    rows = pack(frame, 8).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 300
    assert check([(r.sequence_id, r.offset, r.length) for r in rows], 8) <= 75 + 75


def test_sequences_hold_the_ids_of_their_pieces(spark):
    texts = [(i, cases.prose(i, 40)) for i in range(30)]
    pieces = token_pieces(spark.createDataFrame(texts, "doc_id long, text string"), default_tokenizer_path(), 512)
    packed = pack(pieces, 512).cache()
    whole = {r.sequence_id: r for r in packed_sequences(packed).collect()}
    for r in packed.collect():
        sequence = whole[r.sequence_id]
        assert sequence.ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids
        assert r.offset in sequence.starts
    assert all(len(s.ids) <= 4 * 512 for s in whole.values())
