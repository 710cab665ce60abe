import random

import cases
import numpy as np
import pytest
import sentencepiece

from tillpanel.llm import piece_codec
from tillpanel.llm.piece_codec import (
    Encoder,
    codec_query,
    decode,
    default_model_path,
    encode,
    merge_model,
    part_keys,
    parts_of,
)


@pytest.fixture(scope="module")
def model():
    return merge_model(default_model_path())


def plain_agenda(model, part, key, dropout):
    """One candidate at a time, by looking at all of them."""
    limit = int(dropout * 2**64)
    symbols = [model.id_of.get(c, -1 - ord(c)) for c in part]
    places = list(range(len(symbols)))
    while True:
        best = None
        for i, (a, b) in enumerate(zip(symbols, symbols[1:])):
            made = model.pair_ids_by_key.get(a * model.size + b) if a >= 0 and b >= 0 else None
            if made is None:
                continue
            one = (np.array([x], np.uint64) for x in (int(key), places[i], a, b))
            if limit and int(model._drawn(*one)[0]) < limit:
                continue
            if best is None or (model.rank[made], i) < best[:2]:
                best = (model.rank[made], i, made)
        if best is None:
            return symbols
        symbols[best[1]] = best[2]
        del symbols[best[1] + 1], places[best[1] + 1]


TEXTS = [t or "" for _, t, *_ in cases.odd_rows() if t is None or len(t) < 40_000] + [
    " lead", "trail ", "two  blanks   three", "a▁b ▁ ▁▁", "internationalisation " * 3, "x" * 47, "x" * 48,
    "ß" * 60, "\U0001f600" * 3 + "中文字符", "\x00\x7f\x80", "ab" * 70 + " the end",
]


def test_without_dropout_it_is_the_model_itself(model):
    reference = sentencepiece.SentencePieceProcessor(model_file=default_model_path())
    texts = [t for t in TEXTS if "▁" not in t]
    found = Encoder(model, 0.0, 1)(list(range(len(texts))), texts)
    assert [ids.tolist() for ids in found] == [reference.encode(t) for t in texts]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_decoding_is_lossless(model, dropout):
    found = Encoder(model, dropout, 3)(list(range(len(TEXTS))), TEXTS)
    assert [model.decode(ids) for ids in found] == TEXTS


@pytest.mark.parametrize("long", [0, 8, 48])
def test_dropout_matches_a_plain_agenda(model, monkeypatch, long):
    monkeypatch.setattr(piece_codec, "LONG", long)
    pick = random.Random(long)
    words = ["".join(pick.choices("etaoin rsh中é", k=pick.randint(1, 30))) for _ in range(60)]
    parts = [p for w in words for p in parts_of(w)]
    keys = part_keys(9, 1, len(parts))
    for dropout in (0.0, 0.3):
        symbols, counts = model.agenda(parts, keys, dropout)
        ends = np.cumsum(counts)
        for part, key, end, n in zip(parts, keys, ends, counts, strict=True):
            assert symbols[end - n : end].tolist() == plain_agenda(model, part, key, dropout)


def test_seeds_and_rates_vary_the_pieces(model):
    text = [cases.prose(4, 400)]
    encoded = {(p, s): Encoder(model, p, s)([7], text)[0].tolist() for p in (0.0, 0.1, 0.4) for s in (1, 2)}
    assert encoded[0.0, 1] == encoded[0.0, 2]
    assert encoded[0.1, 1] != encoded[0.1, 2] != encoded[0.0, 1]
    assert len(encoded[0.0, 1]) < len(encoded[0.1, 1]) < len(encoded[0.4, 1])
    assert Encoder(model, 0.1, 1)([8], text)[0].tolist() != encoded[0.1, 1]
    # The pieces of a document do not depend on its neighbours in a batch.
    batch = Encoder(model, 0.1, 1)([3, 7, None], ["other text", *text, "more"])
    assert batch[1].tolist() == encoded[0.1, 1]


def test_spark_round_trip(spark):
    path = default_model_path()
    docs = cases.frame(spark)
    rows = decode(encode(docs, path), path).collect()
    expected = sorted((r[0] or 0, r[1] or "") for r in cases.odd_rows())
    assert sorted((r.doc_id or 0, r.text) for r in rows) == expected
    assert codec_query(docs).count() == len(rows)
    assert codec_query(cases.frame(spark, [])).count() == 0
