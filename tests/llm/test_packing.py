import random
import struct

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.helpers import prose
from tierline.llm import packing

VOCABULARY = "word_bpe_49k.json"


def checked(rows, window):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_encoder_equals_the_tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    texts = ["", " ", "It's we'LL 12ab3", "<|startoftext|> hi<|endoftext|>x", "é é b́ \x1c\x85 x", "ÀÉ öß ÿ, (x)!!\t\nÇ", "日本 语", "'s't a'b", "a b", prose(1, 500)]
    encoder = packing.Encoder(public_tokenizers.path(VOCABULARY))
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert list(ids) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_least_squares_has_no_negative_count_and_fits():
    rng = random.Random(2)
    ways = packing.combinations(32)
    true = np.zeros(len(ways))
    for k in rng.sample(range(len(ways)), 12):
        true[k] = rng.randint(1, 500)
    target = np.bincount(ways.ravel(), np.repeat(true, 3), 33)
    found = packing.nonnegative(ways, target)
    assert (found >= 0).all() and (found > 0).sum() <= 32
    got = np.bincount(ways.ravel(), np.repeat(found, 3), 33)
    assert np.allclose(got[1:], target[1:], atol=1e-3)


def test_documents_come_back_whole_with_little_padding(documents):
    rng = random.Random(4)
    texts = [prose(k, rng.randint(1, 900)) for k in range(400)] + [None, "", prose(1, 5000), prose(0, 3), prose(0, 3)]
    found = packing.pack(documents(texts), VOCABULARY, window=512, grid=4).collect()
    sequences = checked(found, 512)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted((r for r in found if r["doc_id"] == i), key=lambda r: r["start"])
        data = b"".join(r["ids"] for r in mine)
        assert data == struct.pack(f"<{len(ids)}I", *ids) and {r["doc_tokens"] for r in mine} == {len(ids)}
    assert sum(r["length"] for r in found) / (512 * sequences) > 0.96


def test_awkward_rows(awkward):
    found = packing.pack(awkward, VOCABULARY).collect()
    checked(found, packing.WINDOW)
    assert sum(r["doc_tokens"] == 1 for r in found) == 3 and sum(r["start"] == 0 for r in found) == awkward.count()
    assert packing.pack(awkward.limit(0), VOCABULARY).count() == 0


def test_plan_places_every_rest_once():
    rng = random.Random(8)
    for _ in range(20):
        histogram = {rng.randint(1, 127): rng.randint(1, 40) for _ in range(rng.randint(1, 60))}
        plan = packing.plan(histogram, 128, 4)
        used = {}
        for n, count in histogram.items():
            mine = np.flatnonzero(plan.length == n)
            for rank in range(count):
                k = mine[np.searchsorted(plan.first[mine], rank, side="right") - 1]
                used.setdefault(int(plan.sequence[k] + rank - plan.first[k]), []).append((int(plan.offset[k]), n))
        for parts in used.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= 128
        assert sorted(used) == list(range(plan.sequences))
