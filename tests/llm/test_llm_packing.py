import struct
import zlib
from collections import Counter, defaultdict

import cases
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from speechloom.llm.packing import Encoder, cuts, pack, plan


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 200), max_size=25))
def test_plan_places_every_piece_once(histogram):
    capacity = 60
    places = plan(histogram, capacity)
    ranks = defaultdict(list)
    bins = defaultdict(list)
    for length, first_rank, n, first, offset in places:
        ranks[length].append((first_rank, n))
        for i in range(n):
            bins[first + i].append((offset, length))
    for length, n in histogram.items():
        at = 0
        for first, k in sorted(ranks[length]):
            assert first == at
            at += k
        assert at == n
    assert sorted(bins) == list(range(len(bins)))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(k * n for k, n in histogram.items())
    # no more than half of a sequence is wasted on average, but for the last
    assert len(bins) <= 2 * -(-total // capacity) + 1


def test_large_pieces_meet_in_pairs():
    places = plan({40: 3, 20: 2, 21: 1, 5: 2}, 60)
    assert 1 + max(first + n - 1 for _, _, n, first, _ in places) == 4


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)])])
def test_cuts(n, want):
    assert cuts(n, 8) == want


def test_ids_are_those_of_the_tokenizer():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = Encoder("byte_bpe_50k")
    for text in ("", " ", "a  b\n\n c\t", "it's <|endoftext|> here", "½ Ⅷ 漢字 naïve ñ 😀", "x" * 500, "12 345 !!??", "\r\n  z"):
        assert encode(text) == tok.encode(text, add_special_tokens=False).ids


def test_pack_awkward(spark):
    docs = cases.awkward(spark)
    rows = pack(docs, capacity=64).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        for piece, (start, length) in enumerate(cuts(len(ids), 64)):
            own = ids[start:start + length]
            want[(doc_id, piece, start, length, zlib.crc32(struct.pack(f"<{length}I", *own)))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def test_pack_empty(spark):
    assert pack(cases.empty(spark)).collect() == []


def test_ids_kept_on_request(spark):
    rows = pack(cases.awkward(spark), capacity=32, keep_ids=True).collect()
    assert all(len(r.ids) == r.length for r in rows)
