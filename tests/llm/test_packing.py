import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabreg.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [1]


def check(tok, docs, pieces, size=2048):
    """Every id in exactly one piece, pieces as promised, sequences gapless."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for key, texts in docs.items():
        for n_copies in [len(texts)]:
            ids = ids_of(tok, texts[0])
            got = sorted(by_doc[key], key=lambda p: p.start)
            assert sum(p.length for p in got) == n_copies * len(ids)
            covered = np.zeros(len(ids), int)
            for p in got:
                part = ids[p.start:p.start + p.length]
                assert len(part) == p.length and p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
                covered[p.start:p.start + p.length] += 1
            assert (covered == n_copies).all()
    for seq in by_seq.values():
        seq.sort(key=lambda p: p.offset)
        at = 0
        for p in seq:
            assert p.offset == at
            at += p.length
        assert at <= size
    return by_seq


def test_documents_round_trip(spark, sf_docs, tok):
    rows = sf_docs.collect()
    pieces = packing.pack(sf_docs.repartition(3), PATH).collect()
    seqs = check(tok, {r.doc_id: [r.text] for r in rows}, pieces)
    short = [s for s in seqs.values() if sum(p.length for p in s) < 2048]
    assert len(short) <= 3  # one for each task


def test_odd_rows(spark, odd_docs, tok):
    rows = odd_docs.collect()
    docs = defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r.text)
    check(tok, docs, packing.pack(odd_docs.coalesce(1), PATH).collect())
    assert packing.pack(odd_docs.where("false"), PATH).count() == 0
    with_ids = packing.pack(odd_docs, PATH, with_ids=True).collect()
    assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in with_ids)


def test_encoder_equals_tokenizer(tok):
    enc = packing.ByteBpeEncoder(PATH, cache_words=50)
    rnd = random.Random(5)
    bits = [" ", "  ", "\n", "\n\n", "\t", " ", "\x1c", "a", "The", "'s", "'", "19", ".", "é", "日本", "😀", "\r\n",
            "<|endoftext|>", "word", ",", "!?", "​", "\x85", "　", "İ", "ß"]
    for _ in range(4000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def brute_place(levels, size, s):
    """Level for which the sum of squares ends smallest; ties: the fullest."""
    best = None
    for h in range(size - s, -1, -1):
        if h and not levels[h]:
            continue
        after = levels.copy()
        if h:
            after[h] -= 1
        if h + s < size:
            after[h + s] += 1
        cost = sum(x * x for x in after[1:size])
        if best is None or cost < best[0]:
            best = (cost, h)
    return best[1]


def test_sum_of_squares_choice_is_least():
    rnd = random.Random(2)
    for size in (16, 30):
        packer = packing.SumOfSquares(size, max_open=10**6)
        levels = [0] * (size + 1)
        for i in range(400):
            s = rnd.choice([1, 3, 5, size // 2, size - 2, rnd.randint(1, size - 1)])
            h = brute_place(levels, size, s)
            if h:
                levels[h] -= 1
            if h + s < size:
                levels[h + s] += 1
            packer.add(i, b"\0\0\0\0" * s)
            assert packer.level[1:size].tolist() == levels[1:size]


def test_items_that_never_fit_together_stay_bounded():
    packer = packing.SumOfSquares(16, max_open=20)
    for i in range(500):
        packer.add(i, b"\0\0\0\0" * 9)
        assert packer.n_open <= 21
    packer.flush(last=True)
    windows = packer.closed()
    fills = [sum(len(p[2]) // 4 for p in w) for w in windows]
    assert sum(fills) == 4500 and sum(f < 16 for f in fills) <= 1
