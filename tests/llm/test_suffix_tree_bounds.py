import zlib

import pytest

from tabreg.llm import suffix_tree_lm as lm


def keys(held_out, n):
    return [k for k in range(1000) if (zlib.crc32(str(k).encode()) % 10 == 0) == held_out][:n]


def test_a_pair_seen_three_times_is_learnt(spark):
    """3 times against 0.05 expected gains 9.5 nats: the bounds are given here as numbers, not taken from the module."""
    assert (lm.KEPT_GAIN, lm.STATE_GAIN) == (6.0, 1.0)
    filler = iter([f"f{i}" for i in range(174)])
    text = " ".join(" ".join(["a b", *[next(filler) for _ in range(58)]]) for _ in range(3))
    rows = [(keys(False, 1)[0], text), (keys(True, 1)[0], "a b")]
    got = {r.held_out: r for r in lm.fit_and_score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # b after a: 3 of 3 times, half a count handed on
    assert got[True].train_tokens == 181
    p = 3.1 / (181 + 0.1 * 178)
    assert 10 ** (got[True].score - got[True].base_score) == pytest.approx((0.5 * p + 3) / 3.5 / p)
