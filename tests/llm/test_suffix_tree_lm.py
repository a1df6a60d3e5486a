import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tabreg.llm import suffix_tree_lm as lm


def toks(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]  # None: the end token


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0


def brute(rows, depth):
    """The model by dictionaries: {key: (n, known, base, score)}."""
    train = [toks(t) for k, t in rows if not held(k)]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    def p0(w):
        return (c[w] + 0.1) / (n + 0.1 * (v + 1))
    kept, hand_on = {}, {}  # {state + (word,): gain factor}, {state: factor}
    seen = {(w,): k for w, k in c.items()}

    def prob(w, before):
        """Of w after the words before it, by states up to len(before) words."""
        p = p0(w)
        for d in range(1, len(before) + 1):
            s = tuple(before[-d:])
            if s in hand_on:
                p *= hand_on[s]
                p *= kept.get(s + (w,), 1.0)
        return p
    for d in range(1, depth + 1):
        counts = Counter()
        for t in train:
            for i in range(d, len(t)):
                s = tuple(t[i - d:i])
                if d == 1 or s in seen:
                    counts[s + (t[i],)] += 1
        good = defaultdict(list)
        for g, m in counts.items():
            s = g[:-1]
            if m >= 2 and s in seen:
                q = prob(g[-1], s[1:])
                e = seen[s] * q
                if m > e and m * math.log(m / e) - (m - e) >= lm.KEPT_GAIN:
                    good[s].append((g[-1], m, q))
        nxt = {}
        new_kept, new_hand = {}, {}
        for s, steps in good.items():
            rest = seen[s] - sum(m for _, m, _ in steps) + lm.OWN
            a = rest / (seen[s] + lm.OWN)
            gains = {w: 1 + m / (rest * q) for w, m, q in steps}
            for w, m, q in steps:
                nxt[s + (w,)] = m
            won = sum(m * math.log10(gains[w]) for w, m, _ in steps) + seen[s] * math.log10(a)
            if won >= lm.STATE_GAIN:
                new_hand[s] = a
                new_kept.update({s + (w,): x for w, x in gains.items()})
        hand_on.update(new_hand)
        kept.update(new_kept)
        seen = nxt
    out = []
    for k, t in rows:
        t = toks(t)
        base = sum(math.log10(p0(w)) for w in t)
        score = sum(math.log10(prob(w, t[max(0, i - depth):i])) for i, w in enumerate(t))
        out.append((k, held(k), len(t), sum(c[w] > 0 for w in t), n, base, score))
    return out, prob, c


def corpus(seed=3, n=160):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passages = [[rnd.choice(words) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(n):
        t = []
        for _ in range(rnd.randint(1, 6)):
            t += rnd.choice(passages) if rnd.random() < 0.4 else [rnd.choice(words[:rnd.choice([5, 300])]) for _ in range(6)]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(t)))
    return rows


def compare(df, rows, depth):
    want = sorted(brute(rows, depth)[0], key=lambda r: (str(r[0]), r[2:]))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()),
                 key=lambda r: (str(r[0]), r[2:]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


@pytest.mark.parametrize("hot", [1_000_000, 40, 0])
def test_equals_brute_force(spark, monkeypatch, hot):
    """Whatever part of the model is broadcast, the rest is joined: the scores are the same."""
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    compare(lm.fit_and_score(docs, hot_entries=hot), rows, lm.DEPTH)


def test_three_words(spark):
    rows = corpus(8, 80)
    compare(lm.fit_and_score(spark.createDataFrame(rows, "doc_id long, text string"), depth=3), rows, 3)


def test_states_are_distributions_and_help():
    rows, prob, c = brute(corpus(), 2)
    words = list(c) + ["never seen"]
    for before in ([], ["w1"], ["w2", "w3"], ["w0", "w1"]):
        # the unseen mass stands for one more word
        assert sum(prob(w, before) for w in words) == pytest.approx(1.0, abs=1e-9)
    out = [r for r in rows if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out) + 10  # held-out texts gain


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    compare(lm.fit_and_score(odd_docs), rows, lm.DEPTH)
    assert lm.fit_and_score(odd_docs.where("false")).count() == 0
    only_held = spark.createDataFrame([(k, "a b") for k in range(100) if held(k)], "doc_id long, text string")
    got = lm.fit_and_score(only_held).collect()
    assert got and all(r.n_known == 0 and r.train_tokens == 0 and r.score == r.base_score for r in got)
