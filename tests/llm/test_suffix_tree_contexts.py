import math
import random
from collections import Counter, defaultdict

import pytest

from tabreg.llm import suffix_tree_lm as lm

from .test_suffix_tree_lm import held, toks


def by_counts(train, depth):
    """prob(word, words before it) of the model whose candidate contexts are all that occur."""
    runs = [Counter(tuple(t[i:i + d + 1]) for t in train for i in range(len(t) - d)) for d in range(depth + 1)]
    n, v = sum(runs[0].values()), len(runs[0])
    kept, hand_on = {}, {}

    def prob(w, before):
        p = (runs[0][w,] + 0.1) / (n + 0.1 * (v + 1))
        for d in range(1, len(before) + 1):
            s = tuple(before[-d:])
            p *= hand_on.get(s, 1.0) * kept.get(s + (w,), 1.0)
        return p
    for d in range(1, depth + 1):
        good = defaultdict(list)
        for g, m in runs[d].items():
            q = prob(g[-1], g[1:-1])
            e = runs[d - 1][g[:-1]] * q
            if m >= 2 and m > e and m * math.log(m / e) - (m - e) >= 6.0:
                good[g[:-1]].append((g[-1], m, q))
        new_hand, new_kept = {}, {}
        for s, steps in good.items():
            seen = runs[d - 1][s]
            rest = seen - sum(m for _, m, _ in steps) + 0.5
            gains = {s + (w,): 1 + m / (rest * q) for w, m, q in steps}
            if sum(m * math.log10(gains[s + (w,)]) for w, m, _ in steps) + seen * math.log10(rest / (seen + 0.5)) >= 1.0:
                new_hand[s] = rest / (seen + 0.5)
                new_kept.update(gains)
        hand_on.update(new_hand)
        kept.update(new_kept)
    return prob, hand_on, runs


@pytest.mark.parametrize("hot", [1_000_000, 30])
def test_a_pair_met_by_chance_is_a_context(spark, hot):
    """x y comes no more often than chance, so x gives no transition to y; but after x y there is always z."""
    rnd = random.Random(5)
    words = ["x", "y"] + [f"w{i}" for i in range(10)]
    rows = []
    for k in range(60):
        t = []
        while len(t) < 80:
            t += [rnd.choice(words)]
            if t[-2:] == ["x", "y"]:
                t += ["z"]
        rows.append((k, " ".join(t)))
    prob, states, runs = by_counts([toks(t) for k, t in rows if not held(k)], 2)
    chance = runs[0]["x",] * runs[0]["y",] / sum(runs[0].values())
    assert runs[1]["x", "y"] < 1.5 * chance and ("x", "y") in states
    got = {r.doc_id: r.score for r in lm.fit_and_score(spark.createDataFrame(rows, "doc_id long, text string"), hot_entries=hot).collect()}
    for k, t in rows:
        t = toks(t)
        assert got[k] == pytest.approx(sum(math.log10(prob(w, t[max(0, i - 2):i])) for i, w in enumerate(t)), rel=1e-9)
