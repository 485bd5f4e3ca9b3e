"""More kinds of bad documents than eight."""

import numpy as np

from millrace.llm import quality


def test_every_precise_kind_has_a_rule():
    rng = np.random.default_rng(12)
    kinds, each = 14, 60
    kind = np.concatenate([np.repeat(np.arange(kinds), each), np.full(3000, -1)])
    x = {f"f{k}": np.where(kind == k, 1.0, 0.0) + rng.uniform(0, 0.4, len(kind)) for k in range(kinds)}
    rules = quality.learn(x, kind >= 0, np.arange(len(kind)) % 3 == 0)
    hit = np.zeros(len(kind), bool)
    for rule in rules:
        hit |= quality._covered(x, rule.tests, len(kind))
    assert len(rules) >= kinds and hit[kind < 0].mean() <= 0.01
    assert all(hit[kind == k].mean() >= 0.95 for k in range(kinds))
