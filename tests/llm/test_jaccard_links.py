"""All links between different texts, against brute force."""

import random
from itertools import combinations

from millrace.llm import jaccard
from test_training_data import VOCABULARY, _components, _docs, _near_copies, _shingles


def _group(seed):
    """Thirty near copies of one text, some near copies of one another only."""
    rng = random.Random(seed)
    base, texts = rng.choices(VOCABULARY, k=300), []
    for _ in range(30):
        words = list(base)
        for _ in range(rng.choice([1, 2, 4, 8])):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        texts.append(" ".join(words))
    return texts


def _brute(texts, n, percent):
    """(the sets, the smallest id of each set, links between those)."""
    sets, low = [_shingles(t, n) for t in texts], {}
    for k, s in enumerate(sets):
        low.setdefault(frozenset(s), k)
    links = set()
    for a, b in combinations(sorted(low.values()), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            links.add((b, a))
    return sets, low, links


def test_every_link(spark):
    texts = _near_copies(1) + _group(2)
    _, _, want = _brute(texts, 3, 90)
    got = [tuple(r) for r in jaccard.jaccard_links(_docs(spark, texts), 3, 90).collect()]
    assert len(want) > 120 and len(got) == len(set(got)) and set(got) == want


def test_links_are_counted_per_document(spark):
    texts = _near_copies(3) + _group(4)
    sets, low, links = _brute(texts, 5, 80)
    components = _components(texts, 5, 80)[1]
    rows = {r["doc_id"]: r for r in jaccard.jaccard_answers(_docs(spark, texts), 5, 80).collect()}
    for k, s in enumerate(sets):
        assert (rows[k]["n_links"], rows[k]["component_id"]) == (sum(low[frozenset(s)] in p for p in links) if s else 0, components[k])
