"""Near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from masterline.llm import near
from tests.llm.conftest import SCHEMA


def likeness(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def edited_texts():
    """Texts in families of one base with 1 to 7 words changed: likenesses around 0.8, from 0.5 to 1."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = []
    for _ in range(30):
        base = [word() for _ in range(rng.randint(60, 140))]
        texts.append(" ".join(base))
        for _ in range(3):
            w = list(base)
            for i in rng.sample(range(len(w)), rng.randint(1, 4)):
                w[i] = word()
            texts.append(" ".join(w))
    return texts


def brute(texts):
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if likeness(texts[i], texts[j]) >= 0.8 and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 2, "group_shingles": 200}])
def test_groups_are_exact(spark, sizes):
    texts = edited_texts()
    texts += [texts[5].upper(), texts[5], "", None, " \n", "one two", "One  Two", "one three"]
    found = {r["row"]: r["group"] for r in near.near_groups(spark.createDataFrame(list(enumerate(texts)), "row long, text string"), **sizes).collect()}
    root = brute([t or "" for t in texts])
    assert len(found) == len(texts)
    assert len({(found[i], root[i]) for i in found}) == len(set(found.values())) == len(set(root))


def test_pipeline_keeps_pairs_below_and_drops_pairs_from_0_8(spark):
    texts = edited_texts()
    pairs = [likeness(texts[i], texts[i + k]) for i in range(0, len(texts), 4) for k in (1, 2, 3)]
    assert sum(0.6 <= p < 0.8 for p in pairs) > 10 and sum(0.8 <= p < 0.85 for p in pairs) > 10
    left = corpus_pipeline.near_dedup(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA), "")
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(brute(texts)))


def test_alike_sets_share_a_prefix_shingle():
    rng = np.random.default_rng(3)
    for n in range(1, 200):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = a[: -(-4 * len(a) // 5)]
        ranked = a[::3]
        common = (ranked, np.arange(1, len(ranked) + 1))
        assert set(near.prefix(a, common).tolist()) & set(near.prefix(b, common).tolist()), n
