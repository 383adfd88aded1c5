"""What the findings of round 3 showed in the pipeline."""

import random

from masterline.llm import near
from tests.llm.test_near import brute, edited_texts


def test_blocks_of_simhashes_find_candidates(spark, monkeypatch):
    """Pairs within four bits come from blocks of the SimHash bits; all others still from the shingle sets."""
    rng = random.Random(5)
    bases = [rng.getrandbits(64) for _ in range(60)]
    fps = bases + [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 6))) for b in bases]
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    found = [(r["a"], r["b"]) for r in near.simhash_candidates(spark.createDataFrame(rows, "node long, f0 long")).collect()]
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and root[i] != root[j]:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    mine = list(range(len(fps)))
    for a, b in found:
        assert (fps[a] ^ fps[b]).bit_count() <= 4
        low, high = sorted((mine[a], mine[b]))
        mine = [low if r == high else r for r in mine]
    assert mine == root and len(set(root)) < len(fps)

    texts, asked, plain = edited_texts(), [], near.simhash_candidates
    monkeypatch.setattr(near, "simhash_candidates", lambda nodes: asked.append(1) or plain(nodes))
    groups = {r["row"]: r["group"] for r in near.near_groups(spark.createDataFrame(list(enumerate(texts)), "row long, text string")).collect()}
    want = brute(texts)
    assert asked and len({(groups[i], want[i]) for i in groups}) == len(set(groups.values())) == len(set(want))
