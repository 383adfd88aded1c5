"""The pipeline's stages against brute force, and its queries' registration."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from masterline.llm import quality, secrets
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_docs_operators import brute_repeat, words


@pytest.fixture(scope="module")
def corpus(spark, rows):
    base = prose(321, 200).split()
    near = [(900 + i, " ".join([*base[: 20 * i], f"edit{i}", *base[20 * i + 1 :]]), "en", "s1", 1) for i in range(1, 5)]
    return spark.createDataFrame([*rows, *near, (950, " ".join(base), "en", "s2", 1)], SCHEMA)


def similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words(a.lower()), words(b.lower())))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_stages(spark, corpus):
    run = lambda k, df: dict(corpus_pipeline.STAGES)[k](spark, df, "")
    before = corpus.collect()
    kept = run("quality_rules", corpus)
    assert kept.columns == corpus.columns
    good = lambda w: len(w) >= 10 and 100 * brute_repeat(w) <= 20 * len(w)
    assert Counter(kept.collect()) == Counter(r for r in before if good(words(r["text"])))

    kept = kept.persist()
    unique = run("near_dedup", kept)
    assert unique.columns == corpus.columns
    texts, left = [r for r in kept.collect()], unique.collect()
    for r in texts:
        twins = [x for x in texts if similarity(r["text"], x["text"]) >= 0.8]
        stay = [x for x in left if similarity(r["text"], x["text"]) >= 0.8]
        assert len(stay) == 1, r["doc_id"]
        if len(twins) == 1:
            assert r in left

    masked = run("secret_scans", unique)
    assert masked.columns == corpus.columns and masked.count() == len(left)
    for r in masked.collect():
        if r["doc_id"] in (42, 43):
            assert secrets.MASK in r["text"] and not re.search("04dbebab91ab|AKIAABCD|Abcdef0123456789xy", r["text"]) and r["n_chars"] == len(r["text"])
        else:
            assert r in left

    mixed = run("mixing", masked)
    assert mixed.columns == corpus.columns
    assert Counter(mixed.collect()) == Counter({r: n for r, n in brute_mix(masked.collect()).items() if n})

    packed = run("best_fit_packing", mixed).collect()
    assert Counter((r["doc_id"], r["piece"], ids_of(r)) for r in packed) == brute_pieces((r["doc_id"], r["text"]) for r in mixed.collect())
    check_sequences(packed)


def ids_of(r):
    return tuple(np.frombuffer(r["ids"], dtype="<u2").tolist())


def brute_mix(rows):
    """Row -> copies: targets by water level, one draw by the MD5 of the id."""
    size = Counter()
    for r in rows:
        size[r["source"]] += len(words(r["text"]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, stopped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        left, free = 1.5 * sum(size.values()) - sum(2 * size[s] for s in stopped), sum(weight[s] for s in order if s not in stopped)
        target = {s: 2 * size[s] if s in stopped else left * weight[s] / free for s in order}
        above = {s for s in order if target[s] > 2 * size[s]}
        if not above:
            break
        stopped |= above
    out = Counter()
    for r in rows:
        rate = target[r["source"]] / size[r["source"]] if size[r["source"]] else 0
        key = "null" if r["doc_id"] is None else r["doc_id"]
        draw = int(hashlib.md5(f"mix-1:{key}".encode()).hexdigest()[:13], 16) / 16**13
        out[r] += math.floor(rate) + (draw < rate - math.floor(rate))
    return out


def brute_pieces(texts):
    """(doc_id, piece, ids) of texts, by the tokenizers library over the whole text; the first piece may be short."""
    import public_tokenizers
    import tokenizers

    coder = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for doc_id, text in texts:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cut = [ids[:first], *(ids[i : i + 2048] for i in range(first, len(ids), 2048))]
        out.update((doc_id, i, tuple(part)) for i, part in enumerate(cut))
    return out


def check_sequences(packed):
    """Every sequence is gapless from 0 and holds at most 2048 tokens; their number is within one of the least."""
    by = defaultdict(list)
    for r in packed:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r["length"] for r in packed) // 2048) + 1


def test_run_is_what_brute_force_makes(spark, tmp_path):
    """run() over a table, every stage done again in plain Python."""
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    spark.createDataFrame(table.to_pandas(), SCHEMA).coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    docs = [r for r in spark.read.parquet(f"file://{tmp_path}/documents.parquet").collect()]
    # quality: base rules, hosts against the prior, stricter rules on bad hosts
    facts = {}
    for r in docs:
        w, t = words(r["text"]), r["text"] or ""
        lines = [x for x in t.split("\n") if words(x)]
        facts[r] = (len(w), brute_repeat(w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(lines))
    failed = lambda r: facts[r][0] < 10 or 100 * facts[r][1] > 20 * facts[r][0]
    hosts = defaultdict(list)
    for r in docs:
        hosts[r["source"]].append(failed(r))
    m = sum(map(sum, hosts.values())) / len(docs)
    v = sum((sum(h) / len(h) - m) ** 2 for h in hosts.values()) / len(hosts)
    s = max(1, m * (1 - m) / v - 1)
    bad = {h for h, f in hosts.items() if (sum(f) + s * m) / (len(f) + s) > m + quality.HOST_MARGIN * math.sqrt(m * (1 - m) / (s + 1))}
    strict = lambda r: 100 * facts[r][2] > 10 * facts[r][0] or 100 * facts[r][3] > 30 * facts[r][4] or 100 * facts[r][1] > 10 * facts[r][0]
    kept = [r for r in docs if not failed(r) and not (r["source"] in bad and strict(r))]
    # near-duplicates: links of all pairs, the least id of each group
    root = {r["doc_id"]: r["doc_id"] for r in kept}
    for i, a in enumerate(kept):
        for b in kept[:i]:
            if similarity(a["text"], b["text"]) >= 0.8 and root[a["doc_id"]] != root[b["doc_id"]]:
                low, high = sorted((root[a["doc_id"]], root[b["doc_id"]]))
                root = {k: low if x == high else x for k, x in root.items()}
    unique = [r for r in kept if root[r["doc_id"]] == r["doc_id"]]
    # secrets: live values masked
    masked = [spark_row((r["doc_id"], t, r["lang"], r["source"], r["n_chars"] if t == r["text"] else len(t))) for r in unique for t in [brute_mask(r["text"], unique)]]
    mixed = brute_mix(masked)
    want = brute_pieces((r["doc_id"], r["text"]) for r, n in mixed.items() for _ in range(n))
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert Counter((r["doc_id"], r["piece"], ids_of(r)) for r in got) == want
    check_sequences(got)


def spark_row(r):
    from pyspark.sql import Row

    return Row(doc_id=r[0], text=r[1], lang=r[2], source=r[3], n_chars=r[4])


def base_values(text):
    found = [(*m.span(), m[2]) for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    found += [(*m.span(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return found + [(*m.span(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]


def brute_mask(text, docs):
    """text without its live values: looked like, and held by few owners for their texts."""
    shares = Counter(r["source"] for r in docs)
    k = max(1.0, len(docs) ** 2 / sum(n * n for n in shares.values()))
    live = []
    for start, stop, value in base_values(text):
        holders = [r for r in docs if any(x[2] == value for x in base_values(r["text"]))]
        owners, texts = len({r["source"] for r in holders}), len({r["text"] for r in holders})
        looks = len(set(value)) >= 8 and (value.startswith("AKIA") or re.search("[A-Za-z]", value) and re.search("[0-9]", value)) and not re.search(secrets.EXAMPLE, value.lower())
        if looks and (texts == 1 or owners <= max(1, 0.5 * k * (1 - (1 - 1 / k) ** texts))):
            live.append((start, stop))
    out, at = "", 0
    for start, stop in sorted(live):
        if start >= at:
            out += text[at:start] + secrets.MASK
        at = max(at, stop)
    return out + text[at:] if live else text


def test_clashing_columns(spark, corpus):
    from pyspark.sql import functions as F

    df = corpus.select("*", *(F.lit(7).alias(c) for c in "kept spans copies size _row live f0 row".split()))
    for name, f in corpus_pipeline.STAGES[:-1]:
        df = f(spark, df, "")
        assert df.columns == [*corpus.columns, *"kept spans copies size _row live f0 row".split()], name
    assert df.filter("kept = 7 AND spans = 7 AND copies = 7").count() == df.count() > 0


def test_empty(spark, no_docs):
    df = no_docs
    for _, f in corpus_pipeline.STAGES:
        df = f(spark, df, "")
    assert df.count() == 0


def test_run_and_registry(spark, sf):
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)


def test_unrelated_texts_stay(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(60)), "en", "s", 1) for i in range(400)]
    assert corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").count() == 400
