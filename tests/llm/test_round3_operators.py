"""Importance resampling, line dedup and spelling variants against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from masterline.llm import class_lm, importance, line_dedup, secrets, spelling

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_repr(rows):
    return sorted(map(repr, map(tuple, rows)))


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
    return w, [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]


def brute_importance(docs, target, percent=25, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([d for _, d in docs], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000))))
    out = []
    for i, text in docs:
        w, f = features(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], math.inf if x[0] is None else x[0], x[2]))
    ranks = defaultdict(list)
    for r, x in enumerate(fit, 1):
        ranks[x].append(r if r <= len(fit) * percent // 100 else None)
    return [(*x, ranks[x].pop(0) if x in ranks else None) for x in out]


def test_importance_brute_force(spark, docs, rows, clashing):
    target = [r[1] for r in rows[3:6]] + [None, "", "Zoë market day"]
    wanted = spark.createDataFrame([(x,) for x in target], "text string")
    for percent in (25, 100):
        got = importance.resample(docs, wanted, percent=percent).collect()
        assert by_repr(got) == by_repr(brute_importance([(r[0], r[1]) for r in rows], target, percent))
    assert by_repr(importance.resample(clashing, wanted).collect()) == by_repr(importance.resample(docs, wanted).collect())


def test_importance_ties_and_empty(spark, docs, no_docs):
    scored = spark.createDataFrame([(i, 30, 1, 0, i % 3) for i in range(50)], "doc_id long, n_words long, n_features long, weight long, score long")
    got = importance.draw(scored, percent=50).filter("rank IS NOT NULL").orderBy("rank").collect()
    order = sorted(range(50), key=lambda i: (-(i % 3), i))
    assert [(r["doc_id"], r["rank"]) for r in got] == [(i, k) for k, i in enumerate(order[:25], 1)]
    assert importance.resample(no_docs, docs).count() == 0
    alone = importance.resample(docs, no_docs)
    assert alone.count() == docs.count() and alone.filter("rank IS NULL AND weight IS NULL").count() == 0


def test_importance_long_runs():
    n, got = importance.feature_buckets("Ab c1é-d  ".encode(), 3, 1 << 31)
    assert (n, got.tolist()) == (3, [zlib.crc32(x.encode()) % (1 << 31) for x in ("ab", "c1é", "d", "ab c1é", "c1é d", "ab c1é d")])
    assert importance.feature_buckets(b"one", 3)[1].tolist() == [zlib.crc32(b"one") % 10_000]
    assert importance.feature_buckets(b" .,", 2)[0] == 0


def brute_lines(docs, least_docs=3, least_chars=20):
    keys = lambda t: [(x, x.strip(" \t\n\x0b\f\r").translate(ASCII)) for x in (t or "").split("\n")]
    held = defaultdict(list)
    for i, t in docs:
        for k in {k for _, k in keys(t) if len(k) >= least_chars}:
            held[k].append(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= least_docs}
    out = []
    for i, t in docs:
        left = [x for x, k in keys(t) if k not in last or last[k] == i]
        out.append((i, len(keys(t)), len(keys(t)) - len(left), "\n".join(left)))
    return out


def line_docs():
    rng = random.Random(3)
    pool = [f"{'Shared ' * (k % 3 + 1)}line number {k} é日\U0001f600" for k in range(40)] + ["short", "", "  \t"]
    texts = ["\n".join(f"{rng.choice(['', ' ', chr(9)])}{x.upper() if rng.random() < 0.2 else x}{rng.choice(['', chr(13), chr(0x2028)])}" for x in rng.choices(pool, k=rng.randrange(1, 12))) for _ in range(60)]
    texts += [None, "", "\n", "x" * 40, "everywhere the very same line of text"] + ["everywhere the very same line of text\nown " + str(i) for i in range(60)]
    docs = list(enumerate(texts))
    return docs + [docs[3], docs[3], docs[70], (None, texts[1]), (None, "only without an id, this line\nx"), (None, "only without an id, this line"), (None, "only without an id, this line")]


def test_line_dedup_brute_force(spark):
    docs = line_docs()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("h1", F.lit(1)).withColumn("kept", F.lit("x"))
    want = by_repr(brute_lines(docs))
    for batches in (1, 4):
        assert by_repr(line_dedup.dedup_lines(frame, batches=batches).collect()) == want
    assert by_repr(line_dedup.dedup_lines(frame, least_docs=1, least_chars=0).collect()) == by_repr(brute_lines(docs, 1, 0))


def test_line_runs_are_levelled_and_sorted(spark):
    docs = line_docs()[::-1]
    frame = spark.createDataFrame([d for d in docs if d[0] is not None], "id long, text string").select("id", line_dedup.line_hashes(F.col("text")).alias("hashes"))
    runs = line_dedup.LineRuns(spark, buckets=3)
    for low in range(130, -10, -10):
        runs.add(frame.filter((F.col("id") >= low) & (F.col("id") < low + 10)), "id", "hashes")
        assert all(len(level) < runs.fanout for level in runs.levels)
    assert len(runs.levels) == 4
    rows = spark.table(runs.tables()[0]).withColumn("p", F.input_file_name()).collect()
    by_file = defaultdict(list)
    for r in rows:
        by_file[r["p"]].append((r["h1"], r["h2"]))
    assert all(x == sorted(x) and len(set(x)) == len(x) for x in by_file.values())
    join = spark.table(runs.tables()[0]).join(spark.table(runs.tables()[-1]).hint("merge"), ["h1", "h2"], "left_anti")
    assert "Exchange" not in join._jdf.queryExecution().executedPlan().toString()
    names = runs.tables()
    got = {(r["h1"], r["h2"]): r["holder"] for r in runs.repeated().collect()}
    want = defaultdict(list)
    for r in frame.collect():
        for h in {tuple(h) for h in r["hashes"] if h is not None}:
            want[h].append(r["id"])
    assert got == {h: max(ids) for h, ids in want.items() if len(ids) >= 3}
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_line_dedup_edges(spark, docs, rows, no_docs, clashing):
    assert line_dedup.dedup_lines(no_docs).count() == 0
    want = by_repr(brute_lines([(r[0], r[1]) for r in rows]))
    assert by_repr(line_dedup.dedup_lines(docs).collect()) == want == by_repr(line_dedup.dedup_lines(clashing).collect())


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(words, ratio=5):
    near = {w: [v for v in words if distance_one(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def random_words(seed, letters, n):
    rng, out = random.Random(seed), set()
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 12)))
        out |= {w, w[:2] + w[3:], w[:4] + rng.choice(letters) + w[4:], w[:3] + rng.choice(letters) + w[4:], w + w[-1]}
    return {w: 5 ** rng.randrange(1, 9) + rng.randrange(3) for w in sorted(out) if len(w) >= 6}


@pytest.mark.parametrize("letters,n", [("ab", 300), ("abcdeéÿ", 500), ("a", 3)])
def test_spelling_brute_force(spark, letters, n):
    words = random_words(len(letters), letters, n)
    words |= {"x" * 3000: 50, "x" * 3001: 5, "x" * 1500 + "y" + "x" * 1499: 300}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    want = by_repr(brute_spelling(words))
    assert by_repr(spelling.spelling_variants(frame).collect()) == want
    if n == 300:
        assert by_repr(spelling.spelling_variants(frame, q=2).collect()) == want


def test_spelling_long_lists_are_dealt_out(spark):
    words = random_words(5, "abc", 400)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {tuple(sorted((a, b))) for a in words for b in words if distance_one(a, b)}
    for rows in (3, 50, 4096):
        got = spelling.near_pairs(frame, list_rows=rows).collect()
        assert len(got) == len(want) and {tuple(sorted((r["a"], r["b"]))) for r in got} == want
        assert all(words[r["a"]] == r["a_n"] and words[r["b"]] == r["b_n"] for r in got)


def test_corpus_words(spark, docs, rows, no_docs, clashing):
    want = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    got = spelling.corpus_words(docs, held=3).collect()
    assert want and len(got) == len(want) and {r["word"]: r["n"] for r in got} == want
    assert {r["word"]: r["n"] for r in spelling.corpus_words(clashing).collect()} == want
    assert spelling.spelling_variants(spelling.corpus_words(no_docs)).count() == 0


def test_chain_ends(spark):
    links = [(f"w{i:03}", f"w{i + 1:03}") for i in range(100)] + [("a", "w050"), ("b", "a")]
    got = spelling.chain_ends(spark.createDataFrame(links, "word string, form string")).collect()
    assert len(got) == len(links) and {r["root"] for r in got} == {"w100"}


def class_likelihood(pairs, of, classes):
    table = np.zeros((classes, classes))
    np.add.at(table, (of[:, None], of[None]), pairs)
    return class_lm.xlogx(table).sum() - class_lm.xlogx(table.sum(1)).sum() - class_lm.xlogx(table.sum(0)).sum()


def test_exchange_ends_where_no_move_helps():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        pairs = rng.poisson(rng.gamma(0.5, 4, size=(14, 14)) * rng.gamma(1, 1, size=(14, 1)))
        pairs[:, :3] = 0
        pairs[5] = 0
        of = class_lm.exchange(pairs, 4, sweeps=100)
        found = class_likelihood(pairs, of, 4)
        for u in range(14):
            for c in range(4):
                other = of.copy()
                other[u] = c
                assert class_likelihood(pairs, other, 4) <= found + 1e-5


def test_null_repositories_count_as_one(spark):
    token = "token = 'q7Zk29fLm3Xp81Vt'"
    rows = [(i, f"{token} {i}", f"o{i}", None) for i in range(9)] + [(20, "token = 'a9Bk41tRw7Qz53Ys'", "o1", None), (21, "token = 'a9Bk41tRw7Qz53Ys' x", "o1", "r1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, repo string")
    got = {r["doc_id"]: r["spans"][0] for r in secrets.scan(docs, repository_col="repo").collect()}
    assert all((got[i]["owners"], got[i]["repositories"], got[i]["live"]) == (9, 1, True) for i in range(9))
    assert (got[20]["owners"], got[20]["repositories"]) == (1, 2)
