import random
import re

import numpy as np

from ontoloom.llm import bloom, exact_dedup, near_dedup
from pyspark.sql import functions as F


def test_exact_cases(spark, docs):
    rows = [(5, "a  b"), (3, "a\t\nb"), (9, "a b"), (1, None), (2, ""), (7, "A b"), (8, "long " * 50_000), (None, "long " * 50_000), (4, "t"), (4, "t"), (6, "t"), (None, "n"), (None, "n"), (10, " a b")]
    got = exact_dedup.decisions(docs(rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    want = {}
    for i, t in rows:
        want.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    assert sorted(len(v) for v in by.values()) == sorted(len(v) for v in want.values())
    for g in by.values():
        ids = [r.doc_id for r in g]
        known = [i for i in ids if i is not None]
        assert {r.keep_id for r in g} == {min(known) if known else None}
        assert {r.group_size for r in g} == {len(g)}
        assert sum(r.kept for r in g) == 1
        assert next(r for r in g if r.kept).doc_id == g[0].keep_id
    assert next(r for r in got if r.doc_id == 3).kept and not next(r for r in got if r.doc_id == 9).kept


def test_exact_dedup_keeps_columns(spark, docs):
    df = docs([(2, "x"), (1, "x"), (1, "x"), (3, "y"), (None, None), (4, "")])
    out = exact_dedup.dedup(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "x"), (3, "y"), (4, "")]


def test_empty_tables(spark, docs):
    none = docs([(1, "x")]).where("false")
    assert exact_dedup.decisions(none).count() == 0
    assert exact_dedup.dedup(none).count() == 0
    assert near_dedup.components(none).count() == 0
    assert near_dedup.dedup(none).count() == 0


def test_hot_group_of_exact_copies(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text here").otherwise(F.concat(F.lit("own "), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup.decisions(df).groupBy("group_size", "kept").count().collect()
    assert {(r.group_size, r.kept): r["count"] for r in got} == {(1000, True): 1, (1000, False): 999, (1, True): 2000}


def test_twice_filter_loses_no_repeat(spark):
    rng = random.Random(1)
    keys = [rng.getrandbits(63) for _ in range(3000)]
    repeated = keys[:300]
    df = spark.createDataFrame([(k,) for k in keys + repeated], "h long").repartition(5)
    blocks = bloom.blocks_for(3300)
    f = bloom.twice_filter(df, "h", blocks)
    hit = {r.h for r in bloom.hits(df, "h", f, blocks, "m").where("m").collect()}
    assert set(repeated) <= hit and len(hit) < 400
    tiny = bloom.twice_filter(df, "h", 64)  # far too small: more false hits, no loss
    assert set(repeated) <= {r.h for r in bloom.hits(df, "h", tiny, 64, "m").where("m").collect()}


def test_more_hashes_than_a_filter_holds(spark, monkeypatch):
    """Beyond the bound the hashes are counted; the groups are the same, and the filter has repeated ones only."""
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.least(F.col("id"), F.lit(5899)).cast("string")).alias("text"))
    plain = sorted(map(tuple, exact_dedup.decisions(df).collect()))
    monkeypatch.setattr(bloom, "MAX_BLOCKS", 64)
    counted = []
    once = bloom.once_filter
    monkeypatch.setattr(bloom, "once_filter", lambda keys, h, blocks: counted.append(keys.count()) or once(keys, h, blocks))
    assert sorted(map(tuple, exact_dedup.decisions(df).collect())) == plain and counted == [1]
    assert exact_dedup.dedup(df).count() == 5900


def shingle_set(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if x]
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    root[find(a)] = find(b)
    out = {}
    for i, (d, _) in enumerate(rows):
        out.setdefault(find(i), []).append(d)
    least = {r: min([d for d in ds if d is not None], default=None) for r, ds in out.items()}
    return sorted(((d if d is not None else -1), len(sets[i]), -1 if least[find(i)] is None else least[find(i)]) for i, (d, _) in enumerate(rows))


def family(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
    return " ".join(w)


def test_components_match_brute_force(spark, docs):
    rng = random.Random(3)
    rows, i = [], 100
    for f in range(6):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(25):
            rows.append((i, family(rng, base, rng.choice([0, 1, 2, 3, 5, 8]))))
            i += 1
    passage = " ".join(f"p{k}" for k in range(60))
    for k in range(60):
        rows.append((i, passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.choice([5, 20, 60])))))
        i += 1
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\x0btwo"), (8, "Ünder É"), (9, "ünder é"), (10, "x " * 30_000), (11, "x " * 20_000), (12, "a b c"), (12, "a b c"), (None, "a b c"), (None, "lonely null here")]
    for k, percent, exact in ((3, 85, False), (5, 80, False), (3, 40, True), (3, 85, True)):
        got = near_dedup.components(docs(rows), words=k, percent=percent, exact=exact).collect()
        mine = sorted(((r.id if r.id is not None else -1), r.n_shingles, -1 if r.component_id is None else r.component_id) for r in got)
        assert mine == brute(rows, k, percent)


def test_bands_follow_the_limit():
    assert near_dedup.banding(85) == (30, 6)
    for percent in (30, 50, 65, 80, 85, 90, 95, 100):
        n, rows = near_dedup.banding(percent)
        assert (1 - (min(percent, 99) / 100) ** rows) ** n <= near_dedup.LOSS


def test_near_dedup_keeps_one_of_each_group(spark, docs):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    rows = [(k, family(rng, base, 1)) for k in range(40)] + [(100, "clean text of its own with words"), (101, None), (102, None)]
    df = docs(rows)
    out = near_dedup.dedup(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [0, 100, 101, 102]


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for size in (3, 50, 2000):
        pool = near_dedup._mix(rng.integers(0, 2**63, 2 * size).astype(np.uint64))
        agree = []
        for t in range(30):
            p = near_dedup._mix(pool + np.uint64(t))
            a, b = p[: int(1.5 * size)], p[size // 2 :]
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            x, y = near_dedup.sketch(np.unique(a), 180), near_dedup.sketch(np.unique(b), 180)
            assert (x != near_dedup._MAX).all()
            agree.append((x == y).mean())
        assert abs(np.mean(agree) - j) < 0.05
