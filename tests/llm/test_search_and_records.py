import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontoloom.llm import ann, bloom, chat, packing, url_filter, warc
from tests.llm.test_text_models import check_bins

# --- URL filter ------------------------------------------------------------------------

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "org/fr/secret"), ("block", "dup.io/"), ("allow", "dup.io/")]


def brute_rule(url):
    u = url or ""
    if "://" not in u:
        return "", "", None, "allow"
    rest = u.split("://", 1)[1]
    k = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k]), rest[k:]
    path = tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
    fits = []
    for v, r in RULES:
        h, p = r[: r.index("/")], r[r.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(r), len(h), r, v))
    if not fits:
        return host, path, None, "allow"
    best = max(fits)[2]
    return host, path, best, min(v for v, r in RULES if r == best)


URLS = [
    "http://A.Example.NET/en/x", "https://example.net/en/", "http://example.net/en", "http://net/", "http://net", "http://xnet/", "ftp://m.example.com/de/1?q#f", "http://example.com/DE/1", "http://a.b.org/fr/secrets",
    "http://org/fr/x?y", "http://org#/fr/", "http://dup.io/1", "nothing", "", None, "://", "http://", "http://ü.NET/é", "x://a://b.net/", "http://" + "a." * 50 + "net/" + "p" * 5000,
]


def test_urls_match_brute_force(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, "http://x.net/", "h", "r"), (1, URLS[1], "h", "r"), (None, None, "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, best string, pid string")
    got = url_filter.judge(pages, url_filter.rules_table(spark, RULES)).collect()
    key = lambda r: (-1 if r[0] is None else r[0], str(r[1]))
    assert sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got), key=key) == sorted(((i, u, *brute_rule(u)) for i, u, *_ in rows), key=key)
    assert url_filter.judge(pages.where("false"), url_filter.rules_table(spark, RULES)).count() == 0
    none = url_filter.judge(pages, url_filter.rules_table(spark, RULES).where("false"))
    assert {(r.rule, r.verdict) for r in none.select("rule", "verdict").distinct().collect()} == {(None, "allow")}


def test_once_filter_has_no_false_negative(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("h"))
    blocks = bloom.blocks_for(2000)
    f = bloom.once_filter(keys, "h", blocks)
    assert bloom.hits(keys, "h", f, blocks, "m").where("not m").count() == 0
    other = spark.range(10_000, 20_000).select(F.xxhash64("id").alias("h"))
    assert bloom.hits(other, "h", f, blocks, "m").where("m").count() < 200


# --- chat --------------------------------------------------------------------------------


def brute_chat(rows):
    conv = {}
    for c, t, r, x in rows:
        conv.setdefault(c, []).append((-(10**9) if t is None else t, r or "", x or ""))
    seqs = {c: tuple((r, x) for _, r, x in sorted(v)) for c, v in conv.items()}
    groups = {}
    for c, s in seqs.items():
        groups.setdefault(s, []).append(c)
    inner = {s[:k] for s in seqs.values() for k in range(1, len(s))}
    order = lambda c: (c is None, c or 0)
    return sorted(((min(cs, key=order), len(s), len(cs), "".join(f"<|{r}|>\n{x}\n" for r, x in s)) for s, cs in groups.items() if s not in inner), key=str)


def test_chat_matches_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for c in range(120):
        n = rng.randrange(1, 6)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"m{rng.randrange(2)}" if t else "hello") for t in range(n)]
    rows += [(200, 0, None, None), (201, 0, "", ""), (202, None, "user", "x"), (202, 0, "user", "y"), (203, 1, "user", "a"), (203, 1, "user", "a"), (None, 0, "user", "null id"), (204, 0, "user", "long " * 40_000), (205, 0, "ab", "c"), (206, 0, "a", "bc")]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, n int")
    got = sorted(((r.conv_id, r.n_turns, r.copies, r.text) for r in chat.render(df).collect()), key=str)
    assert got == brute_chat(rows)
    assert chat.render(df.where("false")).count() == 0


# --- nearest neighbours -----------------------------------------------------------------


def brute_near(rows, queries, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0) and len(v) == 8}
    out = {}
    for q in queries:
        if q in ok:
            d = sorted((math.sqrt(float(((ok[q] - v) ** 2).sum())), i) for i, v in ok.items() if i != q)[:k]
            out[q] = d
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(i, [1.0] * 8) for i in range(2000, 2400)]  # one vector many times
    rows += [(3000, None), (3001, [0.0] * 8), (3002, [float("nan")] * 8), (3003, [1.0, None] + [0.0] * 6), (3004, [float("inf")] + [0.0] * 7), (3005, [1.0]), (None, [1.0] * 8), (3100, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, v string")
    got = {}
    for r in ann.search(df, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.id))
    want = brute_near(rows, [i for i, _ in rows if i is not None and i % 100 == 0], 10)
    assert set(got) == set(want)
    found = total = 0
    for q, ws in want.items():
        g = sorted(got[q])
        assert [x[0] for x in g] == list(range(1, len(ws) + 1))
        found += len({x[2] for x in g} & {i for _, i in ws})
        total += len(ws)
        dist = {i: d for d, i in brute_near(rows, [q], 10**6)[q]}
        assert all(abs(s - dist[i]) < 1e-9 for _, s, i in g)
    assert found / total >= 0.95
    assert [i for _, _, i in sorted(got[2000])] == list(range(2001, 2011))


def recall(spark, x, **kw):
    """Mean recall at 10 of every hundredth vector, and the share of lists that were probed."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    shares = []
    plain = ann.lists_needed

    def seen(vectors, quantiser, sample, k):
        n = plain(vectors, quantiser, sample, k)
        shares.append(n / len(quantiser.centroids))
        return n

    ann.lists_needed = seen
    try:
        got = {}
        for r in ann.search(df, F.col("id") % 100 == 0, **kw).collect():
            got.setdefault(r.query_id, set()).add(r.id)
    finally:
        ann.lists_needed = plain
    hits = []
    for q in range(0, len(x), 100):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits.append(len(got[q] & set(np.argsort(d, kind="stable")[:10].tolist())) / 10)
    return float(np.mean(hits)), shares[0]


def test_recall_where_lists_are_pruned(spark):
    """20,000 vectors in clusters: a tenth of the lists is enough, and the number is found by measuring."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 32))[rng.integers(0, 200, 20_000)] + 0.3 * rng.normal(size=(20_000, 32))
    found, share = recall(spark, x)
    assert share <= 0.2 and found >= 0.95


def test_recall_without_structure(spark):
    """Independent components: most lists are needed, and taken."""
    x = np.random.default_rng(8).normal(size=(20_000, 32))
    found, share = recall(spark, x)
    assert share < 1 and found >= 0.9


def test_shared_ids_and_other_lengths(spark):
    rows = [(100, [1.0, 0.0]), (100, [2.0, 0.0]), (1, [1.5, 0.0]), (1, [1.25, 0.0]), (200, [1.0, 1.0, 1.0]), (2, [1.0, 1.0, 2.0]), (300, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.id, r.score) for r in ann.search(df, F.col("id") % 100 == 0).collect())
    assert got == [(100, 1, 1, 0.25), (100, 1, 1, 0.5), (100, 2, 1, 0.5), (100, 2, 1, 0.75), (100, 3, 100, 1.0), (100, 3, 100, 1.0), (200, 1, 2, 1.0)]


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_vectors(spark, n):
    df = spark.createDataFrame([(100 * i, [float(i + 1), 1.0]) for i in range(n)], "vec_id long, embedding array<float>")
    assert ann.search(df, F.col("id") % 100 == 0).count() == n * (n - 1)


# --- packing --------------------------------------------------------------------------------


def test_packing_loses_nothing(spark, docs):
    rng = random.Random(8)
    rows = [(i, "w " * rng.choice([1, 3, 50, 255, 256, 257, 700, 2048, 2049, 9000])) for i in range(400)] + [(900, None), (901, ""), (902, " \n"), (903, "a\x0bb  c "), (904, "x"), (904, "x"), (None, "y z")]
    got = packing.plan(docs(rows)).collect()
    by, bins = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for i, t in rows[:400] + rows[403:404]:
        parts = sorted(by[i], key=lambda r: r.piece)
        assert sum(r.length for r in parts) == len(t.split())
        assert [r.start for r in parts] == [2048 * k for k in range(len(parts))]
    assert len(by[904]) == 2 and by[None][0].length == 2
    assert all(by[i][0].bin_id is None and by[i][0].length == 0 for i in (900, 901, 902))
    for rs in bins.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.length
        assert rs[0].bin_size == min(s for s in packing.SIZES if s >= at)
    assert packing.plan(docs([(1, "x")]).where("false")).count() == 0


def best_fit(lengths, sizes, cost, bound):
    rooms, used = [], []
    for n in lengths:
        fit = [(room, -b) for b, room in enumerate(rooms) if room >= n]
        left = sum(lengths) - sum(used)
        if fit:
            b = -min(fit)[1]
        else:
            able = [s for s in sizes if n <= s <= bound] or [min(s for s in sizes if s >= n)]
            rooms.append(min(able, key=lambda s: (cost(s) / min(s, left), -s)))
            used.append(0)
            b = len(rooms) - 1
        rooms[b] -= n
        used[b] += n
    return sum(cost(min(s for s in sizes if s >= u)) for u in used)


@pytest.mark.parametrize("cost", [packing.linear_cost, lambda s: s + s * s / 4096])
def test_packing_cost_equals_brute_force(cost):
    rng = random.Random(1)
    sizes = [64, 128, 512]
    for _ in range(30):
        lengths = sorted((rng.randrange(1, 513) for _ in range(rng.randrange(1, 60))), reverse=True)
        bins, offsets, final = packing.pack_shard(lengths, sizes, cost)
        total = sum(map(cost, final))
        assert total == pytest.approx(min(best_fit(lengths, sizes, cost, b) for b in sizes))
        assert total >= sum(lengths)


def test_plan_equals_brute_force(spark, monkeypatch):
    """Several shards, each as good as the best of all bounds; large ids beside null ones stay as they are."""
    monkeypatch.setattr(packing, "SHARD_PIECES", 60)
    rng = random.Random(6)
    big = 2**53 + 1
    rows = [(big + i if i % 7 else None, rng.choice([0, 1, 60, 64, 65, 128, 200, 511, 512, 513, 1300])) for i in range(300)]
    df = spark.createDataFrame([(i, n, "x") for i, n in rows], "doc_id long, n long, bin_id string")
    sizes = [64, 128, 512]
    got = packing.plan(df, F.col("n"), sizes=tuple(sizes)).collect()
    assert sorted(str(r.doc_id) for r in got if r.piece == 0) == sorted(str(i) for i, _ in rows)
    assert sorted(r.length for r in got) == sorted(k for _, n in rows for k in ([512] * (n // 512) + [n % 512] * (n % 512 > 0) or [0]))
    shards = {}
    for r in got:
        if r.bin_id is not None:
            shards.setdefault(r.bin_id.split("-")[0], []).append(r)
    assert len(shards) > 3
    for rs in shards.values():
        cost = sum(packing.linear_cost(s) for s in {r.bin_id: r.bin_size for r in rs}.values())
        lengths = sorted((r.length for r in rs), reverse=True)
        assert cost == min(best_fit(lengths, sizes, packing.linear_cost, b) for b in sizes)


def test_repeated_rows_spread(spark, monkeypatch):
    """A third of all rows repeat one id and text, a third have no id: no shard holds many more pieces than others."""
    monkeypatch.setattr(packing, "SHARD_PIECES", 500)
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.lit("same words in all").alias("text"))
    got = packing.plan(df)
    per = [r["count"] for r in got.groupBy(F.split("bin_id", "-")[0]).count().collect()]
    assert sum(per) == 30_000 and len(per) == 60 and max(per) < 700
    assert got.where("doc_id = 7").count() == 10_000


def test_sequences_hold_all_tokens(spark):
    rng = random.Random(9)
    rows = [(i, [rng.randrange(50_000) for _ in range(rng.choice([0, 1, 300, 2048, 2049, 5000]))]) for i in range(60)] + [(100, None)]
    df = spark.createDataFrame([(i, None if t is None else bytearray(np.array(t, np.uint16).tobytes()), "x") for i, t in rows], "doc_id long, t binary, tokens string")
    out = packing.pack(df, F.col("t"), 2).withColumnRenamed("ids", "doc_ids")
    check_bins(out.collect(), dict(rows))
    assert packing.pack(df.where("false"), F.col("t"), 2).count() == 0


def test_packed_text(spark, docs):
    df = docs([(1, "a b c"), (2, "d  e"), (3, "f " * 3000)])
    text = packing.render(df, packing.plan(df)).collect()
    assert sorted(" ".join(r.text for r in text).split()) == sorted(("a b c d e " + "f " * 3000).split())
    assert all(len(r.text.split()) <= r.bin_size for r in text)


# --- WARC ------------------------------------------------------------------------------------


def test_audit_finds_each_fault(spark):
    pages = spark.range(900).select(F.col("id").alias("page_id"), F.concat(F.lit("http://x/"), "id").alias("url"), F.repeat(F.col("id").cast("string"), 200).alias("html"), F.lit("c").alias("hash"), F.lit(1).alias("file"))
    a = warc.records(pages)
    assert warc.audit(a, warc.records(pages)).count() == 0
    rotten = F.when(F.col("page_id").isin(5, 300), F.overlay("html", F.lit("#"), F.lit(3))).otherwise(F.col("html"))
    b = warc.records(pages, rotten)
    extra = spark.createDataFrame([(7, 999_999_999, 10, bytearray(b"x"))], "file long, offset long, length long, hash binary")
    b = b.where("page_id <> 700").select("file", "offset", "length", "hash").unionByName(extra)
    got = {(r.file, r.problem) for r in warc.audit(a, b).collect()}
    assert got == {(0, "changed"), (1, "changed"), (2, "missing"), (7, "extra")}
    assert warc.audit(a.where("false"), a.where("false")).count() == 0
    assert warc.audit(a.where("file = 1"), a.where("false")).count() == 256


def test_records_of_nulls(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "h"), (None, "u", "h"), (2, "é", "é" * 100_000)], "page_id long, url string, html string")
    got = warc.records(pages)
    assert got.count() == 4
    assert warc.audit(got, got).count() == 0
    assert warc.audit(got, got.where("page_id is not null")).count() == 2


def test_offsets_are_those_of_the_file(spark):
    pages = spark.createDataFrame([(i, f"http://{i}", "ü" * i) for i in range(300)], "page_id long, url string, html string")
    rows = sorted(warc.records(pages).collect(), key=lambda r: (r.file, r.offset))
    for x, y in zip(rows, rows[1:], strict=False):
        assert y.offset == (x.offset + x.length if x.file == y.file else 0)
    first = pages.select(warc.record(F.col("url"), F.col("html"), F.col("page_id")).alias("r")).first().r
    head, body = bytes(first).split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\n") and b"Content-Length: 0" in head and body == b"\r\n\r\n"
