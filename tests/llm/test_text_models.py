import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import public_tokenizers
import tiktoken
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from ontoloom.llm import bpe, common, packing, quality, queries, toxicity
from tests.llm.test_dedup import family, shingle_set

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCAB = bpe.load_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: i for i, b in enumerate(VOCAB)}, special_tokens={})

TEXTS = [None, "", " ", "a", "hello world", "<|endoftext|> x", "a" * 20_000, " " * 5000 + "x", "é" * 3000, "naïve Straße ñandú", "日本語 🙂🙃", "\n\n\t\r\n x", "don't 123456 !!!???", "Thorble Thorble " * 500, "\x00\x01", "\ufffd\u200b"]


def test_perfect_hash_is_minimal_and_exact():
    table = bpe.table_of(VOCAB)
    assert [table.get(b) for b in VOCAB] == list(range(len(VOCAB)))
    assert sorted(table.ids) == list(range(len(VOCAB)))
    rng = random.Random(0)
    own = set(VOCAB)
    assert all(table.get(x) == -1 for x in (rng.randbytes(rng.randrange(1, 12)) for _ in range(5000)) if x not in own)


def test_encoder_equals_the_library():
    e = bpe.Encoder(VOCAB, public_tokenizers.PATTERN)
    rng = random.Random(3)
    texts = [t or "" for t in TEXTS] + ["".join(chr(rng.choice([32, 65, 97, 233, 0x4E2D, 0x1F600, 10, 39]) + rng.randrange(20)) for _ in range(rng.randrange(200))) for _ in range(300)]
    for t in texts:
        assert e.ids(t) == LIBRARY.encode_ordinary(t)
    e.KNOWN = e.ranks.KNOWN = 3  # forgetting changes nothing
    assert all(e.ids(t) == LIBRARY.encode_ordinary(t) for t in texts[:60])


def test_latin_pattern_finds_the_same():
    e = bpe.Encoder(VOCAB, public_tokenizers.PATTERN)
    every = "".join(map(chr, range(256)))
    rng = random.Random(4)
    for t in [every, every[::-1], *("".join(rng.choice(every) for _ in range(300)) for _ in range(200)), "don't \x1c \x85x  y\xa0 ½²a"]:
        assert e.find_latin(t) == e.find(t) and e.ids(t) == LIBRARY.encode_ordinary(t)
    assert e.find_latin != e.find
    for odd in (r"\p{Lu}+", r"[\S]x", r"(?i:'s)", r"[a-z&&[x]]", r"\w+"):
        assert bpe.latin_pattern(odd) is None


def test_encoding_by_library_is_the_same(spark, docs):
    more = [" " * 300_000, "\n" * 200_000 + "x", "a b" * 100_000]
    df = docs(list(enumerate(TEXTS + more)))
    both = df.select(bpe.encode(F.col("text"), VOCAB, public_tokenizers.PATTERN).alias("a"), bpe.encode_by_library(F.col("text"), VOCAB, public_tokenizers.PATTERN).alias("b"))
    assert bpe.width_of(VOCAB) == 2
    assert all(np.frombuffer(r.b, np.uint16).tolist() == r.a for r in both.collect())
    assert both.where("false").count() == 0


def test_round_trip(spark, docs):
    df = docs([(i, t) for i, t in enumerate(TEXTS)] + [(0, "again"), (None, "null id")])
    ids = df.select("doc_id", "text", bpe.encode(F.col("text"), VOCAB, public_tokenizers.PATTERN).alias("ids"))
    for r in ids.select("text", "ids", bpe.decode(F.col("ids"), VOCAB).alias("back")).collect():
        assert bytes(r.back) == (r.text or "").encode() and r.ids == LIBRARY.encode_ordinary(r.text or "")
    assert ids.where("false").count() == 0


# --- segments --------------------------------------------------------------------------------


def brute_segments(scores):
    """Maximal scoring segments by their recursive definition: the best one, then those left and right of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > 1e-9 and (best is None or s > best[0] + 1e-9 or abs(s - best[0]) <= 1e-9 and (j - i) < best[2] - best[1]):
                best = (s, i, j)
    if best is None:
        return []
    _, i, j = best
    return brute_segments(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in brute_segments(scores[j:])]


def test_segments_equal_brute_force():
    rng = random.Random(6)
    for _ in range(200):
        scores = [rng.choice([1.13, 2.07, 0.71]) if rng.random() < 0.3 else -0.25 for _ in range(rng.randrange(1, 40))]
        got = toxicity.segments([(i, s) for i, s in enumerate(scores) if s > 0])
        total = lambda ab: round(sum(scores[ab[0] : ab[1]]), 6)
        assert sorted(map(total, ((s.start, s.end) for s in got))) == sorted(map(total, brute_segments(scores)))


def test_segment_scan_is_linear():
    n = 200_000
    rng = random.Random(1)
    assert toxicity.segments([(3 * i, rng.random()) for i in range(n)])


INSULTS = ["gruk", "vlat", "plixx", "dronfel", "smerg"]


def corpus(rng, n=500):
    words = ["".join(rng.choice("aeiou") + rng.choice("bcdlmnrst") for _ in range(rng.randrange(1, 4))) for _ in range(1200)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(30, 300))]
        toxic, good = rng.random() < 0.2, rng.random() < 0.75
        if not good:
            w = [x + rng.choice(["%%%", "***", "###"]) for x in w] if rng.random() < 0.5 else [x for x in w[:12] for _ in range(25)]
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        docs.append((i, " ".join(w)))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(11)
    rows, labels = corpus(rng)
    base = rows[1][1].split()
    rows += [(1000 + k, rows[k][1]) for k in range(30)] + [(2000 + k, family(rng, base, 1)) for k in range(5)]
    rows += [(3000, None), (3001, ""), (3002, "x"), (3003, "  spaced   out  ")]
    at = tmp_path_factory.mktemp("sf")
    pq.write_table(pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "lang": ["en"] * len(rows), "source": ["s"] * len(rows), "n_chars": [len(r[1] or "") for r in rows]}), at / "documents.parquet")
    pq.write_table(pa.table({"doc_id": [x[0] for x in labels] + [1], "quality": [x[1] for x in labels] + [None], "toxic": [x[2] for x in labels] + [None]}), at / "labels.parquet")
    return str(at), dict(rows), {x[0]: x for x in labels}


@pytest.mark.parametrize("name, k, folds, held, bar", [("op7_quality", 1, 4, 2, 0.9), ("op5_toxicity", 2, 5, 0, 0.9)])
def test_classifiers_on_held_out_rows(spark, folder, name, k, folds, held, bar):
    at, rows, labels = folder
    got = {r.doc_id: r for r in queries.ALL[name](spark, at).collect()}
    assert set(got) == set(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= (0.7 if k == 1 else 0.5)) for r in got.values())
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == held)
    out = [(got[i].predicted, x[k]) for i, x in labels.items() if got[i].held_out]
    assert len(out) > 50 and np.mean([p == y for p, y in out]) >= bar
    again = {r.doc_id: r.score for r in queries.ALL[name](spark, at).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())


def train_rows(rows, labels, k, folds, held):
    return [(i, rows[i], x[k]) for i, x in labels.items() if zlib.crc32(str(i).encode()) % folds != held]


def test_quality_equals_brute_force(spark, folder):
    """Scores from the two dictionaries by hand; the weights are the optimum of the calibration."""
    at, rows, labels = folder
    model = quality.fit(spark.read.parquet(at + "/documents.parquet"), spark.read.parquet(at + "/labels.parquet"))
    got = {r.doc_id: r.score for r in queries.op7_quality(spark, at).collect()}

    def size(data, raw):
        params = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=False, write_checksum=False, write_dict_id=False)
        at = [*range(0, len(data), 512), len(data)]
        if len(at) > 2 and at[-1] - at[-2] < 64:
            del at[-2]
        one = zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(raw))
        return sum(len(one.compress(data[a:b])) for a, b in zip(at, at[1:], strict=False))

    def row(text, good, bad):
        data = (text or "").encode()
        return (size(data, bad) - size(data, good)) / (len(data) + 24), math.log(len(data) + 24)

    def design(x):
        u, v = ((x - model.centre) / model.scale).T
        return np.stack([np.ones_like(u), u, v, u * u, u * v, v * v], 1)

    z = design(np.array([row(t, model.good, model.bad) for t in rows.values()])) @ model.weights
    assert np.allclose([got[i] for i in rows], 1 / (1 + np.exp(-z)), atol=1e-12)

    train = train_rows(rows, labels, 1, 4, 2)
    half = {r.doc_id: r.h for r in spark.createDataFrame([(i,) for i, *_ in train], "doc_id long").select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("h")).collect()}
    cut = lambda part, y: [b for i, t, q in sorted(part) if q == y for b in quality.blocks(t.encode())]
    x, y = [], []
    for k in (0, 1):
        other = [r for r in train if half[r[0]] != k]
        good, bad = (quality.dictionary(cut(other, q)) for q in (1, 0))
        x += [row(t, good, bad) for i, t, _ in train if half[i] == k]
        y += [q for i, _, q in train if half[i] == k]
    x = np.array(x)
    assert np.allclose(model.centre, x.mean(0)) and np.allclose(model.scale, x.std(0), atol=1e-8)
    d = design(x)
    p = 1 / (1 + np.exp(-(d @ model.weights)))
    slope = d.T @ (p - np.array(y)) + model.weights * np.array([1e-6, 1, 1, 1, 1, 1])
    assert np.abs(slope).max() < 1e-4


def test_toxicity_equals_brute_force(spark, folder):
    """Weights, lambda, K, evidence and calibration by hand."""
    at, rows, labels = folder
    model = toxicity.fit(spark.read.parquet(at + "/documents.parquet"), spark.read.parquet(at + "/labels.parquet"))
    train = [(set(toxicity.tokens(t)), toxicity.tokens(t), y) for _, t, y in train_rows(rows, labels, 2, 5, 0)]
    n, toxic = Counter(), Counter()
    for own, _, y in train:
        n.update(own)
        toxic.update(own if y else ())
    base = sum(toxic.values()) / sum(n.values())

    def odds(y, k, share, prior):
        a, b = y + prior * share, k - y + prior * (1 - share)
        d = math.log(a / b) - math.log(base / (1 - base))
        return d, d / math.sqrt(1 / a + 1 / b)

    sy, sn = Counter(), Counter()
    for t in n:
        if len(t) > 4:
            sy[t[:4]] += toxic[t]
            sn[t[:4]] += n[t]
    stems = {s: odds(sy[s], sn[s], base, 10.0) for s in sn}
    words = {t: odds(toxic[t], n[t], (sy[t[:4]] + 10 * base) / (sn[t[:4]] + 10) if len(t) > 4 else base, 5.0) for t in n}
    heads = {s: d for s, (d, z) in stems.items() if z >= 5 and d > 0}
    strong = {t: d for t, (d, z) in words.items() if z >= 2.5 and d > 0}
    innocent = {t: 0.0 for t, (d, _) in words.items() if len(t) > 4 and t[:4] in heads and d <= 0 and n[t] >= 2}
    assert set(model.stems) == set(heads) and set(model.words) == set(strong) | set(innocent)
    assert all(abs(model.words[t] - w) < 1e-9 for t, w in (strong | innocent).items())

    clean = sum(n.values()) - sum(toxic.values())
    rates = [((n[t] - toxic[t]) + 0.1) / clean for t in strong] + [0.1 / clean] * len(heads)
    values = [*strong.values(), *heads.values()]
    reach = lambda lam: sum(r * math.exp(lam * v) for r, v in zip(rates, values, strict=True)) + (1 - sum(rates)) * math.exp(-0.25 * lam)
    assert abs(reach(model.lam) - 1) < 1e-6

    weight = lambda t: max(0.0, model.words.get(t, heads.get(t[:4], 0.0) if len(t) > 4 else 0.0))
    scan = toxicity.Scanner(model)
    found = lambda ts: toxicity.segments([(i, weight(t)) for i, t in enumerate(ts) if weight(t) > 0])
    many = sum(s.score >= 1 for _, ts, y in train if not y for s in found(ts))
    assert model.k == pytest.approx((many + 0.5) * math.exp(model.lam) / sum(len(ts) for _, ts, y in train if not y))

    def evidence(ts, pieces):
        each = [model.lam * s - math.log(model.k * max(len(ts), 1)) for s in pieces]
        return math.log1p(max([0.0, *each])), math.log1p(sum(e for e in each if e >= -math.log(0.05)))

    for _, t in list(rows.items())[:40]:
        ts = toxicity.tokens(" ".join((t or "").split()[:40]))
        scores = [weight(x) or -0.25 for x in ts]
        want = evidence(ts, [sum(scores[a:b]) for a, b in brute_segments(scores)])
        assert np.allclose(scan.evidence(" ".join(ts)), want, atol=1e-6)
    got = {r.doc_id: r.score for r in queries.op5_toxicity(spark, at).collect()}
    for i, t in rows.items():
        z = model.weights @ np.array([1.0, *evidence(toxicity.tokens(t or ""), [s.score for s in found(toxicity.tokens(t or ""))])])
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
    x = np.array([[1.0, *evidence(ts, [s.score for s in found(ts)])] for _, ts, _ in train])
    p = 1 / (1 + np.exp(-(x @ model.weights)))
    assert np.abs(x.T @ (p - np.array([y for *_, y in train])) + model.weights * np.array([1e-6, 0.1, 0.1])).max() < 1e-4


def test_labelled_samples_are_bounded_by_bytes(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.when(F.col("id") == 3, 900).otherwise(100)).alias("text"))
    lab = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    got = common.labelled(df, lab, "toxic", 5, 0, 50, 2_000).collect()
    assert len(got) == 20 and all(len(r.text) == 100 for r in got)
    assert common.labelled(df, lab, "toxic", 5, 0, 50, 1 << 20).count() == 50


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 1), (3, 0, 1)], [(1, None, None)]])
def test_few_labels_and_empty_tables(spark, docs, labels):
    df = docs([(1, "some words"), (2, None), (3, "more words " * 3000), (None, "x")])
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for d in (df, df.where("false")):
        for op in (quality, toxicity):
            out = d.select(op.score(F.col("text"), op.fit(d, lab)).alias("s")).collect()
            assert all(0 < r.s < 1 for r in out)


def test_passages_are_found_whole(spark, folder):
    at, rows, labels = folder
    df = spark.read.parquet(at + "/documents.parquet")
    model = toxicity.fit(df, spark.read.parquet(at + "/labels.parquet"))
    text = "calm words here " * 50 + " ".join(INSULTS) + " calm words again" * 50
    found = df.limit(1).select(toxicity.passages(F.lit(text), model).alias("p")).first().p
    assert [(p.first, p.behind) for p in found] == [(150, 155)]


# --- the pipeline ------------------------------------------------------------------------------


def test_pipeline_against_brute_force(spark, folder, tmp_path):
    at, rows, _ = folder
    docs = spark.read.parquet(at + "/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, at)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    good = queries.op7_quality(spark, at).where("score >= 0.7").collect()
    assert kept[0] == sorted(r.doc_id for r in good)
    first = {}
    for i in kept[1]:
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", rows[i] or ""), i)
    assert kept[2] == sorted(first.values())
    sets = {i: shingle_set(rows[i], 5) for i in kept[2]}
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    stay = sorted(i for i in sets if find(i) == i)
    assert kept[3] == stay
    bins = corpus_pipeline.run(spark, at).collect()
    check_bins(bins, {i: LIBRARY.encode_ordinary(rows[i] or "") for i in stay})


def check_bins(bins, tokens):
    """Each token of each document is in one place, and each bin is of the least size that holds it."""
    found = {}
    for r in bins:
        held = np.frombuffer(r.tokens, np.uint16).tolist()
        assert r.n_tokens == sum(r.lengths) == len(held) and r.bin_size == min(s for s in packing.SIZES if s >= r.n_tokens)
        at = 0
        for i, piece, start, n in zip(r.doc_ids, r.pieces, r.starts, r.lengths, strict=True):
            assert start == piece * max(packing.SIZES)
            found.setdefault(i, {})[start] = held[at : at + n]
            at += n
    got = {i: [x for _, part in sorted(parts.items()) for x in part] for i, parts in found.items()}
    assert got == {i: t for i, t in tokens.items() if t}
