"""SimHash, phrases and source divergence against brute force, and their edge cases."""

import collections
import random
import re
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from acreage.llm import divergence, phrases, simhash

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_print(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_roots(prints, radius=4):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p in prints:
        for q in prints:
            if (p ^ q).bit_count() <= radius:
                root[max(find(p), find(q))] = min(find(p), find(q))
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("groups", [8, 12, 19])
def test_similar_prints(spark, groups):
    """Chains, balls and far prints: the links found connect what all pairs within the radius connect, and each is within it."""
    rng = random.Random(groups)
    flip = lambda p, n: p ^ sum(1 << b for b in rng.sample(range(64), n))
    prints = [0, (1 << 64) - 1, 1 << 63] + [rng.getrandbits(64) for _ in range(60)]
    for _ in range(60):
        prints.append(flip(rng.choice(prints), rng.choice([1, 2, 3, 4, 4, 5, 6])))
    hub = rng.getrandbits(64)
    prints = sorted(set(prints + [flip(hub, rng.randrange(1, 4)) for _ in range(80)]))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = simhash.similar_prints(spark.createDataFrame([(p,) for p in signed], "print long").repartition(3), groups=groups).collect()
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links]
    assert all(a != b and (a ^ b).bit_count() <= 4 for a, b in pairs) and len(set(pairs)) == len(pairs)
    roots, found = brute_roots(prints), {p: p for p in prints}
    for _ in prints:
        for a, b in pairs:
            found[a] = found[b] = min(found[a], found[b])
    assert len(pairs) < 4 * len(prints) * 30
    assert {frozenset(p for p in prints if found[p] == r) for r in set(found.values())} == {frozenset(p for p in prints if roots[p] == r) for r in set(roots.values())}


def test_an_odd_radius_is_refused(spark):
    with pytest.raises(ValueError, match="even"):
        simhash.similar_prints(spark.createDataFrame([], "print long"), radius=3)


def test_simhash(spark):
    """Null ids, null, blank and short texts, repeated rows, clashing columns, string ids, a text of 200,000 words."""
    base = " ".join(f"w{i % 97}x{i % 13}" for i in range(400))
    texts = [("a", base), ("b", base.upper()), (None, base + " end"), ("c", None), ("d", " \t\n"), ("e", "one Two"), ("e", "one Two"), ("f", "one two"), ("g", "ÄÖ é x y z q"), ("h", " ".join(f"v{i}" for i in range(200_000))), (None, "alone " * 9)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in texts], "doc_id string, text string, print int, node string")
    got = simhash.near_duplicates(df).collect()
    prints = {t: brute_print(t) for _, t in texts}
    roots = brute_roots(sorted(set(prints.values())))
    least = {}
    for d, t in texts:
        if d is not None:
            least[roots[prints[t]]] = min(least.get(roots[prints[t]], d), d)
    expected = collections.Counter((d, format(prints[t], "016x"), least.get(roots[prints[t]])) for d, t in texts)
    assert collections.Counter(tuple(r) for r in got) == expected
    assert {r.component_id for r in got if r.doc_id in ("c", "d")} == {"c"} and simhash.near_duplicates(df.limit(0)).count() == 0


def brute_phrases(rows, least, top):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        scored = []
        for p, a in candidates.items():
            longer = [n for q, n in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * n >= 80 * a for n in longer):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, totals[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(scored)[:top], start=1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(5)
    rows = []
    for k in range(120):
        words = [rng.choice(["new", "york", "city", "of", "the", "É", "ß", "rare%d" % rng.randrange(50)]) + rng.choice(["", "", "", ".", "!", ",", "\n", "\x0b"]) for _ in range(rng.randrange(0, 60))]
        if k % 3 == 0:
            words += ["New", "York", "City", "hall"] * 2
        rows.append((rng.choice(["en", "de", None, "und"]), rng.choice([" ", "\t", "  "]).join(words)))
    return rows + [("en", None), (None, ""), ("x", "a a a a a a"), ("en", "the of " * 3000)]


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_phrases(spark, shards):
    """All columns as by brute force, however many shards; a small filter that is full only costs time."""
    rows = phrase_rows() + [rows for rows in phrase_rows()[:5]]
    df = spark.createDataFrame([(lang, text, 7) for lang, text in rows], "lang string, text string, phrase int").repartition(5)
    for least, top in ((6, 2000), (4, 3)):
        got = phrases.collocations(df, least=least, top=top, shards=shards)
        assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got.collect()) == brute_phrases(rows, least, top)
    assert phrases.collocations(df.limit(0)).count() == 0


def test_a_full_filter_loses_nothing(spark):
    df = spark.createDataFrame(phrase_rows(), "lang string, text string")
    few, many = (phrases.frequent_phrases(df, 5, bits=bits)[0] for bits in (20, 27))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    two = phrases.frequent_phrases(df, 5, longest=2)[0]
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, many.where("size < 3").collect()))


def test_exact_scores(spark):
    """A product beyond 64 bits."""
    row = spark.sql("select cast(9000000000000 as bigint) as a, cast(9000000000001 as bigint) as l, cast(9000000000003 as bigint) as r").select(F.expr("(cast(2000000 as decimal(38,0)) * a) div (l + r)").alias("s")).first()
    assert row.s == 2000000 * 9000000000000 // 18000000000004


def brute_divergence(rows, least, top):
    docs = [("" if a is None else a, "" if b is None else b, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for a, b, t in rows]
    df, c, g = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        c[lang].update(terms)
        g[lang, source].update(terms)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in df[lang].items() if n >= least]
        share = lambda n, total: 1 + int(Fraction(10**9 * (n + 5), total + 5 * len(kept)))  # noqa: B023, E731
        p = {}
        for source in {d[1] for d in docs if d[0] == lang}:
            total = sum(g[lang, source][t] for t in kept)
            p[source] = {t: share(g[lang, source][t], total) for t in kept}
        q = {t: share(c[lang][t], sum(c[lang][t] for t in kept)) for t in kept}
        for source, own in p.items():
            pairs = sorted((-sum(abs(own[t] - other[t]) for t in kept), item.encode()) for item, other in p.items() if item != source)
            terms = sorted((-(own[t] - q[t]), t.encode()) for t in kept if g[lang, source][t] > 0 and own[t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, start=1)]
    return sorted(out)


def test_divergence(spark):
    """Null languages and sources, groups without kept terms, a language that keeps none, ties, repeated rows, clashing columns."""
    rng = random.Random(6)
    words = ["Alpha", "beta", "Éa", "éa", "x1y", "don't", "日本", "tie", "eit"] + [f"r{chr(97 + k)}" for k in range(20)]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None, "zz"]), " ".join(rng.choices(words, k=rng.randrange(0, 25)))) for _ in range(200)]
    rows += [("en", "empty", None), ("en", "only", "123 !"), ("fr", "s1", "solo"), ("fr", "s2", ""), ("it", "s1", "solo")] + rows[:7]
    df = spark.createDataFrame([(a, b, t, 3) for a, b, t in rows], "lang string, source string, text string, term int").repartition(4)
    for least, top in ((5, 50), (20, 3), (1, 2)):
        got = divergence.divergence(df, least, top).collect()
        assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got) == brute_divergence(rows, least, top)
    assert divergence.divergence(df.limit(0)).count() == 0


def test_skyband():
    """Exactly the rows that fewer than k others dominate."""
    rng = np.random.default_rng(7)
    for n, k in ((0, 3), (1, 1), (900, 1), (900, 5), (900, 50)):
        high, low, name = rng.integers(0, 40, n), rng.integers(0, 40, n), rng.permutation(n)
        dominated = [int(((high >= high[i]) & (low <= low[i]) & (name < name[i])).sum()) for i in range(n)]
        assert sorted(divergence.skyband(high, low, name, k).tolist()) == [i for i in range(n) if dominated[i] < k]
