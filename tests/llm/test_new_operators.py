"""Code compression, URL filter and phrase mining against plain versions, with odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoforge.llm import bytescan, code_compression, count_automata, phrase_mining, url_filter
from isoforge.llm.common import beside_groups

CLASHES = ("id", "x", "codes", "part", "n", "host", "score", "phrase", "kind", "__key", "__hot")
CLASH_DDL = ", ".join(f"`{c}` string" for c in CLASHES)


def lloyd(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(e * scale) for e in v], label) for i, v, label in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // parts
    cut = [[tuple(v[p * d : p * d + d]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda e: (far(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [c[p] for c, k in zip(cut, codes, strict=True) if k[p] == e]
                    if own:
                        books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    errors = [sum(far(c[p], books[p][k[p]]) for p in range(parts)) for c, k in zip(cut, codes, strict=True)]
    labels = Counter()
    for (_, _, label), e in zip(kept, errors, strict=True):
        labels[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], bytes(k).hex(), e, labels[r[2]], digest) for r, k, e in zip(kept, codes, errors, strict=True)), key=str)


def vectors(seed, n, width):
    rng = random.Random(seed)
    rows = [(i * 7 % 1000, [rng.choice((-0.5, 0.25, rng.gauss(0, 0.2))) for _ in range(width)], rng.choice((0, 0, 1, None))) for i in range(n)]
    rows += [(3, None, 1), (None, rows[0][1], 2), (4, [None] * width, 1), (5, [math.nan] * width, 1), (6, [math.inf] * width, 0), (rows[1][0], rows[1][1], 1), (rows[1][0], rows[2][1], 1), (9, [], 0)]
    return rows


def test_codes_equal_plain_lloyd(spark, tmp_path):
    rows = vectors(5, 400, 16)
    df = spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], f"vec_id long, embedding array<double>, label int, {CLASH_DDL}")
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = code_compression.op11_code_compression(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == lloyd(rows, 16, 64, 2, 256)


def test_codes_of_few_rows_and_none(spark):
    rows = vectors(6, 3, 32)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out, books = code_compression.compress(spark, df, parts=16, entries=8, rounds=3)
    assert out.count() == 6 and books.shape == (16, 6, 2)
    none, books = code_compression.compress(spark, df.filter("false"))
    assert none.count() == 0 and books.size == 0 and set(none.columns) == set(out.columns)
    other = spark.createDataFrame([(1, [0.0] * 16, 0), (2, [0.0] * 32, 0), (3, [0.0] * 17, 0), (4, [1e30] * 16, 0)], "vec_id long, embedding array<double>, label int")
    got = {r["id"]: r["error"] for r in code_compression.compress(spark, other)[0].collect()}
    assert got == {1: 0, 4: 0}  # of the first vector's length alone


def test_active_entries_give_what_all_give():
    rng = np.random.default_rng(2)
    x, book = rng.integers(-3, 4, (500, 2)), rng.integers(-3, 4, (20, 2))
    codes, distances = code_compression.assign(x, book)
    for _ in range(4):
        new = book.copy()
        new[rng.integers(0, 20, 6)] += rng.integers(-1, 2, (6, 2))
        active = code_compression.assign(x, new, (new != book).any(1), codes, distances)
        full = code_compression.assign(x, new)
        assert np.array_equal(active[0], full[0]) and np.array_equal(active[1], full[1])
        book, (codes, distances) = new, active


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(0, 1, (8, 32))[rng.integers(0, 8, 300)]
    df = spark.createDataFrame([(i, p.tolist(), 0) for i, p in enumerate(points)], "vec_id long, embedding array<double>, label int")
    out, books = code_compression.compress(spark, df)
    for r in out.collect():
        assert np.abs(code_compression.decoded(bytes(r["codes"]), books) - points[r["id"]]).max() < 1 / 128


def test_groups_beside_rows(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id) END AS k")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    got = beside_groups(rows, groups, "k", "n").collect()
    assert len(got) == 5000 and all(r["least"] == (r["id"] if r["id"] % 3 == 2 else r["id"] % 3) for r in got)


URLS = [
    None, "", "no scheme", "http://", "http://COM/", "https://Example.COM/en/x?q=1", "https://www.example.com/en/", "https://a.www.example.com/en/1#f", "https://notexample.com/en/",
    "https://shop.net/es/1", "https://shop.net/ES/1", "https://x.net/fr/?a=1&b=2;c", "https://x.net?x=/es/", "https://x.net/es", "https://x.org/en/9", "ftp://com:80/", "http://a.com/" + "y1" * 60_000,
    "https://example.com/en/://net/es/", "https://日本.net/fr/é", "https://x.net\n/es/",
]


def plain_judgement(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_rules_of_odd_urls(spark):
    urls = URLS * 2
    df = spark.createDataFrame([(i, u, *["x"] * len(CLASHES)) for i, u in enumerate(urls)], f"page_id long, url string, {CLASH_DDL}")
    got = url_filter.judge(spark, df).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain_judgement(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] >= url_filter.THRESHOLD else "allow")) and 0 <= r["score"] <= 1
    assert len({(r["score"], r["verdict"]) for r in got if urls[r["page_id"]] == "https://x.org/en/9"}) == 1
    empty = url_filter.judge(spark, df.filter("false"))
    assert empty.count() == 0
    unlabelled = url_filter.judge(spark, df, rules=(), labels=F.lit(None).cast("int"))
    assert {r["verdict"] for r in unlabelled.collect()} == {"allow"}
    assert {r["verdict"] for r in url_filter.judge(spark, df, rules=(), labels=F.lit(1)).collect()} == {"block"}


def test_url_features(spark):
    own = [u or "" for u in URLS]
    row = spark.createDataFrame([(u,) for u in own], "url string").select("url", *(c.alias(n) for n, c in url_filter.lexical_features(F.col("url")).items())).collect()
    for r in row:
        u = r["url"]
        entropy = -sum(n / len(u) * math.log2(n / len(u)) for n in Counter(u).values()) if u else 0
        assert r["entropy"] == pytest.approx(entropy, abs=1e-6) and r["length"] == len(u)
        assert r["digit_share"] == pytest.approx(sum(c in "0123456789" for c in u) / len(u) if u else 0)
    by = {r["url"]: r for r in row}
    assert by["https://x.net/fr/?a=1&b=2;c"]["parameters"] == 3 and by["https://a.www.example.com/en/1#f"]["depth"] == 2


def test_trees_tell_held_out_urls(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        bad = rng.random() < 0.4
        host = f"{rng.choice('abcdef')}{rng.randrange(50)}.{rng.choice(['biz', 'top', 'info'] if rng.random() < 0.8 and bad else ['org', 'edu', 'info'])}"
        tail = "&".join(f"p{rng.randrange(99)}={rng.getrandbits(64):x}" for _ in range(rng.randrange(2, 6) if bad else rng.randrange(2)))
        rows.append((i, f"https://{host}/{rng.choice(['a', 'b'])}/{rng.randrange(1000)}?{tail}", int(bad)))
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = url_filter.judge(spark, df, rules=(), labels=F.when(F.col("page_id") % 4 != 0, F.col("bad"))).filter("page_id % 4 = 0").collect()
    right = sum((r["verdict"] == "block") == bool(rows[r["page_id"]][2]) for r in got)
    assert len(got) == 750 and right > 0.93 * len(got)


def plain_phrases(rows, least=10, share=50, most=2000, longest=3):
    counts, words = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words["und" if lang is None else lang] += len(w)
            for i in range(len(w)):
                for n in range(1, min(longest, len(w) - i) + 1):
                    own[tuple(w[i : i + n])] += 1
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * inside[p] >= share * a:
                continue
            score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def prose(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "aé", "日本", "x" * 300, "a\x01", "a", "\x00", "longer-than-eight", "longer-than-eighty", *(f"w{i}" for i in range(12))]
    rows = [(rng.choice(["en", "en", "en", "de", None, "und", ""]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "!?", " "]) for _ in range(rng.randrange(60)))) for _ in range(n)]
    return rows + [("en", None), ("en", ""), ("en", " \n"), (None, None), ("en", "the end of all " * 30_000), rows[0], rows[0], ("one", "...".join(["only a"] * 9))]


@pytest.mark.parametrize("sizes", [phrase_mining.Sizes(), phrase_mining.Sizes(shard=3000, every=16, windows=300, fold=64, requests=50)])
def test_phrases_equal_plain_counts(spark, sizes):
    rows = prose(8, 600)
    df = spark.createDataFrame([(i, lang, t, *["x"] * len(CLASHES)) for i, (lang, t) in enumerate(rows)], f"doc_id long, lang string, text string, {CLASH_DDL}").repartition(3)
    assert sorted(map(tuple, phrase_mining.mine_phrases(spark, df, sizes=sizes).collect())) == plain_phrases(rows)
    assert phrase_mining.mine_phrases(spark, df.filter("false"), sizes=sizes).count() == 0


def test_phrases_of_four_words_and_short_lists(spark):
    rows = prose(9, 200)
    df = spark.createDataFrame(rows, "lang string, text string")
    got = phrase_mining.mine_phrases(spark, df, longest=4, least=4, share=70, most=25, sizes=phrase_mining.Sizes(shard=5000, every=16, windows=500))
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 4, 70, 25, 4)


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(bytescan, "hashed_runs", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    words, rows = phrase_mining.windows([b"b a, b", b"abcdefghi abcdefghj"], 2)
    assert words == [b"a", b"abcdefghi", b"abcdefghj", b"b"] and rows.tolist() == [[4, 1], [1, 0], [4, 0], [2, 3], [3, 0]]


def test_automata_are_small_and_give_back_what_went_in():
    rng = np.random.default_rng(3)
    words = [f"w{i:02}".encode() for i in range(30)]
    paths, weights = count_automata.distinct_rows(rng.integers(1, 31, (5000, 3)), np.ones(5000, np.int64), 31)
    whole = count_automata.built(words, paths, weights)
    parts = count_automata.Builder(words, 3)
    for a in range(0, len(paths), 97):
        parts.add(paths[a : a + 97], weights[a : a + 97])
    for own in (whole, parts.finish(), count_automata.Automaton.decoded(whole.encoded())):
        got = own.paths()
        assert np.array_equal(got[0], paths) and np.array_equal(got[1], weights) and own.arcs == whole.arcs
    assert whole.weights(np.array([[1, 1, 31], [31, 1, 1], paths[7].tolist()])).tolist()[2] == weights[7]
    assert whole.weights(np.array([[31, 1, 1], [0, 0, 0]])).tolist() == [0, 0]
    same = count_automata.built(words, np.array([[i, 1, 2] for i in range(1, 31)]), np.full(30, 4))
    assert same.arcs == 32  # all beginnings lead to one state
    both = count_automata.union([(words, paths, weights), (words[5:6], np.array([[1, 1, 1]]), np.array([9]))])
    assert both[2].sum() == 5009
    a, b = count_automata.distinct_rows(paths[::-1], weights[::-1], 1 << 40)  # too wide to pack
    assert np.array_equal(a, paths) and np.array_equal(b, weights)
    assert count_automata.built([], np.zeros((0, 3), np.int64), np.zeros(0, np.int64)).paths()[0].shape == (0, 3)
