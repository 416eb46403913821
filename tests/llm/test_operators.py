"""Operators against brute force, round trips and held-out labels, with nulls, empty and odd rows."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import corpus_pipeline
from isoforge.llm import components as component_module
from isoforge.llm import byte_bpe, bytescan, license_scan, ngram_join, one_bit_neighbours, packing, progressive_jpeg, secret_scan, toxicity, warc
from isoforge.llm.common import held_out
from isoforge.llm.quality import score_quality
from isoforge.llm.toxicity import build_model, score_toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, None if i % 3 else "en", f"s{i % 4}" if i % 5 else None, None, 1.0, "x") for i, t in enumerate(texts)], DOCS)


ODD = [None, "", " ", "one", "two words", "ÄÖ  ß\n\nx", "a" * 5000, "same text here again", "same text here again", "日本 😀 x y"]


def near_copies(seed=3):
    rng = random.Random(seed)
    out = []
    for n in (3, 12, 40, 90, 300):
        base = [f"w{rng.randrange(5000)}" for _ in range(n)]
        for _ in range(12):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = f"v{rng.randrange(9)}"
            out.append(" ".join(own) if rng.random() < 0.8 else " ".join(own).upper())
    return out


def brute_components(texts):
    sets = []
    for t in texts:
        words = [w for w in (t or "").translate({c: c + 32 for c in range(65, 91)}).replace("\n", " ").replace("\t", " ").split(" ") if w]
        sets.append({tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} - {()})
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 90 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i), links[i]) for i in range(len(texts))}


@pytest.mark.parametrize("classes,long,rows", [(ngram_join.CLASSES, ngram_join.LONG, ngram_join.UNIT_ROWS), (((2, 0, 2), (4, 0, 3)), 40, 4)])
def test_jaccard_components(spark, monkeypatch, classes, long, rows):
    monkeypatch.setattr(ngram_join, "CLASSES", classes)
    monkeypatch.setattr(ngram_join, "LONG", long)
    monkeypatch.setattr(ngram_join, "UNIT_ROWS", rows)
    monkeypatch.setattr(ngram_join, "UNIT_SETS", rows)
    texts = ODD + near_copies()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.jaccard_components(spark, documents(spark, texts), counts=True).collect()}
    assert got == brute_components(texts)
    assert ngram_join.jaccard_components(spark, documents(spark, texts).limit(0), counts=True).count() == 0


@pytest.mark.parametrize("part", [1 << 20, 7])
def test_components_of_chains_and_stars(spark, monkeypatch, part):
    monkeypatch.setattr(component_module, "PART_EDGES", part)
    rng = random.Random(8)
    chain, star = list(range(100, 130)), [(500, 500 + i) for i in range(1, 20)]
    rng.shuffle(chain)
    edges = [*zip(chain, chain[1:], strict=False), *star, (900, 901), (901, 900), (7, 7)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in component_module.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(chain, 100), **dict.fromkeys(range(500, 520), 500), 900: 900, 901: 900}


def test_words_that_differ_in_order_alone(spark):
    """Words whose letters a hash by powers would add up to the same."""
    word, other = "ab", "ba"
    for _ in range(10):
        word, other = word + other, other + word
    texts = [f"{word} {word} {word} x", f"{other} {other} {other} x", f"{word} {word} {word} x"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.jaccard_components(spark, documents(spark, texts), counts=True).collect()}
    assert got == brute_components(texts)
    own = byte_bpe.coder(public_tokenizers.path(byte_bpe.RANKS_FILE))
    for n in (1024, 2048):
        pair = [word[:n].encode(), other[:n].encode()]
        assert [own.decode_bytes(x) for x in own.ids([b" ".join(pair), *pair])] == [b" ".join(pair), *pair]


def test_one_of_each_group_keeps_by_row(spark):
    copies = ["one two three four five", "six seven eight nine ten", "a b c d e f"]
    rows = [(None, copies[0]), (None, copies[1]), (None, copies[1]), (5, "p q r s"), (5, "t u v w"), (7, copies[2]), (3, copies[2]), (None, copies[2]), (8, ""), (8, ""), (9, None), (None, None), (None, "")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()]
    truth = [(None, copies[0]), (None, copies[1]), (5, "p q r s"), (5, "t u v w"), (3, copies[2]), (8, ""), (9, None), (None, None), (None, "")]
    assert sorted(got, key=repr) == sorted(truth, key=repr)


@pytest.mark.parametrize("k,long", [(2, 1000), (3, 1000), (5, 1000), (3, 20), (3, 100), (3, 490)])
def test_keys_of_similar_sets_meet(monkeypatch, k, long):
    monkeypatch.setattr(ngram_join, "LONG", long)
    monkeypatch.setattr(ngram_join, "CLASSES", ((0, 0, k),))
    rng = np.random.default_rng(5)
    classes = (rng.random(1 << ngram_join.SKETCH_BITS) < 0.9).astype(np.uint8)
    for n in [*range(9, 30), 100, 500]:
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            drop = rng.integers(0, n // 10 + 1)
            y = np.unique(np.concatenate((rng.permutation(x)[drop:], rng.integers(0, 1 << 63, rng.integers(0, n // 10 + 1)).astype(np.uint64))))
            common = len(np.intersect1d(x, y))
            if not np.array_equal(x, y) and 10 * common >= 9 * (len(x) + len(y) - common) and k * n // 9 < 0.7 * n:
                (a, early_a), (b, early_b) = ngram_join.keys_of(x, classes, (9, 10)), ngram_join.keys_of(y, classes, (9, 10))
                assert np.intersect1d(a, b).size and (np.intersect1d(a[early_a], b).size or np.intersect1d(a, b[early_b]).size)


def test_wide_signatures_bound_what_is_not_common():
    rng = np.random.default_rng(7)
    for n, m in ((600, 600), (1000, 1100), (4000, 4200), (4200, 9000)):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate((x[: n - n // 20], rng.integers(0, 1 << 63, m - n + n // 20).astype(np.uint64))))
        differ = ngram_join.wide_difference(ngram_join.wide_signature(x), ngram_join.wide_signature(y))
        assert n // 20 < differ <= len(np.setxor1d(x, y))
        other = np.unique(rng.integers(0, 1 << 63, m).astype(np.uint64))
        assert 19 * ngram_join.wide_difference(ngram_join.wide_signature(x), ngram_join.wide_signature(other)) > len(x) + len(other)
    assert ngram_join.wide_signature(x[:512]) == b"" and ngram_join.wide_difference(b"", ngram_join.wide_signature(x)) == 0


def labelled(spark, n=1500):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic, good = rng.random() < 0.2, rng.random() < 0.7
        own = [rng.choice(words) for _ in range(rng.randrange(10, 60))] + (["vile"] * 2 if toxic else [])
        rng.shuffle(own)
        rows.append((i, (" ".join(own)) if good else "!! ".join(w.upper() for w in own), f"s{i % 3}"))
        labels.append((i, int(good), int(toxic)))
    rows += [(n, None, None), (n + 1, "", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


@pytest.mark.parametrize("score,column,held", [(score_toxicity, 2, (4, 2)), (score_quality, 1, (5, 0))])
def test_scores_on_held_out_rows(spark, score, column, held):
    docs, labels, rows = labelled(spark)
    got = {r["doc_id"]: r for r in score(spark, docs, labels, held_out(*held)).collect()}
    assert len(got) == len(rows) + 2 and all(0 <= r["score"] <= 1 for r in got.values())
    test = [r for r in rows if zlib.crc32(str(r[0]).encode()) % held[0] == held[1]]
    assert sum(got[r[0]]["predicted"] == r[column] for r in test) >= 0.95 * len(test)
    none = labels.filter("doc_id < 0")
    assert score(spark, docs, none, held_out(*held)).count() == len(got)


@pytest.mark.parametrize("score,column,most", [(score_toxicity, "toxic", 18_000), (score_quality, "quality", 20_000)])
def test_scores_learn_from_all_labelled_rows(spark, score, column, most):
    """Rows beyond the first 18,000 or 20,000 by hash are all negative and alone in what they say."""
    rank = F.row_number().over(W.orderBy(F.xxhash64("id"), "id"))
    rows = spark.range(most + 3000).select(F.col("id").alias("doc_id"), (rank > most).alias("beyond"), (F.col("id") % 2).cast("int").alias("half"))
    said = F.when(F.col("beyond"), "###### ###### zyx zyx").when(F.col("half") == 1, "one two three").otherwise("four five. Six seven eight")
    docs = rows.select("doc_id", said.alias("text")).cache()
    labels = rows.select("doc_id", F.when(F.col("beyond"), 0).otherwise(F.col("half")).alias(column))
    got = score(spark, docs, labels, F.lit(False)).join(docs, "doc_id").groupBy("text").agg(F.max("score").alias("most"), F.min("score").alias("least")).collect()
    got = {r["text"].split()[0]: (r["most"], r["least"]) for r in got}
    assert got["######"][0] < 0.1 and got["four"][0] < 0.1 and got["one"][1] > 0.9


def test_toxicity_model_keeps_rare_bigrams(spark):
    n = 600_000
    pairs = spark.range(n).selectExpr("1 AS kind", "id % 1000 AS v", "id DIV 1000 AS w", "id % 2 AS t", "1 - id % 2 AS o", "1L AS n")
    words = spark.range(1000).selectExpr("0 AS kind", "0L AS v", "id AS w", "0L AS t", "0L AS o", "600L AS n")
    made = build_model(spark, pairs.unionByName(words))["bigram"]
    known, ratios = (np.concatenate(x) for x in zip(*(toxicity._mapped(made.folder, n) for n in made.names), strict=True))
    known = known.view(np.uint64)
    assert len(known) == n and np.isfinite(ratios).all() and (ratios != 0).all()


def test_secrets(spark):
    key = "AKIA" + "A1" * 8
    texts = [*ODD, f'Password: "abcdefghijkl" and {key}', *[f"api_key = {'ab12' * 5}"] * 12, "é token=short", None]
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in secret_scan.classify_secrets(spark, docs).collect()}
    assert len(got) == len(texts)
    row = got[len(ODD)]
    assert row["spans"] == f"assign:0:23,access:29:{29 + len(key)}" and row["base_sha256"] == hashlib.sha256(row["spans"].encode()).hexdigest()
    assert not any(m["example"] for m in row["marked"]) and all(m["example"] for m in got[len(ODD) + 1]["marked"])
    assert got[0]["spans"] == "" and got[len(texts) - 2]["n_assign"] == 0
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact_secrets(spark, docs).collect()}
    assert clean[len(ODD)] == '[secret]" and [secret]' and clean[len(ODD) + 1] == texts[len(ODD) + 1] and clean[0] is None
    assert secret_scan.classify_secrets(spark, docs.limit(0)).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(2)
    big = ["".join(rng.choices("abcdé <p>", k=1500)) for _ in range(6)]
    pages = [(i, f"http://x/{i}" if i % 4 else None, rng.choice([*big, "small", None, ""])) for i in range(120)] + [(None, None, big[0])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder, manifest = warc.archive_pages(spark, df, str(tmp_path / "w"))
    got = warc.read_archives(manifest, folder).collect()
    assert len(got) == len(pages)
    last = {}
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", -1))
    for r in got:
        if r["page_id"] is not None:
            html = pages[r["page_id"]][2] or ""
            raw = html.encode()
            revisit = len(raw) >= 1000 and last[html] != r["page_id"]
            assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
            assert (r["record_type"], r["refers_to"]) == (("revisit", last[html]) if revisit else ("response", None))


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(one_bit_neighbours, "ITEM_BLOCK", 64)
    monkeypatch.setattr(one_bit_neighbours, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(4)
    vectors = [rng.standard_normal(16).astype(float).tolist() for _ in range(300)]
    vectors[5:25] = [vectors[5]] * 20
    rows = [(i, v) for i, v in enumerate(vectors)] + [(300, None), (400, [0.0] * 16), (500, [float("nan")] * 16), (600, [1.0]), (None, vectors[0]), (7, vectors[7])]
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "vec_id long, embedding array<double>, score double, rank string")
    got = {}
    for r in one_bit_neighbours.nearest(spark, df, F.col("vec_id") % 10 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    x, hits = np.array(vectors), 0
    assert set(got) == set(range(0, 300, 10))
    for q, own in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(300), d)) if i != q][:10]
        hits += len({own[i + 1][0] for i in range(10)} & set(order))
        assert all(abs(own[i + 1][1] - d[own[i + 1][0]]) < 1e-12 for i in range(10))
    assert hits >= 0.95 * 300
    assert one_bit_neighbours.nearest(spark, df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_neighbours_of_repeated_query_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [5.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 3.0]), (3, [5.0, 1.0]), (4, [2.0, 2.0, 2.0])]
    got = one_bit_neighbours.nearest(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 2).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [(0, 1, 1, 1.0), (0, 1, 3, 1.0), (0, 2, 2, 3.0), (0, 2, 0, 4.0)][:2] + sorted([(0, 2, 2, 3.0), (0, 2, 0, 4.0)])


def test_packing(spark):
    texts = ODD + near_copies() + ["x <|endoftext|> y"]
    path = public_tokenizers.path(byte_bpe.PACKING_FILE)
    got = packing.pack(spark, documents(spark, texts), path).toPandas()
    ids = byte_bpe.Coder(path).ids([(t or "").encode() for t in texts])
    for doc, part in got.sort_values("start").groupby("doc_id"):
        own = np.append(ids[doc], 0).astype("<u4").tobytes()
        assert part.length.sum() == len(own) // 4 == part.doc_tokens.iloc[0]
        assert all(c == zlib.crc32(own[4 * s : 4 * (s + n)]) for s, n, c in zip(part.start, part.length, part.ids_crc32, strict=True))
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]]
        total = part.length.sum()
        assert total <= 1024 and total & (total - 1) == 0
    assert packing.pack(spark, documents(spark, texts).limit(0), path).count() == 0


def test_each_window_has_the_target_mixture(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 1 << 14)
    rng = random.Random(6)
    sizes = [("long", 1000)] * 32 + [("short", 100)] * 320
    rows = [(i, " ".join(rng.choice(("red", "blue", "green")) for _ in range(n)), s) for i, (s, n) in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(spark, docs, public_tokenizers.path(byte_bpe.PACKING_FILE), {"long": 1, "short": 1}).toPandas()
    got["source"] = got.doc_id.map({r[0]: r[2] for r in rows})
    used = got.pivot_table(index="sequence_id", columns="source", values="length", aggfunc="sum", fill_value=0)
    full = used[used.sum(axis=1) == packing.WINDOW]
    early = full[(full.index & (2**32 - 1)) < 10]
    assert len(full) > 40 and len(early) > 20 and (early.short / packing.WINDOW).between(0.4, 0.6).all()


def test_bpe_equals_tiktoken(spark):
    import tiktoken

    path = public_tokenizers.path(byte_bpe.RANKS_FILE)
    own = byte_bpe.coder(path)
    truth = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    rng = random.Random(7)
    bits = [" ", "  ", "\n", "a", "é", "ß", "'ll", "12", "²", "..", " ", "日本", "😀", "\x85", "\t", "the"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(800)]
    got = own.ids([t.encode() for t in texts])
    assert [x.tolist() for x in got] == [truth.encode_ordinary(t) for t in texts]
    assert [own.decode(x) for x in got] == texts
    coded = byte_bpe.encode_texts(documents(spark, ODD), path)
    assert {r["doc_id"]: r["text"] for r in byte_bpe.decode_ids(coded, path).collect()} == {i: t or "" for i, t in enumerate(ODD)}


def test_jpeg_scans(spark, monkeypatch):
    rng = random.Random(9)
    for n in (0, 1, 191, 193, 3000):
        payload = bytes(rng.randrange(245) for _ in range(n)).ljust(max(192, -(-n // 192) * 192), b" ")
        media = progressive_jpeg.store(payload)
        fast = progressive_jpeg.decode(media)
        assert progressive_jpeg.load(fast) == payload and fast.rgb().shape == (fast.height, fast.width, 3)
        with monkeypatch.context() as m:
            m.setattr(progressive_jpeg.Picture, "_wide_scan", lambda *a: False)
            slow = progressive_jpeg.decode(media)
        assert all(np.array_equal(a, b) for a, b in zip(fast.coefficients, slow.coefficients, strict=True))
    stored = progressive_jpeg.store_texts(documents(spark, ODD)).cache()
    got = progressive_jpeg.read_payloads(stored).collect()
    assert {r["doc_id"]: r["payload_sha256"] for r in got} == {i: hashlib.sha256(progressive_jpeg.padded((t or "").encode())).hexdigest() for i, t in enumerate(ODD)}
    shapes = {r["doc_id"]: (r["shape"], len(r["tensor"])) for r in progressive_jpeg.decode_media(stored).collect()}
    assert shapes[0] == ([16, 16, 3], 768) and all(n == s[0] * s[1] * s[2] for s, n in shapes.values())


def test_licenses(spark):
    texts = [*ODD, "x CC-BY y, All  rights\nreserved.", "Licensed undr the Apache Licence, now", "all rights reservedx", "éall rights reserved"]
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(documents(spark, texts)).collect()}
    n = len(ODD)
    assert (got[n]["n_words"], got[n]["n_base"], got[n]["first_word"], got[n]["last_word"], got[n]["base_labels"]) == (7, 2, 1, 4, "cc-by,reserved")
    assert got[n + 1]["labels"] == "apache" and got[n + 1]["notices"][0]["edits"] == 2 and 0 < got[n + 1]["score"] < 1
    assert got[n + 2]["n_base"] == got[n + 3]["n_base"] == 0 and got[0]["n_words"] == 0


def test_adjacent_notices_are_all_found():
    spans = [x[:3] for x in license_scan.fuzzy_notices("x all rights reservd. all rights reserved. y")]
    assert len(spans) == 2 and spans[0][1] <= spans[1][0] and spans[0][2] == 1 and spans[1] == (22, 41, 0)
    assert len([x for x in license_scan.fuzzy_notices("gnu genral public license gnu general public license") if x[3] == "gpl"]) == 2


def test_hashes_follow_words():
    texts = [b"Ab  cd", b"", b"ab cd", b"x"]
    own = {i: s.tolist() for i, s in bytescan.shingle_sets(texts, 3)}
    assert own[0] == own[2] and own[1] == [] and own[3] != own[0]


def test_links_are_counted_once_however_full_the_filter_is(spark, monkeypatch):
    """A full filter lets all rows through; of equal texts in other batches one alone may stand for the set."""
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base)] * 20 + [" ".join([*base, "more"])] * 20
    docs = documents(spark, texts).repartition(8)
    monkeypatch.setattr(ngram_join, "filter_of", lambda spark, marks, count: spark.sparkContext.broadcast(b"\xff" * (1 << 17)))
    got = ngram_join.jaccard_components(spark, docs, counts=True).collect()
    assert [(r["component_id"], r["n_links"]) for r in got] == [(0, 39)] * 40


def test_pages_of_one_pattern_are_not_paired(spark, monkeypatch):
    """Near misses of one template share very many keys; none is early, so that their rows aren't copied."""
    rng = random.Random(1)
    frame = [f"t{i}" for i in range(185)]
    dealt = {}
    real = ngram_join._mixed_rows

    def counted(rows):
        out = real(rows)
        dealt[len(dealt)] = rows.count(), out.count()
        return out

    monkeypatch.setattr(ngram_join, "_mixed_rows", counted)
    monkeypatch.setattr(ngram_join, "UNIT_ROWS", 64)
    for n in (200, 400):
        texts = [" ".join(frame[:90] + [f"o{rng.getrandbits(40)}" for _ in range(13)] + frame[90:]) for _ in range(n)]
        got = ngram_join.jaccard_components(spark, documents(spark, [*texts, texts[0] + " end"]).repartition(4), counts=True)
        assert sum(r["n_links"] for r in got.collect()) == 2
    assert all(out <= rows / 4 for rows, out in dealt.values()), dealt
