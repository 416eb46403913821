"""Every operator and stage on nulls, empty and long texts, repeated rows, empty tables and clashing names; brute-force versions."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from isoforge.llm import byte_bpe, bytescan, common, license_scan, lookup, ngram_join, packing, progressive_jpeg, quality, secret_scan, toxicity, warc
from isoforge.llm.common import held_out

#: Names that the operators use inside, as columns of the input.
CLASHES = ("row", "__row", "__made", "__scan", "marked", "name", "key", "n", "stats", "score", "predicted", "body", "id", "queue", "pieces", "size", "__toxicity", "tokens")
LONG = "Long words stand here, again and again; some Änderung too. " * 22_000  # 1.3 MB and 200,000 words
TEXTS = [None, "", " \n\t", "one", "same text twice here", "same text twice here", "password = abcdefghijkl12", "éü 日本 😀", LONG]


def clashing(spark, texts, n_sources=2):
    rows = [(i if i % 4 else None, t, "en", f"s{i % n_sources}" if i % 3 else None, None if t is None else len(t), *["x"] * len(CLASHES)) for i, t in enumerate(texts, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with labels, and documents of which some are vile, loud, copies or hold secrets."""
    folder = tmp_path_factory.mktemp("tables")
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        toxic, good = rng.random() < 0.2, rng.random() < 0.7
        own = [rng.choice(words) for _ in range(rng.randrange(12, 40))] + (["vile"] * 2 if toxic else [])
        rng.shuffle(own)
        text = " ".join(own) if good else "!! ".join(w.upper() for w in own)
        if i % 40 == 7:
            text = rows[-3][1]
        if i % 50 == 9:
            text += f" token = {hashlib.md5(str(i).encode()).hexdigest()}"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(good), int(toxic)))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (None, "a row without an id stands here as well", "en", "s", 39)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def each_operator(spark, docs, tables):
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    return {
        "join": ngram_join.jaccard_components(spark, docs, counts=True),
        "toxicity": toxicity.score_toxicity(spark, docs, labels, held_out(4, 2)),
        "secrets": secret_scan.classify_secrets(spark, docs),
        "redacted": secret_scan.redact_secrets(spark, docs),
        "quality": quality.score_quality(spark, docs, labels, held_out(5, 0)),
        "codes": byte_bpe.code_digests(docs, public_tokenizers.path(byte_bpe.RANKS_FILE)),
        "media": progressive_jpeg.read_payloads(progressive_jpeg.store_texts(docs)),
        "licenses": license_scan.scan_licenses(docs),
    }


def test_operators_take_odd_rows(spark, tables):
    docs = clashing(spark, TEXTS)
    for name, out in each_operator(spark, docs, tables).items():
        rows = out.collect()
        assert len(rows) == len(TEXTS), name
        assert not name == "redacted" or set(out.columns) == set(docs.columns)
    own = {(r["doc_id"], r["n_tokens"]) for r in byte_bpe.code_digests(docs, public_tokenizers.path(byte_bpe.RANKS_FILE)).collect()}
    truth = byte_bpe.coder(public_tokenizers.path(byte_bpe.RANKS_FILE))
    assert (9, len(truth.with_offsets(LONG)[0])) in own


def test_operators_take_empty_tables(spark, tables):
    docs = clashing(spark, TEXTS).limit(0)
    for name, out in each_operator(spark, docs, tables).items():
        assert out.count() == 0, name
    pages = spark.createDataFrame([], "page_id long, url string, html string, digest string, size int")
    folder, manifest = warc.archive_pages(spark, pages)
    assert warc.read_archives(manifest, folder).count() == 0


def test_stages_take_odd_rows_and_empty_tables(spark, tables):
    docs = clashing(spark, TEXTS)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), tables).count() == 0, name
        out = stage(spark, docs, tables)
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns and 0 < len(rows) <= len(TEXTS), name
        else:
            assert sum(r["length"] for r in rows if r["start"] == 0) > 0 and {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
        if name == "n-gram Jaccard join":
            assert Counter(r["text"] for r in rows)["same text twice here"] == 1 and len(rows) == len(TEXTS) - 1
        if name == "secret scans":
            assert len(rows) == len(TEXTS) and {r["text"] for r in rows} >= {None, LONG} and "[secret]" in {r["text"] for r in rows}


def test_stages_decide_as_their_operators(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    for stage, score, held, kept in ((corpus_pipeline.drop_toxic, toxicity.score_toxicity, (4, 2), 0), (corpus_pipeline.keep_good, quality.score_quality, (5, 0), 1)):
        truth = {r["doc_id"] for r in score(spark, docs, labels, held_out(*held)).filter(f"predicted = {kept}").collect()}
        assert {r["doc_id"] for r in stage(spark, docs, tables).collect()} == truth


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))


def brute_groups(rows):
    """Rows that stay: of linked rows the first by id, nulls last; of equal rows without words one."""
    sets = []
    for r in rows:
        w = words_of(r["text"] or "")
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 90 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    best, wordless = {}, {}
    for i, r in enumerate(rows):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        if sets[i]:
            best[find(i)] = min(best.get(find(i), (key, i)), (key, i))
        else:
            wordless[tuple(r)] = i
    return sorted([i for _, i in best.values()] + list(wordless.values()))


def brute_redaction(rows):
    """Texts with the values cut that fewer than three owners and ten repositories hold."""
    found = [secret_scan.find_secrets((r["text"] or "").encode()) for r in rows]
    owners, repositories = {}, {}
    for r, own in zip(rows, found, strict=True):
        for _, _, _, value in own:
            owners.setdefault(value, set()).add(r["source"])
            repositories.setdefault(value, set()).add((r["source"], r["doc_id"]))
    out = []
    for r, own in zip(rows, found, strict=True):
        text, end, parts = r["text"] or "", 0, []
        for a, _, b, value in own:
            if len(owners[value]) < 3 and len(repositories[value]) < 10:
                if a >= end:
                    parts += [text[end:a], "[secret]"]
                end = max(end, b)
        out.append("".join(parts) + text[end:])
    return out


def test_pipeline_against_brute_force(spark, tables):
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    clean = {r["doc_id"] for r in toxicity.score_toxicity(spark, docs, labels, held_out(4, 2)).filter("predicted = 0").collect()}
    kept = docs.filter(F.coalesce("doc_id", F.lit(-1)).isin([-1 if i is None else i for i in clean]))
    kept.write.mode("overwrite").parquet(f"{tables}/clean")
    kept = spark.read.parquet(f"{tables}/clean")
    good = {r["doc_id"] for r in quality.score_quality(spark, kept, labels, held_out(5, 0)).filter("predicted = 1").collect()}
    rows = [r for r in kept.collect() if r["doc_id"] in good]
    rows = [rows[i] for i in brute_groups(rows)]
    texts = brute_redaction(rows)
    model = Tokenizer.from_file(public_tokenizers.path(byte_bpe.PACKING_FILE))
    truth = {r["doc_id"]: [*model.encode(t, add_special_tokens=False).ids, 0] for r, t in zip(rows, texts, strict=True)}
    got = corpus_pipeline.run(spark, tables).toPandas()
    assert corpus_pipeline._saved == []
    got["key"] = [None if math.isnan(x) else int(x) for x in got.doc_id]
    assert set(got["key"]) == set(truth) and len(truth) > 300
    for key, part in got.sort_values("start").groupby("key", dropna=False):
        ids = truth[None if key is None or math.isnan(key) else int(key)]
        assert part.start.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() == len(ids)
        crc = [zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) for s, n in zip(part.start, part.length, strict=True)]
        assert crc == part.ids_crc32.tolist()


def brute_ratios(texts, counted):
    """Log-likelihood ratio of each next word by modified Kneser-Ney, in dictionaries."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    every = Counter(w for t in texts for w in split(t))
    shared = lambda w: (every[w] + 1) / (sum(every.values()) + len(every) + 1)
    models = []
    for label in (1, 0):
        pairs = Counter(p for i, t in enumerate(texts) if counted.get(i) == label for p in zip(split(t), split(t)[1:], strict=False))
        before = Counter(w for _, w in pairs)

        def discounts(counts):
            n = [sum(c == k for c in counts) + 0.5 for k in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1])
            return [0.0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), i - 0.02) for i in (1, 2, 3))]

        d2, d1 = discounts(pairs.values()), discounts(before.values())
        types = max(sum(before.values()), 1)
        freed = sum(d1[min(c, 3)] for c in before.values()) / types if before else 1.0
        contexts = {}
        for (v, _), c in pairs.items():
            contexts.setdefault(v, []).append(c)

        def p(v, w, pairs=pairs, before=before, d2=d2, d1=d1, types=types, freed=freed, contexts=contexts):
            one = (before[w] - d1[min(before[w], 3)]) / types + freed * shared(w)
            if v is None or v not in contexts:
                return one
            total = sum(contexts[v])
            return (pairs[v, w] - d2[min(pairs[v, w], 3)]) / total + sum(d2[min(c, 3)] for c in contexts[v]) / total * one

        models.append(p)
    out = []
    for t in texts:
        own = split(t)
        ratios = [math.log(models[0](v, w) / models[1](v, w)) for v, w in zip([None, *own], own, strict=False)]
        out.append(sum(ratios) / max(1, len(ratios)))
    return out


def test_toxicity_ratios_against_brute_force(spark):
    rng = random.Random(4)
    words = ["red", "green", "blue", "vile", "grim", "soft", "Loud", "über", "x1", "y"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 15))) for _ in range(60)]
    counted = {i: int("vile" in t) for i, t in enumerate(texts) if i % 3}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.build_model(spark, toxicity.count_corpus(spark, docs, counted))
    got = toxicity._features([t.encode() for t in texts], model)[:, 0]
    assert np.allclose(got, brute_ratios(texts, counted), atol=1e-5)


def test_quality_score_is_the_sum_of_its_rules(spark, tables):
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    stats = docs.select("doc_id", quality.statistics_of(F.col("text")).alias("stats")).cache()
    train = stats.join(labels, "doc_id").select("stats", F.col("quality").cast("double").alias("label"))
    constant, rules = quality.fit_rules(train)
    assert rules and len(rules) < 200
    for r in stats.withColumn("p", quality.score_column(constant, rules)).collect():
        total = constant
        for weight, rule in rules:
            if all(r["stats"][i] <= b if op == "<=" else r["stats"][i] > b for i, op, b in rule):
                total += weight
        assert abs(r["p"] - 1 / (1 + math.exp(-total))) < 1e-9


def test_statistics_against_brute_force():
    texts = ["Ab cd! x|y\nAb cd! x|y\n12 $$", "", "   ", "one two three one two three one", LONG[:3000]]
    got = np.column_stack([c.to_numpy() for c in quality.statistics([t.encode() for t in texts])])
    for t, row in zip(texts, got, strict=True):
        own = dict(zip(quality.STATS, row, strict=True))
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        low = words_of(t)
        assert own["words"] == len(words)
        if words:
            triples = [tuple(low[i : i + 3]) for i in range(max(1, len(low) - 2))]
            lines = [x for x in t.split("\n") if x]
            assert math.isclose(own["distinct_words"], len(set(low)) / len(low)) and math.isclose(own["distinct_triples"], len(set(triples)) / len(triples))
            assert own["lines"] == len(lines) and math.isclose(own["mean_word"], sum(len(w.encode()) for w in words) / len(words))
            assert math.isclose(own["capital_share"], sum("A" <= w[0] <= "Z" for w in words) / len(words))


def test_secrets_against_brute_force():
    rng = random.Random(5)
    bits = ["password", "PassWord", "api_key", "apikey", "token", '"', "'", " ", "  ", ":", "=", "AKIA", "ABCDEFGH12345678", "abc123", "0123456789abcdef", "deadbeef", "é", "日", "\n", "x" * 12, "/+_.-", "secret"]
    base = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    )
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randrange(14)))
        truth = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(base) for m in p.finditer(text) if ok(m))
        assert [x[:3] for x in secret_scan.find_secrets(text.encode()) if x[1] < 3] == truth


def test_licenses_against_brute_force():
    rng = random.Random(6)
    notices = list(license_scan.NOTICES)
    bits = [*license_scan.PHRASES, "General  Public\nLicense", "cc-by", "CC BY", "all rights", "reserved", "x", "日本", "é", ", ", "; ", "\n"]
    for n in range(400):
        text = " ".join(rng.choices(bits, k=rng.randrange(8)))
        if n % 2:
            notice = list(rng.choice(notices))
            for _ in range(rng.randrange(len(notice) // 8)):
                at = rng.randrange(len(notice))
                notice[at : at + rng.randrange(2)] = rng.choice(["", "q", "zz"])
            text += " " + "".join(notice)
        row = list(zip(*license_scan._columns([text.encode()]), strict=True))[0]
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = sorted(i for p in license_scan.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        assert row[:4] == (len(words), len(places), places[0] if places else None, places[-1] if places else None)
        flat = re.sub(r"[\t-\r]", " ", low)
        found = {label for x, label in license_scan.NOTICES.items() if regex.search(f"(?:{regex.escape(x)}){{e<={license_scan.edits_allowed(x)}}}", flat)}
        base = {label for p, label in license_scan.PHRASES.items() if any(words[i : i + len(p.split())] == p.split() for i in range(len(words)))}
        assert row[5] == ",".join(sorted(base | found))


def test_offsets_cover_the_text():
    own = byte_bpe.coder(public_tokenizers.path(byte_bpe.RANKS_FILE))
    for text in ("plain words", "日本 😀 é", "", "a\n\n b"):
        ids, offsets = own.with_offsets(text)
        assert own.decode(np.array(ids, np.int64)) == text and len(ids) == len(offsets)
        assert all(a <= b for a, b in offsets) and (not text or {i for a, b in offsets for i in range(a, b)} == set(range(len(text))))


def test_deficits_follow_given_shares():
    queues = {"a": [("a", 5000)], "b": [("b", 300)] * 20, "c": [("c", 40)] * 60}
    from collections import deque

    made = list(packing.windows({k: deque(v) for k, v in queues.items()}, {"a": 0.5, "b": 0.3, "c": 0.2}, {}))
    for own in made[:6]:
        used = Counter()
        for s, _, n in own:
            used[s] += n
        assert sum(used.values()) == packing.WINDOW
        assert all(abs(used[s] / packing.WINDOW - share) < 0.07 for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)))
    sizes = [sum(n for _, _, n in own) for own in made]
    assert sum(sizes) == 5000 + 6000 + 2400 and all(n & (n - 1) == 0 for n in sizes)


def test_small_archives_have_dictionaries():
    for records in ([b"WARC/1.1\r\nx: y\r\n\r\n"], [b"a" * 100] * 3, [b"word %d here" % i for i in range(500)]):
        archive = warc.archive_of(records)
        size = int.from_bytes(archive[4:8], "little")
        assert size > 0 and list(warc.records_of(archive)) == records


def test_no_hash_is_shared_by_alike_words():
    words = [f"{a}{b}".encode() for a in ("", "a", "ab", "abcdefg", "abcdefgh", "x" * 15, "y" * 300) for b in ("", "a", "b", "ba", "ab", "\0", "\0\0")]
    words = sorted({w for w in words if w})
    part = next(bytescan.slices([b" ".join(words)]))
    starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
    assert len(set(bytescan.hashed_runs(part.data, starts, starts + [len(w) for w in words]).tolist())) == len(words)


def test_notices_of_long_texts_take_time_in_proportion():
    unit = "gnu general public lxcexse gnu generl pubic license "
    times = []
    for n in (500, 4000):
        began = time.time()
        found = license_scan.fuzzy_notices(unit * n)
        times.append(time.time() - began)
        assert sum(x[3] == "gpl" for x in found) == 2 * n
    assert times[1] < 24 * times[0] + 1


def test_toxicity_leaves_its_models_files_alone(spark, monkeypatch):
    """Counts and the like are deleted once the model is there, and bigrams are joined with nothing on the way to it."""
    docs = spark.createDataFrame([(i, f"some words {i % 7} bad{i % 2} end") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    made = []
    with common.recorded(made):
        out = toxicity.score_toxicity(spark, docs, labels, F.lit(False))
    left = {Path(x.removeprefix("file:")).name.rsplit("-", 1)[0] for x in made if Path(x.removeprefix("file:")).exists()}
    assert "model" in left and not left & {"counts", "words", "word-ratios", "contexts", "ratios"}
    assert all(r["predicted"] == r["doc_id"] % 2 for r in out.collect())


def test_workers_keep_what_one_operator_needs(tmp_path):
    """A vocabulary is dropped when tables are opened, and the other way round: stages follow each other in the same workers."""
    vocabulary = public_tokenizers.path(byte_bpe.PACKING_FILE)
    byte_bpe.coder(vocabulary)
    rows = pa.table({"key": [1, 5], "ratio": pa.array([2.0, 3.0], pa.float32())})
    names = [b["name"][0].as_py() for b in lookup._files(rows.to_batches(), str(tmp_path))]
    table = lookup.Table(str(tmp_path), tuple(names), (5,), -1.0)
    assert table.look_up(np.array([1, 2, 5])).tolist() == [2, -1, 3]
    assert byte_bpe.coder.cache_info().currsize == 0 and lookup._columns.cache_info().currsize == 1
    byte_bpe.coder(vocabulary)
    assert lookup._columns.cache_info().currsize == 0


def test_a_worker_keeps_the_ids_of_words_that_it_meets_again(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 200)
    coder, asked = byte_bpe.Coder(public_tokenizers.path(byte_bpe.PACKING_FILE)), []
    model = coder.merges

    class Asked:
        def tokenize(self, word):
            asked.append(word)
            return model.tokenize(word)

    coder.merges = Asked()
    common = " ".join(f"common{chr(97 + i)}" for i in range(20))
    for turn in range(12):
        text = f"{common} {' '.join(f'rare{chr(97 + turn)}x{chr(97 + i % 26)}{chr(97 + i // 26)}' for i in range(30))} {'long' * 40}"
        assert coder.ids([text.encode()])[0].tolist() == coder.model.encode(text, add_special_tokens=False).ids
    assert max(Counter(w for w in asked if "common" in w).values()) == 1
    assert len(coder.known) <= 200


def test_ids_where_all_words_share_a_hash(monkeypatch):
    monkeypatch.setattr(bytescan, "hashed_runs", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    coder = byte_bpe.Coder(public_tokenizers.path(byte_bpe.PACKING_FILE))
    for text in ("one two one three", "two four", "", "one", "four five"):
        assert coder.ids([text.encode()])[0].tolist() == coder.model.encode(text, add_special_tokens=False).ids


def test_rules_are_one_function_and_are_saved_before_the_lasso(spark, tables, monkeypatch):
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    train = docs.select("doc_id", quality.statistics_of(F.col("text")).alias("stats")).join(labels, "doc_id").select("stats", F.col("quality").cast("double").alias("label"))
    widest, learnt_from = [], []

    class Assembler(quality.VectorAssembler):
        def transform(self, df, *args):
            widest.append(len(self.getInputCols()))
            return super().transform(df, *args)

    class Lasso(quality.LogisticRegression):
        def fit(self, df, *args):
            learnt_from.append(df.inputFiles())
            return super().fit(df, *args)

    monkeypatch.setattr(quality, "VectorAssembler", Assembler)
    monkeypatch.setattr(quality, "LogisticRegression", Lasso)
    quality.fit_rules(train)
    assert max(widest) == len(quality.STATS)
    assert all("/rules-" in f for f in learnt_from[0])
    rules = [((0, ">", 10.0),), ((0, "<=", 20.0), (2, ">", 0.5)), ((11, ">", 1.0), (1, "<=", 4.0))]
    for r in train.select(quality.rules_met(F.col("stats"), rules).alias("met"), *(quality.rule_column(x).cast("double").alias(f"r{i}") for i, x in enumerate(rules))).collect():
        assert r["met"] == [r["r0"], r["r1"], r["r2"]]
