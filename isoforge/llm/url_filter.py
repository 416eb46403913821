"""URL filter: rules first, then gradient-boosted trees on lexical features.

A rule is a host and the start of a path; of those that fit a URL the longest decides. URLs that no
rule fits are judged by boosted trees, trained from labelled URLs: length, depth, shares of digits and
signs, entropy of the characters, counts of parameters, and statistics of suffixes. Those are the
frequency and the share of blocked URLs of a host's last name, its last two names, the end of its
file name and its first folder. They are kept in a fixed number of buckets by hash, so that the table
is of one size however many hosts there are, and rows meet it in a broadcast join.

Everything is a column expression; only the trees' fit sees a bounded sample.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.common import save, table

#: Labelled URLs that the trees are fitted to, at most; suffix statistics are of all.
FIT_ROWS = 20_000
TREES, DEPTH, STEP = 20, 4, 0.3
#: Buckets of suffixes of one kind, and URLs of the mean that smooth a bucket's share.
BUCKETS, PRIOR = 1 << 13, 4
#: Parts of the labelled URLs: a URL that is learnt from gets its suffixes' shares from the other parts.
FOLDS = 5
THRESHOLD = 0.5
#: Kinds of suffixes.
KINDS = ("last_name", "last_two", "ending", "folder")
LEXICAL = (
    "length", "host_length", "path_length", "depth", "names", "digit_share", "host_digit_share", "sign_share", "entropy",
    "parameters", "parameter_length", "longest_part", "has_fragment", "secure", "hyphens", "wide_share",
)
FEATURES = (*LEXICAL, *(f"{k}_{s}" for k in KINDS for s in ("frequency", "blocked")))


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"\A([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"\A[^/?#]*(/[^?#]*)?", 1)


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def rule_for(rules: tuple[Rule, ...], host: Column, path: Column) -> Column:
    """Index of the longest rule that fits, of equally long ones that with the longer host; null if none does.

    The rules are a list of tens or hundreds: each is a condition of one expression.
    """
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), -len(rules[i].host), i))
    return F.coalesce(F.lit(None).cast("int"), *(F.when(fits(rules[i], host, path), F.lit(i)) for i in order))


def _share(text: Column, pattern: str) -> Column:
    """Share of a text's characters that match."""
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.regexp_replace(text, pattern, ""))) / n).otherwise(0.0)


def entropy(text: Column) -> Column:
    """Bits per character: runs of equal characters, once these are sorted, are counted in one pass."""
    n = F.length(text).cast("double")
    zero = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    bits = lambda run: F.when(run > 1, run * F.log2(run)).otherwise(0.0)

    def step(s: Column, c: Column) -> Column:
        same = c == s["last"]
        return F.struct(c.alias("last"), F.when(same, s["run"] + 1).otherwise(1.0).alias("run"), F.when(same, s["sum"]).otherwise(s["sum"] + bits(s["run"])).alias("sum"))

    total = F.aggregate(F.array_sort(F.split(text, "")), zero, step, lambda s: s["sum"] + bits(s["run"]))
    return F.when(n > 0, F.greatest(F.log2(n) - total / n, F.lit(0.0))).otherwise(0.0)


def lexical_features(url: Column) -> dict[str, Column]:
    """The columns LEXICAL; a null URL has those of an empty one."""
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = F.split(path, "/")
    return {
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "depth": F.size(F.filter(parts, lambda p: p != "")),
        "names": F.when(host == "", 0).otherwise(F.size(F.split(host, r"\."))), "digit_share": _share(url, "[0-9]"), "host_digit_share": _share(host, "[0-9]"),
        "sign_share": _share(url, "[^A-Za-z0-9]"), "entropy": entropy(url), "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))),
        "parameter_length": F.length(query), "longest_part": F.array_max(F.transform(parts, F.length)), "has_fragment": url.contains("#").cast("int"),
        "secure": url.startswith("https:").cast("int"), "hyphens": F.length(host) - F.length(F.replace(host, F.lit("-"), F.lit(""))), "wide_share": _share(url, r"[\x00-\x7F]") * -1 + 1,
    }


def suffixes(url: Column) -> dict[str, Column]:
    """The columns KINDS."""
    names, path = F.split(host_of(url), r"\."), path_of(url)
    return {
        "last_name": F.element_at(names, -1), "last_two": F.array_join(F.slice(F.concat(F.array(F.lit("")), names), -2, 2), "."),
        "ending": lower_ascii(F.regexp_extract(path, r"(\.[^./]*|/)\z", 1)), "folder": F.regexp_extract(path, r"\A/([^/]*)/", 1),
    }


def _bucket(suffix: Column) -> Column:
    return F.pmod(F.xxhash64(suffix), F.lit(BUCKETS))



def suffix_table(urls: DataFrame) -> DataFrame:
    """kind, bucket, n, seen, blocked, and lists of the last two by fold: at most BUCKETS rows for each kind. ``urls`` has url and blocked (null: no label)."""
    fold = F.pmod(F.xxhash64("url", F.lit(1)), F.lit(FOLDS))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), _bucket(s).alias("bucket")) for k, s in suffixes(F.col("url")).items())))
    rows = urls.select("blocked", fold.alias("fold"), each.alias("at")).select("blocked", "fold", "at.*")
    by_fold = [F.count(F.when(F.col("fold") == i, F.col("blocked"))) for i in range(FOLDS)], [F.coalesce(F.sum(F.when(F.col("fold") == i, F.col("blocked"))), F.lit(0)) for i in range(FOLDS)]
    sums = [F.count("*").alias("n"), F.count("blocked").alias("seen"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked")]
    return rows.groupBy("kind", "bucket").agg(*sums, F.array(*by_fold[0]).alias("fold_seen"), F.array(*by_fold[1]).alias("fold_blocked"))


@dataclass
class UrlModel:
    """Fitted trees with the suffix table that their features need."""

    suffixes: DataFrame
    mean: float
    total: int
    trees: Transformer | None

    def features(self, rows: DataFrame, url: str, out: str, fold: Column | None = None) -> DataFrame:
        """``rows`` with a vector ``out``; with a ``fold``, shares come from the other folds."""
        u = F.coalesce(F.col(url), F.lit(""))
        own, columns = rows, {f"__{n}": c.cast("double") for n, c in lexical_features(u).items()}
        own = own.withColumns(columns | {f"__{k}": _bucket(s) for k, s in suffixes(u).items()})
        for k in KINDS:
            seen, blocked = F.col("seen"), F.col("blocked")
            t = self.suffixes.filter(F.col("kind") == k)
            values = [F.log1p(F.col("n") * 1e6 / max(self.total, 1)).alias(f"__{k}_frequency"), seen.alias("__seen"), blocked.alias("__blocked"), F.col("fold_seen").alias("__fs"), F.col("fold_blocked").alias("__fb")]
            own = own.join(F.broadcast(t.select(F.col("bucket").alias(f"__{k}"), *values)), f"__{k}", "left")
            s, b = F.coalesce("__seen", F.lit(0)), F.coalesce("__blocked", F.lit(0))
            if fold is not None:
                s, b = s - F.coalesce(F.get("__fs", fold), F.lit(0)), b - F.coalesce(F.get("__fb", fold), F.lit(0))
            share = (b + PRIOR * self.mean) / (s + PRIOR)
            own = own.withColumns({f"__{k}_blocked": share, f"__{k}_frequency": F.coalesce(f"__{k}_frequency", F.lit(0.0))}).drop("__seen", "__blocked", "__fs", "__fb")
        names = [f"__{n}" for n in FEATURES]
        made = VectorAssembler(inputCols=names, outputCol=out).transform(own)
        return made.drop(*names, *(f"__{k}" for k in KINDS))

    def scored(self, rows: DataFrame, url: str, out: str) -> DataFrame:
        """``rows`` with a score from 0 to 1 in ``out``, higher where the URL is likelier to be blocked; without trees the mean of all labels."""
        if self.trees is None:
            return rows.withColumn(out, F.lit(self.mean))
        made = self.trees.transform(self.features(rows, url, "__features")).withColumn(out, vector_to_array("__probability")[1])
        return made.drop("__features", "__raw", "__probability", "__prediction")


def fit(spark: SparkSession, urls: DataFrame) -> UrlModel:
    """``urls`` has url and blocked (1 or 0; null: no label). Suffix statistics are of all rows, trees of at most FIT_ROWS different labelled URLs."""
    found = save(spark, suffix_table(urls), "suffixes")
    total, seen, blocked = found.filter(F.col("kind") == KINDS[0]).agg(F.sum("n"), F.sum("seen"), F.sum("blocked")).first()
    model = UrlModel(found, (blocked or 0) / seen if seen else 0.0, total or 0, None)
    each = urls.filter("blocked IS NOT NULL").groupBy("url").agg(F.max("blocked").cast("double").alias("label"))
    sample = each.orderBy(F.xxhash64("url"), "url").limit(FIT_ROWS)
    if seen and 0 < blocked < seen:
        fold = F.pmod(F.xxhash64("url", F.lit(1)), F.lit(FOLDS))
        rows = save(spark, model.features(sample.withColumn("__fold", fold), "url", "features", F.col("__fold")).select("label", "features"), "url-features")
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=0, maxMemoryInMB=64, predictionCol="__prediction")
        trees = trees.setProbabilityCol("__probability").setRawPredictionCol("__raw")
        if rows.select("label").distinct().count() == 2:
            model.trees = trees.fit(rows.coalesce(4)).setFeaturesCol("__features")
    return model


def judge(spark: SparkSession, urls: DataFrame, key: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES, labels: Column | None = None) -> DataFrame:
    """key, host, path, rule, verdict, score of every row.

    A rule's verdict holds; other URLs are blocked where the score is THRESHOLD or more. ``labels`` is a
    column of ``urls`` with 1 for blocked, 0 for allowed and null for unlabelled; without it the verdicts
    of the rules are the labels. Null URLs, and those without ``://``, have an empty host and path and fit no
    rule; they are scored as they are. Repeated rows are judged alike and null keys kept. Without labels of both
    kinds the score is the mean of the labels, 0 if there are none. An empty table gives no rows; very long
    URLs are read whole, and other columns may have any name.
    """
    own = urls.select(F.col(key).alias("key"), F.col(url).alias("url"), (F.lit(None) if labels is None else labels).cast("int").alias("given"))
    made = own.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumn("index", rule_for(rules, F.col("host"), F.col("path")))
    texts, verdicts = F.array(*(F.lit(r.text) for r in rules)), F.array(*(F.lit(r.verdict) for r in rules))
    made = made.withColumns({"rule": F.get(texts, F.col("index")), "ruled": F.get(verdicts, F.col("index"))})
    known = F.col("given") if labels is not None else (F.col("ruled") == "block").cast("int")
    model = fit(spark, made.select(F.coalesce("url", F.lit("")).alias("url"), known.alias("blocked")))
    scored = model.scored(made, "url", "score")
    verdict = F.coalesce("ruled", F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow"))
    return scored.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "score")


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, table(spark, sf_dir, "pages"))
