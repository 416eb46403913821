"""Secret scans: patterns in every text, then corpus-wide ownership frequency.

Candidate values are hashed where they are found. The hashes are aggregated over the whole
corpus by distinct repositories and owners: a value that many owners hold is a copied
example (documentation, tests), one that a single owner holds looks live.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.common import beside_groups, fresh, per_text, save, table, text_udf

#: Fixed patterns and least lengths. assign: of group 2; letters in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX_LEAST = 16
HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")  # a shorter maximal run would be dropped anyway
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

#: Further kinds, after the base ones: a prefix that must stand in the text, and the pattern.
MORE = {
    "github": (b"gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{20,}")),
    "slack": (b"xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    "stripe": (b"_live_", re.compile(r"[sr]k_live_[A-Za-z0-9]{16,}")),
    "jwt": (b"eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "pem": (b"-----BEGIN", re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----")),
}
BASE = ("assign", "access", "hex")
KINDS = (*BASE, *MORE)
#: A value that this many owners hold, or this many repositories, is an example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 10

SCHEMA = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "found array<struct<kind:string,start:int,end:int,value_hash:string>>"
)


def find_secrets(raw: bytes) -> list[tuple[int, int, str, str]]:
    """Start, rank of kind, end (code points) and value of each match, in order."""
    text = raw.decode("utf-8", "replace")
    out = []
    lowered = raw.lower()
    if (b":" in raw or b"=" in raw) and any(k in lowered for k in _KEYWORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    for rank, (prefix, pattern) in enumerate(MORE.values(), len(BASE)):
        if prefix in raw:
            out += [(m.start(), rank, m.end(), m[0]) for m in pattern.finditer(text)]
    return sorted(out)


def _columns(texts: list[bytes]) -> list[list]:
    rows = []
    for raw in texts:
        found = find_secrets(raw)
        spans = [f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in found]
        base = ",".join(s for s, x in zip(spans, found, strict=True) if x[1] < len(BASE))
        counts = [sum(x[1] == k for x in found) for k in range(len(BASE))]
        hashes = [{"kind": KINDS[k], "start": a, "end": b, "value_hash": hashlib.sha256(v.encode()).hexdigest()} for a, k, b, v in found]
        rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(spans), hashes))
    return list(zip(*rows, strict=True))


def scan_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """Matches of each text, in one pass without a shuffle.

    Null and empty texts have none: counts 0, empty ``spans``, ``base_sha256`` of the empty text.
    Repeated rows give repeated results. Only ``keep`` goes along.
    """
    return per_text(docs, keep, text, SCHEMA, _columns)


def ownership(found: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Distinct repositories and owners of each value hash, over the whole corpus.

    Distinct triples first, then one row for each hash and owner, then for each hash, each
    with partial aggregation, so that a hash which a third of all rows hold does no harm.
    Null repositories or owners count as one of their own.
    """
    each = found.select(F.explode("found.value_hash").alias("value_hash"), F.struct(F.col(repository)).alias("r"), F.struct(F.col(owner)).alias("o"))
    triples = each.groupBy("value_hash", "o", "r").agg(F.count("*").alias("places"))
    owners = triples.groupBy("value_hash", "o").agg(F.count("*").alias("repositories"), F.sum("places").alias("places"))
    return (
        owners.groupBy("value_hash")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("places").alias("places"))
        .withColumn("example", (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES))
    )


def marked_secrets(spark: SparkSession, docs: DataFrame, text: str = "text", repository: str = "doc_id", owner: str = "source") -> tuple[DataFrame, str, str]:
    """``docs``, all columns, with two more, whose names come along: the scan's struct, and ``marked``.

    Each element of ``marked`` has ``example``: true if the value is widely copied, false if
    it is owner-specific and looks live. Only row numbers and hashes are shuffled to be marked; values with
    a thousandth of all places or more are broadcast, so that their places stay where they are. Rows are
    written to the shared folder first, so that their numbers stay the same.
    """
    scan, row, marked = fresh(docs, "__scan"), fresh(docs, "__row"), fresh(docs, "__marked")
    scanned = docs.withColumn(scan, text_udf(SCHEMA, _columns)(F.col(text))).withColumn(row, F.monotonically_increasing_id())
    scanned = save(spark, scanned, "secrets")
    some = scanned.filter(F.size(F.col(scan)["found"]) > 0)
    found = some.select(F.col(row).alias("row"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.col(scan)["found"].alias("found"))
    owned = save(spark, ownership(found, "repository", "owner").select("value_hash", "example", "places"), "ownership")
    each = beside_groups(found.select("row", F.explode("found").alias("f")).select("row", "f.*"), owned, "value_hash", "places")
    mark = F.struct("start", "kind", "end", "value_hash", "example")
    marks = each.groupBy("row").agg(F.array_sort(F.collect_list(mark)).alias(marked)).withColumnRenamed("row", row)
    none = scanned.filter(F.size(F.col(scan)["found"]) == 0).withColumn(marked, F.array().cast(marks.schema[marked].dataType))
    return some.join(marks, row).unionByName(none).drop(row), scan, marked


def classify_secrets(spark: SparkSession, docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source"), repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """``scan_secrets`` with ``marked`` in place of ``found``: one row per document.

    Null and empty texts have no matches and an empty ``marked``; repeated rows, null repositories
    and owners as in ``ownership``; an empty table gives no rows.
    """
    own = docs.select(*keep, F.col(text).alias("__body"), F.col(repository).alias("__repository"), F.col(owner).alias("__owner"))
    out, scan, marked = marked_secrets(spark, own, "__body", "__repository", "__owner")
    return out.select(*keep, *(F.col(scan)[c].alias(c) for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")), F.col(marked).alias("marked"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify_secrets(spark, table(spark, sf_dir, "documents"))
    examples = F.size(F.filter("marked", lambda m: m["example"])).cast("long")
    return out.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans",
        examples.alias("n_example"), (F.size("marked").cast("long") - examples).alias("n_live"),
    )


def redact_secrets(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, all columns, with live-looking secrets replaced by ``[secret]``.

    Examples stay. Spans that overlap are cut together. ``n_chars``, if there, follows the text
    where it was cut. Null stays null, texts without live secrets stay as they are, repeated rows
    stay, and an empty table gives no rows. Extra columns may have any name.
    """
    out, _, marked = marked_secrets(spark, docs, text)
    body = F.col(text)
    live = F.filter(marked, lambda m: ~m["example"])

    def cut(state, m):
        begin = F.greatest(m["start"], state["end"])
        return F.struct(
            F.concat(state["out"], body.substr(state["end"] + 1, begin - state["end"]), F.when(m["start"] >= state["end"], "[secret]").otherwise("")).alias("out"),
            F.greatest(m["end"], state["end"]).alias("end"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("end"))
    cleaned = F.aggregate(live, start, cut, lambda s: F.concat(s["out"], body.substr(s["end"] + 1, F.length(body))))
    clean = {text: F.when(F.size(live) > 0, cleaned).otherwise(body).alias(text)}
    if "n_chars" in docs.columns:
        clean["n_chars"] = F.when(F.size(live) > 0, F.length(cleaned)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*(clean.get(c, F.col(c)) for c in docs.columns))
