"""Readers of the text inputs; each gives a DataFrame of fixed columns, rows of all samples told apart by ``sampleID``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from isoforge.operators.explode import ROW
from isoforge.sources.bam import bam_association

STRINGS = [
    "isoform", "CB", "UMI", "chrom", "strand", "associated_gene", "associated_transcript", "structural_category", "subcategory", "all_canonical",
    "RTS_stage", "predicted_NMD", "within_CAGE_peak", "polyA_motif_found", "coding", "jxn_string", "jxnHash", "FL",
]
NUMBERS = ["exons", "length", "ref_length", "perc_A_downstream_TTS", "diff_to_gene_TSS", "min_cov", "ratio_TSS"]
JUNCTION_STRINGS = ["isoform", "chrom", "strand", "junction_category", "canonical", "RTS_junction", "CB"]
JUNCTION_NUMBERS = ["genomic_start_coord", "genomic_end_coord", "diff_to_Ref_start_site", "diff_to_Ref_end_site"]
MANIFEST = ["cell_association", "abundance", "coverage", "SR_bam"]
#: Ends of file names that are not part of a sample's name. Fixed values but for the summary, which may have another.
SUFFIXES = (
    "_classification.txt", "_junctions.txt", "_corrected.gtf", ".UMI_filtered.ED4.allinfo", ".allinfo", ".tagged.bam", ".bam", "_cell_summary.txt.gz", "_cell_summary.txt",
)
#: Where a row stands: file, block and order in it; unlike the order of partitions it follows the files' lines.
_AT = ("_metadata.file_path", "_metadata.file_block_start")


def conform(df: DataFrame, strings: list[str], numbers: list[str]) -> DataFrame:
    """Missing columns as null, empty and 'NA' texts as null, numbers by try_cast with NaN as null."""
    there = set(df.columns)
    out = {c: F.when(~F.col(c).isin("", "NA"), F.col(c)) if c in there else F.lit(None).cast("string") for c in strings}
    for c in numbers:
        x = F.col(c).try_cast("double") if c in there else F.lit(None).cast("double")
        out[c] = F.when(~F.isnan(x), x)
    return df.withColumns(out)


def sample_id_from_path(path: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """A file's name without its known suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, "(" + "|".join(s.replace(".", "\\.") for s in suffixes) + ")$", "")


def path_key(path: Column) -> Column:
    """A path without the scheme of local files, so that both ways of writing it are equal."""
    return F.regexp_replace(F.regexp_replace(path, "^file:/*", "/"), "/+", "/")


def _with_sample(df: DataFrame, manifest: DataFrame | None, column: str) -> DataFrame:
    """``sampleID`` from the manifest's column of paths, or from the file's name."""
    if manifest is None:
        return df.withColumn("sampleID", sample_id_from_path(F.col("_metadata.file_path")))
    return manifest_join(df.withColumn("source_file", F.col("_metadata.file_path")), manifest, column).drop("source_file")


def _tsv(spark: SparkSession, paths, header: bool = True, comment: str | None = None, sep: str = "\t") -> DataFrame:
    reader = spark.read.option("sep", sep).option("header", header).option("quote", "")
    return (reader.option("comment", comment) if comment else reader).csv(paths)


def _files(spark: SparkSession, paths) -> list[str]:
    """All files of some paths, those of a folder too, but for hidden ones."""
    out = []
    for p in [paths] if isinstance(paths, str) else paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        for f in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at):
            if f.isFile() and f.getPath().getName()[0] not in "._":
                out.append(f.getPath().toString())
    return out


def _head(spark: SparkSession, path: str, comment: str | None) -> str:
    """A file's first line that is neither empty nor a comment; only that much of it is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        while (line := lines.readLine()) is not None:
            if line.strip() and not (comment and line.startswith(comment)):
                return line
        return ""
    finally:
        lines.close()


def headed_tables(spark: SparkSession, paths, comment: str | None = None, names=None, header=None) -> DataFrame:
    """Tab-separated files, which may differ in their columns, as one table of texts by one scan, however many files there are.

    Each file's own header says where its columns stand; a column that a file lacks is null there, and so is
    what a short line lacks. Further columns: source_file, __at (file, place and order of the line) and __short. Lines
    that equal their file's header are no rows. ``names`` gives the columns to take, else all of all files;
    ``header`` maps a file's first line to the columns' places by name and says whether that line is a header.
    """
    found = {f: _head(spark, f, comment) for f in _files(spark, paths)}
    header = header or (lambda line: ({c: i for i, c in enumerate(line.split("\t"))}, True))
    heads = {f: header(line) for f, line in found.items()}
    names = list(names or dict.fromkeys(c for places, _ in heads.values() for c in places))
    rows = [(f, [places.get(c, -1) for c in names], found[f] if is_header else None, len(found[f].split("\t"))) for f, (places, is_header) in heads.items()]
    known = spark.createDataFrame(rows, "__path string, __places array<int>, __header string, __width int").withColumn("__path", path_key(F.col("__path")))
    lines = _in_order(spark.read.text(list(found))) if found else spark.createDataFrame([], "value string, __at struct<file_path:string,file_block_start:long,n:long>")
    lines = lines.filter(F.trim("value") != "")
    if comment:
        lines = lines.filter(~F.col("value").startswith(comment))
    own = lines.withColumn("__path", path_key(F.col("__at.file_path"))).join(F.broadcast(known), "__path").filter("__header IS NULL OR value != __header")  # a row for each file
    fields = F.split("value", "\t", -1)
    each = [F.nullif(F.when(F.col("__places")[i] >= 0, F.get(fields, F.col("__places")[i])), F.lit("")).alias(c) for i, c in enumerate(names)]
    return own.select(*each, F.col("__at.file_path").alias("source_file"), "__at", (F.size(fields) < F.col("__width")).alias("__short"))


def _sampled(df: DataFrame, manifest: DataFrame | None, column: str) -> DataFrame:
    """``sampleID`` from the manifest's column of paths, from the table itself, or from the file's name."""
    if manifest is not None:
        df = manifest_join(df, manifest, column)
    elif "sampleID" not in df.columns:
        df = df.withColumn("sampleID", sample_id_from_path(F.col("source_file")))
    return df.drop("source_file")


def counted(df: DataFrame, watch: Observation | None, **tests: Column) -> DataFrame:
    """``df``; the pass that reads it also counts its rows and those of each test into ``watch``."""
    if watch is None:
        return df
    return df.observe(watch, F.count("*").alias("rows"), *(F.count(F.when(t, 1)).alias(n) for n, t in tests.items()))


def read_classification(spark: SparkSession, paths, manifest: DataFrame | None = None, watch: Observation | None = None) -> DataFrame:
    """All columns of all files; ``watch`` counts rows and short ones, whose missing fields are null."""
    raw = counted(_sampled(headed_tables(spark, paths), manifest, "classification_file"), watch, short=F.col("__short"))
    return conform(raw.drop("__at", "__short"), STRINGS, NUMBERS)


def read_junctions(spark: SparkSession, paths=None, manifest: DataFrame | None = None, watch: Observation | None = None) -> DataFrame:
    """No path: no junctions. ``watch`` counts rows and short ones."""
    raw = _sampled(headed_tables(spark, paths), manifest, "junction_file") if paths else spark.createDataFrame([], "sampleID string, isoform string, __at string, __short boolean")
    return conform(counted(raw, watch, short=F.col("__short")).drop("__at", "__short"), JUNCTION_STRINGS, JUNCTION_NUMBERS)


def read_cell_summaries(spark: SparkSession, paths, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Written summaries, numbers as such; a file without ``sampleID`` has it from its name, columns that a sample lacks are 0."""
    each = []
    for p in [paths] if isinstance(paths, str) else paths:
        df = _tsv(spark, p)
        if "sampleID" not in df.columns:
            df = df.withColumn("sampleID", sample_id_from_path(F.col("_metadata.file_path"), suffixes))
        each.append(df.select("sampleID", "CB", *(F.col(c).try_cast("double").alias(c) for c in df.columns if c not in ("sampleID", "CB"))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each).na.fill(0)


def manifest_violations(manifest: DataFrame, mode: str = "reads") -> DataFrame:
    """Samples that lack what the mode needs, with the reason."""
    lacks = F.col("cell_association") == "" if mode == "reads" else (F.col("cell_association") == "") & (F.col("abundance") == "")
    reason = "no cell association" if mode == "reads" else "neither cell association nor abundance"
    return manifest.filter(lacks).select("sampleID", F.lit(reason).alias("reason"))


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(f.getPath().toString() for f in found or [])


def _searched(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Associations that the manifest leaves out: ``<file_acc>*.bam`` or ``<file_acc>_cell_association.txt`` in the folder."""
    rows = []
    for r in manifest.filter("cell_association = ''").select("sampleID", "file_acc").collect():  # a row for each sample
        found = _glob(spark, f"{folder}/{r['file_acc']}*.bam") or _glob(spark, f"{folder}/{r['file_acc']}_cell_association.txt")
        rows += [(r["sampleID"], found[0])] if found else []
    more = spark.createDataFrame(rows, "sampleID string, __found string")
    own = manifest.join(F.broadcast(more), "sampleID", "left").withColumn("cell_association", F.coalesce("__found", "cell_association"))
    return own.select(manifest.columns)


def read_manifest(spark: SparkSession, path: str, mode: str = "reads", input_dir: str | None = None, out_dir: str | None = None) -> DataFrame:
    """The samples. Missing columns, and samples that lack what the mode needs, raise ValueError.

    With ``input_dir`` associations that are left out are looked for there. Files of a sample are in
    ``out_dir``/``file_acc``, unless the manifest names them.
    """
    df = spark.read.option("header", True).csv(path)
    if missing := {"sampleID", "file_acc"} - set(df.columns):
        raise ValueError(f"the manifest lacks {sorted(missing)}")
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in MANIFEST})
    folder = [F.lit(out_dir)] if out_dir else []
    for name in ("classification", "junction"):
        column, suffix = f"{name}_file", "_classification.txt" if name == "classification" else "_junctions.txt"
        own = F.concat_ws("/", *folder, "file_acc", F.concat("sampleID", F.lit(suffix)))
        df = df.withColumn(column, F.coalesce(F.nullif(F.col(column), F.lit("")), own) if column in df.columns else own)
    if input_dir:
        df = _searched(spark, df, input_dir)
    if bad := [f"{r['sampleID']}: {r['reason']}" for r in manifest_violations(df, mode).collect()]:
        raise ValueError(f"samples lack input for mode {mode}: {'; '.join(bad)}")
    return df


def manifest_join(df: DataFrame, manifest: DataFrame, column: str = "classification_file", file: str = "source_file") -> DataFrame:
    """``sampleID`` of the manifest for rows by their file; the manifest has a row for each sample."""
    own = manifest.select(path_key(F.col(column)).alias("__file"), "sampleID")
    return df.drop("sampleID").withColumn("__file", path_key(F.col(file))).join(F.broadcast(own), "__file").drop("__file")


def last_of(df: DataFrame, keys: list[str], columns: list[str], order: str = "__at") -> DataFrame:
    """The row that came last, for each key."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("__last")).select(*keys, "__last.*")


def _in_order(df: DataFrame) -> DataFrame:
    """``__at`` follows the names of files and the order of their lines: taken right after the scan."""
    return df.withColumn("__at", F.struct(*(F.col(c).alias(c.rsplit(".", 1)[1]) for c in _AT), F.monotonically_increasing_id().alias("n")))


def read_cell_association_reads(spark: SparkSession, path, manifest: DataFrame | None = None) -> DataFrame:
    """sampleID, isoform, CB, UMI of text and BAM files, all in one table; a repeated id takes its last row."""
    files = [path] if isinstance(path, str) else list(path)
    bams = [f for f in files if f.endswith(".bam")]
    texts = [f for f in files if not f.endswith(".bam")]
    out = []
    if texts:

        def header(line):
            places = {c: i for i, c in enumerate(line.split("\t"))}
            if "id" not in places or not {"cell_barcode", "cb"} & set(places):
                raise ValueError("a cell association needs id and cell_barcode")
            return {"id": places["id"], "CB": places.get("cell_barcode", places.get("cb")), "UMI": places.get("umi", -1)}, True

        df = _sampled(headed_tables(spark, texts, "#", ["id", "CB", "UMI"], header), manifest, "cell_association")
        out.append(last_of(df.select("sampleID", F.col("id").alias("isoform"), "CB", "UMI", "__at"), ROW, ["CB", "UMI"]))
    if bams:
        out.append(bam_association(spark, bams, manifest))
    return reduce(DataFrame.unionByName, out)


def read_cell_association_isoforms(spark: SparkSession, path, manifest: DataFrame | None = None) -> DataFrame:
    """sampleID, isoform, CB list: by each header's names, or the first two columns of a file without a known header."""

    def header(line):
        places = {c.lower(): i for i, c in reversed(list(enumerate(line.split("\t"))))}
        ids, cells = ([places[c] for c in names if c in places] for names in (("pbid", "isoform_id", "isoform", "id"), ("cell_barcodes", "cbs", "cb")))
        return ({"isoform": ids[0], "CB": cells[0]}, True) if ids and cells else ({"isoform": 0, "CB": 1}, False)

    df = _sampled(headed_tables(spark, path, "#", ["isoform", "CB"], header), manifest, "cell_association")
    return last_of(df.select("sampleID", "isoform", "CB", "__at").filter("isoform IS NOT NULL AND CB IS NOT NULL"), ROW, ["CB"])


def read_tagged_reads(tags: DataFrame, umi_tags: tuple[str, ...] = ("XM",), order: str | None = None) -> DataFrame:
    """sampleID, isoform, CB, UMI of reads that have a UMI and a cell; a repeated name takes its last row.

    Only tag XM counts as a UMI, unless others are given. ``tags`` has sampleID, read_name and a column for
    each tag; ``order`` names a column that follows the reads, else it is their order in the scan.
    """
    umi = F.coalesce(*(F.col(c) if c in tags.columns else F.lit(None).cast("string") for c in umi_tags))
    at = F.monotonically_increasing_id() if order is None else F.col(order)
    own = tags.select("sampleID", F.col("read_name").alias("isoform"), "CB", umi.alias("UMI"), at.alias("__at"))
    return last_of(own.filter("CB IS NOT NULL AND UMI IS NOT NULL"), ROW, ["CB", "UMI"])


def read_sam_text(spark: SparkSession, path: str) -> DataFrame:
    """sampleID, read_name and CB (the first CB:Z: tag) of alignment lines."""
    parts = F.split("value", "\t")
    tags = F.filter(F.slice(parts, 12, F.greatest(F.size(parts), F.lit(1))), lambda t: t.startswith("CB:Z:"))
    own = _with_sample(spark.read.text(path), None, "").filter(~F.col("value").startswith("@"))
    tag = F.get(tags, F.lit(0))
    own = own.select("sampleID", parts[0].alias("read_name"), F.substring(tag, F.lit(6), F.length(tag)).alias("CB"))
    return own.filter("CB IS NOT NULL AND CB != ''")


def _numbered(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    """folder, n, ``name``: the first field of each line of some files, or folders of parts of one, with its 1-based number.

    Lines keep the order of a split of a file, so that splits alone are counted and summed up.
    """
    lines = _in_order(spark.read.text(paths))
    splits = lines.groupBy(F.col("__at.file_path").alias("f"), F.col("__at.file_block_start").alias("s")).agg(F.min("__at.n").alias("first"), F.count("*").alias("lines"))
    splits = splits.withColumn("folder", _matrix_folder(F.col("f")))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("folder").orderBy("f", "s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = F.broadcast(splits.withColumn("before", before))  # a row for each split of files of names
    own = lines.join(splits, (F.col("__at.file_path") == F.col("f")) & (F.col("__at.file_block_start") == F.col("s")))
    return own.select("folder", (F.col("__at.n") - F.col("first") + F.col("before") + 1).alias("n"), F.split("value", "\t")[0].alias(name))


def _matrix_folder(path: Column) -> Column:
    """The folder of a matrix's three files, each of which may be a folder of parts."""
    return F.regexp_replace(path_key(path), r"/(matrix\.mtx|features\.tsv|barcodes\.tsv)(/[^/]*)?$", "")


def read_mex(spark: SparkSession, folder: str | dict[str, str], sample: str | None = None, watch: Observation | None = None) -> DataFrame:
    """sampleID, isoform, CB, count of one folder (sampleID: its name), or of the folder of each sample, all in one scan.

    Comment lines and the line of dimensions are no rows; indices out of range are dropped and, with ``watch``, counted.
    """
    own = folder if isinstance(folder, dict) else {sample or folder.rstrip("/").rsplit("/", 1)[-1]: folder}
    paths = lambda name: [f"{f.rstrip('/')}/{name}" for f in dict.fromkeys(own.values())]
    heads = {f: _head(spark, f, "%") for p in paths("matrix.mtx") for f in sorted(_files(spark, p))[:1]}
    at = F.struct("__at.file_block_start", "__at.n")
    lines = _in_order(spark.read.text(paths("matrix.mtx"))).filter(~F.col("value").startswith("%") & (F.trim("value") != ""))
    first = F.broadcast(spark.createDataFrame(list(heads.items()), "__path string, __head string").withColumn("__path", path_key(F.col("__path"))))
    lines = lines.withColumn("__path", path_key(F.col("__at.file_path"))).join(first, "__path", "left")
    # The line of dimensions is the first of its file; the same text may be an entry further down.
    top = F.broadcast(lines.filter("value = __head AND __at.file_block_start = 0").groupBy("__path").agg(F.min(at).alias("__top")))
    lines = lines.join(top, "__path", "left").filter(F.col("__top").isNull() | (at != F.col("__top")))
    parts = F.split(F.trim("value"), r"\s+")
    cells = lines.select(_matrix_folder(F.col("__at.file_path")).alias("folder"), parts[0].try_cast("long").alias("row"), parts[1].try_cast("long").alias("col"), parts[2].try_cast("double").alias("count"))
    features, barcodes = _numbered(spark, paths("features.tsv"), "isoform"), _numbered(spark, paths("barcodes.tsv"), "CB")
    samples = F.broadcast(spark.createDataFrame(list(own.items()), "sampleID string, folder string").withColumn("folder", F.regexp_replace(path_key(F.col("folder")), "/$", "")))
    joined = cells.join(features.withColumnRenamed("n", "row"), ["folder", "row"], "left").join(barcodes.withColumnRenamed("n", "col"), ["folder", "col"], "left")
    known = F.col("isoform").isNotNull() & F.col("CB").isNotNull()
    joined = counted(joined, watch, out_of_range=~known).filter(known)
    return joined.join(samples, "folder").select("sampleID", "isoform", "CB", "count")


def read_group_file(spark: SparkSession, path: str) -> DataFrame:
    """sampleID, molecule, isoform; a molecule on several lines belongs to the last."""
    parts = F.split("value", "\t")
    own = _with_sample(_in_order(spark.read.text(path)), None, "").filter(F.size(parts) >= 2)
    own = own.select("sampleID", parts[0].alias("isoform"), F.explode(F.split(parts[1], ",")).alias("molecule"), "__at")
    return last_of(own.filter("molecule != ''"), ["sampleID", "molecule"], ["isoform"])


def read_allinfo(spark: SparkSession, path) -> DataFrame:
    """Assigned reads: lines of at least 12 fields; a missing type is ``unknown``."""
    parts = F.split("value", "\t")
    own = _with_sample(_in_order(spark.read.text(path)), None, "").filter(F.size(parts) >= 12)
    names = {"read": 0, "gene": 1, "barcode": 3, "read_type": 9, "transcript": 11}
    kind = F.coalesce(F.get(parts, F.lit(12)), F.lit("unknown"))
    return own.select("sampleID", *(F.get(parts, F.lit(i)).alias(n) for n, i in names.items()), kind.alias("transcript_type"), "__at")


def read_gtf(spark: SparkSession, path) -> DataFrame:
    """Exon rows: sampleID, chrom, start, end, strand, gene_id, transcript_id."""
    df = _tsv(spark, path, header=False, comment="#")
    names = dict(zip(df.columns, ("chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes"), strict=False))
    df = df.withColumn("sampleID", sample_id_from_path(F.col("_metadata.file_path"), (*SUFFIXES, ".gtf"))).withColumnsRenamed(names).filter("feature = 'exon'")
    tag = lambda t: F.regexp_extract("attributes", rf'{t} "([^"]*)"', 1).alias(t)
    at = (F.col(c).cast("long").alias(c) for c in ("start", "end"))
    return df.select("sampleID", "chrom", *at, "strand", tag("gene_id"), tag("transcript_id"))
