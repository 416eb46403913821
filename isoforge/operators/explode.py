"""One row per molecule, or per isoform and cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from isoforge.functions.columns import valid_cell

#: A cell; a read or isoform.
KEY = ["sampleID", "CB"]
ROW = ["sampleID", "isoform"]


def _lists(cls: DataFrame) -> DataFrame:
    cells = F.split("CB", ",")
    weights = F.when(F.col("FL").isNull(), F.transform(cells, lambda _: F.lit("1"))).otherwise(F.split("FL", ","))
    return cls.withColumn("__cells", cells).withColumn("__weights", weights)


def explode_cells(cls: DataFrame, mode: str = "reads", watch: Observation | None = None) -> DataFrame:
    """Rows with one valid ``CB`` each and ``_count``: 1 per read, or an isoform's ``FL`` in the cell.

    In isoforms mode ``CB`` and ``FL`` are parallel comma lists; a missing ``FL`` weighs 1 for each
    cell. Rows whose lists differ in length have no cells (``unequal_lists``). ``watch`` counts, in the same pass,
    exploded ``rows``, those ``without_cell``, of an ``invalid_cell``, and rows of ``unequal`` lists.
    """
    if mode == "reads":
        each = cls.withColumns({"_count": F.lit(1.0), "__unequal": F.lit(False)})
    else:
        own = _lists(cls if "FL" in cls.columns else cls.withColumn("FL", F.lit(None).cast("string")))
        unequal = F.coalesce(F.size("__cells") != F.size("__weights"), F.lit(False))
        each = own.withColumn("__unequal", unequal).withColumn("__pair", F.explode_outer(F.when(~unequal, F.arrays_zip("__cells", "__weights"))))
        each = each.withColumn("CB", F.trim("__pair.__cells")).withColumn("_count", F.coalesce(F.col("__pair.__weights").try_cast("double"), F.lit(1.0)))
        each = each.drop("__pair", "__cells", "__weights")
    if watch is not None:
        tests = {"unequal": F.col("__unequal"), "without_cell": F.col("CB").isNull() & ~F.col("__unequal"), "invalid_cell": F.col("CB").isNotNull() & ~valid_cell()}
        each = each.observe(watch, F.count("*").alias("rows"), *(F.count(F.when(t, 1)).alias(n) for n, t in tests.items()))
    return each.filter(valid_cell()).drop("__unequal")


def unequal_lists(cls: DataFrame) -> DataFrame:
    """Isoform rows that ``explode_cells`` can't pair."""
    return _lists(cls).filter(F.size("__cells") != F.size("__weights")).drop("__cells", "__weights")


def explode_junction_cells(junctions: DataFrame) -> DataFrame:
    """Junction rows with one barcode each; lists of barcodes (isoforms mode) give a row for each."""
    return junctions.withColumn("CB", F.explode_outer(F.split("CB", ","))).withColumn("CB", F.trim("CB"))
