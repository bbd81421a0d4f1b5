"""Sketches with too many differences are not peeled; those with cells for all digests need few steps."""

from pyspark.sql import functions as F

from larkspur.llm import fingerprints


def test_full_sketches_fail_without_work_and_wide_ones_succeed(spark):
    numbers = lambda a, b: F.array_distinct(F.transform(F.sequence(F.lit(a), F.lit(b)), lambda i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.col("row"), i), 24), 24)))
    checked = lambda c: F.transform(c, lambda d: d.bitwiseOR(fingerprints._check(F.shiftrightunsigned(d, 24))))
    doc = F.struct(checked(numbers(1, 100)).alias("own"), checked(numbers(6, 105)).alias("changed"), checked(numbers(201, 300)).alias("following"))
    rows = spark.range(200).withColumnRenamed("id", "row").select("row", doc.alias("doc")).repartition(4, "row")
    sketched = fingerprints.sketches(rows, ["row"], ["own", "changed", "following"])
    cells = fingerprints.subtracted(sketched, ["row"], [(0, 1), (0, 2)])
    # ten differences keep their cells; two hundred become one cell
    assert cells.where("pair = 1").count() == 200 and cells.where("pair = 0").count() > 200 * 15
    first = fingerprints.outcomes(fingerprints.peeled(cells, ["row"], 0, 6), ["row"], 2).collect()
    assert len(first) == 200 and not any(r.o1.ok for r in first) and sum(r.o0.ok for r in first) > 190
    assert all((len(r.o0.a_only), len(r.o0.b_only)) == (5, 5) for r in first if r.o0.ok)
    size = fingerprints.enough_cells(F.col("doc.own"), F.col("doc.following"))
    wide = fingerprints.peeled(fingerprints.resketched(rows, ["row"], [("own", "following")], [size], 1), ["row"], 1, fingerprints.WIDE_STEPS)
    wide = fingerprints.outcomes(wide, ["row"], 1).collect()
    assert sum(r.o0.ok and (len(r.o0.a_only), len(r.o0.b_only)) == (100, 100) for r in wide) >= 199
