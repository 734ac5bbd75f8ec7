"""Exact top-k search of binary codes by incremental multi-index hashing.

A code is cut into segments. A code within distance ``m * a + b`` of a query (m segments)
differs by at most ``a`` bits in one of the first b + 1 segments, or by fewer than ``a`` in
another. Round ``a`` looks up all segment values that are ``a`` bits from the query's.
Found codes are verified over all bits. After a round, the k-th distance of a query tells
how many segments it still has to look up with one bit more; a query leaves once its
k-th distance is covered.

Equal codes are one entry with their first k + 1 ids, which is all that a top-k can use,
so a vector that a third of all rows share is one row. A pair is reported in one lookup
only: its first segment of least distance.

Defined results: rows without id or vector neither ask nor answer; missing, zero and NaN
components are 0 bits; repeated rows count once; ties go to the smaller id; a query is
not its own neighbour; with fewer than k other rows, all are returned. Extra columns are
ignored; a table without rows gives none.
"""

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from eventlens.session import materialize

BITS = 64
SEGMENTS = 4


def sign_code(vector: Column) -> Column:
    """Bit i of a long is set where component i is above 0; at most 64 components."""
    one = F.lit(1).cast("long")
    bits = F.transform(vector, lambda x, i: F.when(
        (x > 0) & ~F.isnan(x), F.call_function("shiftleft", one, i)).otherwise(F.lit(0).cast("long")))
    checked = F.when(F.size(vector) > BITS, F.raise_error(F.lit(f"more than {BITS} components"))).otherwise(bits)
    return F.aggregate(checked, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _segment(code: Column, number: Column | int, bits: int) -> Column:
    shift = (F.lit(number) if isinstance(number, int) else number) * bits
    return F.call_function("shiftrightunsigned", code, shift.cast("int")).bitwiseAND(F.lit((1 << bits) - 1))


def _entries(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(code, ids): each code with its first k + 1 ids."""
    coded = vectors.select(F.col(id_col).alias("id"), sign_code(F.col(vector_col)).alias("code")).dropna().distinct()
    first = coded.withColumn("n", F.row_number().over(W.partitionBy("code").orderBy("id"))).filter(F.col("n") <= k + 1)
    return first.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding", segments: int = SEGMENTS) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest rows of ``vectors`` for each
    row of ``queries``."""
    spark, bits, keep = vectors.sparkSession, BITS // segments, k + 1
    entries = materialize(_entries(vectors, id_col, vector_col, k), "codes")
    asked = materialize(queries.select(
        F.col(id_col).alias("query_id"), sign_code(F.col(vector_col)).alias("asked")).dropna().distinct(), "asked")
    index = entries.select(
        "code", "ids", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment"),
    ).withColumn("value", _segment(F.col("code"), F.col("segment"), bits))

    found = None  # (asked, distance, id): the best of each asked code so far
    active = asked.select("asked").distinct().select(
        "asked", F.lit(segments).alias("todo"), F.lit(BITS).alias("limit"))
    for radius in range(bits + 1):
        # at most 2 ** bits rows over all rounds
        masks = spark.createDataFrame(
            [(radius, sum(1 << b for b in on)) for on in combinations(range(bits), radius)], "radius int, mask long")
        probes = active.select(
            "asked", "limit", F.lit(radius).alias("radius"),
            F.explode(F.sequence(F.lit(0), F.col("todo") - 1)).alias("probed"),
        ).join(F.broadcast(masks), "radius").withColumn(
            "wanted", _segment(F.col("asked"), F.col("probed"), bits).bitwiseXOR(F.col("mask")))
        apart = F.col("code").bitwiseXOR(F.col("asked"))
        own = [F.bit_count(_segment(apart, s, bits)) for s in range(segments)]
        distance = F.bit_count(apart)
        # reported here and in no other lookup: no segment is nearer, no earlier one as near
        once = F.lit(True)
        for s, d in enumerate(own):
            once &= F.when(F.col("probed") > s, d > radius).otherwise(d >= radius)
        hits = probes.join(
            index, (F.col("probed") == F.col("segment")) & (F.col("wanted") == F.col("value"))
            & (distance <= F.col("limit")) & once,
        ).select("asked", distance.alias("distance"), F.explode("ids").alias("id"))
        merged = hits if found is None else found.unionByName(hits)
        best = merged.withColumn("n", F.row_number().over(W.partitionBy("asked").orderBy("distance", "id")))
        found = materialize(best.filter(F.col("n") <= keep).drop("n"), "nearest")

        # distances up to here are complete; each further one needs one segment more
        covered = segments * (radius + 1) - 1
        reach = found.groupBy("asked").agg(F.count("*").alias("have"), F.max("distance").alias("far"))
        limit = F.when(F.col("have") >= keep, F.col("far")).otherwise(BITS)
        active = materialize(active.select("asked").join(reach, "asked", "left").select(
            "asked", limit.cast("int").alias("limit"),
            F.least(F.lit(segments), limit - covered).cast("int").alias("todo"),
        ).filter("todo > 0"), "active")
        if active.isEmpty():
            break

    answers = asked.join(found, "asked").filter(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(W.partitionBy("query_id", "asked").orderBy("distance", "id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("neighbor_id"),
        F.col("distance").cast("long").alias("distance"))
