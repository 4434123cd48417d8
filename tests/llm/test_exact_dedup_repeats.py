from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.llm import exact_dedup


def test_a_hot_digest_of_repeated_rows_is_spread(spark):
    """Rows of one id, and rows without ids: one of each stays, and no task gets them all."""
    n = 6000
    rows = spark.range(0, 2 * n + 900, numPartitions=12).selectExpr(
        f"case when id < {n} then 7 when id < {2 * n} then null else id end as doc_id",
        f"case when id < {n} then 'Hot text' when id < {2 * n} then 'nameless' else concat('t', id % 700) end as text",
        "id as place",
    )
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        digests = exact_dedup.land(exact_dedup.with_digest(rows).select("id", "digest"), "digests")
        marked = exact_dedup.mark(digests.repartition(24), exact_dedup.heavy_digests(digests))
        # with the marks, or no window would be computed
        placed = marked.select("id", "kept", "keep_id", "group_size", F.spark_partition_id().alias("p"))
        per_task = [r.n for r in placed.groupBy("p").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")), F.max("keep_id"), F.max("group_size")).collect()]
        assert max(per_task) < n / 2 and sum(per_task) == 2 * n + 900
        sizes = {r.id: (r.rows, r.stay, r.size) for r in marked.where("id is null or id = 7").groupBy("id").agg(F.count("*").alias("rows"), F.sum(F.col("kept").cast("int")).alias("stay"), F.max("group_size").alias("size")).collect()}
        assert sizes == {7: (n, 1, n), None: (n, 1, n)}
        kept = exact_dedup.drop_copies(rows)
        assert kept.count() == 702 and kept.select("place").distinct().count() == 702
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
