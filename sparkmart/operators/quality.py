"""Data-quality reports: row counts, key integrity and product coverage.

Spark does not enforce primary or foreign keys; these jobs check them.  Each
is one aggregate (or anti join + aggregate) over whole tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart import schema


def row_count_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, no_rows for each table (UNION ALL of global counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("no_rows"))
             .select(F.lit(name).alias("table_name"), "no_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def pk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, duplicate_keys, rows_with_duplicate_keys per declared key."""
    parts = []
    for name, df in tables.items():
        keys = schema.PRIMARY_KEYS[name]
        dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                    F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
                    .cast("bigint").alias("rows_with_duplicate_keys")))
        parts.append(dup.select(F.lit(name).alias("table_name"), "duplicate_keys",
                                "rows_with_duplicate_keys"))
    return reduce(DataFrame.unionByName, parts)


def fk_violations(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """fk_column, ref_table, orphan_rows: fact rows whose key is missing from
    the referenced dimension (NULL keys count as orphans).  Rows are counted
    per key first, so a hot key reaches the join as one row."""
    parts = []
    for col, dim_name in schema.FOREIGN_KEYS:
        keys = dims[dim_name].select(F.col(col).alias("__k")).distinct()
        counts = fact.groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
        orphans = counts.join(keys, F.col(col) == F.col("__k"), "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
                     .select(F.lit(col).alias("fk_column"), F.lit(dim_name).alias("ref_table"),
                             "orphan_rows"))
    return reduce(DataFrame.unionByName, parts)


def product_coverage(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """matched, total, unmatched: transactions whose product id occurs in the
    product master (membership, so duplicate master rows do not count twice).
    Transactions are counted per product first."""
    known = products.select("product_id").distinct().withColumn("__hit", F.lit(True))
    counts = transactions.groupBy("product_id").agg(F.count(F.lit(1)).alias("__n"))
    j = counts.join(known, "product_id", "left")
    return j.agg(F.coalesce(F.sum(F.when(F.col("__hit"), F.col("__n"))), F.lit(0)).cast("bigint").alias("matched"),
                 F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("total")) \
        .select("matched", "total", (F.col("total") - F.col("matched")).alias("unmatched"))


def duplicate_master_keys(masters: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """source, duplicate_keys, rows_with_duplicate_keys for master inputs.

    Duplicated product ids matter: the product dimension keeps the first row
    while revenue uses the last row's price.

    The keys are dealt out over all shuffle partitions before they are counted.
    Else a source that comes from a join on a part of the key is counted inside the
    join's tasks, which hold the join's rows and every key at once, in as few
    partitions as the join's small rows were coalesced to.
    """
    parts = []
    for source, (df, keys) in masters.items():
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        g = df.select(*keys).repartition(n, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        parts.append(g.agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                           F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
                           .cast("bigint").alias("rows_with_duplicate_keys"))
                     .select(F.lit(source).alias("source"), "duplicate_keys",
                             "rows_with_duplicate_keys"))
    return reduce(DataFrame.unionByName, parts)


def length_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, max_length, too_long: values longer than the
    declared text length (the database would have truncated or refused
    them; here they are loaded whole and counted)."""
    parts = []
    for name, limits in schema.TEXT_LIMITS.items():
        df = tables[name]
        aggs = [F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()]
        # One scan per table: a single aggregate, unpivoted.
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_length"),
                                            F.col(c).alias("too_long")) for c, n in limits.items()]))
        parts.append(df.agg(*aggs).select(F.lit(name).alias("table_name"), rows.alias("r"))
                     .select("table_name", "r.*"))
    return reduce(DataFrame.unionByName, parts)
