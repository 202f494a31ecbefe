"""Queries for reconciliation and change tracking, on copies of orders that differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.bindings.inputs import document_recipes, iso, table
from larder.bindings.registry import query
from larder.bindings.transforms import difficulty_sql
from larder.operators import compare
from larder.plans import change_job
from larder.sources import fresh_folder, read_files, write_files

# The source lost the pending orders, the target those of low priority.
SIDES_SQL = """
    WITH o AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
         s AS (SELECT * FROM o WHERE o_orderstatus <> 'P'),
         t AS (SELECT * FROM o WHERE o_orderpriority <> '5-LOW')
"""


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = table(spark, folder, "orders").withColumn("cents", cents)
    source = orders.where(F.col("o_orderstatus") != "P")
    target = orders.where(F.col("o_orderpriority") != "5-LOW")
    return source, target


def _reconcile_sql(key: str) -> str:
    return f"""{SIDES_SQL}
    SELECT *, CASE WHEN target_rows = 0 THEN 'missing in target'
                   WHEN source_rows = 0 THEN 'missing in source'
                   WHEN source_rows = target_rows AND source_cents IS NOT DISTINCT FROM target_cents
                   THEN 'match' ELSE 'mismatch' END AS status
    FROM (SELECT {key}, coalesce(sn, 0) AS source_rows, coalesce(tn, 0) AS target_rows,
                 sc AS source_cents, tc AS target_cents
          FROM (SELECT {key}, count(*) AS sn, CAST(sum(cents) AS BIGINT) AS sc
                FROM s GROUP BY 1) AS a
          FULL OUTER JOIN (SELECT {key}, count(*) AS tn, CAST(sum(cents) AS BIGINT) AS tc
                           FROM t GROUP BY 1) AS b USING ({key})) AS j"""


@query(_reconcile_sql("o_orderstatus"))
def reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return compare.reconcile(*_sides(spark, folder), ["o_orderstatus"], ["cents"])


@query(_reconcile_sql("o_custkey"))
def reconcile_customers(spark: SparkSession, folder: str) -> DataFrame:
    return compare.reconcile(*_sides(spark, folder), ["o_custkey"], ["cents"])


@query(f"""{SIDES_SQL}
    SELECT o_custkey, o_orderstatus, count(*) FILTER (WHERE side = 1) AS source_rows,
           count(*) FILTER (WHERE side = 2) AS target_rows
    FROM (SELECT 1 AS side, * FROM s UNION ALL SELECT 2, * FROM t) AS u
    GROUP BY o_custkey, o_orderstatus, o_orderpriority
    HAVING count(*) FILTER (WHERE side = 1) <> count(*) FILTER (WHERE side = 2)
""")
def reconcile_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by content: customer and status as key, the priority as the content compared."""
    source, target = _sides(spark, folder)
    return compare.reconcile_rows(
        source, target, ["o_custkey", "o_orderstatus"], ["o_orderpriority"]
    )


@query(f"""{SIDES_SQL}
    SELECT o_custkey, o_orderstatus, count(*) FILTER (WHERE side = 1) AS source_rows,
           count(*) FILTER (WHERE side = 2) AS target_rows
    FROM (SELECT 1 AS side, * FROM o UNION ALL
          SELECT 2, o.* REPLACE (CASE WHEN o_custkey % 50 = 7 THEN NULL ELSE o_orderpriority END
                                 AS o_orderpriority) FROM o) AS u
    GROUP BY o_custkey, o_orderstatus, o_orderpriority, cents
    HAVING count(*) FILTER (WHERE side = 1) <> count(*) FILTER (WHERE side = 2)
""")
def reconcile_by_digest(spark: SparkSession, folder: str) -> DataFrame:
    """A copy of the orders in which some customers' lost their priority."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = table(spark, folder, "orders").withColumn("cents", cents)
    lost = F.when(F.col("o_custkey") % 50 != 7, F.col("o_orderpriority"))
    return compare.reconcile_by_digest(
        orders,
        orders.withColumn("o_orderpriority", lost),
        ["o_custkey", "o_orderstatus"],
        ["o_orderpriority", "cents"],
    )


COMPARED = {"o_orderkey": "bigint", "cents": "bigint", "o_orderstatus": "string"}


def _measures(side: str, view: str, column: str) -> str:
    return f"""CAST(count({column}) AS VARCHAR) AS {side}_filled,
        CAST(min({column}) AS VARCHAR) AS {side}_least,
        CAST(max({column}) AS VARCHAR) AS {side}_greatest FROM {view}"""


def _column_row_sql(column: str, kind: str) -> str:
    return f"""SELECT '{column}' AS "column", '{kind}' AS source_type, '{kind}' AS target_type, *
        FROM (SELECT {_measures("source", "s", column)}) AS a,
             (SELECT {_measures("target", "t", column)}) AS b"""


@query(f"""{SIDES_SQL}
    SELECT *, CASE WHEN source_filled = target_filled AND source_least = target_least
                        AND source_greatest = target_greatest
                   THEN 'match' ELSE 'mismatch' END AS status
    FROM ({" UNION ALL ".join(_column_row_sql(c, k) for c, k in COMPARED.items())}) AS r
    UNION ALL
    SELECT 'o_orderpriority', 'string', NULL, CAST(count(o_orderpriority) AS VARCHAR),
           min(o_orderpriority), max(o_orderpriority), NULL, NULL, NULL, 'missing in target'
    FROM s
""")
def reconcile_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Key, amount and status on both sides; the target has no priority."""
    source, target = _sides(spark, folder)
    return compare.reconcile_columns(
        source.select(*COMPARED, "o_orderpriority"), target.select(*COMPARED)
    )


@query("""
    WITH before AS (SELECT o_orderkey, o_orderstatus AS state, o_orderpriority AS priority
                    FROM orders WHERE o_orderpriority <> '1-URGENT'),
         after AS (SELECT o_orderkey,
                          CASE WHEN year(o_orderdate) = 1997 THEN 'F' ELSE o_orderstatus END
                              AS state,
                          nullif(o_orderpriority, '2-HIGH') AS priority
                   FROM orders WHERE o_orderstatus <> 'P')
    SELECT o_orderkey,
           CASE WHEN b.o_orderkey IS NULL THEN 'added'
                WHEN a.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
           b.state AS old_state, a.state AS new_state,
           b.priority AS old_priority, a.priority AS new_priority
    FROM before AS b FULL OUTER JOIN after AS a USING (o_orderkey)
    WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL
       OR b.state IS DISTINCT FROM a.state OR b.priority IS DISTINCT FROM a.priority
""")
def snapshot_changes(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    before = orders.where(F.col("o_orderpriority") != "1-URGENT").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("state"),
        F.col("o_orderpriority").alias("priority"),
    )
    closed = F.when(F.year("o_orderdate") == 1997, "F").otherwise(F.col("o_orderstatus"))
    after = orders.where(F.col("o_orderstatus") != "P").select(
        "o_orderkey",
        closed.alias("state"),
        F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("priority"),
    )
    return compare.snapshot_changes(before, after, "o_orderkey", ["state", "priority"])


@query("""
    SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM orders) AS o
    WHERE place = 1
""")
def latest_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer's latest order."""
    orders = table(spark, folder, "orders")
    return compare.latest_by_key(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus"]
    )


@query("""
    SELECT coalesce(b.o_custkey, a.o_custkey) AS o_custkey, coalesce(old_rows, 0) AS old_rows,
           coalesce(new_rows, 0) AS new_rows
    FROM (SELECT o_custkey, count(*) AS old_rows FROM orders
          WHERE o_orderpriority <> '1-URGENT' GROUP BY 1) AS b
    FULL OUTER JOIN (SELECT o_custkey, count(*) AS new_rows FROM orders
                     WHERE o_orderstatus <> 'P' GROUP BY 1) AS a ON a.o_custkey = b.o_custkey
    WHERE old_rows > 1 OR new_rows > 1
""")
def snapshot_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Customers who stand more than once in either of two lists of orders."""
    orders = table(spark, folder, "orders")
    return compare.snapshot_duplicates(
        orders.where(F.col("o_orderpriority") != "1-URGENT"),
        orders.where(F.col("o_orderstatus") != "P"),
        "o_custkey",
    )


BEFORE_TOTAL = "(n_chars // 60 + doc_id % 45)"
AFTER_TOTAL = "(CASE WHEN lang = 'de' THEN n_chars // 30 ELSE n_chars // 60 END + doc_id % 45)"


@query(f"""
    WITH r AS (SELECT 'doc/' || doc_id AS url, source, lang, {BEFORE_TOTAL} AS old_total,
                      {AFTER_TOTAL} AS new_total FROM documents),
         b AS (SELECT url, source AS name, old_total AS total,
                      {difficulty_sql("old_total")} AS level FROM r WHERE lang <> 'fr'),
         a AS (SELECT url, source AS name, new_total AS total,
                      {difficulty_sql("new_total")} AS level FROM r WHERE lang <> 'es')
    SELECT url,
           CASE WHEN b.url IS NULL THEN 'added' WHEN a.url IS NULL THEN 'removed'
                ELSE 'changed' END AS change,
           b.name AS old_name, a.name AS new_name,
           b.total AS old_total_cook_time, a.total AS new_total_cook_time,
           b.level AS old_difficulty, a.level AS new_difficulty
    FROM b FULL OUTER JOIN a USING (url)
    WHERE b.url IS NULL OR a.url IS NULL OR b.name IS DISTINCT FROM a.name
       OR b.total IS DISTINCT FROM a.total
""")
def recipe_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Two dumps of the archive: French came, Spanish went, German takes twice as long."""
    recipes = document_recipes(spark, folder)
    chars = F.regexp_extract("cookTime", "[0-9]+", 0).cast("bigint")
    longer = F.when(F.col("description") == "de", iso("PT", chars * 2, "S"))
    before = fresh_folder(spark, "before")
    after = fresh_folder(spark, "after")
    changes = fresh_folder(spark, "changes")
    write_files(recipes.where(F.col("description") != "fr"), before, "json")
    write_files(
        recipes.where(F.col("description") != "es").withColumn(
            "cookTime", F.coalesce(longer, "cookTime")
        ),
        after,
        "json",
    )
    change_job.run(spark, before, after, changes)
    return read_files(spark, "parquet", changes)
