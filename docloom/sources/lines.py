"""Line tables: from document rows, and generated tender lines for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.plans.tables import written

#: One text for Spark and for the SQL check: tender lines from customer, nation and region. Spark writes p out, as it has many readers.
CUSTOMER_SQL = """
WITH c AS (
  SELECT concat('f_', lower(replace(r.r_name, ' ', '_'))) AS file_id,
         lpad(cast(r.r_regionkey + 1 AS varchar(2)), 2, '0') AS rr,
         lpad(cast(n.n_nationkey + 1 AS varchar(2)), 2, '0') AS nn,
         r.r_name, n.n_name, n.n_nationkey, c.c_custkey, c.c_mktsegment,
         row_number() OVER (PARTITION BY n.n_nationkey ORDER BY c.c_custkey) AS k
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT c.*, translate(cast(c_custkey AS varchar(12)), '0123456789', 'abcdefghij') AS tag, n_nationkey * 1000 + cast(floor((k - 1) / 20) AS int) AS page, cast((k - 1) % 20 AS int) AS i FROM c
"""
LINES_SQL = """
SELECT file_id, page, cast(1000 - slot AS double) AS y, cast(0 AS double) AS x, text,
       row_number() OVER (PARTITION BY file_id ORDER BY page, slot) AS line_ord
FROM (
  SELECT DISTINCT file_id, page, 0 AS slot, concat('Seite ', cast(page AS varchar(8)), ' von 99') AS text FROM p
  UNION ALL SELECT DISTINCT file_id, min(page) OVER (PARTITION BY file_id), 1, concat(rr, ' ', r_name, ' ...') FROM p
  UNION ALL SELECT DISTINCT file_id, page, 2, concat(rr, '.', nn, ' ', n_name, ' .....') FROM p WHERE k = 1
  UNION ALL SELECT file_id, page, 10 + i * 5, concat(rr, '.', nn, '.', lpad(cast(k AS varchar(4)), 4, '0'),
       CASE WHEN c_custkey % 17 = 0 THEN ' Entfällt' ELSE concat(' Lieferung ', c_mktsegment) END) FROM p
  UNION ALL SELECT file_id, page, 11 + i * 5, concat(CASE c_custkey % 5
       WHEN 0 THEN 'Fabrikat: BRIX oder gleichwertig' WHEN 1 THEN 'Ausführung muss DIN 79008 entsprechen'
       WHEN 2 THEN 'Farbe soll RAL 7016 sein'         WHEN 3 THEN 'optional mit Zubehör'
       ELSE 'siehe Grundrissplan und Position "Lieferung MACHINERY"' END, ' ', tag) FROM p WHERE c_custkey % 17 <> 0
  UNION ALL SELECT file_id, page, 12 + i * 5, concat(cast(1 + c_custkey % 9 AS varchar(2)), CASE c_custkey % 4
       WHEN 0 THEN ' St' WHEN 1 THEN ' psch' WHEN 2 THEN ' m² Wand' ELSE ' Stück' END,
       CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat(' je ', tag) END) FROM p WHERE c_custkey % 17 <> 0
  UNION ALL SELECT file_id, page, 13 + i * 5, '..........' FROM p WHERE c_custkey % 17 <> 0
  UNION ALL SELECT DISTINCT file_id, page, 998, 'Planungsbüro Muster GmbH' FROM p
  UNION ALL SELECT file_id, max(page), 997, concat('Summe ', min(rr)) FROM p GROUP BY file_id) l
"""
TENDER_SQL = f"WITH p AS ({CUSTOMER_SQL}) {LINES_SQL}"

#: The same for prose tenders: a preamble, headings and lists.
PROSE_SQL = """
WITH s AS (
  SELECT s_suppkey, s_nationkey, concat('prose_', cast(s_nationkey % 5 AS varchar(2))) AS file_id, translate(cast(s_suppkey AS varchar(12)), '0123456789', 'abcdefghij') AS tag FROM supplier),
l AS (
  SELECT DISTINCT file_id, s_nationkey AS page, 0 AS slot, 'Background and general conditions' AS text FROM s WHERE s_nationkey < 10
  UNION ALL SELECT file_id, s_nationkey, 1 + s_suppkey * 6, CASE s_suppkey % 3 WHEN 0 THEN 'REQUIREMENTS' WHEN 1 THEN concat('Section ', tag, ':') ELSE 'Maintenance and care' END FROM s
  UNION ALL SELECT file_id, s_nationkey, 2 + s_suppkey * 6, concat(cast(1 + s_suppkey % 20 AS varchar(3)), '. Supply the ', tag, ' unit or equivalent') FROM s
  UNION ALL SELECT file_id, s_nationkey, 3 + s_suppkey * 6, concat('• Deliver item ', tag, ' within ', cast(s_suppkey AS varchar(8)), ' days') FROM s
  UNION ALL SELECT file_id, s_nationkey, 4 + s_suppkey * 6, concat('The contractor shall insure ', tag, ' against loss. All works ', tag, ' must follow the standard. Plain text stays.') FROM s
  UNION ALL SELECT file_id, s_nationkey, 5 + s_suppkey * 6, concat('- ab ', tag, ' mindestens einmal im Jahr') FROM s WHERE s_suppkey % 4 = 0)
SELECT file_id, page, cast(100000 - slot AS double) AS y, cast(0 AS double) AS x, text,
       row_number() OVER (PARTITION BY file_id ORDER BY page, slot, text) AS line_ord
FROM l
"""


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)


def tender_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "customer", "nation", "region")
    written(spark.sql(CUSTOMER_SQL), "customers").createOrReplaceTempView("p")
    return written(spark.sql(LINES_SQL), "lines")


def prose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "supplier")
    return written(spark.sql(PROSE_SQL), "lines")


def document_lines(docs: DataFrame) -> DataFrame:
    """Lines of document rows: file = source, page = doc_id, line_ord by page and place."""
    each = docs.select(F.col("source").alias("file_id"), F.col("doc_id").alias("page"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "text"))
    return each.select("file_id", "page", (-F.col("i")).cast("double").alias("y"), F.lit(0.0).alias("x"), "text", (F.col("page") * (1 << 24) + F.col("i")).alias("line_ord"))
