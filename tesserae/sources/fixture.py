"""Linkage tables made from customers and nations: one clean reference source, two noisy ones, and the truth.

Some records of the second source look like a reference entity that has no match, and some of the third have its whole address.

The expressions are plain SQL that Spark and DuckDB both read, so that checks start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAME = """concat(CASE c_custkey % 6 WHEN 0 THEN 'Acme' WHEN 1 THEN 'Nova' WHEN 2 THEN 'Société' WHEN 3 THEN 'Café' WHEN 4 THEN 'Delta' ELSE 'Orion' END,
 ' zed', CAST(c_custkey % 401 AS STRING), ' ', CASE c_custkey % 5 WHEN 0 THEN 'Traders' WHEN 1 THEN 'Foods' WHEN 2 THEN 'Textiles' WHEN 3 THEN 'Motors' ELSE 'Systems' END)"""

#: Common table expressions over the tables customer and nation.
CTES = {
    "er_base": f"""SELECT c_custkey AS k, n_name AS country, {NAME} AS nm, CAST(100 + c_custkey % 883 AS STRING) AS house,
 CASE c_custkey % 4 WHEN 0 THEN 'Lake' WHEN 1 THEN 'Hill' WHEN 2 THEN 'Station' ELSE 'Market' END AS street, CAST(560000 + c_custkey % 4999 AS STRING) AS pin
 FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "er_source1": """SELECT concat('S1-', lpad(CAST(k AS STRING), 9, '0')) AS entity_id,
 concat(nm, CASE k % 3 WHEN 0 THEN ' Pvt. Ltd.' WHEN 1 THEN ' LLC' ELSE '' END) AS business_name,
 concat(house, ', ', street, ' Rd, Block ', CAST(k % 17 AS STRING), ', ', pin) AS business_address, country FROM er_base""",
    "er_source2": """SELECT concat('S2-', lpad(CAST(k * 2 + d AS STRING), 9, '0')) AS entity_id,
 CASE (k + d) % 4 WHEN 0 THEN concat(nm, ' Private Limited') WHEN 1 THEN upper(nm) WHEN 2 THEN concat(substr(nm, 1, 2), substr(nm, 4)) ELSE concat('The ', nm, ' & Co') END AS business_name,
 CASE WHEN k % 30 = 7 THEN '' ELSE concat(house, ' ', street, ' Road ', pin) END AS business_address, CASE WHEN k % 41 = 3 THEN '' ELSE country END AS country
 FROM er_base CROSS JOIN (SELECT 0 AS d UNION ALL SELECT 1 AS d) dup WHERE k % 5 <> 0 AND (d = 0 OR k % 7 = 0)
 UNION ALL SELECT concat('S2-', lpad(CAST(900000000 + k AS STRING), 9, '0')), concat(nm, ' LLC'), concat(house, ' ', street, ' Road ', pin), country FROM er_base WHERE k % 20 = 5 AND k % 3 <> 0""",
    "er_source3": """SELECT concat('S3-', lpad(CAST(k AS STRING), 9, '0')) AS entity_id, concat(nm, ' Inc.') AS business_name,
 CASE WHEN k % 12 = 0 THEN concat(house, ', ', street, ' Road, Block ', CAST(k % 17 AS STRING), ', ', pin)
 ELSE concat(street, ' St near SBI ATM, ', CASE WHEN k % 2 = 0 THEN pin ELSE house END) END AS business_address, country FROM er_base WHERE k % 3 = 0""",
    "er_pairs": """SELECT concat('S1-', lpad(CAST(k AS STRING), 9, '0')) AS source1_entity_id, concat('S2-', lpad(CAST(k * 2 + d AS STRING), 9, '0')) AS candidate_entity_id
 FROM er_base CROSS JOIN (SELECT 0 AS d UNION ALL SELECT 1 AS d) dup WHERE k % 5 <> 0 AND (d = 0 OR k % 7 = 0)
 UNION ALL SELECT concat('S1-', lpad(CAST(k AS STRING), 9, '0')), concat('S3-', lpad(CAST(k AS STRING), 9, '0')) FROM er_base WHERE k % 3 = 0""",
}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """s1, s2, s3 (entity_id, business_name, business_address, country), truth (source1_entity_id, matched_entity_ids) and its pairs as they are listed."""
    from pyspark.sql import functions as F

    read = lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    made: dict[str, DataFrame] = {"customer": read("customer"), "nation": read("nation")}
    for name, sql in CTES.items():
        used = {t: made[t] for t in ("customer", "nation", "er_base") if t in made and t in sql}
        # DataFrames as arguments leave no temporary views behind
        text = sql
        for t in used:
            text = text.replace(f" {t} ", f" {{{t}}} ").replace(f"FROM {t}", f"FROM {{{t}}}").replace("{{", "{").replace("}}", "}")
        made[name] = spark.sql(text, **used)
    lists = made["er_pairs"].groupBy("source1_entity_id").agg(F.array_join(F.sort_array(F.collect_set("candidate_entity_id")), ",").alias("matched_entity_ids"))
    truth = made["er_source1"].select(F.col("entity_id").alias("source1_entity_id")).join(lists, "source1_entity_id", "left").na.fill("", ["matched_entity_ids"])
    return {"s1": made["er_source1"], "s2": made["er_source2"], "s3": made["er_source3"], "truth": truth, "pairs": made["er_pairs"]}


