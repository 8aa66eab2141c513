"""Rules of a result file, over its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXAMPLES = 5
HEADERS = {"matching": ["source1_entity_id", "matched_entity_ids"], "candidate": ["source1_entity_id", "candidate_entity_ids"]}


def header_error(line: str | None, kind: str) -> str | None:
    """What is wrong with the first line, or None."""
    if not line:
        return "the file is empty"
    if "\t" not in line and "," in line:
        return "the header has commas and no tab: the file must be tab-separated"
    found = [c.strip().lower() for c in line.rstrip("\n").split("\t")]
    return None if found == HEADERS[kind] else f"unexpected header {found}, expected {HEADERS[kind]}"


def report(lines: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """rule, offenders, examples (up to five, sorted) for each rule that is broken.

    lines: value (a line after the header); required: entity_id of the reference; valid: entity_id of the targets,
    where unknown ids count as errors.
    """
    tab = F.instr("value", "\t")
    broken = lines.where((tab == 0) & (F.trim("value") != "")).select(F.lit("malformed_row").alias("rule"), F.col("value").alias("x"))
    rows = lines.where(tab > 0).select(F.substring_index("value", "\t", 1).alias("s1"), F.expr("substring(value, instr(value, '\t') + 1)").alias("rest"))
    listed = rows.withColumn("ids", F.when(F.trim("rest") == "", F.array().cast("array<string>")).otherwise(F.split("rest", ",")))
    twice = rows.groupBy("s1").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_row").alias("rule"), F.col("s1").alias("x"))
    repeated = listed.where(F.size("ids") != F.size(F.array_distinct("ids"))).select(F.lit("duplicate_id_in_list").alias("rule"), F.col("s1").alias("x"))
    ids = listed.select(F.explode("ids").alias("x"))
    itself = ids.where(F.col("x").startswith("S1-")).select(F.lit("self_match").alias("rule"), "x")
    targeted = F.col("x").startswith("S2-") | F.col("x").startswith("S3-")
    prefix = ids.where(~targeted & ~F.col("x").startswith("S1-")).select(F.lit("wrong_prefix").alias("rule"), "x")
    wanted, seen = required.select(F.col("entity_id").alias("x")).distinct(), rows.select(F.col("s1").alias("x")).distinct()
    found = [broken, twice, repeated, itself, prefix, wanted.join(seen, "x", "left_anti").select(F.lit("missing_s1").alias("rule"), "x"), seen.join(wanted, "x", "left_anti").select(F.lit("unexpected_s1").alias("rule"), "x")]
    if valid is not None:
        known = valid.select(F.col("entity_id").alias("x")).distinct()
        found.append(ids.where(targeted).join(known, "x", "left_anti").select(F.lit("unknown_id").alias("rule"), "x"))
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    every = every.distinct()
    counts = every.groupBy("rule").agg(F.count("*").alias("offenders"))
    # the first few of a rule, by a top-k that never holds them all
    from pyspark.sql.window import Window

    first = every.withColumn("_r", F.row_number().over(Window.partitionBy("rule").orderBy("x"))).where(F.col("_r") <= EXAMPLES)
    few = first.groupBy("rule").agg(F.array_join(F.sort_array(F.collect_list("x")), ", ").alias("examples"))
    return counts.join(few, "rule").select("rule", "offenders", "examples")


def validate_files(spark, matching: str, required: DataFrame, candidate: str | None = None, valid: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """(errors, warnings) of the result files; a path may be any that Spark reads."""
    from tesserae.operators.output import subset_violations

    errors, warnings, tables = [], [], {}
    if valid is None:
        warnings.append("ids are not checked against the targets")
    for kind, path in (("matching", matching), ("candidate", candidate)):
        if path is None:
            continue
        try:
            lines = spark.read.text(path)
            first = lines.first()
        except Exception as error:  # a missing path is a finding, other failures are not
            if "PATH_NOT_FOUND" not in str(error):
                raise
            (errors if kind == "matching" else warnings).append(f"{path} not found")
            continue
        head = first["value"] if first else None
        if wrong := header_error(head, kind):
            errors.append(f"{kind}: {wrong}")
            continue
        body = lines.where(F.col("value") != head)
        for row in report(body, required, valid).collect():
            errors.append(f"{kind}: {row['rule']}: {row['offenders']}, e.g. {row['examples']}")
        tables[kind] = body.where(F.instr("value", "\t") > 0).select(F.substring_index("value", "\t", 1).alias("source1_entity_id"), F.expr("substring(value, instr(value, '\t') + 1)").alias(HEADERS[kind][1]))
    if len(tables) == 2 and (n := subset_violations(tables["matching"], tables["candidate"]).select("source1_entity_id").distinct().count()):
        warnings.append(f"{n} entities have matches that are no candidates")
    return errors, warnings
