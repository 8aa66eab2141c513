"""The engine against its SQL, against plain forms, and the pipeline end to end."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tesserae.operators import metrics as M
from tesserae.operators import output as O
from tesserae.operators import threshold as H
from tesserae.operators import truth as G
from tesserae.operators import validate as W
from tesserae.plans.oracle import ORACLE_SQL
from tesserae.plans.queries import QUERIES, Tables
from tests.conftest import DATA

CHECKED = ("clean_source", "block_exact_core", "block_rare_name_token", "label_candidates", "features_numeric", "threshold_sweep", "matching_results", "validate_report", "sim_token_set")


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for name in ("customer", "nation"):
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return made


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda df: sorted(tuple(str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))
    assert rows(got) == rows(want) and len(got)


def test_registered_sql_covers_all_but_learned_scores():
    assert set(QUERIES) - set(ORACLE_SQL) == {"sim_partial", "sim_wratio", "features_all", "gbt_score"}


def test_f_score_examples(spark):
    rows = spark.createDataFrame([(2, 2, 3, 0.714286), (0, 0, 0, 1.0), (0, 0, 1, 0.0), (0, 2, 0, 0.0)], "tp int, n_actual int, n_predicted int, wanted double")
    for r in rows.withColumn("got", F.round(M.f_beta(F.col("tp"), F.col("n_actual"), F.col("n_predicted")), 6)).collect():
        assert r["got"] == r["wanted"]


def test_sweep_equals_each_threshold(spark):
    t = Tables(spark, DATA)
    swept = {round(r["threshold"], 2): r for r in H.sweep(t.scored, t.truth).collect()}
    assert len(swept) == 90
    for cut in (0.1, 0.25, 0.57, 0.99):
        one = M.macro(M.per_entity(t.ids, t.truth, t.scored.where(F.col("probability") >= cut))).first()
        assert abs(one["macro_f05"] - swept[cut]["macro_f05"]) < 1e-9
    predicted = [swept[k]["predicted"] for k in sorted(swept)]
    assert predicted == sorted(predicted, reverse=True)


def test_split_is_disjoint_and_sized(spark):
    ids = spark.range(997).select(F.concat(F.lit("S1-"), "id").alias("source1_entity_id"))
    parts = {r["part"]: r["n"] for r in G.split(ids).groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert parts == {"train": 798, "validation": 199}
    with pytest.raises(ValueError):
        G.split(ids, 1.0)


def test_header_rules():
    assert W.header_error("", "matching") and "comma" in W.header_error("a,b", "matching")
    assert W.header_error("Source1_Entity_ID\t matched_entity_ids", "matching") is None


def test_subset(spark):
    m = spark.createDataFrame([("a", "x,y"), ("b", "")], "source1_entity_id string, matched_entity_ids string")
    c = spark.createDataFrame([("a", "x"), ("b", "z")], "source1_entity_id string, candidate_entity_ids string")
    assert [tuple(r) for r in O.subset_violations(m, c).collect()] == [("a", "y")]


def test_files_round_trip(spark, tmp_path):
    from tesserae.sources import files

    rows = spark.createDataFrame([("S1-1", "NA"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    path = files.write_tsv(rows, str(tmp_path / "m.tsv"))
    assert open(path).read() == "source1_entity_id\tmatched_entity_ids\nS1-1\tNA\nS1-2\t\n"
    assert sorted(map(tuple, files.read_tsv(spark, path, files.MATCHING).collect())) == [("S1-1", "NA"), ("S1-2", "")]
    with pytest.raises(ValueError):
        files.read_tsv(spark, path, ("other",))
    files.save_threshold(str(tmp_path / "t.json"), 0.4)
    assert files.load_threshold(str(tmp_path / "t.json")) == 0.4


def test_pipeline_end_to_end(spark, tmp_path):
    """All stages, then the test stages again from the saved artefacts, for other test data and in a folder for each kind."""
    from tesserae.plans.config import Blocking, Config, Thresholds, Training
    from tesserae.plans.pipeline import Run, call, infer, run
    from tesserae.sources import files

    raw, data, out = Tables(spark, DATA).raw, str(tmp_path / "in"), str(tmp_path / "out")
    for kind in ("train", "test"):
        for n in (1, 2, 3):
            files.write_tsv(raw[f"s{n}"], f"{data}/{kind}/{kind}_source{n}.tsv")
    files.write_tsv(raw["truth"], f"{data}/train/train_ground_truth.tsv")
    assert files.find_data(spark, [str(tmp_path / "none"), data]) == data
    parts = dict(blocking=Blocking(passes=("exact_core", "exact_address", "numeric_address", "rare_name")), training=Training(rounds=5, depth=2, rate=0.3))
    errors, warnings = run(spark, data, out, Config(**parts))
    assert errors == [] and warnings == []
    lines = open(tmp_path / "out" / "matching_results.tsv").read().splitlines()
    assert len(lines) == 151 and any("S2-" in line for line in lines)
    assert len(files.read_json(f"{out}/model_feature_schema.json")["feature_columns"]) == 44
    facts = files.read_json(f"{out}/experiment.json")
    assert facts["config"]["training"]["rounds"] == 5 and "threshold" in facts["facts"]

    fewer = raw["s1"].orderBy("entity_id").limit(40)
    files.write_tsv(fewer, f"{data}/test/test_source1.tsv")
    assert infer(spark, data, out, Config(**parts)) == ([], [])
    again = open(tmp_path / "out" / "matching_results.tsv").read().splitlines()
    assert len(again) == 41 and set(again) <= set(lines)

    closed = Config(**parts, thresholds=Thresholds(s3=1.1))
    call(Run(spark, data, out, closed), ["results"])
    assert not any("S3-" in line for line in open(tmp_path / "out" / "matching_results.tsv").read().splitlines()[1:])


def test_encodings_line_breaks_and_archives(spark, tmp_path):
    import zipfile

    from tesserae.sources import files

    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    for name, text, encoding in (("u", "S1-1\tCaf\u00e9 \ufffd\tx\tFR\n", "utf-8"), ("l", "S1-1\tCaf\u00e9\tx\tFR\n", "latin-1"), ("b", 'S1-1\t"a\nb ""c"""\tx\t\n', "utf-8")):
        (tmp_path / f"{name}.tsv").write_bytes((head + text).encode(encoding))
    read = lambda n: [tuple(r) for r in files.read_source(spark, str(tmp_path / f"{n}.tsv")).collect()]
    assert files.layout(spark, str(tmp_path / "u.tsv")) == ("UTF-8", False)
    assert read("u") == [("S1-1", "Caf\u00e9 \ufffd", "x", "FR")] and read("l") == [("S1-1", "Caf\u00e9", "x", "FR")]
    assert read("b") == [("S1-1", 'a\nb "c"', "x", "")]
    files.pack(str(tmp_path), str(tmp_path / "all.zip"))
    with zipfile.ZipFile(tmp_path / "all.zip") as z:
        assert z.namelist() == ["b.tsv", "l.tsv", "u.tsv"] and z.read("l.tsv") == (tmp_path / "l.tsv").read_bytes()
    scored = spark.createDataFrame([(1, 0.5, 0.25)], "is_match int, a double, b double")
    files.write_label_first_csv(scored, ["b", "a"], str(tmp_path / "csv"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "csv")).collect()] == ["1,0.250000,0.500000"]
    for n in (1, 2):
        files.append_parquet(spark.range(n), str(tmp_path / "grown"))
    assert spark.read.parquet(str(tmp_path / "grown")).count() == 3


def test_draws_equal_sorting(spark):
    from tesserae.operators import pairs as P

    rows = spark.range(500).select(F.concat(F.lit("S1-"), F.col("id") % 70).alias("source1_entity_id"), F.concat(F.lit("S2-"), "id").alias("candidate_entity_id"), F.lit(0).alias("is_match"))
    for n in (0, 1, 37, 499, 500, 900):
        want = rows.orderBy(G.hash_order(7, *P.KEY), *P.KEY).limit(n)
        assert sorted(map(tuple, P.easy_negatives(rows, n, 7).collect())) == sorted(map(tuple, want.collect()))


def test_search_keeps_the_best(spark):
    from tesserae.operators import model as L

    rows = spark.range(300).select(F.concat(F.lit("S1-"), "id").alias("source1_entity_id"), F.concat(F.lit("S2-"), "id").alias("candidate_entity_id"), F.lit("S2").alias("candidate_source"), ((F.col("id") % 7 + F.col("id") % 3) > 4).cast("int").alias("is_match"), (F.col("id") % 7).cast("double").alias("name_jaccard"), (F.col("id") % 3).cast("double").alias("name_containment"))
    best, area = L.search(rows, rows, {"depth": (1, 4)}, rounds=2, depth=1)
    assert best["depth"] == 4 and area > 0.95


@pytest.mark.parametrize("name", ["block_fuzzy_name", "block_fuzzy_address"])
def test_fuzzy_passes_equal_sql(spark, con, name):
    test_query_equals_sql(spark, con, name)


def test_stream_matches_like_batch(spark, tmp_path):
    from tesserae.functions.text import clean
    from tesserae.operators.blocking import exact_core
    from tesserae.streaming.cleaning import match_stream, read_stream, write_stream

    raw = Tables(spark, DATA).raw
    raw["s2"].write.csv(str(tmp_path / "in"), sep="\t", header=True)
    write_stream(match_stream(read_stream(spark, str(tmp_path / "in")), clean(raw["s1"])), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("source1_entity_id", "candidate_entity_id").collect()}
    want = {(r[0], r[1]) for r in exact_core(clean(raw["s1"]), clean(raw["s2"]), "S2").collect()}
    assert got == want and got


ROW_BY_ROW = ("block_all", "label_candidates", "pair_records", "sim_jaccard", "sim_containment", "sim_overlap", "sim_common", "features_name", "features_address", "features_numeric", "features_country", "features_structural", "features_interaction", "linear_score", "hard_negative_pool")
FOLDED = ("entity_eval", "macro_f05", "predictions_at", "matching_results", "errors_fp", "errors_singleton", "easy_negatives", "hard_negatives", "blocking_report", "recall_by_country")


def _above_pairs(df) -> list[str]:
    """The lines of the optimised plan, those over the join that makes the pairs first; kept tables are looked into."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return lines[: next(i for i, line in enumerate(lines) if "Join Inner" in line and "_key" in line)]


@pytest.mark.parametrize("name", ROW_BY_ROW)
def test_pairs_are_not_shuffled(spark, name):
    assert not [line for line in _above_pairs(QUERIES[name](spark, DATA)) if any(w in line for w in ("Aggregate", "Join", "Sort", "Window", "Repartition"))]


@pytest.mark.parametrize("name", FOLDED)
def test_folded_pairs_equal_sql(spark, con, name):
    test_query_equals_sql(spark, con, name)


def test_pairs_of_several_keys_are_made_once(spark):
    from tesserae.operators import blocking as B

    schema = "entity_id string, business_name_norm string, business_name_core string, business_address_norm string"
    s1 = spark.createDataFrame([("a", "acme tool shop", "acme tool", "1234 lake 5678"), ("a", "other name", "other", ""), ("b", "none", "", "")], schema)
    s2 = spark.createDataFrame([("x", "acme tool shop", "acme tool", "1234 lake 5678"), ("x", "acme name", "other", ""), ("y", "tool shop shop", "tool", "lake 5678 1234"), ("z", "nothing", "", "")], schema)
    got = sorted(map(tuple, B.all_passes(s1, {"S2": s2}).collect()))
    plain = None
    for make in (B.exact_name, B.exact_core, B.exact_address, B.numeric_address, lambda *a: B.rare_tokens(*a[:2], "business_name_norm", a[2]), lambda *a: B.rare_tokens(*a[:2], "business_address_norm", a[2])):
        one = make(s1, s2, "S2")
        plain = one if plain is None else plain.unionByName(one)
    assert got == sorted(map(tuple, plain.distinct().collect())) == [("a", "x", "S2"), ("a", "y", "S2")]


def test_a_key_is_listed_where_it_makes_pairs(spark):
    """One list for each reference id serves all sources; a source's records keep no key that the reference lacks or that counts for another source alone."""
    from tesserae.operators import blocking as B

    schema = "entity_id string, business_name_norm string, business_name_core string, business_address_norm string"
    s1 = spark.createDataFrame([("a", "tool shop", "tool", "")], schema)
    s2 = spark.createDataFrame([("x", "tool shop", "tool", ""), ("y", "tool none", "none", "")], schema)
    s3 = spark.createDataFrame([("z", "shop none", "tool", ""), ("w", "shop", "", "")], schema)
    kept = {(r["_id"], r["candidate_source"]): r["_keys"] for r in B.sides(s1, {"S2": s2, "S3": s3}).collect()}
    assert kept == {("a", None): ["0shop", "0tool", "3tool", "4tool shop"], ("x", "S2"): ["0tool", "3tool", "4tool shop"], ("y", "S2"): ["0tool"], ("z", "S3"): ["0shop", "3tool"], ("w", "S3"): ["0shop"]}
    pairs = sorted(map(tuple, B.all_passes(s1, {"S2": s2, "S3": s3}).collect()))
    assert pairs == [("a", "w", "S3"), ("a", "x", "S2"), ("a", "y", "S2"), ("a", "z", "S3")]


@pytest.mark.parametrize("name", ("pair_records", "features_country", "features_interaction", "features_name", "features_numeric", "sim_containment"))
def test_a_side_reads_its_own_records_alone(spark, name):
    """The kept tables that the plan reads: the keys and the records of either side, and the list of true pairs where is_match is asked for."""
    kept, inside = [], None
    for line in QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is None or depth <= inside:  # below it stands how a kept table is made
            inside = depth if "InMemoryRelation" in line else None
            kept += [line] if "InMemoryRelation" in line else []
    records = [x for x in kept if "business_name_norm" in x]
    assert len(records) == 3 and len([x for x in kept if "_keys" in x]) == 2
    assert len([x for x in kept if "matched" in x]) == (name == "pair_records")


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """Customers twice, the last key of the first copy being the first of the second: records and true pairs come twice."""
    made, at = duckdb.connect(), tmp_path_factory.mktemp("repeated")
    made.execute(f"COPY (SELECT c.* REPLACE (c_custkey + i * 19 AS c_custkey) FROM '{DATA}/customer.parquet' c, range(2) r(i) WHERE c_custkey < 20) TO '{at}/customer.parquet' (FORMAT parquet)")
    made.execute(f"COPY (SELECT * FROM '{DATA}/nation.parquet') TO '{at}/nation.parquet' (FORMAT parquet)")
    for name in ("customer", "nation"):
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet'")
    return str(at), made


@pytest.mark.parametrize("name", ("label_candidates", "pair_records", "entity_eval", "macro_f05", "recall_by_country"))
def test_repeated_records_equal_sql(spark, repeated, name):
    got, want = QUERIES[name](spark, repeated[0]).toPandas(), repeated[1].execute(ORACLE_SQL[name]).df()
    rows = lambda df: sorted(tuple(str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))
    assert rows(got) == rows(want) and len(got)


def test_shared_elements(spark):
    from tesserae.functions import similarity as S

    words = [[f"w{i}" for i in range(n)] for n in (0, 1, 3, 4, 5, 12, 13, 30)]
    df = spark.createDataFrame([(a, b[::2] + ["x"]) for a in words for b in words], "a array<string>, b array<string>")
    got = df.select(S.shared(F.col("a"), F.col("b")).alias("n"), F.size(F.array_intersect("a", "b")).alias("m"), S.jaccard(F.col("a"), F.col("b"), S.shared(F.col("a"), F.col("b"))).alias("j"), S.jaccard(F.col("a"), F.col("b")).alias("k"))
    assert got.where("n <> m or j <> k").isEmpty()


IN_BLOCKS = ("sim_jaccard", "sim_common", "sim_overlap", "sim_containment", "features_interaction", "features_name", "features_address", "features_numeric", "entity_eval", "macro_f05", "predictions_at", "matching_results", "linear_score", "errors_fp")


@pytest.mark.parametrize("name", IN_BLOCKS)
def test_pairs_are_worked_on_in_blocks(spark, name):
    """No expression of the engine takes a pair's word lists or rounds its values: both cost more than all else of a pair."""
    above = _above_pairs(QUERIES[name](spark, DATA))
    blocks = [i for i, line in enumerate(above) if "MapInArrow" in line]
    assert blocks and not [line for line in above if "array_contains" in line or "arrays_overlap" in line]
    assert name in FOLDED or not [line for line in above if "round(" in line]


ODD = ("", " ", "a", "acme  tool\x1cshop", "tool acme tool", "café ١٢٣ 12", "12 12 345, 7a89 345", "x" * 70 + " 12", "x" * 64 + " y", " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(20, 70)), " acme tool")


def test_blocks_equal_columns(spark):
    from tesserae.operators import blocks as K
    from tesserae.operators import features as V
    from tesserae.operators import model as L

    fields = [f"{f}_{{}} string" for f in ("business_name_norm", "business_name_core", "business_address_norm", "country_norm")]
    schema = lambda ids, n: ", ".join([ids, "_keys array<string>", *fields]).format(*[n] * 4)
    left = spark.createDataFrame([(f"S1-{i:02}", ["0k"], x, x[:9], ODD[-1 - i], x[:3]) for i, x in enumerate(ODD)], schema("source1_entity_id string", 1))
    right = spark.createDataFrame([(f"S2-{i:02}", "S2", ["0k"], x, x[:9], ODD[i - 3], x[:3]) for i, x in enumerate(ODD)], schema("candidate_entity_id string, candidate_source string", 2))
    rows = left.drop("_keys").join(right.drop("_keys"))
    made = V.name_features() | V.address_features() | V.numeric_features() | V.country_features() | V.interaction_features()
    names = sorted(n for n in made if not n.endswith(("jaro_winkler", "partial_ratio")))
    scored = L.linear_score(V.features(rows, as_float=False)).select("source1_entity_id", "candidate_entity_id", "probability")
    plain = V.with_scores(rows).select("source1_entity_id", "candidate_entity_id", *[F.round(made[n].cast("double"), 6).alias(n) for n in names]).join(scored, ["source1_entity_id", "candidate_entity_id"])
    got = K.met(left, right, {c: c for c in plain.columns}).select(*[F.col(c).cast(t) for c, t in plain.dtypes])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect())) and got.count() == len(ODD) ** 2


def test_rounding_equals_the_engines(spark):
    import numpy as np

    from tesserae.operators import blocks as K

    values = np.concatenate((np.arange(1, 4000) / 64.0**3, np.random.default_rng(7).random(4000), (np.arange(4000) * 2 + 1) / 2e6, (np.arange(4000) * 2 + 1) / 3 / 2e6, [0.0, 1.0, 17.0]))
    want = [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "v double").select(F.round("v", 6)).collect()]
    assert K.rounded(values).tolist() == want


def test_chunks_hold_all_pairs(spark, con, monkeypatch):
    """Blocks and chunks of a few records: keys with more pairs than a chunk and rows with more records than a block are cut, none is lost."""
    import pyarrow as pa

    from tesserae.operators import blocks as K

    monkeypatch.setattr(K, "CHUNK", 5), monkeypatch.setattr(K, "RECORDS", 4)
    one = lambda prefix, n, before: [{"_id": f"{prefix}{i}", "_before": before if i % 2 else []} for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"_left": [one("a", 7, ["k"]), one("b", 1, []), one("c", 2, [])], "_right": [one("x", 9, ["k"]), one("y", 2, ["k"]), one("z", 1, [])]}, schema=pa.schema([(n, pa.list_(pa.struct([("_id", pa.string()), ("_before", pa.list_(pa.string()))]))) for n in ("_left", "_right")]))
    got = []
    for rows in K._slices(batch):
        block = K.Block(rows)
        for chunk in block.chunks():
            got += zip(block.left["_id"].take(pa.array(chunk.left)).to_pylist(), block.right["_id"].take(pa.array(chunk.right)).to_pylist())
    want = [(f"a{i}", f"x{j}") for i in range(7) for j in range(9) if not (i % 2 and j % 2)] + [("b0", "y0"), ("b0", "y1"), ("c0", "z0"), ("c1", "z0")]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("name", ("linear_score", "sim_common", "matching_results"))
def test_repeated_pairs_of_blocks_equal_sql(spark, repeated, name):
    test_repeated_records_equal_sql(spark, repeated, name)
