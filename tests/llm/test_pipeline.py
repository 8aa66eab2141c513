"""The pipeline: each stage against its operator's brute form on a small fixture, and the columns it returns."""

from collections import Counter

from tesserae.llm import common
from tests.conftest import DATA
from tests.llm.test_operators import brute_components, docs, empty, words  # noqa: F401


def test_stages(spark):
    import corpus_pipeline as p

    docs, scratch = common.table(spark, DATA, "documents"), common.Scratch(spark, "t")
    columns, kept = docs.columns, [docs]
    for i, (_, stage) in enumerate(p.STAGES):
        kept.append(scratch.save(stage(spark, kept[-1], DATA), f"s{i}"))
        assert i == len(p.STAGES) - 1 or kept[-1].columns == columns
    ids = [Counter(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
    assert ids[1] <= ids[0] and ids[2] <= ids[1]
    before = [(r["doc_id"], r["text"]) for r in kept[2].collect()]
    assert set(ids[3]) == {c for _, _, c in brute_components(before, 5, 8, 10)} and max(ids[3].values()) == 1
    sizes = [sum(len(words(r["text"])) for r in k.collect()) for k in kept[3:5]]
    assert abs(sizes[0] - sizes[1]) <= 30
    assert {r["doc_id"] for r in kept[5].collect()} == set(ids[4])


def test_stages_take_nulls_clashes_and_nothing(spark, docs, empty):
    """Each stage over odd rows with clashing columns, and over none: the columns stay, nothing is made up."""
    import corpus_pipeline as p

    texts = {r["text"] for r in docs.collect()}
    for i, (name, stage) in enumerate(p.STAGES):
        found, nothing = stage(spark, docs, DATA), stage(spark, empty, DATA)
        assert nothing.count() == 0, name
        if i < len(p.STAGES) - 1:
            assert found.columns == docs.columns and nothing.columns == docs.columns, name
            if name != "mixing":  # which cuts the last row of a source
                assert {r["text"] for r in found.collect()} <= texts, name


def test_queries_equal_sql(spark):
    import duckdb

    from tesserae.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    for name in ("op2_bottomk_neardup", "op7_jump_sharding", "op8_source_mixing"):
        got, want = QUERIES[name](spark, DATA).toPandas(), con.execute(ORACLE_SQL[name]).df()
        rows = lambda df: sorted(tuple(str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))
        assert rows(got) == rows(want) and len(got), name


def test_registered():
    import __spark_entry__ as e

    names = [n for n in e.queries() if n.startswith("op")]
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 11)} and len(names) == 10
    assert "pipeline" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
