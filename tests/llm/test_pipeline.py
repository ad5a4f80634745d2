"""The pipeline and the registration of its queries."""

import corpus_pipeline
from adweave.llm import queries
from tests.llm import cases


def test_names():
    assert [n.split("_")[0] for n in queries.QUERIES] == [*(f"op{k}" for k in range(1, 14)), "pipeline"]
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == columns, name
        docs = corpus_pipeline.saved(kept, "test")
        assert 0.5 * len(before) < docs.count() <= len(before), name
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(t == before[i] or "[SECRET]" in t for i, t in left.items())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in pieces} == set(left)


def test_leaks_are_told_by_id_and_text(spark, sf_dir):
    """Null and equal ids: a leaked row goes and a clean one with the same id stays."""
    item = next(r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if len(r["text"].split()) >= 8)
    clean = [(None, "nothing of the kind here"), (1, cases.prose(1, 50)), (2, None), (2, ""), (3, cases.prose(2, 30)), (3, cases.prose(2, 30))]
    leaked = [(None, item), (1, f"{cases.prose(3, 20)} {item}"), (1, item.upper()), (4, item)]
    docs = cases.table(spark, [*clean, *leaked])
    kept = corpus_pipeline.drop_leaks(spark, docs, sf_dir)
    assert cases.ordered(r[:2] for r in kept.collect()) == cases.ordered(clean) and kept.columns == docs.columns


def test_near_duplicates_stage_is_that_of_all_pairs(spark, sf_dir):
    rows = cases.odd_texts()
    kept = corpus_pipeline.one_of_each_group(spark, cases.table(spark, rows), sf_dir).collect()
    group = {}
    for (i, text), (_, n, low) in zip(rows, sorted_components(rows), strict=True):
        group.setdefault((low, text if not n else None), []).append((i, text))
    want = []
    for (low, blank), held in group.items():
        wordless = blank is not None or not cases.words(held[0][1])
        want += held if wordless else [min(held, key=lambda r: (r[0] is not None, r[0] or 0))]
    assert cases.ordered((r["doc_id"],) for r in kept) == cases.ordered((i,) for i, _ in want)


def sorted_components(rows: list[tuple]) -> list[tuple]:
    """(id, size, group) of the rows in their order; groups are numbered, not named by ids, as ids may be equal or null."""
    sets = [cases.shingles(t, 5) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return [(i, len(s), g) for (i, _), s, g in zip(rows, sets, group, strict=True)]


def test_odd_rows_pass_every_stage(spark, sf_dir):
    docs = cases.table(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() > 0, name
        stage(spark, docs.limit(0), sf_dir).count()
