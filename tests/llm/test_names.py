"""Extra columns of the very names that operators use inside."""

from callmart.llm import maglev, nearcopies, simhash, surrogates

CLASHING = ["gone", "_gone_id", "_of", "_new", "_text_key", "_slot", "_shard", "_at", "_row"]


def docs(spark):
    rows = [(1, "one text that is long enough to be compared"), (2, "one text that is long enough to be compared"), (3, "mail a.b@example.com"), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"'{c}' as {c}" for c in CLASHING])


def kept(df):
    return all(r[c] == c for r in df.collect() for c in CLASHING)


def test_clashing_names(spark):
    table = docs(spark)
    for done in (nearcopies.keep_first(table), simhash.keep_first(table)):
        assert done.columns == table.columns and kept(done)
        assert sorted(str(r.doc_id) for r in done.collect()) == ["1", "3", "None"]
    changed = surrogates.replace_private(table, "key")
    assert changed.columns == [*table.columns, "n_entities"] and kept(changed)
    assert sorted(r.n_entities for r in changed.collect()) == [0, 0, 0, 1]
    placed = maglev.assign(table, "doc_id", ["a", "b"], slots=7)
    assert placed.columns == [*table.columns, "slot", "shard"] and kept(placed) and placed.count() == 4
