"""Documents whose columns are called like helpers of the operators."""

import pytest

from lakeops.llm import line_dedup, lsh_forest, mixing

NAMES = ["_doc", "_hash", "_keeps", "_n_dropped", "_text_hash", "_mix_row", "_mix_row_n", "_forest_row", "_line_keeps", "_LINE_DOC", "_id", "_row", "node", "set_key", "component_id"]


@pytest.mark.parametrize("of", [line_dedup.deduped_documents, lsh_forest.unique_documents, mixing.mixed_documents])
def test_helper_names(spark, frame, odd, of):
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    plain = frame(odd).select(*[c.split()[0] for c in shape.split(", ")])
    named = plain.selectExpr("*", *[f"'own' AS `{c}`" for c in NAMES])
    got = of(named)
    assert got.columns == named.columns
    assert sorted(map(repr, got.select(plain.columns).collect())) == sorted(map(repr, of(plain).collect()))
    assert {tuple(r) for r in got.select(NAMES).distinct().collect()} == {("own",) * len(NAMES)}
