"""Sources come near their targets whatever ids their documents have."""

import pytest

from tickloom.llm import mixing

from .cases import DOCS


@pytest.mark.parametrize("ids", ["null", "equal", "few"])
def test_targets_with_null_or_repeated_ids(spark, ids):
    given = {"null": lambda i: None, "equal": lambda i: 7, "few": lambda i: i % 3}[ids]
    rows = [(given(i), f"text {i}", "en", f"s{i % 3}", 1) for i in range(3000)]
    out = mixing.taken_words(spark.createDataFrame(rows, DOCS))
    per = out.groupBy("source_size", "target").sum("taken").collect()
    got = {}
    for r in out.collect():
        got.setdefault(r.target, []).append(r.taken)
    assert per and len(got) >= 2
    for target, taken in got.items():
        sources = max(round(2 * len(taken) / 2000), 1)
        assert sum(taken) / sources == pytest.approx(target, rel=0.06)
