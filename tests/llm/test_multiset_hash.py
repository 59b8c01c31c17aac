"""The multiset hash on texts that repeat themselves, and against plain sums."""

import pytest

from lakeload.llm.multiset_hash import Sum, changed, paragraphs, vector_sum


@pytest.mark.parametrize("times", [100, 20_000, 1_000_000])
def test_long_repetitive_texts_stay_alike(times):
    short, long = (vector_sum(paragraphs("a " * n)) for n in (times, 2 * times))
    assert short.text() != long.text()
    assert short.likeness(long) == pytest.approx(1)


def test_order_and_edits_of_paragraphs():
    parts = [f"line {i % 5} of the text {i}" for i in range(200)]
    whole = vector_sum(parts)
    assert whole.text() == vector_sum(parts[::-1]).text()
    assert changed(whole, parts[:50], ["new"]).text() == vector_sum([*parts[50:], "new"]).text()
    assert sum((vector_sum([p]) for p in parts), Sum()).text() == whole.text()
    assert changed(whole, parts, []).text() == Sum().text()
