"""What a Python worker holds when another operator's tasks start in it."""

import pyarrow as pa
import pytest

from lakeload.llm import decontaminate, importance, lsh_forest, packing, words
from lakeload.llm.tokens import default_vocabulary, text_tokens


@pytest.mark.parametrize(
    "task",
    [importance.counting, lsh_forest.signing(5), lsh_forest.linking(5, 80), decontaminate.counting(frozenset())],
    ids=["quality", "signatures", "links", "decontamination"],
)
def test_other_stages_free_the_packer_caches(task):
    text_tokens(default_vocabulary(), named=True)
    packing.bound_functions(64)
    list(task(iter([])))
    assert text_tokens.cache_info().currsize == packing.bound_functions.cache_info().currsize == 0


def test_decontamination_frees_the_word_hashes():
    list(lsh_forest.signing(5)(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words"]})])))
    assert len(words.word_hashes()) == 2
    list(decontaminate.counting(frozenset())(iter([])))
    assert words.word_hashes.cache_info().currsize == 0


def test_groups_keep_their_bounds_and_free_the_words():
    text_tokens(default_vocabulary(), named=True)
    bounds = packing.bound_functions(64)
    row = {"row": [0], "doc_id": [1], "piece": [0], "start": [0], "length": [3], "ids_crc32": [0], "pack_group": [0]}
    out = packing.packed_group(64, 0)((pa.scalar(0),), pa.table(row))
    assert out.column("gap").to_pylist() == [0]
    assert text_tokens.cache_info().currsize == 0
    assert packing.bound_functions(64)[0] is bounds[0]
