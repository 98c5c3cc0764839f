"""Verbatim excerpts of longer benchmark items."""

from __future__ import annotations

import numpy as np
import pytest

from tests.llm.conftest import frame
from tijara.llm import decontaminate


def words(rng, n):
    return [f"w{k}" for k in rng.integers(0, 10**6, n)]


@pytest.mark.parametrize("size, edited", [(50, False), (60, False), (60, True)])
def test_excerpt_of_a_longer_item(spark, size, edited):
    """An excerpt leaks wherever it begins in its item; 30 words of it do not."""
    rng = np.random.default_rng(size)
    items = {k: words(rng, 200) for k in range(12)}
    docs = [(1000, " ".join(words(rng, 400)))]
    for k, item in items.items():
        part = item[3 * k + 40:3 * k + 40 + size]
        part = [w if not edited or i != size // 2 else "other" for i, w in enumerate(part)]
        docs.append((k, " ".join(words(rng, 120) + part + words(rng, 120))))
        docs.append((k + 100, " ".join(words(rng, 120) + part[:30] + words(rng, 120))))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, docs), benchmark).collect()}
    assert found == {(k, k) for k in items}
