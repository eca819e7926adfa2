"""What training leaves in the driver's Python."""
import re
from pathlib import Path

import numpy as np
import pytest

from tendersift.llm import nbsvm, rules, toxicity
from tendersift.llm.labelled import releasing


def anonymous():
    return int(re.search(r"Anonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def small_arrays():
    """100 MB of small arrays, most of which go while some between them stay."""
    made = [np.ones(4000) for _ in range(3200)]
    return made[::40]


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_memory_of_a_sample_goes_back():
    before = anonymous()
    left = releasing(small_arrays)()
    assert len(left) == 80
    assert anonymous() - before < 20


@pytest.mark.parametrize("module", [nbsvm, rules, toxicity])
def test_fit_leaves_no_freed_memory(module, spark, monkeypatch):
    """Both ends of a fit give memory back, also of one that fails, and the last time when the sample is gone."""
    from tendersift.llm import labelled
    seen = []
    monkeypatch.setattr(labelled, "released", lambda: seen.append(anonymous()))
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)], "doc_id long, quality int, toxic int")
    module.fit(docs, labels)
    assert len(seen) == 2
    with pytest.raises(Exception):
        module.fit(docs, labels.select("doc_id"))
    assert len(seen) == 4
