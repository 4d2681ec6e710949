"""Memory of a task beside its batch."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa
from pyspark.sql.classic.dataframe import DataFrame

from riskloom.llm import quality


def test_quality_rules_measure_a_small_run_at_a_time(spark, monkeypatch):
    held, real = [], DataFrame.mapInArrow

    def seen(self, run, schema, *more):
        held.append(run)
        return real(self, run, schema, *more)

    monkeypatch.setattr(DataFrame, "mapInArrow", seen)
    quality.quality_rules(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    texts = [" ".join(f"w{(i * 7919 + j * j) % 9973}" for j in range(250)) for i in range(2_000)]
    batch = pa.RecordBatch.from_pydict({"row": pa.array([{"doc_id": i} for i in range(len(texts))]), "t": texts})
    tracemalloc.start()
    found = [r for out in held[0](iter([batch])) for r in out.column("_rules").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r["n_words"] for r in found] == [250] * len(texts) and all(r["kept"] for r in found)
    assert peak < 40 << 20
