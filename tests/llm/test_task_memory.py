"""What a Python task of the language classifier holds beside its batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline
from gridlake.llm import langid


def _model():
    rng = np.random.default_rng(3)
    centres = rng.random((40, langid.DIMS), dtype=np.float32)
    return {"langs": [f"l{i}" for i in range(10)], "idf": np.ones(langid.DIMS, np.float32), "centres": centres,
            "of": np.repeat(np.arange(10), 4), "floor": np.zeros(10)}


def _column(n: int, chars: int) -> pa.Array:
    rng = np.random.default_rng(4)
    return pa.array(["".join(map(chr, rng.integers(97, 123, chars))) for _ in range(n)])


def test_texts_are_judged_a_few_at_a_time():
    column, model = _column(300, 1500), _model()
    model = langid._ready(model)
    langid._letters(np.zeros(1, dtype=np.uint32))
    tracemalloc.start()
    for low in langid._texts(column):
        langid._judge(low, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6, peak


def test_every_text_is_judged_once_and_alike_in_any_slice():
    column, model = _column(70, 300), langid._ready(_model())
    column = pa.concat_arrays([column, pa.array([None, "", "x" * 200_000, "1 2 3"])])
    whole = [x for low in langid._texts(column, step=1000, most=1 << 30) for x in langid._similar(low, model)[0]]
    parts = [x for low in langid._texts(column) for x in langid._similar(low, model)[0]]
    assert len(whole) == len(parts) == 74
    assert np.array_equal(np.array(whole), np.array(parts))


def test_pipeline_passes_texts_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(1, "some words of a text", "en", "a")], "doc_id long, text string, lang string, source string")
    try:
        corpus_pipeline.language(spark, docs, "").count()
        assert int(spark.conf.get(key)) == 1000
    finally:
        spark.conf.set(key, before)
