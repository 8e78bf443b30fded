import numpy as np
import pyarrow as pa

from ledgerline.llm.batches import slices


def test_slices_keep_every_row_in_order():
    rng = np.random.default_rng(0)
    texts = ["x" * int(n) for n in rng.integers(0, 400, 500)] + [None, "y" * 5000, "", None]
    batch = pa.RecordBatch.from_pydict({"k": list(range(len(texts))), "text": texts})
    parts = list(slices(batch, "text", 1000))
    assert sum((p.column("k").to_pylist() for p in parts), []) == list(range(len(texts)))
    assert all(sum(len(t or "") for t in p.column("text").to_pylist()[:-1]) <= 1000 for p in parts)
    assert list(slices(batch.slice(0, 0), "text", 10)) == []
