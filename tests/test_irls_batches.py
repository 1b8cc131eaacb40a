"""IRLS sums come from Arrow batches, a whole batch at a time."""

import numpy as np
import pyarrow as pa

from creditspark.operators import irls


def test_sums_of_arrow_batches():
    r = np.random.default_rng(2)
    x, y, b = r.normal(size=(50, 3)), r.integers(0, 2, 50).astype(float), np.array([.1, .5, -.3])
    whole = pa.record_batch({"x": pa.array(x.tolist(), pa.list_(pa.float64())), "y": pa.array(y)})
    got = [t for t in irls._partials([[0, 2], []], [b, np.array([.2])])(iter([whole.slice(0, 20), whole.slice(20)]))]
    assert got[0].column(0).to_pylist() == [0, 1]
    v = np.frombuffer(got[0].column(1)[0].as_py())
    design = np.column_stack([np.ones(50), x[:, [0, 2]]])
    p = 1 / (1 + np.exp(-design @ b))
    assert np.allclose(v[:9].reshape(3, 3), design.T @ (design * (p * (1 - p))[:, None]))
    assert np.isclose(v[-1], (y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
