"""The registered queries against their SQL, on small tables; whitening against numpy."""

from __future__ import annotations

import numpy as np
import pytest

from affinia.llm.queries import ORACLE, QUERIES
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    outcome = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert outcome.startswith("ok") and outcome != "ok, 0 rows"


def test_whitening_query(spark):
    got = QUERIES["op11_whitening"](spark, SF_DIR).toPandas()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.floor(1024 * np.stack(table["embedding"].to_numpy()).astype(float)) + 100_000
    off = x - x.mean(0)
    values = np.linalg.eigvalsh(off.T @ off / len(x))[::-1]
    got = got.sort_values(["vec_id", "component"])
    first = got[got["component"] == 1]
    n = len(x)
    ints = x.astype(int)
    want = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, ints.sum(0), strict=True)) for row in ints]
    assert first["deviation"].tolist() == want and first["n"].unique().tolist() == [n]
    assert np.allclose(got["explained"][:8], values[:8] / values.sum(), rtol=1e-9)
    w = got["whitened"].to_numpy().reshape(n, 8)
    assert np.abs(w.T @ w / n - np.eye(8)).max() < 1e-9 and got["identity_error"].max() < 1e-9
    loads = off.T @ w / n  # eigenvectors times the roots of their eigenvalues
    assert np.allclose((loads * loads).sum(0), values[:8], rtol=1e-9)
