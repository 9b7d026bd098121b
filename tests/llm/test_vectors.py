"""Vector links against a full comparison."""

import math
import random

import numpy as np
import pytest

from tagwright.llm.vectors import cosine_links
from tests.llm.test_jaccard import closure


def brute(rows, threshold):
    ok = [
        r for r in rows
        if r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])
    ]
    links, count = [], {}
    for i, a in enumerate(ok):
        for b in ok[i + 1 :]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                    links.append((a[0], b[0]))
                    for k in (a[0], b[0]):
                        count[k] = count.get(k, 0) + 1
    root = closure({r[0] for r in rows if r[0] is not None}, links)
    return sorted(((r[0], count.get(r[0], 0), root.get(r[0]), root.get(r[0]) == r[0]) for r in rows), key=str)


@pytest.mark.parametrize(("dim", "tile"), [(20, 2048), (20, 7), (3, 16)])
def test_links_equal_brute_force(spark, dim, tile):
    rng = random.Random(dim)
    rows = []
    for _ in range(30):
        base = [rng.gauss(0, 1) * (3 if d == 0 else 1) for d in range(dim)]
        label = rng.choice([0, 1])
        for _ in range(rng.randrange(1, 7)):
            rows.append([[round(x + rng.gauss(0, 0.25), 3) for x in base], label])
    rows += [[list(rows[0][0]), rows[0][1]] for _ in range(5)] + [[[2 * x for x in rows[1][0]], rows[1][1]]]
    rows += [[None, 0], [[], 0], [[0.0] * dim, 0], [[1.0] * (dim - 1) + [None], 1], [[math.nan] * dim, 1], [[math.inf] * dim, 1], [list(rows[0][0]), None]]
    rows += [[[1.0, 2.0], 0], [[1.0, 2.1], 0], [[1e200] + [0.0] * (dim - 1), 0], [[1e-200] + [0.0] * (dim - 1), 0]]
    rng.shuffle(rows)
    rows = [(i * 3 + 1, v, label) for i, (v, label) in enumerate(rows)]
    wanted = [r if r[1] is None or not any(x and math.isfinite(x) and abs(x) in (1e200, 1e-200) for x in r[1]) else (r[0], [1.0] + r[1][1:], r[2]) for r in rows]
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = sorted((tuple(r) for r in cosine_links(df, tile=tile).collect()), key=str)
    assert got == brute(wanted, 0.93)


def test_edge_tables(spark):
    df = spark.createDataFrame([(None, [1.0], 1), (1, [1.0], 1), (2, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted((tuple(r) for r in cosine_links(df).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)], key=str)
    assert cosine_links(df.limit(0)).count() == 0
