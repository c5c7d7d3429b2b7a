"""Shared lines and centroid clusters against brute force."""

import hashlib
import random
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroledger.llm import line_dedup, va_clusters
from aeroledger.llm.va_clusters import ClusterOptions, Grid
from conftest import final_plan

DOCS = "doc_id long, text string, h1 string, lines string, dropped string"
BLANKS = " \t\n\x0b\x0c\r"


def as_docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", f"d{i}") for i, t in rows], DOCS)


def plain_lines(rows, min_docs, min_chars=1):
    def key(line):
        return "".join(c.lower() if c in string.ascii_uppercase else c for c in line.strip(BLANKS))

    count = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(key(x)) < min_chars or count[key(x)] < min_docs]
        out.append((i, f"d{i}", len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("min_docs", "min_chars"), [(1, 1), (2, 1), (3, 1), (10, 1), (3, 0), (2, 5)])
def test_lines_as_brute_force(spark, min_docs, min_chars):
    rng = random.Random(min_docs)
    lines = ["Common line", " common LINE\t", "É", "é", "x", "", "  ", "\x0b", "\r", "a b", "A B ", "u ", "ẞ", "tail \x1f", "日本 語"]
    rows = [(i, "\n".join(rng.choices([*lines, *(f"own {rng.randrange(60)}" for _ in range(4))], k=rng.randrange(1, 12)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, "Common line\nno id"), (None, "other"), (None, "other"), (7, "other"), (203, "all\n" * 2), (203, "all\n" * 2)]
    got = line_dedup.drop_frequent_lines(as_docs(spark, rows), min_docs, min_chars, keep=("dropped",))
    assert got.columns == ["doc_id", "dropped", "n_lines", "n_dropped", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_lines(rows, min_docs, min_chars)


def test_lines_of_a_very_long_text(spark):
    long = "\n".join(f"line {i % 150_000}" if i % 3 else "Shared" for i in range(300_000))
    rows = [(0, long), *((i, f"shared\nown {i}") for i in range(1, 12))]
    got = line_dedup.drop_frequent_lines(as_docs(spark, rows), keep=("dropped",))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_lines(rows, 10)
    assert line_dedup.drop_frequent_lines(as_docs(spark, [])).count() == 0


def test_shared_lines_are_counted_before_the_shuffle(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    rows = [(i, "everywhere\n" + "\n".join(f"{i} {k}" for k in range(5))) for i in range(300)]
    cleaned = line_dedup.drop_frequent_lines(as_docs(spark, rows))
    plan = final_plan(cleaned)
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowToRow", "")
    assert {r.n_dropped for r in cleaned.collect()} == {1}


# ---- centroid clusters


def plain_clusters(rows, options):
    """Lloyd's rounds in Python integers."""
    kept = [(i, [int(np.floor(options.scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == options.dims and all(x is not None and np.isfinite(x) for x in v)]
    by_hash = sorted(kept, key=lambda r: (hashlib.sha256(f"{options.seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in by_hash[: options.clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centroids)) for _, x in kept]

    for _ in range(options.rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [x for (_, x), (_, c) in zip(kept, found, strict=True) if c == k]
            if own:
                centroids[k] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    found = assign()
    inertia = [sum(d for d, c in found if c == k) for k in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, found, strict=True)), key=repr)


def vectors_of(rng, n, dims, centres=5, noise=0.1):
    middle = rng.normal(size=(centres, dims))
    return (middle[rng.integers(0, centres, n)] + noise * rng.normal(size=(n, dims))).tolist()


@pytest.mark.parametrize(("dims", "noise", "bits"), [(4, 0.5, 2), (4, 0.02, 6), (64, 0.1, 6), (3, 2.0, 1)])
def test_clusters_as_brute_force(spark, dims, noise, bits):
    rng = np.random.default_rng(dims)
    rows = list(enumerate(vectors_of(rng, 200, dims, noise=noise)))
    rows += [(900, None), (901, [1.0] * (dims + 1)), (902, [float("nan")] * dims), (903, [None] * dims), (904, [float("inf")] * dims), (905, [])]
    rows += rows[:9] + [(950, [-30_000.0] * dims), (951, [0.0] * dims), (952, [-0.0] * dims)]
    options = ClusterOptions(dims=dims, bits=bits)
    frame = spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], "vec_id long, embedding array<double>, components string, cells string")
    got = sorted((tuple(r) for r in va_clusters.cluster(frame.repartition(5), options).collect()), key=repr)
    assert got == plain_clusters(rows, options)


def test_cluster_edge_cases(spark):
    kind = "vec_id long, embedding array<float>"
    same = [(i % 3, [0.5] * 64) for i in range(20)]
    options = ClusterOptions()
    for rows in (same, same[:2], [(5, None)], []):
        got = va_clusters.cluster(spark.createDataFrame(rows, kind), options)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(rows, options)
    no_id = va_clusters.cluster(spark.createDataFrame([*same, (None, [9.0] * 64)], kind), ClusterOptions(clusters=2))
    assert no_id.where("vec_id IS NULL").count() == 1 and no_id.count() == 21
    with pytest.raises(Exception, match="beyond"):
        va_clusters.cluster(spark.createDataFrame([(1, [1e9] * 64)], kind)).collect()


def test_approximation_bounds_distances_and_saves_fetches(spark):
    rng = np.random.default_rng(7)
    x = np.floor(1024 * np.array(vectors_of(rng, 3_000, 64, centres=8, noise=0.3))).astype(np.int64)
    grid = Grid.fit(x.min(0), x.max(0), x.mean(0), x.std(0), 6)
    cells = grid.cells(x)
    packed = grid.pack(cells)
    assert packed.shape == (3_000, 48) and (grid.unpack(packed) == cells).all()
    centroids = x[:8]
    best, squared = va_clusters.nearest(x, centroids)
    least, largest = grid.tables(centroids)
    low, high = (sum(t[d][cells[:, d]] for d in range(64)) for t in (least, largest))
    every = ((x[:, None, :] - centroids) ** 2).sum(2)
    own = (x * x).sum(1)[:, None]
    assert (low + own <= every).all() and (every <= high + own).all() and (every.min(1) == squared).all()
    alone = va_clusters.settled(cells, (least, largest))
    assert (alone[alone >= 0] == best[alone >= 0]).all() and (alone >= 0).mean() > 0.6
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, components array<int>")
    table = va_clusters.approximate(frame, grid)
    fetched = table.where(va_clusters._open(table, grid, centroids, centroids))
    assert fetched.count() == (alone < 0).sum()
    plan = fetched.select(F.sum(F.col("components")[0])).selectExpr("*")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
