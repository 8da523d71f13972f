"""Connected components against a search in memory."""

import numpy as np

from tickloom.llm.components import connected
from tickloom.llm.store import written
from tickloom.session import settings


def expected(edges):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        if start not in out:
            stack = [start]
            while stack:
                i = stack.pop()
                if i not in out:
                    out[i] = start
                    stack += near[i]
    return out


def test_components(spark):
    random = np.random.default_rng(5)
    cases = [
        [], [(1, 1)], [(5, 3)], [(n, n + 1) for n in range(40)], [(0, n) for n in range(1, 30)],
        [(99, n) for n in range(30)] + [(99, 98), (98, 97)],
        [tuple(map(int, random.integers(-60, 60, 2))) for _ in range(60)],
    ]
    for edges in cases:
        frame = spark.createDataFrame(edges, "a long, b long")
        found = connected(frame).collect()
        assert len(found) == len({r.id for r in found})
        assert {r.id: r.component for r in found} == expected(edges)


def test_rounds_take_few_tasks(spark):
    edges = written(spark.createDataFrame([(n, n + 1) for n in range(40)], "a long, b long"), "edges")
    context = spark.sparkContext
    held = {"spark.sql.shuffle.partitions": 24, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    try:
        with settings(spark, **held):
            context.setJobGroup("rounds", "connected")
            assert {r.component for r in connected(edges).collect()} == {0}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    stages = {s for job in status.getJobIdsForGroup("rounds") for s in status.getJobInfo(job).stageIds}
    # 943; 1183 when a round computed its links up to three times over.
    done = [status.getStageInfo(s) for s in stages]
    assert sum(info.numCompletedTasks for info in done if info) < 1060
