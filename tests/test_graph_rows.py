"""Factor logs against a plain replay, box suppression against the plain walk."""

import random

import pytest
from framequery.operators import boxes, factor_log
from framequery.plans import graph_rows


def plain(events, most):
    """Active and inactive edges of one graph after all events, as lists in order of addition, and what 'use' saw."""
    active, inactive, used = [], [], []
    for op, pairs, n in events:
        if op == "add":
            new = []
            for p in pairs:
                if p not in new and all(p != e[:2] for e in active + inactive):
                    new.append(p)
            while new and most and len(active) + len(new) > most and active:
                old = max(active, key=lambda e: e[2])
                active.remove(old)
                inactive.append(old)
            active += [(*p, 0) for p in new]
        elif op == "age":
            active = [(i, j, a + 1) for i, j, a in active]
        elif op == "retire":
            inactive += [e for e in active if e[2] > n]
            active = [e for e in active if e[2] <= n]
        elif op == "drop":
            shift = lambda own: [(i - (i > n), j - (j > n), a) for i, j, a in own if n not in (i, j)]  # noqa: B023, E731
            active, inactive = shift(active), shift(inactive)
        elif op == "use":
            used.append(sorted(e[:2] for e in inactive if min(e[:2]) >= n - 3))
    return sorted(e[:2] for e in active), sorted(e[:2] for e in inactive), used


@pytest.mark.parametrize("most", [0, 7])
def test_random_logs(spark, most):
    rnd = random.Random(most)
    logs = {}
    for graph in range(12):
        logs[graph] = []
        for _ in range(rnd.randint(0, 60)):
            op = rnd.choice(["add", "add", "add", "age", "retire", "drop", "use"])
            pairs = [(rnd.randint(0, 9), rnd.randint(0, 9)) for _ in range(rnd.randint(0, 4))] if op == "add" else None
            logs[graph].append((op, pairs, rnd.randint(0, 9)))
    rows = [(g, s, op, None if pairs is None else [{"i": i, "j": j} for i, j in pairs], n) for g, own in logs.items() for s, (op, pairs, n) in enumerate(own)]
    rows += [(None, 1, "add", [{"i": 1, "j": 2}], 0), (3, 1000, "unknown", None, 0)]
    events = spark.createDataFrame(rows, "graph long, seq long, op string, pairs array<struct<i: long, j: long>>, n long").repartition(3)
    versions = factor_log.replay(events, most).persist()
    for upto in (None, 15):
        got = {}
        for r in factor_log.edges_at(versions, upto).collect():
            got.setdefault((r.graph, r.state), []).append((r.i, r.j))
        for g, own in logs.items():
            active, inactive, _ = plain(own[: None if upto is None else upto + 1], most)
            assert sorted(got.get((g, "active"), [])) == active and sorted(got.get((g, "inactive"), [])) == inactive
    seen = {}
    for r in versions.where("state = 'used'").collect():
        seen.setdefault((r.graph, r.seq), []).append((r.i, r.j))
    for g, own in logs.items():
        want = iter(plain(own, most)[2])
        for s, (op, *_) in enumerate(own):
            if op == "use":
                assert sorted(seen.get((g, s), [])) == next(want)


def iou(a, b):
    both = max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / union if union > 0 else 0.0


def walk(own, threshold):
    kept = []
    for k, _, box in sorted(own, key=lambda r: (-r[1], r[0])):
        if all(iou(box, b) <= threshold for _, b in kept):
            kept.append((k, box))
    return {k for k, _ in kept}


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.7])
def test_suppression(spark, threshold):
    rnd = random.Random(9)
    frames = {}
    for f in range(6):
        frames[f] = []
        for k in range(90):
            x, y, w, h = rnd.uniform(-20, 20), rnd.uniform(-20, 20), 2.0 ** rnd.uniform(-2, 4), 2.0 ** rnd.uniform(-2, 4)
            frames[f].append((k, rnd.randint(0, 20) / 20, (x, y, x + w, y + h)))
    # a chain in which each box overlaps only its neighbours, equal boxes, and one without an area
    frames[7] = [(k, 1 - k / 100, (k * 0.6, 0.0, k * 0.6 + 1, 1.0)) for k in range(30)]
    frames[8] = [(k, 0.5, (0.0, 0.0, 1.0, 1.0)) for k in range(40)] + [(50, 0.9, (0.5, 0.5, 0.5, 0.5))]
    rows = [(f, k, s, *box, "kept") for f, own in frames.items() for k, s, box in own] + [(9, 1, None, 0.0, 0.0, 1.0, 1.0, "x"), (9, 2, 0.1, 1.0, 0.0, 0.0, 1.0, "x")]
    df = spark.createDataFrame(rows, "f long, id long, score double, x0 double, y0 double, x1 double, y1 double, more string")
    out = boxes.suppressed(df, "f", threshold)
    assert out.columns == df.columns
    got = {}
    for r in out.collect():
        got.setdefault(r.f, set()).add(r.id)
    assert got == {f: walk(own, threshold) for f, own in frames.items()}
    assert boxes.suppressed(df.limit(0), "f", threshold).count() == 0


def test_suppression_of_large_groups(spark, monkeypatch):
    """Groups too large for a walk go through rounds, with the same result beside small ones."""
    rnd = random.Random(10)
    frames = {f: [(k, rnd.randint(0, 9) / 10, (x, y, x + rnd.uniform(0, 4), y + rnd.uniform(0, 4))) for k, x, y in ((k, rnd.uniform(0, 9), rnd.uniform(0, 9)) for k in range(n))] for f, n in ((1, 30), (2, 8), (3, 1), (4, 9))}
    frames[5] = [(k, 1 - k / 100, (k * 0.6, 0.0, k * 0.6 + 1, 1.0)) for k in range(10)]
    df = spark.createDataFrame([(f, k, s, *box) for f, own in frames.items() for k, s, box in own], "f long, id long, score double, x0 double, y0 double, x1 double, y1 double")
    for most in (8, 0):
        monkeypatch.setattr(boxes, "TOGETHER", most)
        got = {}
        for r in boxes.suppressed(df, "f", 0.2).collect():
            got.setdefault(r.f, set()).add(r.id)
        assert got == {f: walk(own, 0.2) for f, own in frames.items()}


def test_small_groups_meet_no_pairs(spark, sf, monkeypatch):
    monkeypatch.setattr(boxes, "neighbours", lambda *_: 1 / 0)
    assert graph_rows.box_suppression(spark, sf).count() > 500
