"""Raking and sampling against a plain version."""

import hashlib
import re

import pytest

from pulsegrid.llm import mixing as m


def rake(cells, targets, keep):
    """{(source, lang, topic): tokens} -> {cell: probability}."""
    total = sum(cells.values())
    wanted = []
    for axis, d in enumerate(m.DIMENSIONS):
        sums, t = {}, targets[d]
        for c, n in cells.items():
            sums[c[axis]] = sums.get(c[axis], 0) + n
        if isinstance(t, dict):
            rest = sum(n for k, n in sums.items() if k not in t) or 1e-300
            raw = {k: 0.0 if n == 0 else t[k] if k in t else max(0.0, 1 - sum(t.values())) * n / rest for k, n in sums.items()}
        else:
            raw = {k: n**t if n else 0.0 for k, n in sums.items()}
        whole = sum(raw.values()) or 1
        wanted.append({k: v / whole for k, v in raw.items()})
    w = {c: n / total if total else 0.0 for c, n in cells.items()}
    for _ in range(m.SWEEPS):
        for axis in range(3):
            sums = {}
            for c, x in w.items():
                sums[c[axis]] = sums.get(c[axis], 0) + x
            w = {c: x * wanted[axis][c[axis]] / sums[c[axis]] if sums[c[axis]] else 0.0 for c, x in w.items()}
    level = keep * total
    for _ in range(m.FILL):
        got = sum(min(n, level * w[c]) for c, n in cells.items())
        level = level * keep * total / got if got else 0.0
    return {c: 1.0 if n == 0 else min(1.0, level * w[c] / n) for c, n in cells.items()}, w, wanted


def facts(docs):
    out = []
    for r in docs.collect():
        text = r["text"] or ""
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        topic = "table" if " | " in text else "licence" if "icense" in text else "contact" if "@" in text else "short" if n < 100 else "prose"
        out.append((r["doc_id"], (r["source"] if r["source"] is not None else "(none)", r["lang"] if r["lang"] is not None else "(none)", topic), n))
    return out


def check(docs, **more):
    rows = facts(docs)
    cells = {}
    for _, c, n in rows:
        cells[c] = cells.get(c, 0) + n
    p, w, wanted = rake(cells, m.TARGETS, m.KEEP)
    u = lambda d: int(hashlib.md5(f"{m.SEED}:{'' if d is None else d}".encode()).hexdigest()[:13], 16) / (1 << 52)
    expected = sorted((repr((d, *c, n)), round(p[c], 6), u(d) < p[c]) for d, c, n in rows)
    out = m.mix(m.measured(docs), **more).collect()
    assert sorted((repr((r["doc_id"], *(r[d] for d in m.DIMENSIONS), r["tokens"])), round(r["probability"], 6), r["kept"]) for r in out) == expected
    return w, wanted


@pytest.mark.parametrize("max_cells", [m.MAX_CELLS, 0])
def test_documents(spark, small, max_cells, monkeypatch):
    if not max_cells:
        monkeypatch.setattr(m, "SWEEPS", 4)
        monkeypatch.setattr(m, "FILL", 4)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    w, wanted = check(docs, max_cells=max_cells)
    if max_cells:  # the marginals are met
        for axis in range(3):
            for k, t in wanted[axis].items():
                assert sum(x for c, x in w.items() if c[axis] == k) == pytest.approx(t, abs=1e-3)


def test_awkward_rows(awkward, nothing):
    check(awkward)
    assert m.report(nothing).count() == 0
    kept = m.sample(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r["kept"] for r in m.mix(m.measured(awkward)).collect())


def test_no_python_in_the_plan(spark, small):
    plan = m.report(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
