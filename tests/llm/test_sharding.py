"""Interleaved shards against a plain ranking."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from pulsegrid.llm import sharding as s


def plain(rows, shards):
    """rows(doc_id, source, text) -> sorted (doc_id, size, crc, shard, slot)."""
    facts = []
    for d, source, text in rows:
        data = (text or "").encode()
        facts.append((source or "(none)" if source is not None else "(none)", hashlib.md5(f"{s.SEED}:{'' if d is None else d}".encode()).hexdigest(), d, zlib.crc32(data), len(data) + 1))
    order = lambda r: (r[1], r[2] is not None, r[2] or 0, r[3], r[4])
    groups = defaultdict(list)
    for r in sorted(facts, key=order):
        groups[r[0]].append(r)
    ranked = sorted((((i + 0.5) / len(g), r) for g in groups.values() for i, r in enumerate(g)), key=lambda x: (x[0], x[1][0].encode(), order(x[1])))
    n, out = len(ranked), []
    for p, (_, r) in enumerate(ranked):
        k = p * shards // n
        out.append((r[2], r[4], r[3], k, p - -(-k * n // shards)))
    return sorted(out, key=repr)


def got(df, shards=16):
    return sorted(map(tuple, s.shard_report(df, shards).select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=repr)


def test_awkward_rows(awkward, nothing):
    assert got(awkward) == plain([(r["doc_id"], r["source"], r["text"]) for r in awkward.collect()], 16)
    assert got(nothing) == []


@pytest.mark.parametrize("bucket", [s.BUCKET_ROWS, 7])
def test_mixture_in_every_shard(spark, monkeypatch, bucket):
    monkeypatch.setattr(s, "BUCKET_ROWS", bucket)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}", f"t{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = got(df)
    assert out == plain(rows, 16)
    sizes = Counter(r[3] for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    source = {r[0]: r[1] for r in rows}
    for name, n in Counter(source.values()).items():
        each = Counter(r[3] for r in out if source[r[0]] == name)
        assert all(abs(each[k] - n / 16) <= 8 for k in range(16))
    for k in range(16):
        assert sorted(r[4] for r in out if r[3] == k) == list(range(sizes[k]))


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"s{i % 3}", f"t{i}") for i in range(100)], "doc_id long, source string, text string")
    s.write_shards(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 4 and {r["text"] for r in back.collect()} == {f"t{i}" for i in range(100)}
