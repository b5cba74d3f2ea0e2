"""Units, cuts and forms against regular expressions; outputs give their texts back."""

import random
import re
from hashlib import sha256

import pytest

from pulsegrid.llm import fillmiddle as f

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
ALPHABET = ["a", "P", "S", "M", "<", ">", "<P>", "<S", "P>", " ", "\n", "é", "漢", "🙂", "Zz", "́", "7"]


def texts(seed, many=400):
    rng = random.Random(seed)
    for n in range(many):
        yield "".join(rng.choice(ALPHABET) for _ in range(n % 60))


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, f.CHUNK])
def test_scan_is_the_expression(chunk):
    scanner = f.Scanner(chunk=chunk)
    for text in texts(1):
        data, units = text.encode(), UNIT.findall(text)
        counts, before = scanner.scan(data)
        assert counts.sum() == len(data)
        assert counts @ scanner.units == len(units)
        assert counts @ scanner.points == len(text)
        assert bool(counts @ scanner.ends) == any(s in text for s in f.SENTINELS)
        for k in range(len(units) + 1):
            assert scanner.cut(data, k, len(units), before) == len("".join(units[:k]).encode())


def test_other_sentinels():
    scanner = f.Scanner(("<|middle|>", "aab", "é"), 5)
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(["a", "b", "aab", "<|mid", "<|middle|>", "é", " ", "|", "<"]) for _ in range(rng.randrange(12)))
        counts, _ = scanner.scan(text.encode())
        found = sum(text.endswith(("<|middle|>", "aab", "é"), 0, i) for i in range(1, len(text) + 1))
        assert (counts @ scanner.ends, counts @ scanner.units) == (found, len(UNIT.findall(text)))
    with pytest.raises(ValueError):
        f.Scanner(("",))


def plain(doc_id, text):
    text = text or ""
    units, digest = UNIT.findall(text), sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, output, lengths = "plain", text, (None, None)
    elif h4 % 100 < 20:
        form, output, lengths = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", (len(prefix), len(middle))
    else:
        form, output, lengths = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", (len(prefix), len(middle))
    return (doc_id, len(units), form, *lengths, sha256(output.encode()).hexdigest(), sha256(text.encode()).hexdigest())


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_report(spark, awkward, nothing):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts(2))] + [(10**12, None), (5, "<" * 30), (6, "a<")]
    made = f.report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert order(made.collect()) == order(plain(*r) for r in rows)
    assert {r["form"] for r in made.collect()} == {"plain", "psm", "spm"}
    assert order(f.report(awkward).collect()) == order(plain(r["doc_id"], r["text"]) for r in awkward.collect())
    assert f.report(nothing).count() == 0


def test_no_shuffle_and_small_chunks(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts(4))], "doc_id long, text string")
    assert "Exchange" not in f.report(df)._jdf.queryExecution().executedPlan().toString()
    assert order(f.fill_in_middle(df, chunk=4).collect()) == order(f.fill_in_middle(df).collect())
