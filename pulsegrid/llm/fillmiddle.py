"""Fill-in-middle transformation: texts cut into prefix, middle and suffix at unit boundaries and put in another order.

A unit is a run of the letters A-Z and a-z, or any other single code point. One table-driven automaton reads the UTF-8
bytes: its states are the begun sentinels and whether the last byte was a letter, its transitions say where a unit or a
code point starts and where a sentinel ends. Such an automaton forgets where it began after as many bytes as the longest
sentinel has less one, so all bytes of a chunk are looked up at once. The first scan gives only how often each
transition occurs, and with it the units, code points and sentinels of the text; a second pass goes to the chunks that
hold the two cuts.

Choices are drawn from the sha256 of seed and doc_id, so they are the same in any run, order and partitioning. Every
row becomes one row; nothing is shuffled.

Defined results: a null text is an empty one; an empty text, one that holds a sentinel, and one the draw leaves out
keep their form (plain: output is the text, no lengths); a null doc_id draws as an empty id; rows with one id and
other texts are cut each by its own number of units. Further columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prefix, suffix and middle follow these.
SENTINELS = ("<P>", "<S>", "<M>")
SEED = "1"
#: Of 100 texts so many are transformed, of 100 of those so many with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Bytes scanned at once, and of output handed on at once.
CHUNK = 1 << 20
TOGETHER = 16 << 20

LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


class Scanner:
    """The automaton of a set of sentinels, and what its transitions mean."""

    def __init__(self, sentinels: tuple[str, ...] = SENTINELS, chunk: int = CHUNK):
        whole = [s.encode() for s in sentinels]
        if not whole or not all(whole):
            raise ValueError("sentinels must not be empty")
        begun = sorted({w[:n] for w in whole for n in range(1, len(w))})
        states: list[tuple[bytes, bool]] = [(b"", False), (b"", True), *((p, p[-1] in LETTERS) for p in begun)]
        number = {s: n for n, s in enumerate(states)}
        kinds: dict[tuple, int] = {}
        self.chunk, self.classes, columns = chunk, np.empty(256, np.uint8), []
        for byte in range(256):
            column = []
            for prefix, in_run in states:
                read = prefix + bytes([byte])
                rest = next((read[k:] for k in range(len(read)) if (read[k:], read[-1] in LETTERS) in number), b"")
                letter, point = byte in LETTERS, byte & 0xC0 != 0x80
                column.append((number[rest, letter], point and not (letter and in_run), point, read.endswith(tuple(whole))))
            if (key := tuple(column)) not in kinds:
                kinds[key] = len(columns)
                columns.append(column)
            self.classes[byte] = kinds[key]
        table = np.array(columns, np.int64).transpose(1, 0, 2)  # state, class, (next, unit, point, sentinel)
        self.width = table.shape[1]
        self.next = table[..., 0].astype(np.uint16).ravel()
        self.units, self.points, self.ends = (table[..., i].ravel() for i in (1, 2, 3))
        self.starts = self.units.astype(bool)
        self.memory = max(1, max(map(len, whole)) - 1)

    def transitions(self, data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """The transition at each byte, as state x width + class, and the state after the last."""
        read = self.classes[data].astype(np.uint16)
        before = np.full(len(data), state, np.uint16)
        for _ in range(self.memory):
            before[1:] = self.next[before[:-1] * np.uint16(self.width) + read[:-1]]
        taken = before * np.uint16(self.width) + read
        return taken, int(self.next[taken[-1]])

    def scan(self, text: bytes) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """How often each transition occurs; units begun and state before every chunk."""
        data, state, counts, before = np.frombuffer(text, np.uint8), 0, np.zeros(len(self.next), np.int64), []
        for at in range(0, len(data), self.chunk):
            before.append((int(counts @ self.units), state))
            taken, state = self.transitions(data[at : at + self.chunk], state)
            counts += np.bincount(taken, minlength=len(counts))
        return counts, before

    def cut(self, text: bytes, unit: int, n: int, before: list[tuple[int, int]]) -> int:
        """The byte at which the unit of that number starts; the end of the text for number n."""
        if unit >= n:
            return len(text)
        k = max(i for i, (begun, _) in enumerate(before) if begun <= unit)
        begun, state = before[k]
        data = np.frombuffer(text, np.uint8)[k * self.chunk : (k + 1) * self.chunk]
        taken, _ = self.transitions(data, state)
        return k * self.chunk + int(np.flatnonzero(self.starts[taken])[unit - begun])

    def characters(self, part: bytes) -> int:
        return sum(int(np.count_nonzero(np.frombuffer(part, np.uint8)[at : at + self.chunk] & 0xC0 != 0x80)) for at in range(0, len(part), self.chunk))


def draws(doc_id: str | None, seed: str) -> tuple[int, ...]:
    digest = sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    return tuple(int(digest[8 * i : 8 * i + 8], 16) for i in range(4))


def fill_in_middle(documents: DataFrame, id_col: str = "doc_id", text: str = "text", sentinels: tuple[str, str, str] = SENTINELS, seed: str = SEED, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST, chunk: int = CHUNK) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row; form is plain, psm (prefix, suffix, middle) or spm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sentinels, chunk)
        first, second, third = (s.encode() for s in sentinels)

        def one(name: str | None, text: bytes) -> tuple:
            counts, before = scanner.scan(text)
            n, (h1, h2, h3, h4) = int(counts @ scanner.units), draws(name, seed)
            if not text or counts @ scanner.ends or h3 % 100 >= transformed:
                return n, "plain", None, None, text
            low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
            a, b = scanner.cut(text, low, n, before), scanner.cut(text, high, n, before)
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            lengths = scanner.characters(prefix), scanner.characters(middle)
            if h4 % 100 < suffix_first:
                return n, "spm", *lengths, b"".join((second, suffix, first, prefix, third, middle))
            return n, "psm", *lengths, b"".join((first, prefix, second, suffix, third, middle))

        for b in batches:
            rows, held, at = [], 0, 0
            for i, (name, text) in enumerate(zip(b[1].to_pylist(), b[2].cast(pa.binary()))):
                rows.append(one(name, text.as_py() or b""))
                held += len(rows[-1][-1])
                if held >= TOGETHER or i + 1 == b.num_rows:
                    n, form, prefix, middle, output = zip(*rows)
                    yield pa.record_batch([b[0].slice(at, len(rows)), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])
                    rows, held, at = [], 0, i + 1

    kind = documents.schema[id_col].dataType.simpleString()
    told = documents.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("name"), F.col(text).cast("string").alias("text"))
    return told.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of. No part holds a sentinel, so each one is found where it was put."""
    first, second, third = (re.escape(s) for s in sentinels)
    psm = F.regexp_replace(output, f"(?s)^{first}(.*){second}(.*){third}(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{second}(.*){first}(.*){third}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(documents: DataFrame) -> DataFrame:
    made = fill_in_middle(documents)
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


#: The same report in DuckDB's SQL, with regular expressions and lists of units.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
h AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS prefix, coalesce(array_to_string(units[low + 1:high], ''), '') AS middle, coalesce(array_to_string(units[high + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
