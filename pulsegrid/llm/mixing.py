"""Mixing sources to target weights: iterative proportional fitting of token weights to source, language and topic shares, then sampling by calibrated probabilities.

Documents are counted in cells of (source, lang, topic). Raking multiplies the cells' token shares until all three
marginals meet their targets; a cell's probability is its raked share of the token budget over the tokens it has, at
most 1, the rest of the budget going to the other cells. Documents are kept by an md5 of their id, so a rerun or
another engine keeps the same ones.

The cells are a table of their own, small beside the documents: one row holds them all while it is raked, if they are
at most MAX_CELLS (counted first); beyond that the same sweeps run as grouped sums over a distributed table.

Defined results: null source, lang or topic count as "(none)"; null and empty texts have no tokens and, as they cost no
budget, the probability of their cell, 1 where the cell is without tokens; a category that is listed nowhere in its
explicit targets shares what these leave over; targets for absent categories are spread over those present; an empty
table gives no rows. Where the targets contradict the cells there are, the last sweep's marginal (topic) is met.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.storage import cut
from pulsegrid.llm.common import WORD, unit_interval

DIMENSIONS = ("source", "lang", "topic")
#: A number is an exponent on the present token shares (1 keeps them, 0 makes them equal); a dict states shares.
TARGETS: dict[str, float | dict[str, float]] = {"source": 0.5, "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}, "topic": 0.8}
#: The part of all tokens that the mixture may have.
KEEP = 0.6
SWEEPS, FILL = 40, 30
MAX_CELLS = 20_000
SEED = "mixture-1"


def default_topic(text: Column, tokens: Column) -> Column:
    """The kind of text, by plain marks: tables, licence texts, texts with addresses, short texts, prose."""
    return F.when(F.contains(text, F.lit(" | ")), "table").when(F.contains(text, F.lit("icense")), "licence").when(F.contains(text, F.lit("@")), "contact").when(tokens < 100, "short").otherwise("prose")


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, tokens): what the mixture needs of every document."""
    text = F.coalesce("text", F.lit(""))
    base = documents.select("doc_id", *(F.coalesce(c, F.lit("(none)")).alias(c) for c in ("source", "lang")), text.alias("text"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"))
    return base.select("doc_id", "source", "lang", F.coalesce(default_topic(F.col("text"), F.col("tokens")), F.lit("(none)")).alias("topic"), "tokens")


def _target_sql(target: float | dict[str, float], name: str, tokens: str) -> str:
    """The unscaled target of category {name} with {tokens} tokens, {all} over the dimension's unlisted tokens."""
    if not isinstance(target, dict):
        return f"CASE WHEN {tokens} > 0 THEN pow({tokens}, {float(target)}D) ELSE 0D END"
    listed = " ".join(f"WHEN {name} = '{k}' THEN {float(v)!r}D" for k, v in target.items())
    rest = max(0.0, 1 - sum(target.values()))
    return f"CASE WHEN {tokens} = 0 THEN 0D {listed} ELSE {rest}D * {tokens} / {{rest}} END"


def _rest_sql(target: float | dict[str, float], name: str) -> str:
    """Whether a category is not listed."""
    return "false" if not isinstance(target, dict) else f"{name} NOT IN ({', '.join(repr(k) for k in target)})"


def rake_row(cells: DataFrame, targets: dict, keep: float) -> DataFrame:
    """cells(source, lang, topic, tokens), few -> with share (raked, sums to 1) and probability, by array expressions over one row."""
    row = cells.agg(F.array_sort(F.collect_list(F.struct(*DIMENSIONS, F.col("tokens").cast("double").alias("tokens")))).alias("c"))
    row = row.withColumn("total", F.expr("aggregate(c, 0D, (a, x) -> a + x.tokens)"))
    for d in DIMENSIONS:
        row = row.withColumn(f"v_{d}", F.expr(f"array_sort(array_distinct(transform(c, x -> x.{d})))"))
        row = row.withColumn(f"k_{d}", F.expr(f"transform(c, x -> array_position(v_{d}, x.{d}) - 1)"))
        row = row.withColumn(f"n_{d}", F.expr(f"transform(v_{d}, v -> aggregate(c, 0D, (a, x) -> a + IF(x.{d} = v, x.tokens, 0D)))"))
        row = row.withColumn("rest", F.expr(f"greatest(1e-300D, aggregate(zip_with(v_{d}, n_{d}, (v, n) -> IF({_rest_sql(targets[d], 'v')}, n, 0D)), 0D, (a, x) -> a + x))"))
        row = row.withColumn(f"t_{d}", F.expr(f"zip_with(v_{d}, n_{d}, (v, n) -> {_target_sql(targets[d], 'v', 'n').format(rest='rest')})"))
        row = row.withColumn(f"t_{d}", F.expr(f"transform(t_{d}, t -> coalesce(try_divide(t, aggregate(t_{d}, 0D, (a, x) -> a + x)), 0D))"))
    row = cut(row)  # one row; else every sweep would carry the expressions above

    def sweep(w: str) -> str:
        for d in DIMENSIONS:
            factors = f"transform(t_{d}, (t, k) -> coalesce(try_divide(t, aggregate(zip_with(w_{d}, k_{d}, (x, i) -> IF(i = k, x, 0D)), 0D, (a, x) -> a + x)), 0D))"
            w = f"flatten(transform(array({w}), w_{d} -> flatten(transform(array({factors}), f -> zip_with(w_{d}, k_{d}, (x, i) -> x * f[CAST(i AS INT)])))))"
        return w

    row = row.withColumn("start", F.expr("transform(c, x -> coalesce(try_divide(x.tokens, total), 0D))"))
    row = row.withColumn("w", F.expr(f"aggregate(sequence(1, {SWEEPS}), start, (w, s) -> {sweep('w')})"))
    row = cut(row)
    filled = "aggregate(zip_with(c, w, (x, s) -> least(x.tokens, l * s)), 0D, (a, x) -> a + x)"
    row = row.withColumn("level", F.expr(f"aggregate(sequence(1, {FILL}), {keep}D * total, (l, s) -> coalesce(try_divide(l * {keep}D * total, {filled}), 0D))"))
    probability = "IF(x.tokens = 0, 1D, least(1D, level * s / x.tokens))"
    return row.select(F.expr(f"inline(zip_with(c, w, (x, s) -> named_struct('source', x.source, 'lang', x.lang, 'topic', x.topic, 'share', s, 'probability', {probability})))"))


def rake_table(cells: DataFrame, targets: dict, keep: float) -> DataFrame:
    """The same for any number of cells: each step of a sweep is a grouped sum joined back, each sweep is kept."""
    total = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]) or 1.0
    state = cells.withColumn("share", F.col("tokens") / F.lit(total))
    wanted = {}
    for d in DIMENSIONS:
        sums = cells.groupBy(d).agg(F.sum("tokens").cast("double").alias("n"))
        rest = float(sums.where(F.expr(_rest_sql(targets[d], d))).agg(F.coalesce(F.sum("n"), F.lit(0.0))).first()[0]) or 1e-300
        raw = sums.withColumn("t", F.expr(_target_sql(targets[d], d, "n").format(rest=f"{rest!r}D")))
        whole = float(raw.agg(F.coalesce(F.sum("t"), F.lit(0.0))).first()[0]) or 1.0
        wanted[d] = cut(raw.select(d, (F.col("t") / F.lit(whole)).alias("t")))
    for _ in range(SWEEPS):
        for d in DIMENSIONS:
            now = state.groupBy(d).agg(F.sum("share").alias("m")).join(wanted[d], d)
            factor = now.select(d, F.when(F.col("m") > 0, F.col("t") / F.col("m")).otherwise(0.0).alias("f"))
            state = state.join(factor, d).withColumn("share", F.col("share") * F.col("f")).drop("f")
        state = cut(state)
    level = keep * total
    for _ in range(FILL):
        got = float(state.agg(F.coalesce(F.sum(F.least(F.col("tokens").cast("double"), F.col("share") * F.lit(level))), F.lit(0.0))).first()[0])
        level = level * keep * total / got if got else 0.0
    p = F.when(F.col("tokens") == 0, 1.0).otherwise(F.least(F.lit(1.0), F.col("share") * F.lit(level) / F.col("tokens")))
    return state.select(*DIMENSIONS, "share", p.alias("probability"))


def mix(rows: DataFrame, targets: dict | None = None, keep: float = KEEP, seed: str = SEED, max_cells: int = MAX_CELLS) -> DataFrame:
    """rows(doc_id, source, lang, topic, tokens, ...) with probability, and kept: whether the sample has the row."""
    targets = targets or TARGETS
    cells = cut(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    few = cells.count() <= max_cells
    raked = (rake_row if few else rake_table)(cells, targets, keep)
    raked = F.broadcast(raked) if few else raked  # max_cells rows at most
    joined = rows.join(raked.select(*DIMENSIONS, "probability"), list(DIMENSIONS))
    return joined.withColumn("kept", unit_interval(F.col("doc_id").cast("string"), seed=seed) < F.col("probability"))


def report(documents: DataFrame) -> DataFrame:
    """Every document with its cell, tokens, probability and whether the mixture has it."""
    return mix(measured(documents)).select("doc_id", *DIMENSIONS, "tokens", F.round("probability", 9).alias("probability"), "kept")


def sample(documents: DataFrame, targets: dict | None = None, keep: float = KEEP) -> DataFrame:
    """The documents that the mixture has, with the columns they came with."""
    carried = documents.select(F.struct("*").alias("row"), "doc_id", "source", "lang", "text")
    text = F.coalesce("text", F.lit(""))
    tokens = F.regexp_count(text, F.lit(WORD)).cast("long")
    rows = carried.select("row", "doc_id", *(F.coalesce(c, F.lit("(none)")).alias(c) for c in ("source", "lang")), tokens.alias("tokens"), text.alias("text"))
    rows = rows.select("row", "doc_id", "source", "lang", "tokens", default_topic(F.col("text"), F.col("tokens")).alias("topic"))
    return mix(rows, targets, keep).where("kept").select("row.*")


def _oracle() -> str:
    parts = [rf"""measured AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, coalesce(text, '') AS text,
  CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS tokens FROM documents)""",
        "docs AS (SELECT doc_id, source, lang, tokens, CASE WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, 'icense') THEN 'licence' WHEN contains(text, '@') THEN 'contact' WHEN tokens < 100 THEN 'short' ELSE 'prose' END AS topic FROM measured)",
        "cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS n FROM docs GROUP BY ALL)"]
    for d in DIMENSIONS:
        t = TARGETS[d]
        rest = f"sum(CASE WHEN {_rest_sql(t, d)} THEN sum(n) ELSE 0 END) OVER ()"
        raw = _target_sql(t, d, "sum(n)").replace("{rest}", f"greatest(1e-300, {rest})")
        raw = re.sub(r"(?<=\d)D\b", "", raw)  # DuckDB has no suffix for doubles
        parts.append(f"raw_{d} AS (SELECT {d}, {raw} AS t FROM cells GROUP BY {d})")
        parts.append(f"t_{d} AS MATERIALIZED (SELECT {d}, t / sum(t) OVER () AS t FROM raw_{d})")
    parts.append("w0 AS MATERIALIZED (SELECT source, lang, topic, n, n / sum(n) OVER () AS w FROM cells)")
    last = "w0"
    for s in range(SWEEPS):
        for d in DIMENSIONS:
            name = f"w{s + 1}_{d}"
            parts.append(f"{name} AS MATERIALIZED (SELECT source, lang, topic, n, CASE WHEN sum(w) OVER (PARTITION BY {d}) > 0 THEN w * t / sum(w) OVER (PARTITION BY {d}) ELSE 0 END AS w FROM {last} JOIN t_{d} USING ({d}))")
            last = name
    parts.append(f"l0 AS MATERIALIZED (SELECT {KEEP} * sum(n) AS l FROM cells)")
    for s in range(FILL):
        parts.append(f"l{s + 1} AS MATERIALIZED (SELECT l * {KEEP} * sum(n) / sum(least(n, l * w)) AS l FROM {last}, l{s} GROUP BY l)")
    parts.append(f"p AS (SELECT source, lang, topic, CASE WHEN n = 0 THEN 1 ELSE least(1, l * w / n) END AS p FROM {last}, l{FILL})")
    u = f"CAST('0x' || substr(md5(concat_ws(':', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 13) AS BIGINT) / {float(1 << 52)}"
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, source, lang, topic, tokens, round(p, 9) AS probability, {u} < p AS kept FROM docs JOIN p USING (source, lang, topic)"


ORACLE = _oracle()
