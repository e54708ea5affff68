"""Mixing sources to target weights (3), native: iterative proportional fitting, then sampling.

1. Documents are reduced to cells (source, language, topic) with their numbers of tokens (words).
2. Targets: each dimension's share of the tokens, either given or the observed share tempered by an
   exponent below 1, which raises rare values. Given targets need not name every value: those not
   named keep their observed shares of the rest.
3. A budget: ``share`` of all tokens is to be kept, so no cell's weight may exceed its own tokens.
4. Raking: the cells' weights are scaled to the targets of source, language and topic in turn, and a cell
   that reaches its bound is held there while the others take up the rest, until a round moves no weight by
   more than ``TOLERANCE`` of itself (or the movement shrinks no more, which means that the targets
   ask for more than some value has). The cell table is aggregated before it is joined with anything,
   and each round's sums are pre-aggregated by task, so a source with a third of the documents is one
   number in each task. A dimension's factors are broadcast while it has at most ``BROADCAST_ROWS``
   values; beyond that Spark plans the join.
5. A cell's raked over its observed tokens is the probability of each of its documents. A tiny cell is kept
   whole at most; it does not lower the others. In expectation the sample has the raked marginals and
   the budget's size, or less where a target cannot be met. A document is drawn if a hash of its id and
   text lies below the probability, so the draw does not depend on the number of tasks.

Null source or language is a value of its own (``''``), null texts are empty with 0 tokens. Documents of cells
without tokens have the probability ``share``. Repeated rows share one draw. An empty table gives an
empty result. Further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import keep, table
from tillbook.session import configure

DIMENSIONS = ("source", "lang", "topic")
EXPONENTS = {"source": 0.7, "lang": 0.7, "topic": 0.8}
SHARE = 0.3  # of the tokens are kept
TOLERANCE = 1e-10
PATIENCE = 5  # rounds in which the movement has to shrink
DIGITS = 6  # of the probabilities that the query shows
BROADCAST_ROWS = 100_000
# Topic rules, first match wins; no match is prose. Fixed values of this operator.
TOPICS = (("table", " | "), ("licence", "icense"), ("web", "://"), ("contact", "@"))
TOPIC_DEFAULT = "prose"
TOKEN = r"[^ \t\n\r]+"


def topic(text):
    """The topic of a text by its first matching marker."""
    out = F.lit(TOPIC_DEFAULT)
    for name, marker in reversed(TOPICS):
        out = F.when(F.contains(text, F.lit(marker)), name).otherwise(out)
    return out


def traits() -> dict:
    """The columns a document (doc_id, text, source, lang) is mixed by; draw lies between 0 and 1."""
    text = F.coalesce("text", F.lit(""))
    seed = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))
    draw = F.conv(F.substring(F.md5(seed.cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
    return {"source": F.coalesce("source", F.lit("")), "lang": F.coalesce("lang", F.lit("")), "topic": topic(text),
            "n_tokens": F.regexp_count(text, F.lit(TOKEN)).cast("long"), "draw": draw}


def _targets(cells: DataFrame, dim: str, exponent: float, given: dict[str, float] | None) -> DataFrame:
    """(dim, target): each value's share of the tokens."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("tokens"))
    if given:
        named = F.create_map(*[F.lit(x) for kv in given.items() for x in kv])
        sums = sums.withColumn("given", F.element_at(named, F.col(dim)))
        rest = max(0.0, 1 - sum(given.values()))
        other = sums.where("given is null").agg(F.sum("tokens").alias("all_other"))
        sums = sums.withColumn("target", F.coalesce("given", F.try_divide(F.col("tokens") * F.lit(rest), other.scalar())))
        return sums.select(dim, F.coalesce("target", F.lit(0.0)).alias("target"))
    raised = sums.withColumn("raised", F.pow("tokens", F.lit(exponent)))
    return raised.select(dim, F.coalesce(F.try_divide("raised", raised.agg(F.sum("raised")).scalar()), F.lit(0.0)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], share: float = SHARE, rounds: int | None = None) -> DataFrame:
    """``cells`` (dimensions, tokens) with the raked ``weight`` and its ``bound``, tokens / (share * all tokens); the weights
    sum to 1 if the targets can be met. ``rounds`` ends it sooner."""
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    small = {dim: target.count() <= BROADCAST_ROWS for dim, target in targets.items()}
    own = F.col("tokens").cast("double") / F.lit(total) if total else F.lit(0.0)
    now = keep(cells.withColumn("weight", own).withColumn("bound", own / F.lit(share)), "mix-cells")
    moved: list[float] = []
    while rounds is None or len(moved) < rounds:
        now = now.withColumn("before", F.col("weight"))
        for dim, target in targets.items():
            held = now.groupBy(dim).agg(F.sum("weight").alias("held"))
            factor = held.join(F.broadcast(target) if small[dim] else target, dim).select(
                dim, F.when(F.col("held") > 0, F.col("target") / F.col("held")).otherwise(1.0).alias("factor"))
            now = now.join(F.broadcast(factor) if small[dim] else factor, dim)
            now = now.withColumn("weight", F.least(F.col("weight") * F.col("factor"), F.col("bound"))).drop("factor")
        seen = Observation()
        step = F.when(F.col("before") > 0, F.abs(F.col("weight") / F.col("before") - 1)).otherwise(0.0)
        now = keep(now.observe(seen, F.max(step).alias("step")).drop("before"), "mix-round")
        moved.append(seen.get["step"] or 0.0)
        if moved[-1] <= TOLERANCE or (len(moved) > PATIENCE and moved[-1] >= moved[-1 - PATIENCE]) or math.isnan(moved[-1]):
            break
    return now


def calibrated(rows: DataFrame, exponents: dict[str, float] | None = None, given: dict[str, dict[str, float]] | None = None,
               rounds: int | None = None, share: float = SHARE) -> DataFrame:
    """(source, lang, topic, probability) from the dimensions and n_tokens of documents."""
    cells = keep(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mix-counts")
    use = {**EXPONENTS, **(exponents or {})}
    targets = {d: keep(_targets(cells, d, use[d], (given or {}).get(d)), "mix-targets") for d in DIMENSIONS}
    raked = rake(cells, targets, share, rounds)
    total = cells.agg(F.sum("tokens").cast("double")).scalar()
    odds = F.when(F.col("tokens") == 0, share).when(F.col("weight") >= F.col("bound"), 1.0).otherwise(
        F.col("weight") * share * total / F.col("tokens"))
    return keep(raked.select(*DIMENSIONS, odds.alias("probability")), "mix-odds")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, probability, sampled."""
    configure(docs.sparkSession)
    rows = keep(docs.select("doc_id", *(c.alias(n) for n, c in traits().items())), "mix-docs")
    return rows.join(calibrated(rows, **options), list(DIMENSIONS)).select(
        "doc_id", *DIMENSIONS, "n_tokens", "probability", (F.col("draw") < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``docs``, with their own columns; their texts are not shuffled for it."""
    configure(docs.sparkSession)
    own = [c.alias(f"_{n}") for n, c in traits().items() if n != "n_tokens"]
    odds = calibrated(docs.select(*(c.alias(n) for n, c in traits().items() if n != "draw")), **options)
    odds = odds.toDF(*(f"_{n}" for n in odds.columns))
    return docs.select("*", *own).join(odds, [f"_{d}" for d in DIMENSIONS]).where("_draw < _probability").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the whole documents table, tempered targets; the probabilities are rounded for display only."""
    mixed = mix(table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))
    return mixed.withColumn("probability", F.round("probability", DIGITS))


def oracle(rounds: int = 30) -> str:
    """The same in DuckDB: one materialised CTE for each scaling, a fixed number of rounds."""
    marker = " ".join(f"WHEN contains(body, '{m}') THEN '{n}'" for n, m in TOPICS)
    dims = ", ".join(DIMENSIONS)
    parts = [
        "texts AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS body FROM documents)",
        f"""docs AS MATERIALIZED (SELECT doc_id, source, lang, CASE {marker} ELSE '{TOPIC_DEFAULT}' END AS topic,
            CAST(len(regexp_extract_all(body, '{TOKEN}')) AS BIGINT) AS n_tokens,
            CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(body)), 1, 12)) AS BIGINT)
            / {float(1 << 48)} AS draw FROM texts)""",
        f"cells AS MATERIALIZED (SELECT {dims}, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM docs GROUP BY ALL)",
        f"r0 AS MATERIALIZED (SELECT *, weight / {SHARE} AS bound FROM (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS weight FROM cells))",
    ]
    for d in DIMENSIONS:
        parts.append(f"""t_{d} AS MATERIALIZED (SELECT {d}, p / sum(p) OVER () AS target
            FROM (SELECT {d}, pow(sum(tokens), {EXPONENTS[d]}) AS p FROM cells GROUP BY {d}))""")
    k = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            parts.append(f"""r{k + 1} AS MATERIALIZED (SELECT {dims}, tokens, bound,
                least(bound, weight * CASE WHEN held > 0 THEN target / held ELSE 1.0 END) AS weight
                FROM (SELECT *, sum(weight) OVER (PARTITION BY {d}) AS held FROM r{k}) JOIN t_{d} USING ({d}))""")
            k += 1
    parts.append(f"""odds AS MATERIALIZED (SELECT {dims},
        CASE WHEN tokens = 0 THEN {SHARE} WHEN weight >= bound THEN 1.0 ELSE weight * {SHARE} * (SELECT sum(tokens) FROM cells) / tokens END AS p FROM r{k})""")
    return (f"WITH {', '.join(parts)} SELECT doc_id, {dims}, n_tokens, round(p, {DIGITS}) AS probability, draw < p AS sampled "
            f"FROM docs JOIN odds USING ({dims})")
