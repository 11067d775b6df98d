"""Mixing sources to target weights: iterative proportional fitting.

1. Documents are added up into cells (source, language, topic) by a map-side
   combined aggregate; only cells take part in the fitting.
2. Cell weights start as token counts and are raked in turn to the target
   marginals of source, language and topic, ``rounds`` times.
3. A cell's ratio of fitted weight to tokens, divided by the largest ratio, is
   the probability with which each of its documents is kept.  The draw is a
   hash of the document id, so it is the same on every run and cluster.

DataFrame functions only.  Cells are distinct combinations, not documents: a
counted number of at most ``ONE_TASK_CELLS`` is raked inside one task without
any exchange, a larger one by the same windows with exchanges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarry.session import materialize

DIMS = ("source", "lang", "topic")
ROUNDS = 25
ONE_TASK_CELLS = 20_000
BROADCAST_CELLS = 200_000  # cells of about 60 bytes
#: Exponents that turn observed shares into target shares: 1 keeps them, 0 makes all equal.
TEMPER = {"source": 0.95, "lang": 0.95, "topic": 0.97}
NONE = "(none)"


def n_words(text: Column) -> Column:
    """Blank-separated words: the token weight when no token count is given."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t == "", F.lit(0)).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


def topic(text: Column) -> Column:
    """Kind of text by what it contains; the first that holds."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(t, F.lit("License")) | F.contains(t, F.lit("Copyright")), "legal")
            .when(F.contains(t, F.lit(" | ")), "table").when(F.contains(t, F.lit("@")), "contact")
            .when(F.contains(t, F.lit("!!")), "shout").otherwise("prose"))


def cells_of(docs: DataFrame, columns: list, topic_col: Column | None = None, tokens: Column | None = None,
             source_col: str = "source", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``columns`` of ``docs`` and ``_source``, ``_lang``, ``_topic`` (null is a
    value of its own) and ``_tokens``."""
    own = [F.col(source_col), F.col(lang_col), topic(F.col(text_col)) if topic_col is None else topic_col]
    n = n_words(F.col(text_col)) if tokens is None else F.coalesce(tokens, F.lit(0)).cast("long")
    return docs.select(*columns, *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(f"_{d}") for d, c in zip(DIMS, own)],
                       n.alias("_tokens"))


def tempered_targets(cells: DataFrame, powers: dict[str, float] | None = None) -> dict[str, DataFrame]:
    """Per dimension: (value, target share), the observed share to a power."""
    out = {}
    for d in DIMS:
        power = (powers or TEMPER)[d]
        shares = cells.groupBy(f"_{d}").agg(F.sum("_tokens").alias("_n"))
        total = shares.agg(F.sum(F.pow(F.col("_n").cast("double"), F.lit(float(power)))).alias("s")).collect()[0]["s"]
        out[d] = shares.select(F.col(f"_{d}").alias("value"),
                               (F.pow(F.col("_n").cast("double"), F.lit(float(power))) / F.lit(total or 1.0)).alias("share"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, n_cells: int | None = None) -> DataFrame:
    """Cells with tokens, and their fitted ``_weight``.  A value without a
    target share gets weight 0; a target that no cell has is ignored."""
    n_cells = cells.count() if n_cells is None else n_cells
    fitted = cells.where("_tokens > 0")
    for d in DIMS:
        t = targets[d].select(F.col("value").alias(f"_{d}"), F.col("share").alias(f"_t_{d}"))
        fitted = fitted.join(t, f"_{d}", "left")
    if n_cells <= ONE_TASK_CELLS:
        fitted = fitted.coalesce(1)
    fitted = fitted.withColumn("_weight", F.col("_tokens").cast("double"))
    for _ in range(rounds):
        for d in DIMS:
            now = F.sum("_weight").over(Window.partitionBy(f"_{d}"))
            fitted = fitted.withColumn("_weight", F.when(now > 0, F.col("_weight") * F.coalesce(f"_t_{d}", F.lit(0.0)) / now)
                                       .otherwise(0.0))
    return fitted.select(*[f"_{d}" for d in DIMS], "_tokens", "_weight")


def probabilities(fitted: DataFrame) -> DataFrame:
    ratio = F.col("_weight") / F.col("_tokens")
    top = fitted.agg(F.max(ratio).alias("m")).collect()[0]["m"]
    return fitted.select(*[F.col(f"_{d}").alias(f"_c_{d}") for d in DIMS], (ratio / F.lit(top or 1.0)).alias("_prob"))


def draw(id_col: Column, seed: int = 7) -> Column:
    """Uniform in [0, 1) from the id (null ids share one draw)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(NONE))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


CELL_COLUMNS = ("_source", "_lang", "_topic", "_tokens", "_prob", "_keep")


def _weighed(docs: DataFrame, carried: list[str], targets: dict[str, DataFrame] | None = None, powers: dict[str, float] | None = None,
             rounds: int = ROUNDS, seed: int = 7, id_col: str = "doc_id", **kw) -> DataFrame:
    """``CELL_COLUMNS`` and the struct ``_row`` of the carried columns, which
    therefore may have any names."""
    row = F.struct(*[docs[f"`{c}`"] for c in carried])
    placed = cells_of(docs, [row.alias("_row"), draw(F.col(id_col), seed).alias("_draw")], **kw)
    cells = materialize(placed.groupBy(*[f"_{d}" for d in DIMS]).agg(F.sum("_tokens").alias("_tokens")), "mixing-cells")
    n_cells = cells.count()
    probs = materialize(probabilities(rake(cells, targets or tempered_targets(cells, powers), rounds, n_cells)), "mixing-probs")
    if n_cells <= BROADCAST_CELLS:
        probs = F.broadcast(probs)
    on = [F.col(f"_{d}") == F.col(f"_c_{d}") for d in DIMS]
    return (placed.join(probs, on, "left").withColumn("_prob", F.coalesce("_prob", F.lit(1.0)))
            .select("_row", *CELL_COLUMNS[:-1], (F.col("_draw") < F.col("_prob")).alias("_keep")))


def weigh(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with ``_source``, ``_lang``, ``_topic``, ``_tokens``, ``_prob``
    and ``_keep``, which take the place of columns of these names.  Empty and
    null texts have no tokens; a cell without any does not bear on the mix and
    keeps its documents (probability 1).  Repeated rows are kept or dropped
    together; an empty table gives an empty result."""
    return _weighed(docs, [c for c in docs.columns if c not in CELL_COLUMNS], **kw).select("_row.*", *CELL_COLUMNS)


def report(docs: DataFrame, **kw) -> DataFrame:
    """One row per document: its cell, tokens, probability and whether the
    sample keeps it (see ``weigh``); other columns are ignored."""
    return _weighed(docs, ["doc_id"], **kw).select(
        "_row.doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"), F.round("_prob", 6).alias("prob"), F.col("_keep").alias("kept"))


def sample(docs: DataFrame, **kw) -> DataFrame:
    """The documents (all their columns, whatever their names) that the
    calibrated sample keeps (see ``weigh``)."""
    return _weighed(docs, docs.columns, **kw).where("_keep").select("_row.*")


def oracle_sql(rounds: int = ROUNDS, powers: dict[str, float] | None = None, seed: int = 7) -> str:
    """The same in DuckDB SQL: one common table per raking step."""
    p = powers or TEMPER
    steps = ["""d AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
         CASE WHEN contains(t, 'License') OR contains(t, 'Copyright') THEN 'legal' WHEN contains(t, ' | ') THEN 'table'
              WHEN contains(t, '@') THEN 'contact' WHEN contains(t, '!!') THEN 'shout' ELSE 'prose' END AS topic,
         CAST(CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END AS BIGINT) AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
)""", """c AS (SELECT source, lang, topic, sum(n_tokens) AS n FROM d GROUP BY ALL)"""]
    for x in DIMS:
        steps.append(f"""t_{x} AS (
  SELECT {x}, pow(CAST(sum(n) AS DOUBLE), {p[x]}) / sum(pow(CAST(sum(n) AS DOUBLE), {p[x]})) OVER () AS share FROM c GROUP BY {x})""")
    steps.append("""w0 AS (
  SELECT c.source, c.lang, c.topic, c.n, a.share AS s_source, b.share AS s_lang, e.share AS s_topic, CAST(c.n AS DOUBLE) AS w
  FROM c JOIN t_source a USING (source) JOIN t_lang b USING (lang) JOIN t_topic e USING (topic) WHERE c.n > 0)""")
    k = 0
    for _ in range(rounds):
        for x in DIMS:
            steps.append(f"w{k + 1} AS (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY {x}) > 0 "
                         f"THEN w * s_{x} / sum(w) OVER (PARTITION BY {x}) ELSE 0 END AS w) FROM w{k})")
            k += 1
    steps.append(f"p AS (SELECT source, lang, topic, (w / n) / max(w / n) OVER () AS prob FROM w{k})")
    return f"""WITH {', '.join(steps)}
SELECT doc_id, d.source, d.lang, d.topic, n_tokens, round(coalesce(prob, 1), 6) AS prob,
       CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '(none)')), 1, 8) AS BIGINT) / 4294967296.0
         < coalesce(prob, 1) AS kept
FROM d LEFT JOIN p ON d.source = p.source AND d.lang = p.lang AND d.topic = p.topic"""
