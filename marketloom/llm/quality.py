"""Quality rules with adaptive thresholds.

Four features per document are put into logarithmic buckets; the bucket counts per language and
source are a quantile sketch with bounded relative error that merges by addition. A high quantile of
the merged counts, and a little more, is the upper fence of a group, and documents are joined with
their group's fences. Groups with few documents use the sketch of their language, then that of all documents.

Only DataFrame functions. The text is read once; features are checkpointed, because they are
used by the sketch and by the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.sqlwords import GAP_CHARS, let, words
from marketloom.session import checkpointed

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Parameters of the method: relative error of a bucket, documents a group needs for fences of
#: its own, and per feature the quantile of a fence and the slack above it. The slack keeps a group whose
#: documents are all alike from rejecting a document for one odd word or line.
ACCURACY = 0.02
MIN_GROUP = 100
FENCES = {"symbol_share": (0.9, 0.25), "dup_line_share": (0.98, 0.15), "repeat_share": (0.98, 0.15), "word_length": (0.9, 1.0)}
PROBS = {f"q{round(100 * p)}": p for p, _ in FENCES.values()}
LEVELS = (("lang", "source"), ("lang",), ())


def repeated_window_words(w: Column, size: int = WINDOW) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the word array ``w``.

    Windows are compared by 64-bit hashes; sorted hashes bring equal windows together.
    """
    def spans(hashes: Column) -> Column:
        at = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.struct(
            F.xxhash64(F.slice(hashes, i + 1, size)).alias("h"), i.alias("i")))

        def repeated(s: Column) -> Column:
            return F.array_sort(F.transform(F.filter(
                F.transform(s, lambda x, k: F.struct(
                    x["i"].alias("i"),
                    (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
                lambda x: x["twice"]), lambda x: x["i"]))

        def covered(starts: Column) -> Column:
            return F.aggregate(
                F.transform(starts, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(starts, k + 1) - x, F.lit(size)))),
                F.lit(0).cast("long"), lambda a, x: a + x)

        return let(at, lambda a: F.when(
            F.size(F.array_distinct(F.transform(a, lambda x: x["h"]))) == F.size(a), F.lit(0).cast("long")
        ).otherwise(let(let(F.array_sort(a), repeated), covered)))

    hashed = F.transform(w, lambda x: F.xxhash64(x))
    return F.when(F.size(w) > size, let(hashed, spans)).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words; null
    texts count nothing."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, GAP_CHARS, "")) > 0)
    by_word = let(words(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeated_window_words(w).alias("rep")))
    return docs.withColumn("_w", by_word).withColumn("_l", let(
        lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))).select(
        *[c for c in docs.columns if c != text],
        F.col("_w.n").alias("n_words"),
        F.length(F.translate(t, GAP_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.col("_l.n").alias("n_lines"),
        F.col("_l.dup").alias("n_dup_lines"),
        F.col("_w.rep").alias("n_repeat_words"),
    )


def _shares() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbol_share": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
        "repeat_share": F.col("n_repeat_words") / n,
        "word_length": F.col("word_chars") / n,
    }


def bucket_of(x: Column, accuracy: float = ACCURACY) -> Column:
    """Logarithmic bucket of a value >= 0; values below 1e-6 share the lowest one."""
    return F.ceil(F.log(F.greatest(x, F.lit(1e-6))) / F.log(F.lit((1 + accuracy) / (1 - accuracy)))).cast("int")


def sketch(rows: DataFrame, values: dict[str, Column], keys: tuple[str, ...]) -> DataFrame:
    """Mergeable sketch: keys, feature, bucket, n. Two sketches merge by adding n per bucket."""
    long = rows.select(*keys, F.explode(F.create_map(*[
        x for name, v in values.items() for x in (F.lit(name), bucket_of(v))])).alias("feature", "bucket"))
    return long.groupBy(*keys, "feature", "bucket").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sk: DataFrame, keys: tuple[str, ...], probs: dict[str, float], accuracy: float = ACCURACY) -> DataFrame:
    """keys, feature, total and one column per quantile. A window holds the buckets of one
    feature of one group, a number bounded by the accuracy and not by the rows."""
    part = Window.partitionBy(*keys, "feature")
    below = part.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sk.withColumns({"upto": F.sum("n").over(below), "total": F.sum("n").over(part)})
    gamma = (1 + accuracy) / (1 - accuracy)
    value = F.pow(F.lit(gamma), F.col("bucket")) * (2 / (1 + gamma))
    return ranked.groupBy(*keys, "feature").agg(
        F.first("total").alias("total"),
        *[F.min(F.when(F.col("upto") >= F.col("total") * p, value)).alias(name) for name, p in probs.items()])


def fences(sk: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """keys, total, fences (feature -> largest accepted value)."""
    q = quantiles(sk, keys, PROBS)
    top = F.coalesce(*[F.when(F.col("feature") == f, F.col(f"q{round(100 * p)}") + slack) for f, (p, slack) in FENCES.items()])
    return q.groupBy(*keys).agg(
        F.max("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("feature", top))).alias("fences"))


def judge(docs: DataFrame, min_group: int = MIN_GROUP,
          id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, lang, source, features, base_failed, kept, reason.

    Reads ``id``, ``text``, ``lang`` and ``source``; other columns are not read. Null languages
    and sources form groups of their own. Null and empty texts fail the base rules. Repeated
    rows are judged alike and count each for the fences; an empty table gives no rows.
    Documents that fail the base rules stay out of the sketch, so junk doesn't move the fences.
    """
    f = checkpointed(features(docs.select(F.col(id).alias(id), F.col(text).alias("_text"), "lang", "source"), "_text"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    f = f.withColumn("base_failed", base_failed)
    fine = sketch(f.filter(~F.col("base_failed")), _shares(), LEVELS[0])
    out = f
    for k, keys in enumerate(LEVELS):
        # The sketch of a wider level is the sum of the sketches below it.
        own = fine.groupBy(*keys, "feature", "bucket").agg(F.sum("n").alias("n")) if k else fine
        table = fences(own, keys).filter(F.col("total") >= (min_group if keys else 0))
        named = table.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("fences").alias(f"_f{k}"))
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
        out = out.join(named, on, "left") if keys else out.join(F.broadcast(named), F.lit(True), "left")  # one row
        out = out.drop(*[f"_{c}" for c in keys])
    fence = F.coalesce(*[F.col(f"_f{k}") for k in range(len(LEVELS))])
    over = F.filter(F.array(*[
        F.when(v > F.coalesce(fence[name], F.lit(float("inf"))), F.lit(name)) for name, v in _shares().items()
    ]), lambda x: x.isNotNull())
    return out.withColumn("_over", over).select(
        id, "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("_over") == 0)).alias("kept"),
        F.when(F.col("base_failed"), F.lit("base")).when(F.size("_over") > 0, F.array_join("_over", ",")).alias("reason"),
        fence.alias("fences"))


def quality_digest(docs: DataFrame) -> DataFrame:
    return judge(docs).drop("lang", "source", "n_lines", "reason", "fences")


def digest_sql() -> str:
    """The same counts, sketches and fences in SQL over documents."""
    gap = "[\\x20\\x09-\\x0D]+"
    words, lines = ("greatest({}, 1)::DOUBLE".format(c) for c in ("n_words", "n_lines"))
    values = {"symbol_share": f"n_symbols / {words}", "dup_line_share": f"n_dup_lines / {lines}",
              "repeat_share": f"n_repeat_words / {words}", "word_length": f"word_chars / {words}"}
    top = " ".join(f"WHEN '{f}' THEN q{round(100 * p)} + {slack}" for f, (p, slack) in FENCES.items())
    long = " UNION ALL ".join(
        f"SELECT lang, source, '{f}' AS feature, greatest({c}, 1e-6) AS x FROM fine" for f, c in values.items())
    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    levels = []
    for k, keys in enumerate(LEVELS):
        by = "".join(f"{c}, " for c in keys)
        group = f"PARTITION BY {by}feature"
        levels.append(f"""
ranked{k} AS (SELECT {by}feature, bucket, sum(n) OVER ({group} ORDER BY bucket) AS upto, sum(n) OVER ({group}) AS total
  FROM (SELECT {by}feature, bucket, sum(n) AS n FROM sketch GROUP BY ALL)),
fence{k} AS (SELECT {by}feature, total, CASE feature {top} END AS top FROM (
  SELECT {by}feature, total, {', '.join(f"min(CASE WHEN upto >= total * {p}::DOUBLE THEN pow({gamma}, bucket) * {2 / (1 + gamma)} END) AS {q}" for q, p in PROBS.items())}
  FROM ranked{k} GROUP BY ALL))""")

    def fence(f: str) -> str:
        tries = []
        for k, keys in enumerate(LEVELS):
            same = "".join(f" AND t.{c} IS NOT DISTINCT FROM d.{c}" for c in keys)
            tries.append(f"(SELECT top FROM fence{k} t WHERE t.feature = '{f}' AND t.total >= {MIN_GROUP if keys else 0}{same})")
        return f"coalesce({', '.join(tries)}, 'infinity'::DOUBLE)"

    over = " OR ".join(f"{c} > {fence(f)}" for f, c in values.items())
    return f"""
WITH split_up AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '{gap}'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM split_up)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY r),
counted AS (
  SELECT s.doc_id, lang, source, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(t) - len(translate(t, '{SYMBOLS}', '')) AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) AS n_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM split_up s LEFT JOIN repeats USING (r)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
fine AS (SELECT * FROM judged WHERE NOT base_failed),
sketch AS (SELECT lang, source, feature, ceil(ln(x) / ln({gamma}))::INT AS bucket, count(*) AS n FROM ({long}) GROUP BY ALL),
{','.join(levels)}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT ({over}) AS kept
FROM judged d"""
