"""Quality rules: base limits, then robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics in whole thousandths, so that all sums are
exact and do not depend on the order of rows. Per (language, source) a minimum covariance
determinant estimate is refined from a median/MAD start by concentration steps: the three
quarters of rows nearest to the current centre give the next mean and covariance. A row is
rejected if its squared Mahalanobis distance under the last estimate is over the cutoff.
Everything is DataFrame and SQL functions; one expression text serves Spark and the check SQL.

Scale: statistics are computed where the text is read; no text is shuffled. Each step is a
map-side combined aggregate of fixed width per group, and medians run over whole thousandths,
whose number of distinct values is bounded. A group may hold any share of the rows.

Defined cases: a null or blank text has no words and fails the base limits; a null language or
source is a value of its own; groups of under ``MIN_GROUP`` rows share one pool, and a pool of
under ``MIN_POOL`` rows rejects nothing; repeated rows count as often as they occur; an empty
table gives an empty result. Texts may have up to 2**24 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenderline.llm.common import words, written

FEATURES = ["f_length", "f_word", "f_symbol", "f_line", "f_repeat"]
#: Least standard deviation of each feature, in thousandths: a constant feature still has a scale, and
#: one repeated line is no more than one deviation.
FLOORS = [400, 80, 400, 700, 600]
SYMBOLS = "#*$%&|<>"
STEPS = 3
SHARE = 0.75
#: Chi-square with 5 degrees of freedom: consistency factor of a 75 % subset, and the cutoff at 1 - 1e-9.
CONSISTENCY, CUTOFF = 1.41, 50.8
MIN_GROUP, MIN_POOL = 50, 12
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_LOW = (1 << 24) - 1


def _thousandths(x: str) -> str:
    return f"CAST(floor(1000 * ln(1 + {x}) + 0.5) AS BIGINT)"


def feature_sql() -> dict[str, str]:
    """Transformed statistics, as SQL over the base columns of texts with a word."""
    n = "CAST(n_words AS DOUBLE)"
    return {
        "f_length": _thousandths(n),
        "f_word": _thousandths(f"word_chars / {n}"),
        "f_symbol": _thousandths(f"100 * n_symbols / {n}"),
        "f_line": _thousandths("CAST(n_dup_lines AS DOUBLE)"),
        "f_repeat": _thousandths(f"100 * n_repeat_words / {n}"),
    }


def start_distance_sql() -> str:
    """Squared distance from the medians, scaled by the MADs."""
    return " + ".join(f"power(({f} - med_{f}) / greatest(1.4826 * mad_{f}, {floor}.0), 2)" for f, floor in zip(FEATURES, FLOORS))


def score_sql(distance: str) -> str:
    """A distance in whole steps, for exact and bounded order statistics."""
    return f"CAST(floor(1000 * ln(1 + ({distance}))) AS BIGINT)"


def sums_sql() -> dict[str, str]:
    out = {"n": "count(*)"}
    for i, a in enumerate(FEATURES):
        out[f"s{i}"] = f"sum({a})"
        for j in range(i + 1):
            out[f"s{i}{j}"] = f"sum({a} * {FEATURES[j]})"
    return out


def factor_sql() -> list[dict[str, str]]:
    """Mean and Cholesky factor of the covariance from the sums, one layer per column."""
    d = range(len(FEATURES))
    as_double = lambda x: f"CAST({x} AS DOUBLE)"
    cov = {f"m{i}": f"{as_double(f's{i}')} / n" for i in d}
    for i in d:
        for j in range(i + 1):
            ridge = f" + {FLOORS[i] ** 2}.0" if i == j else ""
            cov[f"c{i}{j}"] = f"({as_double(f's{i}{j}')} - {as_double(f's{i}')} / n * {as_double(f's{j}')}) / n{ridge}"
    layers = [cov]
    for j in d:
        dots = lambda i: "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        layers.append({f"l{j}{j}": f"sqrt(c{j}{j}{dots(j)})"})
        below = {f"l{i}{j}": f"(c{i}{j}{dots(i)}) / l{j}{j}" for i in range(j + 1, len(FEATURES))}
        if below:
            layers.append(below)
    return layers


def estimate_columns() -> list[str]:
    d = range(len(FEATURES))
    return [f"m{i}" for i in d] + [f"l{i}{j}" for i in d for j in range(i + 1)]


def whiten_sql() -> list[dict[str, str]]:
    """Forward substitution z = L^-1 (f - mean), one layer per coordinate."""
    return [{f"z{i}": f"({FEATURES[i]} - m{i}" + "".join(f" - l{i}{k} * z{k}" for k in range(i)) + f") / l{i}{i}"} for i in range(len(FEATURES))]


DISTANCE = " + ".join(f"z{i} * z{i}" for i in range(len(FEATURES)))


def _layers(df: DataFrame, layers: list[dict[str, str]]) -> DataFrame:
    for layer in layers:
        df = df.withColumns({name: F.expr(sql) for name, sql in layer.items()})
    return df


def repeated_words(w: str) -> tuple[dict[str, Column], Column]:
    """Layers of columns, and the count of words in 3-word windows that occur twice or more.

    Windows are hashed, packed with their position into one long and sorted as primitives;
    equal neighbours are confirmed on the whole hash.
    """
    at = lambda name, i: F.get(F.col(name), i)
    whole = lambda x: at("tri", x.bitwiseAND(F.lit(_LOW)).cast("int"))
    layers = {
        "word_hash": F.transform(F.col(w), lambda x: F.xxhash64(x)),
        "tri": F.transform(
            F.slice(F.col("word_hash"), 1, F.greatest(F.size("word_hash") - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, at("word_hash", i + 1), at("word_hash", i + 2)),
        ),
        "packed": F.sort_array(F.transform(F.col("tri"), lambda x, i: x.bitwiseAND(F.lit(~_LOW)).bitwiseOR(i.cast("bigint")))),
        "twice": F.sort_array(
            F.transform(
                F.filter(F.col("packed"), lambda x, i: (whole(x) == F.when(i > 0, whole(at("packed", i - 1)))) | (whole(x) == whole(at("packed", i + 1)))),
                lambda x: x.bitwiseAND(F.lit(_LOW)),
            )
        ),
    }
    covered = F.transform(F.col("twice"), lambda p, i: F.least(F.lit(3).cast("bigint"), F.coalesce(at("twice", i + 1) - p, F.lit(3).cast("bigint"))))
    return layers, F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)


def base_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The named columns, ``lang``, ``source`` and the base counts of every text."""
    has_word = lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")) != ""
    lines = F.transform(F.filter(F.split(F.col("the_text"), "\n"), has_word), lambda x: F.xxhash64(x))
    df = docs.select(
        *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col("lang").alias("of_lang"), F.col("source").alias("of_source"),
        F.coalesce(F.col("text"), F.lit("")).alias("the_text"),
    )
    df = df.select(
        "*",
        F.char_length(F.translate("the_text", " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        (F.char_length("the_text") - F.char_length(F.translate("the_text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("line_hash"), words(F.col("the_text")).alias("word_list"),
    ).drop("the_text")
    layers, repeated = repeated_words("word_list")
    df = df.withColumn("n_words", F.size("word_list").cast("bigint")).withColumn("n_dup_lines", (F.size("line_hash") - F.size(F.array_distinct("line_hash"))).cast("bigint"))
    for name, column in layers.items():
        df = df.withColumn(name, column)
    return df.withColumn("n_repeat_words", repeated).drop("word_list", "line_hash", *layers)


def _joined(df: DataFrame, by_group: DataFrame) -> DataFrame:
    return df.join(by_group, (F.col("of_group") == F.col("for_group")), "left").drop("for_group")


def judge(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Named columns of ``docs`` (default doc_id), base counts, ``base_failed``, ``distance``, ``kept``."""
    keep = ["doc_id"] if keep is None else keep
    stats = base_statistics(docs, keep).withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
    stats = stats.withColumns({f: F.expr(f"CASE WHEN n_words > 0 THEN {sql} ELSE 0 END") for f, sql in feature_sql().items()})
    named = F.to_json(F.struct("of_lang", "of_source"))
    stats = written(stats.withColumn("own_group", named), "quality-stats")
    sizes = stats.where("NOT base_failed").groupBy("own_group").agg(F.count("*").alias("rows")).withColumnRenamed("own_group", "name")
    large = written(sizes.where(F.col("rows") >= MIN_GROUP), "quality-groups")
    stats = stats.join(large, F.col("own_group") == F.col("name"), "left").withColumn("of_group", F.coalesce("name", F.lit("small"))).drop("name", "rows")

    passing = stats.where("NOT base_failed").select("of_group", *FEATURES)
    medians = passing.groupBy(F.col("of_group").alias("for_group")).agg(*[F.expr(f"percentile({f}, 0.5)").alias(f"med_{f}") for f in FEATURES])
    centred = _joined(passing, medians).select(F.col("of_group").alias("for_group"), *[f"med_{f}" for f in FEATURES], *[F.expr(f"abs({f} - med_{f})").alias(f"dev_{f}") for f in FEATURES])
    start = centred.groupBy("for_group").agg(
        *[F.first(f"med_{f}").alias(f"med_{f}") for f in FEATURES], *[F.expr(f"percentile(dev_{f}, 0.5)").alias(f"mad_{f}") for f in FEATURES]
    )
    scored = _joined(passing, written(start, "quality-start")).withColumn("score", F.expr(score_sql(start_distance_sql())))
    for step in range(STEPS + 1):
        nearest = scored.groupBy(F.col("of_group").alias("for_group")).agg(F.expr(f"percentile(score, {SHARE})").alias("limit"))
        subset = _joined(scored.select("of_group", *FEATURES, "score"), nearest).where("score <= limit")
        sums = subset.groupBy(F.col("of_group").alias("for_group")).agg(*[F.expr(sql).alias(name) for name, sql in sums_sql().items()])
        estimate = written(_layers(sums, factor_sql()).select("for_group", "n", *estimate_columns()), "quality-estimate")
        scored = _layers(_joined(passing, estimate.drop("n")), whiten_sql()).withColumn("score", F.expr(score_sql(DISTANCE)))
    judged = _layers(_joined(stats, estimate), whiten_sql()).withColumn("distance", F.expr(f"({DISTANCE}) / {CONSISTENCY}"))
    kept = F.expr(f"NOT base_failed AND (n IS NULL OR n < {SHARE} * {MIN_POOL} OR distance <= {CUTOFF})")
    back = [F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)]
    return judged.select(*back, *_BASE, "base_failed", "distance", kept.alias("kept"))


def judge_sql() -> str:
    """DuckDB SQL of the same verdicts over the table documents."""
    def layered(name: str, source: str, layers: list[dict[str, str]]) -> str:
        out, at = [], source
        for i, layer in enumerate(layers):
            out.append(f"{name}_{i} AS (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in layer.items())} FROM {at})")
            at = f"{name}_{i}"
        return ",\n".join(out) + f",\n{name} AS (SELECT * FROM {at})"

    features = ", ".join(f"CASE WHEN n_words > 0 THEN {sql} ELSE 0 END AS {f}" for f, sql in feature_sql().items())
    text = f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT row, doc_id, lang, source, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM texts),
windows AS (
  SELECT row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS tri
  FROM (SELECT row, w, unnest(generate_series(1, len(w) - 2)) AS i FROM split)),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, tri) AS c FROM windows) WHERE c > 1),
repeated AS (SELECT row, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS offsets(o) GROUP BY row),
base AS (
  SELECT s.row, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN repeated r ON s.row = r.row),
judged_base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {features} FROM base),
grouped AS (
  SELECT *, CASE WHEN count(*) FILTER (NOT base_failed) OVER (PARTITION BY lang, source) >= {MIN_GROUP}
                 THEN coalesce('l' || lang, '') || '/' || coalesce('s' || source, '') ELSE 'small' END AS of_group
  FROM judged_base),
passing AS (SELECT row, of_group, {', '.join(FEATURES)} FROM grouped WHERE NOT base_failed),
medians AS (SELECT of_group, {', '.join(f'quantile_cont({f}, 0.5) AS med_{f}' for f in FEATURES)} FROM passing GROUP BY of_group),
start AS (
  SELECT of_group, {', '.join(f'any_value(med_{f}) AS med_{f}, quantile_cont(abs({f} - med_{f}), 0.5) AS mad_{f}' for f in FEATURES)}
  FROM passing JOIN medians USING (of_group) GROUP BY of_group),
scored_0 AS (SELECT row, of_group, {', '.join(FEATURES)}, {score_sql(start_distance_sql())} AS score FROM passing JOIN start USING (of_group))"""
    for k in range(STEPS + 1):
        text += f""",
limits_{k} AS (SELECT of_group, quantile_cont(score, {SHARE}) AS near FROM scored_{k} GROUP BY of_group),
sums_{k} AS (
  SELECT of_group, {', '.join(f'{sql} AS {name}' for name, sql in sums_sql().items())}
  FROM scored_{k} JOIN limits_{k} USING (of_group) WHERE score <= near GROUP BY of_group),
{layered(f'estimate_{k}', f'sums_{k}', factor_sql())}"""
        rows = "passing" if k < STEPS else "grouped"
        columns = f"row, of_group, {', '.join(FEATURES)}" if k < STEPS else "*"
        text += f""",
{layered(f'white_{k}', f'(SELECT {rows}.*, {", ".join(["n", *estimate_columns()])} FROM {rows} LEFT JOIN estimate_{k} USING (of_group))', whiten_sql())}"""
        if k < STEPS:
            text += f""",
scored_{k + 1} AS (SELECT {columns}, {score_sql(DISTANCE)} AS score FROM white_{k})"""
    return text + f"""
SELECT doc_id, {', '.join(_BASE)}, base_failed,
       NOT base_failed AND (n IS NULL OR n < {SHARE} * {MIN_POOL} OR ({DISTANCE}) / {CONSISTENCY} <= {CUTOFF}) AS kept
FROM white_{STEPS}"""
