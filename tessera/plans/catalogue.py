"""The registered queries over the driver tables, and their DuckDB SQL.

documents stand for articles, labels (left-joined, missing is `uncertain`) for annotated tasks, embeddings for the pooled output
of an encoder, the first two turns of conversations for title and content. Doubles are rounded to six places.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BATCH_SIZE
from ..functions.arrays import label_of
from ..functions.text import clean_text, fixed, joint_length, task_name
from ..operators import clean, encode, metrics, model, predict, profile, split, tokens, train, validate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
TASKS = {"quality_label": ["no", "yes", "uncertain"], "toxic_label": ["no", "yes", "uncertain"], "lang_label": ["no", "yes", "uncertain"], "length_label": ["A", "B", "C"]}
HEADS = {"first": ["no", "yes", "uncertain"], "second": ["A", "B", "C"], "third": ["no", "yes", "uncertain"], "fourth": ["no", "yes", "uncertain"]}
#: A task's true class is the label divided by this, modulo 3.
TRUTH = {"first": 1, "second": 2, "third": 3, "fourth": 4}
WIDTH = 64
WEIGHTS = {"first": [0.5, 1.0, 2.0], "second": [1.0, 1.5, 0.75], "third": [1.0, 1.0, 1.0], "fourth": [2.0, 0.25, 1.25]}
#: epoch, mean macro-F1: better, level, equal (no improvement), better, worse, worse, and one that isn't reached.
HISTORY = [(1, 0.41), (2, 0.52), (3, 0.52), (4, 0.58), (5, 0.57), (6, 0.55), (7, 0.90)]


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lambda c: F.when(F.col(c) == 1, "yes").when(F.col(c) == 0, "no").otherwise("uncertain")
    band = F.when(F.col("n_chars") < 800, "A").when(F.col("n_chars") < 2500, "B").otherwise("C")
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.withColumns({"quality_label": named("quality"), "toxic_label": named("toxic"), "lang_label": F.when(F.col("lang") == "en", "yes").when(F.col("lang") == "de", "no").otherwise("uncertain"), "length_label": band}).drop("quality", "toxic")


LABELLED = """labelled AS (SELECT d.*, CASE l.quality WHEN 1 THEN 'yes' WHEN 0 THEN 'no' ELSE 'uncertain' END AS quality_label,
    CASE l.toxic WHEN 1 THEN 'yes' WHEN 0 THEN 'no' ELSE 'uncertain' END AS toxic_label,
    CASE d.lang WHEN 'en' THEN 'yes' WHEN 'de' THEN 'no' ELSE 'uncertain' END AS lang_label, CASE WHEN d.n_chars < 800 THEN 'A' WHEN d.n_chars < 2500 THEN 'B' ELSE 'C' END AS length_label
    FROM documents d LEFT JOIN labels l USING (doc_id))"""
LONG_LABELS = LABELLED + """, long AS (SELECT doc_id, 'quality_label' AS task, quality_label AS label FROM labelled
    UNION ALL SELECT doc_id, 'toxic_label', toxic_label FROM labelled UNION ALL SELECT doc_id, 'lang_label', lang_label FROM labelled UNION ALL SELECT doc_id, 'length_label', length_label FROM labelled)"""
CLASSES = "classes(task, place, label) AS (VALUES " + ", ".join(f"('{t}', {i}, '{c}')" for t, cs in TASKS.items() for i, c in enumerate(cs)) + ")"
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")

# --- profiles


@query(
    "dedup_lang_share",
    """WITH kept AS (SELECT text, min_by(lang, doc_id) AS lang FROM documents GROUP BY text)
    SELECT lang, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM kept WHERE lang IS NOT NULL GROUP BY lang""",
)
def dedup_lang_share(spark, sf_dir):
    kept = clean.dedupe_first(read(spark, sf_dir, "documents").select("text", "lang", "doc_id"), "doc_id", ["text"])
    return rounded(profile.shares(profile.value_counts(kept, "lang")), "share_pct")


def joined_raw(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")


@query(
    "missing_by_column",
    "WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_missing FROM j" for c in (*DOCUMENTS, "quality", "toxic")),
)
def missing_by_column(spark, sf_dir):
    return profile.missing(joined_raw(spark, sf_dir))


KINDS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint", "quality": "int", "toxic": "int"}


@query(
    "schema_profile",
    "WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS dtype, count({c}) AS n_filled FROM j" for c, k in KINDS.items()),
)
def schema_profile(spark, sf_dir):
    return profile.schema_profile(joined_raw(spark, sf_dir))


@query("row_count", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def row_count(spark, sf_dir):
    return profile.row_count(read(spark, sf_dir, "lineitem"))


@query("dup_row_count", "SELECT (SELECT count(*) FROM d) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS n_duplicates FROM (SELECT 1) one".replace("FROM d)", "FROM (SELECT text, lang FROM documents))"))
def dup_row_count(spark, sf_dir):
    return profile.duplicate_count(read(spark, sf_dir, "documents").select("text", "lang"))


@query(
    "dup_by_column",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count(DISTINCT {c}) AS n_duplicates FROM documents" for c in ("text", "lang", "source")),
)
def dup_by_column(spark, sf_dir):
    return profile.duplicates_by_column(read(spark, sf_dir, "documents"), ["text", "lang", "source"])


@query("dup_rows_text", "SELECT doc_id, text, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1")
def dup_rows_text(spark, sf_dir):
    return profile.duplicate_rows(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ["text"], "doc_id")


@query("distinct_values_first_seen", "SELECT source AS value, min(doc_id) AS first_seen FROM documents GROUP BY source")
def distinct_values_first_seen(spark, sf_dir):
    return profile.distinct_first_seen(read(spark, sf_dir, "documents"), "source", "doc_id")


@query("value_counts_source", "SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def value_counts_source(spark, sf_dir):
    return profile.ranked_counts(read(spark, sf_dir, "documents"), "source")


@query("value_share_lang", "SELECT lang, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def value_share_lang(spark, sf_dir):
    return rounded(profile.shares(profile.value_counts(read(spark, sf_dir, "documents"), "lang")), "share_pct")


@query(
    "label_task_matrix",
    f"WITH {LONG_LABELS} SELECT label, " + ", ".join(f"CAST(nullif(count(*) FILTER (task = '{t}'), 0) AS DOUBLE) AS {t}" for t in TASKS) + " FROM long GROUP BY label",
)
def label_task_matrix(spark, sf_dir):
    out = profile.label_matrix(labelled(spark, sf_dir), list(TASKS))
    return out.withColumns({t: F.col(t).cast("double") for t in TASKS})  # nulls beside counts read as doubles everywhere


@query("pair_counts_source_lang", "SELECT source, lang, count(*) AS n FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY source, lang")
def pair_counts_source_lang(spark, sf_dir):
    return profile.ranked_counts(read(spark, sf_dir, "documents"), "source", "lang")


def described(table: str, column: str, ps: tuple) -> str:
    x = f"CAST({column} AS DOUBLE)"
    at = ", ".join(f"round(quantile_cont({x}, {p}), 6) AS " + f"p{p * 100:g}".replace(".", "_") for p in ps)
    return f'SELECT count({column}) AS "count", round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, min({x}) AS "min", {at}, max({x}) AS "max" FROM {table}'


@query("describe_length", described("documents", "n_chars", (0.25, 0.5, 0.75)))
def describe_length(spark, sf_dir):
    return rounded(profile.describe(read(spark, sf_dir, "documents"), "n_chars"), "mean", "std", "p25", "p50", "p75")


@query("describe_price", described("lineitem", "l_extendedprice", (0.25, 0.5, 0.75)))
def describe_price(spark, sf_dir):
    return rounded(profile.describe(read(spark, sf_dir, "lineitem"), "l_extendedprice"), "mean", "std", "p25", "p50", "p75")


@query("length_percentiles", described("documents", "n_chars", (0.5, 0.9, 0.95, 0.99)))
def length_percentiles(spark, sf_dir):
    out = profile.describe(read(spark, sf_dir, "documents"), "n_chars", (0.5, 0.9, 0.95, 0.99))
    return rounded(out, "mean", "std", "p50", "p90", "p95", "p99")


@query(
    "describe_text",
    "WITH v AS (SELECT 'lang' AS c, lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang "
    "UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY source) "
    'SELECT c AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique", first(value ORDER BY n DESC, value) AS top, max(n) AS freq FROM v GROUP BY c',
)
def describe_text(spark, sf_dir):
    return profile.describe_text(read(spark, sf_dir, "documents"), ["lang", "source"])


@query(
    "length_mean_above_below",
    "WITH m AS (SELECT avg(length(text)) AS a FROM documents) SELECT round(any_value(a), 6) AS mean, count(*) FILTER (length(text) > a) AS n_above, count(*) FILTER (length(text) < a) AS n_below FROM documents, m",
)
def length_mean_above_below(spark, sf_dir):
    return rounded(profile.around_mean(read(spark, sf_dir, "documents"), F.length("text")), "mean")


@query(
    "length_histogram",
    """WITH x AS (SELECT CAST(length(text) AS DOUBLE) AS x FROM documents WHERE text IS NOT NULL), e AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
    b AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * 10), 9) AS INT) AS bin, count(*) AS n FROM x, e GROUP BY 1), g AS (SELECT CAST(range AS INT) AS bin FROM range(10))
    SELECT g.bin, round(lo + g.bin * ((hi - lo) / 10), 6) AS low, round(lo + (g.bin + 1) * ((hi - lo) / 10), 6) AS high, coalesce(n, 0) AS n FROM g LEFT JOIN b USING (bin), e""",
)
def length_histogram(spark, sf_dir):
    return rounded(profile.histogram(read(spark, sf_dir, "documents"), F.length("text")), "low", "high")


@query(
    "category_counts_fixed_order",
    f"WITH {LABELLED}, {CLASSES} SELECT place, c.label, count(doc_id) AS n FROM classes c LEFT JOIN labelled l ON l.quality_label = c.label WHERE task = 'quality_label' GROUP BY place, c.label",
)
def category_counts_fixed_order(spark, sf_dir):
    return profile.class_counts(labelled(spark, sf_dir), "quality_label", TASKS["quality_label"])


@query("head_orders", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_orders(spark, sf_dir):
    return profile.head(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")


# --- cleaning


@query("dedupe_first", "SELECT doc_id, text, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1")
def dedupe_first(spark, sf_dir):
    return clean.dedupe_first(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id", ["text", "lang"])


RAW = "raw AS (SELECT doc_id AS ord, nullif(text, '') AS content, lang, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE source END AS source, quality AS tag FROM documents LEFT JOIN labels USING (doc_id))"


@query(
    "clean_pipeline_raw",
    f"WITH {RAW} SELECT min(ord) AS ord, content, lang, tag_free_source AS source FROM (SELECT ord, content, lang, source AS tag_free_source, tag FROM raw) GROUP BY content, lang, tag_free_source, tag HAVING content IS NOT NULL",
)
def clean_pipeline_raw(spark, sf_dir):
    raw = joined_raw(spark, sf_dir).select(
        F.col("doc_id").alias("ord"), F.nullif("text", F.lit("")).alias("content"), "lang",
        F.when(F.col("doc_id") % 7 != 0, F.col("source")).alias("source"), F.col("quality").alias("tag"),
    )
    return clean.clean_raw(raw, "ord", ["tag"], "content")


@query("drop_null_subset", "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def drop_null_subset(spark, sf_dir):
    return clean.drop_missing(joined_raw(spark, sf_dir), ["quality"]).select("doc_id", "quality")


@query(
    "filter_nonempty_counts",
    "SELECT count(*) FILTER (coalesce(props <> '' AND event_type <> 'click', false)) AS n_kept, count(*) FILTER (NOT coalesce(props <> '' AND event_type <> 'click', false)) AS n_dropped FROM events",
)
def filter_nonempty_counts(spark, sf_dir):
    return clean.nonempty_counts(read(spark, sf_dir, "events").withColumn("kind", F.when(F.col("event_type") != "click", F.col("event_type")).otherwise("")), "props", "kind")


CLEAN = r"trim(regexp_replace(regexp_replace({}, 'https?://\S+|www\.\S+', ' ', 'g'), '\s+', ' ', 'g'))"


@query("clean_text_url", f"SELECT page_id, {CLEAN.format(chr(39) + ' see ' + chr(39) + ' || url || chr(10) || ' + chr(39) + ' at www.' + chr(39) + ' || url || ' + chr(39) + '  end ' + chr(39))} AS cleaned FROM pages")
def clean_text_url(spark, sf_dir):
    text = F.concat(F.lit(" see "), "url", F.lit("\n at www."), "url", F.lit("  end "))
    return read(spark, sf_dir, "pages").select("page_id", clean_text(text, normalize=False).alias("cleaned"))


#: Signs that NFKC changes and NFC doesn't, and what they become.
COMPATIBLE, PLAIN = " \ufb01ne \uff21\uff11 \u00b2\u2460", " fine A1 21"


@query("clean_text_nfkc", f"SELECT doc_id, {CLEAN.format(f'(nfc_normalize(text) || {PLAIN!r})')} AS cleaned FROM documents")
def clean_text_nfkc(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", clean_text(F.concat("text", F.lit(COMPATIBLE))).alias("cleaned"))


@query(
    "clean_labelled",
    f"WITH {LABELLED}, c AS (SELECT *, {CLEAN.format('source')} AS t, {CLEAN.format('nfc_normalize(text)')} AS x FROM labelled) SELECT doc_id, t AS source, CAST(length(x) AS INT) AS n_clean, "
    + ", ".join(f"CAST(list_position(['{chr(39) + ', ' + chr(39)}'], {t}) - 1 AS BIGINT) AS {t}_id".replace("['', '']", str(cs)) for t, cs in TASKS.items()) + " FROM c WHERE t <> '' AND x <> ''",
)
def clean_labelled(spark, sf_dir):
    out = clean.clean_labelled(labelled(spark, sf_dir), TASKS, "source", "text")
    return out.select("doc_id", "source", F.length("text").alias("n_clean"), *(f"{t}_id" for t in TASKS))


# --- encoding, validation, splits

ID_SQL = {t: "CASE " + t + " " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(cs)) + " END" for t, cs in TASKS.items()}


def encoded(spark, sf_dir):
    return encode.encode(labelled(spark, sf_dir).drop("text"), TASKS)


@query("encode_labels", f"WITH {LABELLED} SELECT doc_id, " + ", ".join(f"CAST({x} AS BIGINT) AS {t}_id" for t, x in ID_SQL.items()) + " FROM labelled")
def encode_labels(spark, sf_dir):
    return encoded(spark, sf_dir).select("doc_id", *(f"{t}_id" for t in TASKS))


@query(
    "one_hot_labels",
    f"WITH {LABELLED} SELECT doc_id, " + ", ".join(f"CAST({t} = '{c}' AS INT) AS {t}_{c}" for t, cs in TASKS.items() for c in cs) + " FROM labelled",
)
def one_hot_labels(spark, sf_dir):
    return encode.one_hot_columns(encoded(spark, sf_dir), TASKS).select("doc_id", *(f"{t}_{c}" for t, cs in TASKS.items() for c in cs))


@query(
    "class_weights",
    f"WITH {LONG_LABELS}, {CLASSES}, total AS (SELECT count(*) AS t FROM labelled) SELECT c.task, c.label, count(doc_id) AS n, "
    "round(any_value(t) / (3.0 * greatest(count(doc_id), 1)), 6) AS weight FROM classes c LEFT JOIN long l ON l.task = c.task AND l.label = c.label, total GROUP BY c.task, c.label",
)
def class_weights(spark, sf_dir):
    return rounded(encode.class_weights(labelled(spark, sf_dir), TASKS), "weight")


@query("validate_unique_key", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 1")
def validate_unique_key(spark, sf_dir):
    return validate.repeated_keys(read(spark, sf_dir, "events"), "user_id")


@query(
    "validate_label_domain",
    "SELECT 'event_type' AS task, event_type AS label, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY event_type UNION ALL "
    "SELECT 'props', trim(props), count(*) FROM events WHERE trim(props) NOT IN ('{}') GROUP BY trim(props)",
)
def validate_label_domain(spark, sf_dir):
    return validate.unknown_labels(read(spark, sf_dir, "events"), {"event_type": ["click", "view"], "props": ["{}"]})


def drawn(spark, sf_dir):
    """Embeddings with two tasks out of their label, and a split."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("label") % 3).alias("first_id"), (F.col("label") % 2).alias("second_id"))
    return split.stratified_split(rows, "vec_id", ["first_id", "second_id"])


@query("split_disjoint", "SELECT vec_id, CAST(2 AS BIGINT) AS n_splits FROM embeddings WHERE vec_id % 10 = 3")
def split_disjoint(spark, sf_dir):
    """Every tenth key is planted in a split of its own beside its true one; the true splits share none."""
    rows = drawn(spark, sf_dir).select("vec_id", "split")
    return validate.shared_keys(rows.unionByName(rows.where("vec_id % 10 = 3").withColumn("split", F.lit("planted"))), "vec_id")


@query("split_overlap", "SELECT DISTINCT o_custkey AS key FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def split_overlap(spark, sf_dir):
    poor = read(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("key"))
    return validate.overlap(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), poor, "key")


@query("joint_length", "SELECT doc_id, CAST(length(coalesce(source, '')) + length(coalesce(text, '')) AS INT) AS char_length FROM documents")
def joint_length_(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", joint_length(F.col("source"), F.col("text")).alias("char_length"))


@query("fixed_decimals", "SELECT o_orderkey, printf('%.2f', o_totalprice) AS price FROM orders")
def fixed_decimals(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", fixed(F.col("o_totalprice")).alias("price"))


@query("fill_missing", "SELECT doc_id, coalesce(CASE WHEN doc_id % 7 <> 0 THEN source END, '') AS source FROM documents")
def fill_missing(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("source")).alias("source"))
    return clean.fill_missing(rows, ["source"])


@query("task_names", f"WITH {LONG_LABELS} SELECT replace(task, '_label', '') AS task, count(*) AS n FROM long GROUP BY task")
def task_names(spark, sf_dir):
    counts = profile.label_counts(labelled(spark, sf_dir), list(TASKS)).groupBy("task").agg(F.sum("n").alias("n"))
    return counts.select(F.element_at(F.create_map(*(F.lit(x) for t in TASKS for x in (t, task_name(t)))), F.col("task")).alias("task"), "n")


@query("split_stratified")
def split_stratified(spark, sf_dir):
    return drawn(spark, sf_dir)


@query("split_distribution")
def split_distribution(spark, sf_dir):
    return split.split_distribution(drawn(spark, sf_dir), ["first_id", "second_id"])


# --- tokens

PAIR = r"""pair AS (SELECT conv_id, min({'turn': turn, 'text': text}).text AS title, max({'turn': turn, 'text': text}).text AS content FROM conversations GROUP BY conv_id),
    tok AS (SELECT conv_id, CASE WHEN a = '' THEN 0 ELSE len(string_split(a, ' ')) END AS nt, CASE WHEN b = '' THEN [] ELSE string_split(b, ' ') END AS tokens
    FROM (SELECT conv_id, trim(regexp_replace(coalesce(title, ''), '\s+', ' ', 'g')) AS a, trim(regexp_replace(coalesce(content, ''), '\s+', ' ', 'g')) AS b FROM pair)),
    enc AS (SELECT conv_id, nt, tokens[1:greatest(LIMIT - 3 - nt, 0)] AS kept FROM tok)""".replace("LIMIT", "64")


def pair_tokens(spark, sf_dir):
    turns, at = read(spark, sf_dir, "conversations"), F.struct("turn", "text")
    ends = turns.groupBy("conv_id").agg(F.min(at)["text"].alias("title"), F.max(at)["text"].alias("content"))
    return tokens.encode_pair(ends, "title", "content", 64)


@query("pair_truncate", f"WITH {PAIR} SELECT conv_id, CAST(nt AS INT) AS n_title, CAST(len(kept) AS INT) AS n_content, CAST(nt + len(kept) + 3 AS INT) AS n_tokens, nt > 61 AS over_budget, array_to_string(kept, ' ') AS content FROM enc")
def pair_truncate(spark, sf_dir):
    out = pair_tokens(spark, sf_dir)
    return out.select("conv_id", F.size("title_tokens").alias("n_title"), F.size("content_tokens").alias("n_content"), "n_tokens", "over_budget", F.array_join("content_tokens", " ").alias("content"))


@query(
    "batch_pad_lengths",
    f"WITH {PAIR}, b AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // 8 AS batch FROM enc) "
    "SELECT conv_id, CAST(batch AS BIGINT) AS batch, CAST(len(kept) AS INT) AS n_real, CAST(max(len(kept)) OVER (PARTITION BY batch) AS INT) AS n_padded FROM b",
)
def batch_pad_lengths(spark, sf_dir):
    out = tokens.padded(tokens.batched(pair_tokens(spark, sf_dir), "conv_id", BATCH_SIZE), "content_tokens")
    real = F.aggregate("mask", F.lit(0), lambda s, x: s + x)
    return out.select("conv_id", "batch", real.alias("n_real"), F.size("content_tokens").alias("n_padded"))


# --- heads, losses, schedule


def weight(task: int, c: int, d: int) -> float:
    return ((c * 31 + d * 17 + task * 7) % 11 - 5) / 10


def fixed_heads() -> dict[str, model.Head]:
    return {t: model.Head(cs, [[weight(k, c, d) for d in range(WIDTH)] for c in range(len(cs))], [0.1 * (c + k) for c in range(len(cs))]) for k, (t, cs) in enumerate(HEADS.items())}


SCORED = (
    "z AS (SELECT vec_id, label, "
    + ", ".join(
        "[" + ", ".join(f"list_sum(list_transform(range(0, {WIDTH}), lambda i: CAST(embedding[i + 1] AS DOUBLE) * (((({c * 31 + k * 7}) + i * 17) % 11 - 5) / 10.0))) + {0.1 * (c + k)!r}" for c in range(3)) + f"] AS {t}_z"
        for k, t in enumerate(HEADS)
    )
    + " FROM embeddings), s AS (SELECT vec_id, label, "
    + ", ".join(f"{t}_z, list_transform({t}_z, lambda x: exp(x - list_max({t}_z)) / list_sum(list_transform({t}_z, lambda y: exp(y - list_max({t}_z))))) AS {t}_p, list_position({t}_z, list_max({t}_z)) - 1 AS {t}_pred" for t in HEADS)
    + "".join(f", (label // {d}) % 3 AS {t}_id" for t, d in TRUTH.items()) + " FROM z)"
)


def scored(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    truth = {f"{t}_id": (F.floor(F.col("label") / d) % 3).cast("int") for t, d in TRUTH.items()}
    return model.score(rows, "embedding", fixed_heads()).withColumns(truth)


def per_index(kind: str) -> str:
    return ", ".join(f"round({t}_{kind}[{i + 1}], 6) AS {t}_{i}" for t in HEADS for i in range(3))


def spread(df: DataFrame, kind: str) -> list:
    return [F.round(F.col(f"{t}_{kind}")[i], 6).alias(f"{t}_{i}") for t in HEADS for i in range(3)]


@query("head_logits", f"WITH {SCORED} SELECT vec_id, {per_index('z')} FROM s")
def head_logits(spark, sf_dir):
    df = scored(spark, sf_dir)
    return df.select("vec_id", *spread(df, "logits"))


@query("softmax_probs", f"WITH {SCORED} SELECT vec_id, {per_index('p')} FROM s")
def softmax_probs(spark, sf_dir):
    df = scored(spark, sf_dir)
    return df.select("vec_id", *spread(df, "probs"))


@query(
    "predict_argmax",
    f"WITH {SCORED} SELECT vec_id, " + ", ".join(f"CAST({t}_pred AS INT) AS {t}_pred, {cs}[{t}_pred + 1] AS {t}_label, round(list_max({t}_p), 6) AS {t}_confidence" for t, cs in HEADS.items()) + " FROM s",
)
def predict_argmax(spark, sf_dir):
    df = scored(spark, sf_dir)
    out = [x for t, cs in HEADS.items() for x in (F.col(f"{t}_pred"), label_of(F.col(f"{t}_pred"), cs).alias(f"{t}_label"), F.round(F.array_max(f"{t}_probs"), 6).alias(f"{t}_confidence"))]
    return df.select("vec_id", *out)


@query(
    "predict_map",
    f"WITH {SCORED} " + " UNION ALL ".join(f"SELECT vec_id, '{t}' AS task, {cs}[{t}_pred + 1] AS label, round({t}_p[{i + 1}], 6) AS probability, '{c}' AS class FROM s" for t, cs in HEADS.items() for i, c in enumerate(cs)),
)
def predict_map(spark, sf_dir):
    out = model.predictions(scored(spark, sf_dir), fixed_heads()).select("vec_id", F.explode("prediction").alias("task", "p"))
    return out.select("vec_id", "task", "p.label", F.explode("p.probabilities").alias("class", "probability")).select("vec_id", "task", "label", F.round("probability", 6).alias("probability"), "class")


def json_sql(t: str, classes: list[str]) -> str:
    six = lambda x: f"CAST(CAST({x} AS DECIMAL(9, 6)) AS VARCHAR)"
    each = " || ',' || ".join(f"'\"{c}\":' || {six(f'{t}_p[{i + 1}]')}" for i, c in enumerate(classes))
    return f"'\"{t}\":{{\"label\":\"' || {classes}[{t}_pred + 1] || '\",\"confidence\":' || {six(f'list_max({t}_p)')} || ',\"probabilities\":{{' || {each} || '}}}}'"


@query("predict_map_json", f"WITH {SCORED} SELECT vec_id, '{{' || " + " || ',' || ".join(json_sql(t, cs) for t, cs in HEADS.items()) + " || '}' AS json FROM s")
def predict_map_json(spark, sf_dir):
    return model.predictions(scored(spark, sf_dir), fixed_heads()).select("vec_id", predict.as_json(places=6).alias("json"))


def loss_sql(t: str) -> str:
    w = WEIGHTS[t]
    return f"sum(-ln({t}_p[{t}_id + 1]) * {w}[{t}_id + 1]) / sum({w}[{t}_id + 1])"


@query("weighted_cross_entropy", f"WITH {SCORED} SELECT " + ", ".join(f"round({loss_sql(t)}, 6) AS {t}" for t in HEADS) + f", round({' + '.join(map(loss_sql, HEADS))}, 6) AS loss FROM s")
def weighted_cross_entropy(spark, sf_dir):
    return rounded(model.losses(scored(spark, sf_dir), WEIGHTS), *HEADS, "loss")


@query(
    "loss_batch_mean",
    f"WITH {SCORED}, b AS (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) // 8 AS batch FROM s), l AS (SELECT batch, {' + '.join(map(loss_sql, HEADS))} AS loss FROM b GROUP BY batch) SELECT round(avg(loss), 6) AS loss_batch_mean FROM l",
)
def loss_batch_mean(spark, sf_dir):
    return rounded(model.batch_mean_loss(tokens.batched(scored(spark, sf_dir), "vec_id"), WEIGHTS), "loss_batch_mean")


UPDATES = "n AS (SELECT ceil(count(*) / 8.0) AS batches FROM embeddings), u AS (SELECT CAST(ceil(batches / 4.0) * 5 AS BIGINT) AS total, CAST(floor(ceil(batches / 4.0) * 5 * 0.1) AS BIGINT) AS warm FROM n)"


@query("update_counts", f"WITH {UPDATES} SELECT total, warm FROM u")
def update_counts(spark, sf_dir):
    batches = F.ceil(F.count("*") / BATCH_SIZE)
    total = (F.ceil(batches / 4) * 5).cast("long")
    return read(spark, sf_dir, "embeddings").agg(total.alias("total"), F.floor(total * 0.1).cast("long").alias("warm"))


@query(
    "lr_schedule",
    f"WITH {UPDATES} SELECT CAST(range AS BIGINT) AS step, round(CASE WHEN range < warm THEN range / greatest(1.0, warm) ELSE greatest(0.0, (total - range) / greatest(1.0, total - warm)) END, 6) AS factor FROM u, range(0, 100000) WHERE range <= total",
)
def lr_schedule(spark, sf_dir):
    batches = -(-read(spark, sf_dir, "embeddings").count() // BATCH_SIZE)
    return rounded(model.schedule(spark, *model.updates(batches)), "factor")


def history(spark):
    return spark.createDataFrame(HISTORY, "epoch int, mean_macro_f1 double")


@query("best_epoch", "SELECT 4 AS best_epoch, CAST(0.58 AS DOUBLE) AS best_score, 6 AS last_epoch")
def best_epoch(spark, sf_dir):
    return model.best_epoch(history(spark))


HISTORY_SQL = "h(epoch, f1) AS (VALUES " + ", ".join(f"({e}, CAST({f} AS DOUBLE))" for e, f in HISTORY) + ")"


@query(
    "early_stop_epoch",
    f"""WITH {HISTORY_SQL}, b AS (SELECT *, max(f1) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM h), i AS (SELECT *, best IS NULL OR f1 > best AS improved FROM b),
    r AS (SELECT *, sum(CAST(improved AS INT)) OVER (ORDER BY epoch) AS run FROM i), k AS (SELECT *, sum(1 - CAST(improved AS INT)) OVER (PARTITION BY run ORDER BY epoch) AS bad FROM r)
    SELECT epoch, improved, CAST(bad AS BIGINT) AS bad_epochs, (SELECT min(epoch) FROM k WHERE bad >= 2) AS stop_epoch FROM k""",
)
def early_stop_epoch(spark, sf_dir):
    return model.marked_history(history(spark)).select("epoch", "improved", "bad_epochs", "stop_epoch")


# --- metrics

YP = f"{SCORED}, yp AS (" + " UNION ALL ".join(f"SELECT '{t}' AS task, {t}_id AS y, {t}_pred AS p FROM s" for t in HEADS) + ")"
HEAD_CLASSES = "cls(task, k, label) AS (VALUES " + ", ".join(f"('{t}', {i}, '{c}')" for t, cs in HEADS.items() for i, c in enumerate(cs)) + ")"
PER_CLASS = f"""{YP}, {HEAD_CLASSES}, c AS (SELECT cls.task, k, label, count(*) FILTER (y = k) AS support, count(*) FILTER (p = k) AS predicted, count(*) FILTER (y = k AND p = k) AS hit FROM cls JOIN yp USING (task) GROUP BY cls.task, k, label),
    f AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE hit / CAST(predicted AS DOUBLE) END AS "precision", CASE WHEN support = 0 THEN 0.0 ELSE hit / CAST(support AS DOUBLE) END AS recall,
    CASE WHEN support + predicted = 0 THEN 0.0 ELSE 2.0 * hit / (support + predicted) END AS f1 FROM c)"""


def truth_and_prediction(spark, sf_dir):
    return metrics.pairs(scored(spark, sf_dir), list(HEADS))


@query("confusion_matrix", f"WITH {YP} SELECT a.task, CAST(a.k AS INT) AS y, CAST(b.k AS INT) AS p, (SELECT count(*) FROM yp WHERE yp.task = a.task AND yp.y = a.k AND yp.p = b.k) AS n FROM cls a JOIN cls b ON a.task = b.task".replace(YP, f"{YP}, {HEAD_CLASSES}"))
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(truth_and_prediction(spark, sf_dir), HEADS)


@query("macro_prf_fixed", f'WITH {PER_CLASS} SELECT task, round(avg("precision"), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1 FROM f GROUP BY task')
def macro_prf_fixed(spark, sf_dir):
    return rounded(metrics.macro_fixed(metrics.per_class(truth_and_prediction(spark, sf_dir), HEADS)), "macro_precision", "macro_recall", "macro_f1")


@query("macro_f1_observed", f"WITH {PER_CLASS} SELECT task, round(avg(f1), 6) AS macro_f1 FROM f WHERE support + predicted > 0 GROUP BY task")
def macro_f1_observed(spark, sf_dir):
    return rounded(metrics.macro_f1_observed(metrics.per_class(truth_and_prediction(spark, sf_dir), HEADS)), "macro_f1")


@query("macro_f1_series", f"WITH {PER_CLASS}, m AS (SELECT task, avg(f1) AS m FROM f WHERE support + predicted > 0 GROUP BY task) SELECT task, round(m, 6) AS macro_f1, row_number() OVER (ORDER BY m DESC, task) AS place FROM m")
def macro_f1_series(spark, sf_dir):
    out = metrics.ranked(metrics.macro_f1_observed(metrics.per_class(truth_and_prediction(spark, sf_dir), HEADS)))
    # as many rows as tasks
    return rounded(out.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1), "macro_f1")


@query(
    "evaluate_heads",
    f"WITH {PER_CLASS}, b AS (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) // 8 AS batch FROM s), l AS (SELECT batch, {' + '.join(map(loss_sql, HEADS))} AS loss FROM b GROUP BY batch), "
    "m AS (SELECT task, avg(f1) AS m FROM f WHERE support + predicted > 0 GROUP BY task) SELECT task, round(m, 6) AS macro_f1, round((SELECT avg(loss) FROM l), 6) AS loss FROM m",
)
def evaluate_heads(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").withColumns({f"{t}_id": (F.floor(F.col("label") / d) % 3).cast("int") for t, d in TRUTH.items()})
    loss, f1, _ = train.evaluate(rows, "embedding", "vec_id", fixed_heads(), WEIGHTS)
    return rounded(f1.withColumn("loss", loss.scalar()), "macro_f1", "loss")


@query("mean_macro_f1", f"WITH {PER_CLASS} SELECT round(avg(m), 6) AS mean_macro_f1 FROM (SELECT avg(f1) AS m FROM f WHERE support + predicted > 0 GROUP BY task)")
def mean_macro_f1(spark, sf_dir):
    return rounded(metrics.mean_macro_f1(truth_and_prediction(spark, sf_dir), HEADS), "mean_macro_f1")


@query(
    "weighted_f1_accuracy",
    f"WITH {PER_CLASS} SELECT task, round(sum(f1 * support) / sum(support), 6) AS weighted_f1, round(CAST(sum(hit) AS DOUBLE) / CAST(sum(support) AS DOUBLE), 6) AS accuracy FROM f GROUP BY task",
)
def weighted_f1_accuracy(spark, sf_dir):
    out = metrics.metrics_table(truth_and_prediction(spark, sf_dir), HEADS).select("task", "weighted_f1", "accuracy")
    return rounded(out, "weighted_f1", "accuracy")


@query(
    "classification_report",
    f"""WITH {PER_CLASS} SELECT task, label, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
    UNION ALL SELECT task, 'macro avg', round(avg("precision"), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f GROUP BY task
    UNION ALL SELECT task, 'weighted avg', round(sum("precision" * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f GROUP BY task
    UNION ALL SELECT task, 'accuracy', NULL, NULL, round(CAST(sum(hit) AS DOUBLE) / CAST(sum(support) AS DOUBLE), 6), CAST(sum(support) AS BIGINT) FROM f GROUP BY task""",
)
def classification_report(spark, sf_dir):
    return rounded(metrics.report(truth_and_prediction(spark, sf_dir), HEADS), "precision", "recall", "f1")


# --- training


def trained(spark, sf_dir):
    rows = drawn(spark, sf_dir).join(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id")
    classes = {"first": ["no", "yes", "uncertain"], "second": ["A", "B"]}
    named = rows.withColumns({t: label_of(F.col(f"{t}_id"), cs) for t, cs in classes.items()})
    return named, classes, model.train_heads(named.where("split = 'train'"), "embedding", classes)


@query("train_heads_mllib")
def train_heads_mllib(spark, sf_dir):
    named, classes, heads = trained(spark, sf_dir)
    test = model.score(named.where("split = 'test'"), "embedding", heads)
    return metrics.metrics_table(metrics.pairs(test, list(classes)), classes)


def four_tasks(spark, sf_dir):
    """Embeddings with the classes of four tasks, and a split."""
    rows = read(spark, sf_dir, "embeddings").withColumns({f"{t}_id": (F.floor(F.col("label") / d) % 3).cast("long") for t, d in TRUTH.items()})
    named = rows.withColumns({t: label_of(F.col(f"{t}_id"), cs) for t, cs in HEADS.items()})
    return split.stratified_split(named, "vec_id", [f"{t}_id" for t in HEADS])


@query("train_epochs")
def train_epochs(spark, sf_dir):
    """The epoch loop on four tasks; the metrics, on validation and test rows, of the checkpoint that was best and read back."""
    rows = four_tasks(spark, sf_dir)
    folder = f"{shared_folder(spark)}/tessera/heads-{uuid.uuid4().hex}"
    settings = train.Settings(rate=0.05, updates=4, accumulation=1)
    heads, _ = train.fit(rows.where("split = 'train'"), rows.where("split = 'val'"), "vec_id", "embedding", HEADS, folder, settings)
    out = None
    for name in ("val", "test"):
        yp = metrics.pairs(model.score(rows.where(F.col("split") == name), "embedding", heads), list(HEADS))
        part = metrics.metrics_table(yp, HEADS).withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def shared_folder(spark) -> str:
    """The folder in spark.checkpoint.dir; on one machine a temporary one will do."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (at or tempfile.mkdtemp(prefix="tessera-")).rstrip("/")


@query("score_documents")
def score_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("title"), F.col("text").alias("content"))
    return predict.predict(docs, fixed_heads()).select("doc_id", predict.as_json().alias("json"))


