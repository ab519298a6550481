"""The registered queries of the operators, and SQL for those that SQL can express.

Each query applies its operator to the whole table and derives the columns that are compared.
"""

import hashlib
import sys
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenshoe.llm import (
    chat_format,
    decontaminate,
    hard_negatives,
    jaccard_join,
    lexical_search,
    line_dedup,
    quality_model,
    quality_rules,
    secret_scan,
    source_mix,
    token_files,
    toxicity,
    url_lists,
)
from greenshoe.llm.shared import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

IDS_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CHAT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    kinds = F.array(*map(F.lit, secret_scan.KINDS))
    plain = F.filter("secrets", lambda s: s["depth"] == 0)

    def count(kind: int):
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long")

    def listed(secrets):
        parts = F.transform(
            secrets,
            lambda s: F.concat_ws(
                ":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string")
            ),
        )
        return F.array_join(parts, ",")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS)],
        F.sha2(listed(plain), 256).alias("base_sha256"),
        listed("secrets").alias("spans"),
        (F.size("secrets") - F.size(plain)).cast("long").alias("n_hidden"),
        "n_layers",
        "n_unread",
    )


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(
        table(spark, folder, "documents"),
        table(spark, folder, "benchmark"),
        Scratch(spark, "op2"),
    )
    return found.drop("text_hash")


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What formatted conversations hold, read back from their text, offsets and mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, text, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
                turns = chat_format.read_back(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                loss = "".join(chat_format.unescape(text[a:b]) for a, b in zip(starts, ends))
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
                out.append((conv, len(turns), digests[0], len(loss), digests[1], len(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], f.type) for k, f in enumerate(digest_schema)],
                schema=digest_schema,
            )

    digest_schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    return formatted.select("conv_id", "formatted", "loss_starts", "loss_ends").mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long",
    )


@query("op3_chat_format")
def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema
    )
    formatted = chat_format.format_conversations(turns.unionByName(extra), CHAT_VOCABULARY)
    return chat_digests(formatted)


@query(
    "op4_line_dedup",
    """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last_doc AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
    AS kept_sha256
FROM judged GROUP BY doc_id""",
)
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    bitmaps = line_dedup.keep_bitmaps(docs, Scratch(spark, "op4"))
    return line_dedup.apply_bitmaps(docs, bitmaps).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


_OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, n, unnest(range(len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, text AS n, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) t),
wordy AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
    length(line) - length(regexp_replace(line, '[#*$%&<>!]', '', 'g')) AS marks,
    length(line) - length(regexp_replace(line, '[|»›•]', '', 'g')) AS seps
  FROM lines),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS again,
    marks > 0.5 * words OR (seps >= 3 AND words - seps <= 3 * (seps + 1))
    OR regexp_matches(lower(line), 'all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept cookies|enable javascript|lorem ipsum|released under the|licensed under the|subscribe to our') AS bad
  FROM wordy WHERE words > 0),
by_line AS (
  SELECT doc_id, count(*) FILTER (WHERE again) AS n_dup_lines, count(*) FILTER (WHERE bad) AS n_bad_lines,
    coalesce(sum(chars) FILTER (WHERE bad), 0) AS bad_word_chars FROM judged GROUP BY doc_id),
words AS (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS w
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents) t),
windows AS (
  SELECT doc_id, pos, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o
    || ' ' || lead(w, 4) OVER o || ' ' || lead(w, 5) OVER o || ' ' || lead(w, 6) OVER o
    || ' ' || lead(w, 7) OVER o AS win
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (
  SELECT doc_id, win FROM windows WHERE win IS NOT NULL GROUP BY doc_id, win HAVING count(*) > 1),
flagged AS (
  SELECT x.doc_id, x.pos, t.win IS NOT NULL AS hit
  FROM windows x LEFT JOIN twice t ON x.doc_id = t.doc_id AND x.win = t.win),
covered AS (
  SELECT doc_id, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c
  FROM flagged),
by_word AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE c) AS n_repeat_words FROM covered GROUP BY doc_id),
figures AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words,
    length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_bad_lines, 0) AS n_bad_lines, cast(coalesce(bad_word_chars, 0) AS BIGINT) AS bad_word_chars
  FROM documents d LEFT JOIN by_line USING (doc_id) LEFT JOIN by_word USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND 100 * (word_chars - bad_word_chars) >= 50 * word_chars AS kept
FROM figures"""


@query("op5_quality_rules", _OP5_SQL)
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.measure_quality(table(spark, folder, "documents"))


_OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(cast(doc_id AS VARCHAR), '')) AS place FROM documents),
s AS (
  SELECT source, cast(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS number FROM s),
c AS (
  SELECT *, number % 3 + 1 AS weight, cast(3 AS DOUBLE) * source_size / (number % 3 + 1) AS reached FROM w),
l AS (
  SELECT *, (cast(sum(source_size) OVER () AS DOUBLE) - cast(3 AS DOUBLE) * coalesce(sum(source_size) OVER (
      ORDER BY reached, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / cast(sum(weight) OVER () - coalesce(sum(weight) OVER (
      ORDER BY reached, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level FROM c),
t AS (
  SELECT source, source_size, least(cast(3 AS DOUBLE) * source_size,
    (SELECT max(level) FROM l WHERE level <= reached) * weight) AS target FROM l),
p AS (
  SELECT d.*, t.source_size, t.target, coalesce(sum(size) OVER (
      PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    + cast(size AS DOUBLE) / 2 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, cast(size AS BIGINT) AS size, source_size, target,
  cast(CASE WHEN source_size > 0 THEN size * least(3, greatest(0, ceil((target - middle) / source_size))) ELSE 0 END
    AS BIGINT) AS taken
FROM p"""


@query("op6_source_mix", _OP6_SQL)
def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark, "op6")
    documents, order = source_mix.training_plan(table(spark, folder, "documents"), scratch)
    order = scratch.save(order, "order")
    times = order.groupBy("row").agg(F.count("*").alias("n"))
    taken = F.col("size") * F.coalesce("n", F.lit(0))
    return documents.join(times, "row", "left").select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"), Scratch(spark, "op7"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


# Captures: every page, fetched on a day that depends on its number. Lists: dated changes for the
# hosts of the pages and the domains above them, and allowed paths.
_HOSTS = """
  SELECT host, md5(host) AS m, cast(length(host) AS INT) AS n FROM (
    SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host FROM {pages}) h
  WHERE host <> ''"""
_CAPTURES = """
  SELECT page_id, url, DATE '2024-01-01' + cast(page_id * 37 % 366 AS INT) AS fetched_on FROM {pages}"""
_ENTRIES = f"""
  SELECT 'abuse' AS list, 'block' AS verdict, host AS pattern, 'add' AS action,
    DATE '2024-01-01' + n * 7 % 200 AS effective_on FROM ({_HOSTS}) a WHERE substr(m, 1, 1) < '8'
  UNION ALL
  SELECT 'abuse', 'block', host, 'remove', DATE '2024-01-01' + n * 7 % 200 + 60 FROM ({_HOSTS}) b
  WHERE substr(m, 1, 1) < '4'
  UNION ALL
  SELECT 'abuse', 'block', host, 'add', DATE '2024-01-01' + n * 7 % 200 + 120 FROM ({_HOSTS}) c
  WHERE substr(m, 1, 1) < '2'
  UNION ALL
  SELECT 'spam', 'block', regexp_extract(host, '^[^.]+[.](.*)$', 1), 'add', DATE '2024-03-01' + n
  FROM ({_HOSTS}) d WHERE substr(m, 2, 1) < '6' AND host LIKE '%.%.%.%'
  UNION ALL
  SELECT 'partners', 'allow', host || '/en', 'add', DATE '2024-02-01' FROM ({_HOSTS}) e
  WHERE substr(m, 3, 1) < '8'
  UNION ALL
  SELECT 'partners', 'allow', host || '/en', 'remove', DATE '2024-09-01' FROM ({_HOSTS}) f
  WHERE substr(m, 3, 1) < '3'"""
_OP9_SQL = f"""
WITH captures AS ({_CAPTURES}),
entries AS ({_ENTRIES}),
changes AS (
  SELECT list, verdict, pattern, effective_on, max(action) AS action FROM entries
  GROUP BY list, verdict, pattern, effective_on),
dated AS (
  SELECT *, lead(effective_on) OVER (PARTITION BY list, verdict, pattern ORDER BY effective_on) AS until
  FROM changes),
parts AS (
  SELECT *, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM captures),
hits AS (
  SELECT page_id, verdict, list, pattern, effective_on, row_number() OVER (PARTITION BY page_id ORDER BY
      length(pattern) - length(replace(pattern, '/', '')) DESC, length(pattern) DESC, verdict ASC,
      list DESC, effective_on DESC) AS place
  FROM parts JOIN dated ON action = 'add' AND effective_on <= fetched_on
    AND (until IS NULL OR fetched_on < until)
    AND (host = pattern OR host LIKE '%.' || pattern OR host || path = pattern
      OR (contains(pattern, '/') AND starts_with(host || path, pattern || '/'))))
SELECT p.page_id, p.url, p.fetched_on, coalesce(h.verdict, 'unlisted') AS verdict, h.list, h.pattern,
  h.effective_on AS valid_from
FROM parts p LEFT JOIN hits h ON p.page_id = h.page_id AND h.place = 1"""


@query("op9_url_filters", _OP9_SQL.replace("{pages}", "pages"))
def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    captures, entries = (spark.sql(sql, pages=pages) for sql in (_CAPTURES, _ENTRIES))
    return url_lists.judge(captures, entries)


@query("op10_token_files")
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write_files(
        table(spark, folder, "documents"), Scratch(spark, "op10"), IDS_VOCABULARY
    )
    return token_files.read_documents(files)


_OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (
  SELECT row, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
sizes AS (
  SELECT row, count(*) AS n FROM d GROUP BY row),
figures AS (
  SELECT count(*) AS docs, cast(sum(n) AS BIGINT) AS total FROM sizes),
df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (
  SELECT term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, figures),
factors AS (
  SELECT row, 100 - 90 + (90 * n * docs) // total AS m FROM sizes, figures),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, row, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN factors USING (row)
  GROUP BY item_id, row, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, cast(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


@query("op11_lexical_search", _OP11_SQL)
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), Scratch(spark, "op11")
    )


@query("op12_quality_model")
def op12_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_model.train(docs, table(spark, folder, "labels"))
    return quality_model.score(docs, model).select(
        "doc_id",
        quality_model.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


_OP13_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    cast(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
hard AS (
  SELECT p.anchor_id, p.other_id AS positive_id, row_number() OVER (
      PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS rank,
    n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score)
SELECT anchor_id, positive_id, cast(rank AS INT) AS rank, negative_id, positive_score, negative_score
FROM hard WHERE rank <= 3"""


@query("op13_hard_negatives", _OP13_SQL)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), Scratch(spark, "op13"))
