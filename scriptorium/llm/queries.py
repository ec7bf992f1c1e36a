"""The queries opN_<name>: each applies an operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import (
    chat_format,
    decontaminate,
    html_extract,
    language,
    packing,
    quality,
    secret_scan,
    simhash,
    token_count,
    url_filter,
)
from scriptorium.session import spread, table

URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
EXTRA_TURN = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TURN).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.format_conversations(rows))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.UrlModel.fit(url_filter.labelled_urls(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES, model).drop("score")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s.kind.isin("assign", "access", "hex"))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    number = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def held_out() -> Column:
    """Whether a document is held out of the training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


def language_model(docs: DataFrame, train_docs: int = 4000) -> language.Profiles:
    """Learned from about ``train_docs`` documents of each language that are not held out."""
    return language.learn(language.sample(docs.filter(~held_out() & F.col("lang").isNotNull()), train_docs))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = language.identify(docs, language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.token_counts(_documents(spark, sf_dir))
    return counts.select("*", (F.col("n_tokens") > 4096).alias("over_limit"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.containments(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spread(table(spark, sf_dir, "pages")))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_url_filter": op2_url_filter,
    "op3_secret_scan": op3_secret_scan,
    "op4_simhash": op4_simhash,
    "op5_quality_rules": op5_quality_rules,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_token_counts": op8_token_counts,
    "op9_decontaminate": op9_decontaminate,
    "op10_html_extract": op10_html_extract,
}

_TURNS = f"""
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '{EXTRA_TURN}' union all select -1, 1, 'assistant', '{EXTRA_TURN}'"""

ORACLE_SQL = {
    "op1_chat_format": f"""
with turns as ({_TURNS}),
runs as (
    select *, row_number() over w as nth,
        coalesce(lag(role) over w <> role, true) as opens
    from turns window w as (partition by conv_id order by turn nulls first, role, text)
),
sized as (
    select *, length(text) + length(text) - length(replace(text, chr(92), ''))
            + len(regexp_extract_all(text, '<\\||</?s>|\\[/?INST\\]')) as text_chars,
        length(role) + length(role) - length(replace(role, chr(92), '')) + 3 * (length(role) - length(replace(role, chr(10), '')))
            + len(regexp_extract_all(role, '<\\||</?s>|\\[/?INST\\]')) as role_chars
    from runs
)
select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by nth)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by nth) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(text_chars + case when opens then role_chars + 12 + 1 + 11 else 9 end)::bigint as formatted_chars
from sized group by conv_id""",
    "op9_decontaminate": """
with docs as (select row_number() over () as r, doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') as a from documents),
items as (
    select row_number() over () as k, item_id, a, least(5, len(a)) as width
    from (select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') as a from (select distinct item_id, text from benchmark)) where len(a) > 0
),
item_shingles as (
    select distinct k, item_id, width, array_to_string(a[i + 1 : i + width], ' ') as s
    from (select *, unnest(range(len(a) - width + 1)) as i from items)
),
sizes as (select k, count(*) as n_shingles from item_shingles group by k),
doc_shingles as (
    select distinct r, doc_id, width, array_to_string(a[i + 1 : i + width], ' ') as s
    from (select r, doc_id, a, width, unnest(range(len(a) - width + 1)) as i from docs, (select distinct width from items))
),
found as (
    select d.r, d.doc_id, i.k, i.item_id, count(*) as n_found
    from doc_shingles d join item_shingles i on d.s = i.s and d.width = i.width group by 1, 2, 3, 4
)
select doc_id, item_id, n_shingles, n_found, n_found / n_shingles as containment
from found join sizes using (k) where n_found >= 0.8 * n_shingles - 1e-9""",
    "op5_quality_rules": """
with docs as (select row_number() over () as r, doc_id, coalesce(source, '') as host, coalesce(text, '') as text from documents),
words as (select r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w from docs),
windows as (
    select r, i, array_to_string(w[i + 1 : i + 5], ' ') as s
    from (select r, w, unnest(range(len(w) - 4)) as i from words)
),
twice as (select r, i from (select r, i, count(*) over (partition by r, s) as n from windows) where n > 1),
repeats as (select r, count(distinct i + k) as n_repeat_words from (select r, i, unnest(range(5)) as k from twice) group by r),
lines as (select r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from docs),
figures as (
    select r, doc_id, host, len(w) as n_words,
        length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
        len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, len(l) as n_lines,
        length(text) - length(regexp_replace(text, '[A-ZÀ-ÖØ-Þ]', '', 'g')) as n_upper,
        length(text) - length(regexp_replace(text, '[\\p{L}\\p{Nl}\\p{No}]', '', 'g')) as n_letters,
        length(text) - length(replace(text, '!', '')) as n_shouts
    from docs join words using (r) join lines using (r) left join repeats using (r)
),
judged as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
        10 * n_symbols > n_words or (n_dup_lines > 2 and 10 * n_dup_lines > 3 * n_lines) or 10 * n_upper > 5 * n_letters
        or 10 * n_shouts > 3 * n_words or 10 * word_chars < 25 * n_words or word_chars > 15 * n_words as soft_failed
    from figures
),
hosts as (select host, count(*) as n, count(*) filter (where base_failed or soft_failed) as f from judged group by host),
mean as (
    select sum(n)::double as n, sum(f)::double as f, count(*) as h, sum(f * f / n) as q, (sum(f) + 0.5) / (sum(n) + 1) as m from hosts
),
spread as (select n / h as w, m, greatest(0.0, q / n - (f / n) ** 2 - m * (1 - m) * h / n) as v from mean),
prior as (select m, greatest(least(case when v > 1e-9 then m * (1 - m) / v - 1 else w end, w), 1.0) as t from spread),
bounds as (select m, t, m - 0.67 * sqrt(m * (1 - m) / (t + 1)) as low, greatest(0.5, m + 1.0 * sqrt(m * (1 - m) / (t + 1))) as high from prior),
rates as (select host, (f + m * t) / (n + t) as rate, low, high from hosts, bounds)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and (rate < low or (rate <= high and not soft_failed)) as kept
from judged join rates using (host)""",
}
