"""The registered queries of the engine, each with the SQL that gives the same rows.

The driver's tables stand in for a corpus: ``documents`` are passages (a document
is a ``source``, the order is ``doc_id``), ``labels`` say which are translated and
how well, pairs of ``conversations`` are sources with translations, ``pages`` are a
web archive, ``benchmark`` are references, ``events`` are a usage ledger, and the
order tables stand for generic relational shapes. The texts are Latin, so operators
run with the profile ``LATIN``; Devanagari is covered by the unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import profiles as P
from scriptorium.functions import text as T
from scriptorium.functions import translation as R
from scriptorium.functions import verses as V
from scriptorium.functions.profiles import LATIN
from scriptorium.operators import gazetteer, intake as pages_in, reports, segment, sinks, translate, upsert
from scriptorium.session import spread, table
from scriptorium.sources import files, web
from scriptorium.streaming import intake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of ``(spark, sf_dir)`` under its name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


# --- stand-in tables ----------------------------------------------------------------------------

_PASSAGES = """
    select d.doc_id as key, d.source as doc, cast(d.doc_id {div} 40 as int) as page_no, cast(d.doc_id % 40 as int) as idx, d.text, d.lang,
        case d.doc_id % 6 when 0 then null when 1 then 'mula' when 2 then 'tika' when 3 then 'noise' when 4 then 'prose' else 'frontmatter' end as text_type,
        cast(d.doc_id % 11 as double) / 10 as quality_score,
        case when l.quality is null then null when d.doc_id % 9 = 0 then '  ' else concat('The ', d.text) end as translation,
        case when l.quality is null then null when d.doc_id % 3 = 0 then 'openai:gpt-4o' when d.doc_id % 3 = 1 then 'gemini:gemini-2.5-flash' else 'echo' end as engine,
        case when l.quality is null or d.doc_id % 8 = 0 then null when l.quality = 1 then 1 - cast(d.doc_id % 5 as double) / 8 else cast(d.doc_id % 4 as double) / 8 end as translation_qa,
        case when l.quality is null then null when d.doc_id % 5 = 0 then '' when d.doc_id % 2 = 0 then 'v2-2026-07-20' else 'v1-legacy' end as mt_prompt_version
    from {documents} d left join {labels} l on d.doc_id = l.doc_id"""
PASSAGES = "passages as (" + _PASSAGES.format(div="//", documents="documents", labels="labels") + ")"
PAIRS = """pairs as (
    select * from (
        select conv_id, turn, role, text as source, lead(text) over w as output, lead(role) over w as next_role
        from conversations window w as (partition by conv_id order by turn)
    ) where role = 'user' and next_role = 'assistant')"""
WS = r"^\s+|\s+$"


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = _PASSAGES.format(div="div", documents="{documents}", labels="{labels}")
    return spark.sql(sql, documents=table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lead("text").over(w).alias("output"), F.lead("role").over(w).alias("next_role"))
    return rows.filter("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("source"), "output")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


# --- reports ------------------------------------------------------------------------------------

_QA = """count(*) as total, count(*) filter (where done) as translated, count(*) filter (where not done) as pending,
    count(*) filter (where done and translation_qa is null) as unscored, count(translation_qa) as scored, round(avg(translation_qa), 6) as mean_qa,
    count(*) filter (where translation_qa < 0.2) as b0, count(*) filter (where translation_qa >= 0.2 and translation_qa < 0.4) as b1,
    count(*) filter (where translation_qa >= 0.4 and translation_qa < 0.6) as b2, count(*) filter (where translation_qa >= 0.6 and translation_qa < 0.8) as b3,
    count(*) filter (where translation_qa >= 0.8) as b4"""
_DONE = f"{PASSAGES}, p as (select *, trim(coalesce(translation, '')) <> '' as done from passages)"


@query(f"with {_DONE} select doc, {_QA} from p group by doc")
def qa_summary(spark, sf_dir):
    return reports.qa_summary(passages(spark, sf_dir))


@query(f"with {_DONE} select {_QA} from p")
def qa_totals(spark, sf_dir):
    return reports.qa_summary(passages(spark, sf_dir), ())


@query(f"""with {PASSAGES}, n as (select doc, cast(least(floor(translation_qa * 5), 4) as int) as bucket, count(*) as n from passages where translation_qa is not null group by 1, 2)
select doc, bucket, n, repeat('#', cast(floor(30 * n / sum(n) over (partition by doc) + 0.5) as int)) as bar from n""")
def qa_histogram(spark, sf_dir):
    return reports.histogram(passages(spark, sf_dir), ["doc"], F.col("translation_qa"))


@query(f"""with {PASSAGES} select doc, page_no, idx, key, quality_score, coalesce(quality_score > 0 and quality_score < 0.35, false) as below_threshold
from passages where coalesce(text_type, 'mula') not in ('noise', 'frontmatter') and trim(coalesce(translation, '')) = '' order by doc, page_no, idx limit 100""")
def pending_queue(spark, sf_dir):
    return reports.pending_queue(passages(spark, sf_dir), 0.35, 100).select("doc", "page_no", "idx", "key", "quality_score", "below_threshold")


@query(f"with {PASSAGES} select key, doc, translation_qa from passages where translation_qa < 0.6 order by translation_qa, doc, page_no, idx limit 50")
def weakest_rows(spark, sf_dir):
    return reports.weakest(passages(spark, sf_dir), limit=50).select("key", "doc", "translation_qa")


@query(f"with {PASSAGES} select key, doc, page_no, idx from passages where coalesce(text_type, 'mula') = 'mula' order by doc, page_no, idx limit 50 offset 25")
def page_slice(spark, sf_dir):
    rows = passages(spark, sf_dir).filter(F.coalesce("text_type", F.lit("mula")) == "mula")
    return reports.page_of(rows, ["doc", "page_no", "idx"], 50, 25).select("key", "doc", "page_no", "idx")


@query(f"with {PASSAGES} select doc, coalesce(text_type, 'mula') as text_type, count(*) as n from passages group by 1, 2")
def text_type_counts(spark, sf_dir):
    return reports.type_counts(passages(spark, sf_dir), ["doc"])


@query(f"""with {PASSAGES} select doc, count(*) as n, coalesce(string_agg(distinct engine, ',' order by engine), '') as engines,
coalesce(string_agg(distinct mt_prompt_version, ',' order by mt_prompt_version), '') as versions, round(avg(translation_qa), 3) as mean_qa
from passages where trim(coalesce(translation, '')) <> '' group by doc""")
def provenance(spark, sf_dir):
    return reports.provenance(passages(spark, sf_dir))


@query(f"""with {_DONE} select doc, count(*) as total, count(*) filter (where done) as translated, count(*) filter (where not done) as missing,
round(avg(quality_score), 3) as avg_quality, round(100.0 * count(*) filter (where done) / greatest(count(*), 1), 1) as pct from p group by doc""")
def progress_summary(spark, sf_dir):
    return reports.progress(passages(spark, sf_dir))


@query("""select c.c_custkey, count(o.o_orderkey) as n_rows, count(distinct o.o_orderdate) as n_pages
from customer c left join orders o on c.c_custkey = o.o_custkey group by 1""")
def doc_status(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("page_no"))
    return reports.doc_status(table(spark, sf_dir, "customer").select("c_custkey"), rows, "c_custkey")


@query("select s.s_nationkey, s.s_suppkey from supplier s where not exists (select 1 from lineitem l where l.l_suppkey = s.s_suppkey and l.l_quantity > 49)")
def empty_docs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey").join(lines, "s_suppkey", "left_anti").select("s_nationkey", "s_suppkey")


@query(f"with {PASSAGES} select doc, min(page_no) as page_from, max(page_no) as page_to, count(*) as n from passages group by doc")
def page_spans(spark, sf_dir):
    return reports.page_spans(passages(spark, sf_dir), ["doc"], "page_no")


@query(f"with {PASSAGES} select doc, page_no, sum(length(text))::bigint as chars from passages group by 1, 2 having sum(length(text)) < 300")
def low_pages(spark, sf_dir):
    return reports.low_pages(passages(spark, sf_dir), ["doc", "page_no"])


@query(f"""with {PASSAGES}, s as (
    select 'text' as "column", text as value from passages union all select 'translation', translation from passages
    union all select 'lang', lang from passages union all select 'engine', engine from passages),
m as (select "column", avg(length(regexp_replace(value, '[^A-Za-z]', '', 'g')) / greatest(length(value), 1)) as own,
    avg(length(regexp_replace(value, '[^\\x00-\\x7f]', '', 'g')) / greatest(length(value), 1)) as plain,
    avg(cast(regexp_matches(value, '^\\s*[{{\\[]') or contains(value, '"engine"') or contains(value, '"entities"') as double)) as jsonish
    from s where value <> '' group by 1)
select "column", round(1.2 * own + case when contains("column", 'text') then 0.5 else 0.0 end - 0.3 * plain, 6) as source_score,
    round(1.2 * plain + case when contains("column", 'translation') or contains("column", 'en') then 0.5 else 0.0 end - 0.3 * own - 2.0 * jsonish, 6) as target_score from m""")
def column_roles(spark, sf_dir):
    return reports.column_roles(passages(spark, sf_dir), ["text", "translation", "lang", "engine"], ["text"], ["translation", "en"], LATIN)


@query("""select event_type as engine, count(*) as calls, sum(length(props))::bigint as in_chars, sum(2 * length(props))::bigint as out_chars,
cast(sum(cast(value as decimal(12,2))) as double) as cost_usd, sum(user_id % 7)::bigint as passages, round(sum(user_id % 7) / greatest(1.0, sum(cast(user_id % 60 as double))) * 3600, 1) as passages_per_hour
from events group by 1""")
def usage_totals(spark, sf_dir):
    ledger = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("engine"),
        F.length("props").alias("in_chars"),
        (2 * F.length("props")).alias("out_chars"),
        F.col("value").cast("decimal(12,2)").alias("cost_usd"),
        (F.col("user_id") % 7).alias("passages"),
        (F.col("user_id") % 60).cast("double").alias("duration_s"),
    )
    return translate.usage_totals(ledger).withColumn("cost_usd", F.col("cost_usd").cast("double"))


@query("select event_id, event_type, user_id from events order by event_id desc limit 20")
def recent_calls(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "user_id").orderBy(F.desc("event_id")).limit(20)


@query("with t as (select * from events order by event_id desc limit 40) select event_id, user_id from t where event_type = 'view' order by event_id desc limit 10")
def job_history(spark, sf_dir):
    return reports.tail(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "event_id", 10, F.col("event_type") == "view").select("event_id", "user_id")


@query("""select lang, count(*) as n, count(*) filter (where not (length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) <= 2 or text like '%:' or (upper(text) = text and lower(text) <> text))) as kept,
round(100.0 * count(*) filter (where not (length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) <= 2 or text like '%:' or (upper(text) = text and lower(text) <> text))) / count(*), 1) as pct from documents group by lang""")
def keep_skip(spark, sf_dir):
    kept = F.count_if(~T.is_heading(F.col("text"), LATIN))
    return documents(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"), kept.alias("kept"), F.round(100.0 * kept / F.count("*"), 1).alias("pct"))


@query("""select r.r_name as category, count(*) as n_docs, count(*) filter (where starts_with(c.c_mktsegment, 'AUTO')) as n_exports
from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey group by 1""")
def categories(spark, sf_dir):
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    exports = F.count_if(F.startswith("c_mktsegment", F.lit("AUTO")))
    return joined.groupBy(F.col("r_name").alias("category")).agg(F.count("*").alias("n_docs"), exports.alias("n_exports"))


# --- text functions -----------------------------------------------------------------------------


@query("""select doc_id, round(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / greatest(length(text), 1), 6) as own,
round(length(regexp_replace(text, '[^\\x00-\\x7f]', '', 'g')) / greatest(length(text), 1), 6) as plain from documents""")
def script_fraction(spark, sf_dir):
    own, plain = T.script_share(F.col("text"), LATIN), T.share(F.col("text"), "\\x00-\\x7f")
    return documents(spark, sf_dir).select("doc_id", F.round(own, 6).alias("own"), F.round(plain, 6).alias("plain"))


_NOISE = r"(regexp_replace({0}, '^\s+|\s+$', '', 'g') = '' or regexp_full_match(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '[^\p{{L}}\p{{N}}]+'))"
_DENSITY = r"""round(0.6 * (length(regexp_replace({0}, '[^A-Za-z]', '', 'g')) / greatest(length({0}), 1)) + 0.4 * least(1.0,
    (length({0}) - length(replace({0}, '.', '')) + 2 * (length({0}) - length(replace({0}, chr(10), '')))) / 5.0), 3)"""


@query(f"""select doc_id, case when {_NOISE.format('text')} then 0.0 else {_DENSITY.format('text')} end as quality,
case when {_NOISE.format('text')} then 'red' when {_DENSITY.format('text')} >= 0.9 then 'green' when {_DENSITY.format('text')} >= 0.7 then 'amber' else 'red' end as band from documents""")
def passage_quality(spark, sf_dir):
    q = T.passage_quality(F.col("text"), LATIN)
    return documents(spark, sf_dir).select("doc_id", q.alias("quality")).withColumn("band", T.quality_band(F.col("quality"), (0.7, 0.9)))


_LINES = """lines as (select doc_id, unnest(range(len(a))) as line_no, unnest(a) as line from (select doc_id, string_split(text, chr(10)) as a from documents))"""


def text_lines(spark, sf_dir, *columns):
    return documents(spark, sf_dir).select("doc_id", *columns, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


_TABLE = r"(regexp_matches({0}, '(?i)(?:^|[^\p{{L}}\p{{N}}_])[ivxlcdm]+\s*[.)]') or regexp_matches({0}, '^\s*[-•*]\s+[\p{{L}}\p{{N}}_]'))"
_HEADING = r"({0} <> '' and (length(regexp_replace({0}, '^\s+|\s+$', '', 'g')) <= 2 or regexp_replace({0}, '^\s+|\s+$', '', 'g') like '%:' or (upper({0}) = {0} and lower({0}) <> {0} and not contains({0}, 'ß'))))"
_FRONT = "(({banner}) or (length(regexp_replace({0}, '[^A-Za-z]', '', 'g')) / greatest(length({0}), 1) <= 0.05 and ({front})))".replace(
    "{banner}", " or ".join(f"contains(lower({{0}}), '{b}')" for b in P.PUBLISHER_BANNERS)
).replace("{front}", " or ".join(f"contains(lower({{0}}), '{b}')" for b in P.FRONT_MATTER))


@query(f"""with {_LINES} select doc_id, line_no, {_NOISE.format('line')} as noise, {_HEADING.format('line')} as heading, {_TABLE.format('line')} as fragment,
{_FRONT.format('line')} as front_matter from lines""")
def line_classes(spark, sf_dir):
    line = F.col("line")
    rows = text_lines(spark, sf_dir)
    return rows.select("doc_id", "line_no", T.is_noise(line).alias("noise"), T.is_heading(line, LATIN).alias("heading"), T.is_table_fragment(line).alias("fragment"), T.is_front_matter(line, LATIN).alias("front_matter"))


@query(f"""with {_LINES} select doc_id, count(*) filter (where not ({_NOISE.format('line')} or {_HEADING.format('line')} or {_TABLE.format('line')} or {_FRONT.format('line')})
and length(regexp_replace(line, '[^A-Za-z]', '', 'g')) / greatest(length(line), 1) >= 0.05) as worth from lines group by doc_id""")
def worth_gate(spark, sf_dir):
    rows = text_lines(spark, sf_dir)
    return rows.groupBy("doc_id").agg(F.count_if(T.worth_translating(F.col("line"), LATIN)).alias("worth"))


@query(f"with {PASSAGES} select key, coalesce(quality_score > 0 and quality_score < 0.35, false) as skip_quality from passages")
def quality_gate(spark, sf_dir):
    return passages(spark, sf_dir).select("key", T.skips_quality(F.col("quality_score"), 0.35).alias("skip_quality"))


@query("""with t as (select doc_id, '  ' || replace(replace(text, ' of ', ' “of” '), '. ', '.' || chr(13) || chr(10) || ' – ‘x’-' || chr(10)) as t from documents)
select doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, chr(13) || chr(10) || '?', chr(10), 'g'), '-\\s*\\n\\s*', '', 'g'),
'[“”"]', '"', 'g'), '[‘’`´]', '''', 'g'), '[‒–—―]+', '-', 'g'), '[ \\t\u00a0]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')) as norm_sha from t""")
def norm_spaces_quotes(spark, sf_dir):
    raw = F.concat(F.lit("  "), F.replace(F.replace("text", F.lit(" of "), F.lit(" “of” ")), F.lit(". "), F.lit(".\r\n – ‘x’-\n")))
    return documents(spark, sf_dir).select("doc_id", F.sha2(T.normalize(raw), 256).alias("norm_sha"))


@query("""select doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text || '  |x [12°] ', '\\[\\s*[0-9]+[°*]\\s*\\]', '', 'g'), '\\s*([.])\\s*', ' . ', 'g'), '  +', ' ', 'g'), '^\\s+|\\s+$', '', 'g')) as sha from documents""")
def delimiter_spaces(spark, sf_dir):
    raw = F.regexp_replace(F.concat("text", F.lit("  |x [12°] ")), r"\[\s*[0-9]+[°*]\s*\]", "")
    plain = P.ScriptProfile(**{**LATIN.__dict__, "major": "."})
    return documents(spark, sf_dir).select("doc_id", F.sha2(T.space_delimiters(raw, plain), 256).alias("sha"))


@query("""with t as (select doc_id, '- ' || text || ' [12°]  [fol. 3r] [4*]' as t from documents)
select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '^\\s*[-•*]\\s+', ''), '\\[\\s*[0-9]+[°*]\\s*\\]', '', 'g'), '(?i)\\[fol\\.\\s*[0-9]+[\\p{L}\\p{N}_]*\\]', '', 'g'), '  +', ' ', 'g'), '^\\s+|\\s+$', '', 'g') as clean from t""")
def clean_for_mt(spark, sf_dir):
    raw = F.concat(F.lit("- "), F.col("text"), F.lit(" [12°]  [fol. 3r] [4*]"))
    return documents(spark, sf_dir).select("doc_id", T.clean_for_translation(raw).alias("clean"))


@query("""select doc_id, sha256(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '^ | $', '', 'g')) as collapsed,
sha256(regexp_replace(array_to_string(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), chr(10)), '^\\s+|\\s+$', '', 'g')) as stripped from documents""")
def line_cleaning(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.sha2(T.collapse(F.col("text")), 256).alias("collapsed"), F.sha2(T.strip_lines(F.col("text")), 256).alias("stripped"))


@query("select doc_id, translate(translate(cast(doc_id * 7919 as varchar), '0123456789', '०१२३४५६७८९'), '०१२३४५६७८९', '0123456789') as digits, length(text) - length(replace(text, '.', '')) as minor, length(text) - length(replace(text, chr(10), '')) as major from documents")
def delimiter_counts(spark, sf_dir):
    minor, major = T.delimiters(F.col("text"), LATIN)
    deva = F.translate((F.col("doc_id") * 7919).cast("string"), "0123456789", P.DEVA.digits_from)
    return documents(spark, sf_dir).select("doc_id", T.ascii_digits(deva).alias("digits"), minor.alias("minor"), major.alias("major"))


@query(f"""with {_LINES}, s as (select doc_id, line_no, regexp_replace(line, '{WS}', '', 'g') as t from lines)
select doc_id, line_no, t <> '' and (length(regexp_replace(t, '[^A-Za-z]', '', 'g')) > 0 and length(regexp_replace(t, '[^A-Za-z]', '', 'g')) / greatest(length(t), 1) >= 0.7
 or length(t) <> length(replace(t, '.', '')) and length(regexp_replace(t, '[^A-Za-zéèêç]', '', 'g')) > 0
 or length(regexp_replace(t, '[^éèêç]', '', 'g')) >= 3 and length(regexp_replace(t, '[^éèêç]', '', 'g')) / greatest(length(t), 1) >= 0.02) as verse from s""")
def verse_lines(spark, sf_dir):
    return text_lines(spark, sf_dir).select("doc_id", "line_no", T.is_verse_line(F.col("line"), 0.7, LATIN, "éèêç").alias("verse"))


@query(f"""with {_LINES}, s as (select doc_id, line_no, lower(regexp_replace(line, '{WS}', '', 'g')) as t from lines)
select doc_id, line_no, t in ('home', 'about', 'contact', 'shop', 'links', 'the.', 'as.') or (length(t) <= 2 and length(regexp_replace(t, '[^A-Za-z]', '', 'g')) = 0) as navigation from s""")
def navigation_lines(spark, sf_dir):
    t = T.strip(F.col("line"))
    extra = F.lower(t).isin("the.", "as.")
    return text_lines(spark, sf_dir).select("doc_id", "line_no", (T.is_navigation(t, LATIN) | extra).alias("navigation"))


# --- verses -------------------------------------------------------------------------------------

_REF_TEXT = "select doc_id, text || ' ' || case doc_id % 4 when 0 then cast(doc_id as varchar) when 1 then '1.' || (doc_id % 500) || '.7' when 2 then '12.' || (doc_id % 2000) || ' . ' else '' end as t from documents"


@query(f"""with t as ({_REF_TEXT}), s as (select doc_id, t, regexp_replace(t, '\\s+$', '') as w from t)
select doc_id, case when regexp_matches(w, '[.\\s]*([0-9]{{1,3}})\\.([0-9]{{1,3}})(?:\\.([0-9]{{1,3}}))?[.\\s]*$')
    then regexp_extract(w, '[.\\s]*([0-9]{{1,3}})\\.([0-9]{{1,3}})(?:\\.([0-9]{{1,3}}))?[.\\s]*$', 1) || '.' || regexp_extract(w, '[.\\s]*([0-9]{{1,3}})\\.([0-9]{{1,3}})(?:\\.([0-9]{{1,3}}))?[.\\s]*$', 2)
      || case when regexp_extract(w, '[.\\s]*([0-9]{{1,3}})\\.([0-9]{{1,3}})(?:\\.([0-9]{{1,3}}))?[.\\s]*$', 3) <> '' then '.' || regexp_extract(w, '[.\\s]*([0-9]{{1,3}})\\.([0-9]{{1,3}})(?:\\.([0-9]{{1,3}}))?[.\\s]*$', 3) else '' end
    when regexp_matches(w, '[.\\s]*([0-9]{{1,3}})[.\\s]*$') then regexp_extract(w, '[.\\s]*([0-9]{{1,3}})[.\\s]*$', 1) end as verse_ref,
  case when regexp_matches(w, '[.\\s]*([0-9]{{1,3}})\\.([0-9]{{1,3}})(?:\\.([0-9]{{1,3}}))?[.\\s]*$') then regexp_replace(w, '[.\\s]*([0-9]{{1,3}})\\.([0-9]{{1,3}})(?:\\.([0-9]{{1,3}}))?[.\\s]*$', '')
    when regexp_matches(w, '[.\\s]*([0-9]{{1,3}})[.\\s]*$') then regexp_replace(w, '[.\\s]*([0-9]{{1,3}})[.\\s]*$', '') else t end as clean from s""")
def verse_ref(spark, sf_dir):
    d = F.col("doc_id")
    tail = (
        F.when(d % 4 == 0, d.cast("string"))
        .when(d % 4 == 1, F.concat(F.lit("1."), (d % 500).cast("string"), F.lit(".7")))
        .when(d % 4 == 2, F.concat(F.lit("12."), (d % 2000).cast("string"), F.lit(" . ")))
        .otherwise("")
    )
    rows = documents(spark, sf_dir).select("doc_id", F.concat(F.col("text"), F.lit(" "), tail).alias("t"))
    ref, clean = V.verse_ref(F.col("t"), LATIN)
    return rows.select("doc_id", ref.alias("verse_ref"), clean.alias("clean"))


_SYLLABLES = "length(regexp_replace({0}, '[^aeiouyAEIOUY]', '', 'g')) + len(regexp_extract_all({0}, '[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]')) - len(regexp_extract_all({0}, '[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ][aeiouyAEIOUY]'))"
_METRE = "case when {0} between 28 and 36 then 'anustubh' when {0} between 40 and 48 then 'tristubh' when {0} between 44 and 52 then 'jagati' when {0} between 70 and 82 then 'sardula_vikridata' when {0} between 56 and 64 then 'malini' when {0} between 52 and 60 then 'vasantatilaka' end"


@query(f"with {_LINES}, s as (select doc_id, line_no, {_SYLLABLES.format('line')} as syllables from lines) select *, {_METRE.format('syllables')} as metre from s")
def syllables_metre(spark, sf_dir):
    rows = text_lines(spark, sf_dir).select("doc_id", "line_no", V.syllables(F.col("line"), LATIN).alias("syllables"))
    return rows.withColumn("metre", V.metre(F.col("syllables")))


_CHAPTER = "(?:Chapter|Kapitel|The|Der)[ ]*(?:[0-9]+)?"
_CHAPTER_OF = f"""case when regexp_matches({{0}}, '{_CHAPTER}') then case when regexp_extract({{0}}, '({_CHAPTER})\\s*([0-9]*)', 2) <> ''
    then regexp_extract({{0}}, '({_CHAPTER})\\s*([0-9]*)', 2) else regexp_replace(regexp_extract({{0}}, '({_CHAPTER})\\s*([0-9]*)', 1), '{WS}', '', 'g') end end"""
#: Lines; in texts of one line the sentences in pairs; in texts without a full stop the text.
_PARTS = f"""with pieces as (
    select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '{WS}', '', 'g')), lambda x: x <> '') as parts from documents where contains(text, chr(10))
    union all select doc_id, list_filter([regexp_replace(text, '{WS}', '', 'g')], lambda x: x <> '') from documents where not contains(text, chr(10)) and not contains(text, '.')
    union all select doc_id, list_transform(range(0, len(a), 2), lambda i: a[i + 1] || case when i + 2 <= len(a) then chr(10) || a[i + 2] else '' end) from (
        select doc_id, list_filter(list_transform(range(1, len(b) + 1), lambda i: regexp_replace(b[i] || case when i < len(b) then '.' else '' end, '{WS}', '', 'g')), lambda x: x <> '') as a
        from (select doc_id, string_split(text, '.') as b from documents where not contains(text, chr(10)) and contains(text, '.')))),
parts as (select doc_id, unnest(range(len(parts))) as pos, unnest(parts) as seg from pieces)"""


@query(f"""{_PARTS}, c as (select *, {_CHAPTER_OF.format('seg')} as seg_chapter from parts), f as (select doc_id, {_CHAPTER_OF.format('text')} as first from documents)
select doc_id, cast(pos as int) as pos, coalesce(last_value(seg_chapter ignore nulls) over (partition by doc_id order by pos rows unbounded preceding), first) as chapter from c join f using (doc_id)""")
def chapter_carry(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "text")
    return segment.segments(rows, ["doc_id"], "text", LATIN).select("doc_id", "pos", "chapter")


_OWN = "length(regexp_replace(t, '[^A-Za-z]', '', 'g')) / greatest(length(t), 1)"
_KIND = f"""case when {_OWN} < 0.03 and length(regexp_replace(t, '{WS}', '', 'g')) < 30 then 'noise'
    when {_OWN} < 0.05 and ({' or '.join(f"contains(lower(t), '{w}')" for w in P.SEGMENT_FRONT_MATTER)}) then 'frontmatter' when {_OWN} < 0.05 then 'prose'
    when regexp_matches(t, '[Tt]he .{{5,80}}(?:tion|ing)') then 'colophon' when regexp_matches(t, '{_CHAPTER}') then 'colophon'
    when {_OWN} < 0.4 and regexp_matches(t, 'ver|tre|and') then 'tika' when not contains(t, '.') and not contains(t, chr(10)) and {_OWN} < 0.6 then 'prose' else 'mula' end"""
_DOTTED, _SINGLE = r"[.\s]*([0-9]{1,3})\.([0-9]{1,3})(?:\.([0-9]{1,3}))?[.\s]*$", r"[.\s]*([0-9]{1,3})[.\s]*$"
_WITHOUT_REF = f"""case when regexp_matches(seg, '{_DOTTED}') then regexp_replace(seg, '{_DOTTED}', '') when regexp_matches(seg, '{_SINGLE}') then regexp_replace(seg, '{_SINGLE}', '') else seg end"""
_REF = f"""case when regexp_matches(seg, '{_DOTTED}') then regexp_extract(seg, '{_DOTTED}', 1) || '.' || regexp_extract(seg, '{_DOTTED}', 2)
    || case when regexp_extract(seg, '{_DOTTED}', 3) <> '' then '.' || regexp_extract(seg, '{_DOTTED}', 3) else '' end when regexp_matches(seg, '{_SINGLE}') then regexp_extract(seg, '{_SINGLE}', 1) end"""
_WHOLE_QUALITY = f"case when {_NOISE.format('text')} then 0.0 else {_DENSITY.format('text')} end"


@query(f"""{_PARTS}, r as (select doc_id, pos, {_REF} as verse_ref, regexp_replace({_WITHOUT_REF}, '{WS}', '', 'g') as t from parts),
k as (select *, {_KIND} as text_type from r),
s as (select *, {_SYLLABLES.format('t')} as syl from k where t <> '' and text_type <> 'noise')
select doc_id, cast(row_number() over (partition by doc_id order by pos) - 1 as int) as idx, t as text, verse_ref, text_type, case when text_type = 'mula' then {_METRE.format('syl')} end as chandas,
    case when text_type = 'mula' then length(t) - length(replace(t, '.', '')) + 2 * (length(t) - length(replace(t, chr(10), ''))) else 0 end as padas, {_DENSITY.format('t')} as quality_score from s
union all select doc_id, 0, text, null, 'prose', null, 0, {_WHOLE_QUALITY} from documents where doc_id in (select doc_id from parts) and doc_id not in (select doc_id from s)""")
def segments(spark, sf_dir):
    out = segment.segment_pages(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"], "text", LATIN)
    return out.select("doc_id", "idx", "text", "verse_ref", "text_type", "chandas", "padas", "quality_score")


@query("""with s as (select doc_id, list_filter(list_transform(string_split(text, '.'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') as a from documents)
select doc_id, i as pos, a[2 * i + 1] || case when 2 * i + 2 <= len(a) then chr(10) || a[2 * i + 2] else '' end as pair from s, unnest(range(cast((len(a) + 1) // 2 as bigint))) as u(i)""")
def half_verse_pairs(spark, sf_dir):
    halves = F.filter(F.transform(F.split("text", r"\.", -1), T.strip), lambda x: x != "")
    return documents(spark, sf_dir).select("doc_id", F.posexplode_outer(segment.pair_halves(halves)).alias("pos", "pair")).filter("pos is not null")


@query(f"""with {_LINES}, h as (select * from lines where contains(line, 'th')),
i as (select *, case when line_no - lag(line_no) over (partition by doc_id order by line_no) >= 3 then 1 else 0 end as opens from h),
b as (select *, sum(opens) over (partition by doc_id order by line_no rows unbounded preceding) as block from i)
select doc_id, block::bigint as block, count(*) as n_lines, min(line_no)::int as first_line, string_agg(regexp_replace(line, '{WS}', '', 'g'), chr(10) order by line_no) as text
from b group by 1, 2 having length(string_agg(regexp_replace(line, '{WS}', '', 'g'), chr(10) order by line_no)) >= 20""")
def line_blocks(spark, sf_dir):
    return segment.line_blocks(text_lines(spark, sf_dir), ["doc_id"], "line_no", "line", F.contains("line", F.lit("th")))


@query("select c.doc_id, count(*) as n_clauses, coalesce(sum(len(c.w)), 0)::bigint as n_words from (select doc_id, list_filter(string_split_regex(unnest(string_split_regex(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '[|.\\n]+')), '\\s+'), lambda x: x <> '') as w from documents) c where len(c.w) > 0 group by 1")
def sandhi_tokens(spark, sf_dir):
    c = V.clauses(F.col("text"), LATIN)
    rows = documents(spark, sf_dir).select("doc_id", c.alias("c"))
    return rows.select("doc_id", F.size("c").cast("long").alias("n_clauses"), F.size(F.flatten("c")).cast("long").alias("n_words"))


@query("select doc_id, case when regexp_matches(ch, '^[0-9]+([.–-][0-9]+)*$') then 'chapter:' || ch else 'page:' || (doc_id // 40) end as section from (select doc_id, case doc_id % 4 when 0 then cast(doc_id as varchar) when 1 then '1.' || doc_id when 2 then 'parva' end as ch from documents)")
def section_keys(spark, sf_dir):
    d = F.col("doc_id")
    ch = F.when(d % 4 == 0, d.cast("string")).when(d % 4 == 1, F.concat(F.lit("1."), d.cast("string"))).when(d % 4 == 2, "parva")
    return documents(spark, sf_dir).select("doc_id", V.section_key(ch, F.expr("doc_id div 40")).alias("section"))


@query("""select doc_id, c as code from (select doc_id, substr('wl_' || case when regexp_matches(s, '[0-9]$') then s || '_x' else s end, 1, 64) as c
from (select doc_id, regexp_replace(regexp_replace(regexp_replace(lower('The-' || text || (doc_id % 3)), '^(the|a|an)-', ''), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as s from documents))""")
def doc_codes(spark, sf_dir):
    slug = F.concat(F.lit("The-"), F.col("text"), (F.col("doc_id") % 3).cast("string"))
    return documents(spark, sf_dir).select("doc_id", T.doc_code(slug, "wl_").alias("code"))


# --- translations -------------------------------------------------------------------------------

_BOILER = "({0} = '' or regexp_full_match({0}, '[^\\p{{L}}\\p{{N}}]+') or length({0}) < 4 or " + " or ".join(
    "contains(lower({0}), '" + p.replace("'", "''") + "')" for p in P.JUNK_PHRASES
) + ")"
#: Pairs, some of them made worse in known ways.
_WORSE = f"""{PAIRS}, worse as (select conv_id, turn, source, regexp_replace(case (conv_id + turn) % 7 when 0 then output || ' The rest is unclear.' when 1 then 'n/a' when 2 then substr(output, 1, 20)
    when 3 then 'Lake | lake' when 4 then replace(output, ' the ', ' / the ') when 5 then 'I cannot translate this.' else output end, '{WS}', '', 'g') as t from pairs)"""


def worse(spark, sf_dir):
    k = (F.col("conv_id") + F.col("turn")) % 7
    t = (
        F.when(k == 0, F.concat("output", F.lit(" The rest is unclear.")))
        .when(k == 1, "n/a")
        .when(k == 2, F.substring("output", 1, 20))
        .when(k == 3, "Lake | lake")
        .when(k == 4, F.replace("output", F.lit(" the "), F.lit(" / the ")))
        .when(k == 5, "I cannot translate this.")
        .otherwise(F.col("output"))
    )
    return pairs(spark, sf_dir).select("conv_id", "turn", "source", T.strip(t).alias("t"))


@query(f"with {_WORSE} select conv_id, turn, {_BOILER.format('t')} as boilerplate from worse")
def boilerplate(spark, sf_dir):
    return worse(spark, sf_dir).select("conv_id", "turn", R.is_boilerplate(F.col("t")).alias("boilerplate"))


_RATIO = "(length(t) / greatest(length(regexp_replace(source, '^\\s+|\\s+$', '', 'g')), 1))"
_LOST = f"""case when {_RATIO} < 0.6 then 0.4 when {_RATIO} < 1.0 then 0.15 when {_RATIO} > 5.0 then 0.3 when {_RATIO} > 3.5 then 0.1 else 0.0 end
  + case when regexp_matches(t, '^\\s*([^|/\\n]{{2,60}})\\s*\\|\\s*([^|/\\n]{{2,60}})\\s*$') and lower(trim(regexp_extract(t, '^\\s*([^|/\\n]{{2,60}})\\s*\\|\\s*([^|/\\n]{{2,60}})\\s*$', 1))) = lower(trim(regexp_extract(t, '^\\s*([^|/\\n]{{2,60}})\\s*\\|\\s*([^|/\\n]{{2,60}})\\s*$', 2))) then 0.6 else 0.0 end
  + case when (length(t) - length(replace(t, ' / ', ''))) / 3 / greatest(len(list_filter(string_split_regex(t, '\\s+'), lambda x: x <> '')), 1) > 0.08 then 0.2
      when (length(t) - length(replace(t, ' / ', ''))) / 3 / greatest(len(list_filter(string_split_regex(t, '\\s+'), lambda x: x <> '')), 1) > 0.04 then 0.1 else 0.0 end
  + case when regexp_matches(t, '[A-Za-z]') then 0.0 else 0.5 end"""


@query(f"with {_WORSE} select conv_id, turn, case when {_BOILER.format('t')} then 0.0 else round(greatest(0.0, least(1.0, 1.0 - cast({_LOST} as double))), 3) end as qa, round(least(1.0, length(t) / greatest(length(source), 1) / 5), 3) as length_score from worse")
def translation_qa(spark, sf_dir):
    qa, n = R.translation_quality(F.col("source"), F.col("t")), R.length_score(F.col("source"), F.col("t"))
    return worse(spark, sf_dir).select("conv_id", "turn", qa.alias("qa"), n.alias("length_score"))


_CAVEAT_AT = "list_min(list_filter([" + ", ".join("strpos(lower(t), '" + p.replace("'", "''") + "')" for p in P.JUNK_PHRASES + P.CAVEATS) + "], lambda x: x > 0))"


@query(f"""with {_WORSE}, a as (select *, {_CAVEAT_AT} as cut_at from worse),
k as (select *, regexp_replace(regexp_extract(substr(t, 1, cast(cut_at - 1 as int)), '(?s)^(.*(?:[.।॥!?](?:\\s|$)|//))', 1), '{WS}', '', 'g') as kept from a)
select conv_id, turn, case when cut_at is null then t when length(kept) >= 15 and not {_BOILER.format('kept')} then kept || ' […]' else '' end as salvaged from k""")
def salvage(spark, sf_dir):
    return worse(spark, sf_dir).select("conv_id", "turn", R.salvage(F.col("t")).alias("salvaged"))


@query(f"""with {PAIRS}, w as (select conv_id, turn, list_distinct(list_filter(string_split_regex(source, '\\s+'), lambda x: x <> '')) as s, list_distinct(list_filter(string_split_regex(output, '\\s+'), lambda x: x <> '')) as o from pairs)
select conv_id, turn, round(len(list_intersect(s, o)) / greatest(len(s), 1), 6) as overlap from w""")
def overlap_ratio(spark, sf_dir):
    return pairs(spark, sf_dir).select("conv_id", "turn", F.round(R.overlap(F.col("source"), F.col("output")), 6).alias("overlap"))


@query(f"""with {PAIRS}, e as (select conv_id, turn, source, case (conv_id + turn) % 3 when 0 then output || ' १२' when 1 then 'धर्मक्षेत्रे कुरुक्षेत्रे समवेता' else output end as o from pairs)
select conv_id, turn, regexp_matches(o, '[०-९]') or length(regexp_replace(o, '[^ऀ-ॿ]', '', 'g')) / length(o) > 0.5 as echo from e""")
def source_echo(spark, sf_dir):
    k = (F.col("conv_id") + F.col("turn")) % 3
    o = F.when(k == 0, F.concat("output", F.lit(" १२"))).when(k == 1, "धर्मक्षेत्रे कुरुक्षेत्रे समवेता").otherwise(F.col("output"))
    return pairs(spark, sf_dir).select("conv_id", "turn", R.is_echo(F.col("source"), o).alias("echo"))


@query("""with t as (select doc_id, '<b>' || text || ' // and / or *term* & "q" //' as t from documents),
e as (select doc_id, replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') as e from t)
select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(e, '\\s*//+\\s*$', '', 'g'), '\\s*//+\\s*', ' — ', 'g'), '\\s+/\\s+', ' — ', 'g'), '\\s+', ' ', 'g'),
'\\*([^*\\s]|[^*\\s][^*\\n]*[^*\\s])\\*', '<em>\\1</em>', 'g'), '^\\s+|\\s+$', '', 'g') as html from e""")
def inline_format(spark, sf_dir):
    raw = F.concat(F.lit("<b>"), F.col("text"), F.lit(' // and / or *term* & "q" //'))
    return documents(spark, sf_dir).select("doc_id", R.inline_format(R.escape_html(raw)).alias("html"))


#: Each ``the`` becomes a note, each ``of`` a gloss, each ``and`` a mark of an illegible place.
_NOTED = "replace(replace(replace(translate({text}, '[]', '()'), ' the ', concat(' [i.e., ', {lang}, '] ')), ' of ', ' [lake] '), ' and ', ' [illegible] ')"


@query("""with t as (select doc_id, source, 'i.e., ' || lang as note, unnest(range((length(text) - length(replace(text, ' the ', ''))) // 5)) as k from documents)
select source, doc_id, note, cast(row_number() over (partition by source order by doc_id, k) as int) as number from t""")
def footnote_numbers(spark, sf_dir):
    rows = documents(spark, sf_dir).select("source", "doc_id", F.expr(_NOTED.format(text="text", lang="lang")).alias("t"))
    return sinks.numbered_notes(rows, ["source"], ["doc_id"], "t").select("source", "doc_id", "note", "number")


@query(f"""with t as (select doc_id, doc_id % 4 as k, case doc_id % 4 when 0 then 'Tale of the ' when 1 then 'There once was a Bargad and a BARGAD. ' when 2 then 'Stories from Panchatantra: ' else 'no ' end || replace(text, ' of ', ' Bargad ') as raw from documents),
a as (select *, regexp_replace(regexp_replace(regexp_replace(raw, '\\s*\\n+\\s*', ' ', 'g'), '\\s{{2,}}', ' ', 'g'), '{WS}', '', 'g') as clean from t),
b as (select *, case k when 0 then regexp_replace(clean, '^Tale of the\\s+', '') when 1 then regexp_replace(clean, '^There once was', 'There was') when 2 then regexp_replace(clean, '^Stories from Panchatantra:\\s*', '') else clean end as cut from a),
c as (select *, replace(replace(replace(cut, ' Bargad ', ' Banyan '), ' Bargad ', ' Banyan '), 'a BARGAD. ', 'a BANYAN. ') as styled from b)
select doc_id, sha256(styled) as styled, array_to_string(list_filter([case when clean <> raw then 'whitespace/zw' end, case when cut <> clean then case k when 0 then 'strip:TaleOf' when 1 then 'diction:once_was' else 'strip:SfP' end end,
    case when styled <> cut then 'terms:common' end], lambda x: x is not null), ';') as rules from c""")
def style_rules(spark, sf_dir):
    k = F.col("doc_id") % 4
    head = F.when(k == 0, "Tale of the ").when(k == 1, "There once was a Bargad and a BARGAD. ").when(k == 2, "Stories from Panchatantra: ").otherwise("no ")
    styled, rules = R.style(F.concat(head, F.replace("text", F.lit(" of "), F.lit(" Bargad "))))
    return documents(spark, sf_dir).select("doc_id", F.sha2(styled, 256).alias("styled"), F.array_join(rules, ";").alias("rules"))


@query(f"""with t as (select doc_id, replace(text, ' of ', ' bargad ,') || ' ,bargad tree' as t from documents),
a as (select doc_id, regexp_replace(replace(translate(replace(t, 'bargad', 'banyan'), '“”‘’—–', '""''''--'), '…', '...'), '([\\p{{L}}\\p{{N}}_])-\\n([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g') as t from t),
b as (select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[ \\t]*\\n[ \\t]*', ' ', 'g'), '[ \\t]+', ' ', 'g'), '{WS}', '', 'g'), '\\s+([,.;:?!])', '\\1', 'g') as t from a)
select doc_id, regexp_replace(regexp_replace(regexp_replace(t, '([,.;:?!])([^\\s])', '\\1 \\2', 'g'), '[ \\t]+', ' ', 'g'), '{WS}', '', 'g') as polished from b""")
def term_map(spark, sf_dir):
    text = F.concat(F.replace("text", F.lit(" of "), F.lit(" bargad ,")), F.lit(" ,bargad tree"))
    return documents(spark, sf_dir).select("doc_id", R.polish(R.apply_terms(text, [("bargad", "banyan"), ("Panchatantr", "Panchatantra")])).alias("polished"))


@query(f"""with {PASSAGES} select key, 'Context: Text: ' || upper(substr(doc, 1, 1)) || substr(doc, 2) || ' | Category: ' || lang || ' | Verse: ' || idx ||
case text_type when 'tika' then ' | Note: This passage is commentary (ṭīkā), not the root text (mūla)' when 'prose' then ' | Note: This passage is Sanskrit prose, not metrical verse' else '' end as line from passages""")
def prompt_context(spark, sf_dir):
    none = F.lit(None).cast("string")
    line = R.context_line(F.col("doc"), F.col("lang"), none, F.col("idx").cast("string"), none, F.col("text_type"))
    return passages(spark, sf_dir).select("key", line.alias("line"))


# --- cache, costs, history ----------------------------------------------------------------------


@query("select doc_id, sha256('v2-2026-07-20' || chr(0) || text) as text_hash from documents")
def cache_keys(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", R.cache_key(F.col("text")).alias("text_hash"))


@query("select sha256('v2-2026-07-20' || chr(0) || text) as text_hash, min(doc_id) as first_doc, count(*) as n from documents group by text")
def cache_dedup(spark, sf_dir):
    return documents(spark, sf_dir).groupBy(R.cache_key(F.col("text")).alias("text_hash")).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"))


@query("""with c as (select text, min(doc_id) as k from documents where doc_id % 2 = 0 group by text) select d.doc_id, c.text is not null as hit, case when c.text is not null then 'out ' || c.k end as output from documents d left join c on d.text = c.text""")
def cache_hits(spark, sf_dir):
    rows = documents(spark, sf_dir)
    cache = translate.with_cache_key(rows.filter("doc_id % 2 = 0").groupBy("text").agg(F.min("doc_id").alias("k")), "e", "sa", "en")
    found = translate.lookup(translate.with_cache_key(rows.select("doc_id", "text"), "e", "sa", "en"), cache.withColumn("output", F.concat(F.lit("out "), F.col("k").cast("string"))))
    return found.select("doc_id", F.col("output").isNotNull().alias("hit"), "output")


@query(f"""with t as (select lang as engine, regexp_replace(case doc_id % 5 when 0 then '  ' when 1 then 'Sorry, but the text is garbled. ' || text else text end, '{WS}', '', 'g') as o from documents)
select engine, count(*) as total, count(*) filter (where o = '') as empty, count(*) filter (where o <> '' and {_BOILER.format('o')}) as junk, count(*) filter (where not {_BOILER.format('o')}) as kept from t group by 1""")
def cache_poison(spark, sf_dir):
    k = F.col("doc_id") % 5
    output = F.when(k == 0, "  ").when(k == 1, F.concat(F.lit("Sorry, but the text is garbled. "), F.col("text"))).otherwise(F.col("text"))
    return translate.poison_report(documents(spark, sf_dir).select(F.col("lang").alias("engine"), output.alias("output")))


@query("""with n as (select *, row_number() over (partition by text order by doc_id) as r from documents where doc_id % 2 = 1 and text not in (select text from documents where doc_id % 2 = 0))
select doc_id, source from documents where doc_id % 2 = 0 union all select doc_id, source from n where r = 1""")
def insert_or_ignore(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "source", "text")
    return upsert.first_wins(rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 = 1"), ["text"], "doc_id").select("doc_id", "source")


@query("select max(doc_id) as doc_id, count(distinct text) as one from documents group by text")
def insert_or_replace(spark, sf_dir):
    return upsert.last_wins(documents(spark, sf_dir).select("doc_id", "text"), ["text"], "doc_id").select("doc_id", F.lit(1).cast("long").alias("one"))


@query("""with r as (select *, turn >= 1 and text <> '' as fits, row_number() over (partition by conv_id order by turn) as n from conversations)
select conv_id, turn, coalesce((select string_agg(x, '|' order by n) from (select b.text as x, b.n from r b where b.conv_id = a.conv_id and b.n < a.n and b.fits order by b.n desc limit 3)), '') as context from r a""")
def context_window(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    found = translate.preceding(rows, "conv_id", ["turn"], F.col("text"), 3, (F.col("turn") >= 1) & (F.col("text") != ""))
    return found.select("conv_id", "turn", F.array_join("context", "|").alias("context"))


@query("""with e as (select doc_id, case doc_id % 5 when 0 then 'openai:gpt-4o' when 1 then 'gemini:gemini-2.5-pro' when 2 then 'openai:gpt-4o-mini' when 3 then 'gemini:gemini-2.0-flash' else 'other' end as engine, n_chars from documents)
select doc_id, engine, round(p.i * (n_chars / 4e6) + p.o * (2 * n_chars / 4e6), 9) as cost, round(case when engine = 'openai:gpt-4o' then 0.15 * (n_chars / 4e6) + 0.6 * (2 * n_chars / 4e6) else p.i * (n_chars / 4e6) + p.o * (2 * n_chars / 4e6) end, 9) as loose_cost
from e join (values ('openai:gpt-4o', 2.5, 10.0), ('gemini:gemini-2.5-pro', 1.25, 10.0), ('openai:gpt-4o-mini', 0.15, 0.6), ('gemini:gemini-2.0-flash', 0.075, 0.3), ('other', 0.15, 0.6)) p(name, i, o) on p.name = e.engine""")
def engine_cost(spark, sf_dir):
    k = F.col("doc_id") % 5
    engine = F.when(k == 0, "openai:gpt-4o").when(k == 1, "gemini:gemini-2.5-pro").when(k == 2, "openai:gpt-4o-mini").when(k == 3, "gemini:gemini-2.0-flash").otherwise("other")
    rows = documents(spark, sf_dir).select("doc_id", engine.alias("engine"), "n_chars")
    cost = lambda exact: F.round(R.cost(F.col("engine"), F.col("n_chars"), 2 * F.col("n_chars"), exact), 9)
    return rows.select("doc_id", "engine", cost(True).alias("cost"), cost(False).alias("loose_cost"))


@query("select source, sum(length(text) + 100)::bigint as in_chars, (2 * sum(length(text) + 100))::bigint as out_chars from documents group by 1")
def batch_estimate(spark, sf_dir):
    return translate.batch_estimate(documents(spark, sf_dir), ["source"], F.col("text"), 100)


_CALLS = "calls as (select event_id, user_id, ts, cast(value as decimal(12,2)) as cost from events)"


@query(f"with {_CALLS} select event_id, user_id, cast(sum(cost) over w as double) as spent from calls window w as (partition by user_id order by event_id rows unbounded preceding)")
def running_spend(spark, sf_dir):
    calls = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("value").cast("decimal(12,2)").alias("cost"))
    out = translate.running_spend(calls, "event_id", "cost", ["user_id"], 1000)
    return out.select("event_id", "user_id", F.col("spent").cast("double").alias("spent"))


@query(f"""with {_CALLS}, s as (select *, sum(cost) over (partition by user_id order by event_id rows unbounded preceding) as spent from calls)
select event_id, user_id, max(case when spent > 100 then 1 else 0 end) over (partition by user_id order by event_id rows unbounded preceding) = 0 as accepted from s""")
def budget_gate(spark, sf_dir):
    calls = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("value").cast("decimal(12,2)").alias("cost"))
    return translate.budget_gate(calls, "event_id", "cost", 100, ["user_id"], 1000).select("event_id", "user_id", "accepted")


@query("""with i as (select *, sum(case when event_type <> 'error' then 1 else 0 end) over (partition by user_id order by event_id rows unbounded preceding) as island from events)
select event_id, user_id, sum(case when event_type = 'error' then 1 else 0 end) over (partition by user_id, island order by event_id rows unbounded preceding)::bigint as streak from i""")
def failure_streaks(spark, sf_dir):
    calls = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return translate.failure_streaks(calls, ["user_id"], ["event_id"], F.col("event_type") != "error", width=1000).select("event_id", "user_id", F.col("streak").cast("long").alias("streak"))


@query(f"with {PASSAGES} select key, 'qa<0.6;prompt-upgrade:v1-legacy' as reason from passages where trim(coalesce(translation, '')) <> '' and translation_qa < 0.6 and mt_prompt_version = 'v1-legacy'")
def retranslate_pick(spark, sf_dir):
    return translate.retranslate_pick(passages(spark, sf_dir), below=0.6, version="v1-legacy").select("key", "reason")


@query(f"""with {PASSAGES}, pick as (select * from passages where trim(coalesce(translation, '')) <> '' and translation_qa < 0.6)
select 'history' as part, key, translation, translation_qa from pick union all
select 'table', p.key, case when k.key is null then p.translation end, case when k.key is null then p.translation_qa end from passages p left join pick k on p.key = k.key""")
def archive_and_clear(spark, sf_dir):
    rows = passages(spark, sf_dir)
    history, cleared = translate.archive_and_clear(rows, translate.retranslate_pick(rows, below=0.6))
    show = lambda df, part: df.select(F.lit(part).alias("part"), "key", "translation", "translation_qa")
    return show(history, "history").unionByName(show(cleared, "table"))


@query(f"with {PASSAGES} select key, case when trim(coalesce(mt_prompt_version, '')) = '' and trim(coalesce(translation, '')) <> '' then 'v1-legacy' else mt_prompt_version end as mt_prompt_version from passages")
def backfill_version(spark, sf_dir):
    return translate.backfill_version(passages(spark, sf_dir)).select("key", "mt_prompt_version")


@query("""with o as (select * from orders where o_orderkey % 3 < 2), n as (select o_orderkey, 'N' as o_orderstatus, case when o_orderkey % 2 = 0 then 'new' end as o_orderpriority from orders where o_orderkey % 3 > 0)
select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey, coalesce(n.o_orderstatus, o.o_orderstatus) as o_orderstatus, coalesce(n.o_orderpriority, o.o_orderpriority) as o_orderpriority, o.o_custkey
from o full join n on o.o_orderkey = n.o_orderkey""")
def ingest_upsert(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    new = rows.filter("o_orderkey % 3 > 0").select("o_orderkey", F.lit("N").alias("o_orderstatus"), F.expr("case when o_orderkey % 2 = 0 then 'new' end").alias("o_orderpriority"))
    return upsert.upsert(rows.filter("o_orderkey % 3 < 2"), new, ["o_orderkey"], ["o_orderstatus"], ["o_orderpriority"])


@query("""with o as (select distinct source as code, cast(null as varchar) as category from documents where doc_id % 2 = 0), n as (select source as code, max(lang) as category from documents where doc_id % 3 = 0 group by 1)
select coalesce(o.code, n.code) as code, coalesce(n.category, o.category) as category from o full join n on o.code = n.code""")
def doc_upsert(spark, sf_dir):
    rows = documents(spark, sf_dir)
    old = rows.filter("doc_id % 2 = 0").select(F.col("source").alias("code"), F.lit(None).cast("string").alias("category")).distinct()
    return upsert.ensure_docs(old, rows.filter("doc_id % 3 = 0").groupBy(F.col("source").alias("code")).agg(F.max("lang").alias("category")))


@query(f"with {PASSAGES} select key, doc from passages where doc <> 'src3'")
def wipe_doc(spark, sf_dir):
    return upsert.wipe(passages(spark, sf_dir), "src3").select("key", "doc")


@query("select doc_id, source, 'kept' as part from documents where source not in (select source from documents where lang = 'es' and doc_id % 2 = 0) union all select doc_id, source, 'new' from documents where lang = 'es' and doc_id % 2 = 0")
def source_records(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "source", "lang")
    new = rows.filter("lang = 'es' and doc_id % 2 = 0").select("doc_id", "source", F.lit("new").alias("part"))
    return upsert.replace_rows(rows.select("doc_id", "source", F.lit("kept").alias("part")), new, ["source"])


# --- joins and audits ---------------------------------------------------------------------------


@query(f"with {PASSAGES}, s as (select doc, min(page_no) as a, max(page_no) as b from passages group by doc) select s.doc, cast(u.p as int) as page_no from s, unnest(range(a, b + 1)) as u(p) where not exists (select 1 from passages x where x.doc = s.doc and x.page_no = u.p and x.idx < 20)")
def missing_pages(spark, sf_dir):
    rows = passages(spark, sf_dir)
    want = reports.expected_pages(reports.page_spans(rows, ["doc"], "page_no"), ["doc"], "page_no")
    return reports.missing(want, rows.filter("idx < 20"), ["doc", "page_no"])


@query(f"with {PASSAGES} select doc, page_no, count(*) as n from passages where trim(coalesce(translation, '')) = '' group by 1, 2")
def missing_per_page(spark, sf_dir):
    return passages(spark, sf_dir).filter(T.is_blank(F.col("translation"))).groupBy("doc", "page_no").agg(F.count("*").alias("n"))


@query("select o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l.l_returnflag = 'R')")
def anti_missing(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left_anti")


@query("""with r as (select c_custkey as run, cast(c_custkey * 7 as bigint) as page_to, cast(c_custkey * 7 + c_custkey % 90 as bigint) as page_from from customer)
select o.o_orderkey, r.run from orders o join r on o.o_orderkey between least(page_from, page_to) and greatest(page_from, page_to)""")
def range_join(spark, sf_dir):
    ranges = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run"), (F.col("c_custkey") * 7).alias("page_to"), (F.col("c_custkey") * 7 + F.col("c_custkey") % 90).alias("page_from"))
    return reports.in_ranges(table(spark, sf_dir, "orders").select("o_orderkey"), ranges, "o_orderkey").select("o_orderkey", "run")


@query(f"with {PASSAGES} select p.key, p.doc, l.translation as hi, p.translation as en from passages p left join (select key, translation from passages where lang = 'de' and translation is not null) l on p.key = l.key")
def localized_rows(spark, sf_dir):
    rows = passages(spark, sf_dir)
    other = rows.filter("lang = 'de' and translation is not null").select("key", F.col("translation").alias("hi"))
    return rows.join(other, "key", "left").select("key", "doc", "hi", F.col("translation").alias("en"))


@query(f"with {PASSAGES} select distinct doc from passages where lang = 'fr' and trim(coalesce(translation, '')) <> ''")
def has_localized(spark, sf_dir):
    rows = passages(spark, sf_dir)
    done = rows.filter((F.col("lang") == "fr") & ~T.is_blank(F.col("translation")))
    return rows.select("doc").distinct().join(done.select("doc"), "doc", "left_semi")


@query(f"with {PASSAGES} select key, case when trim(coalesce(translation, '')) <> '' and coalesce(translation_qa, 0) >= 0.6 then translation end as anchor from passages")
def anchor_rows(spark, sf_dir):
    return passages(spark, sf_dir).select("key", translate.anchor(F.col("translation"), F.col("translation_qa")).alias("anchor"))


_NORM = f"lower(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '{WS}', '', 'g'))"


@query(f"""with refs as (select item_id as ref, {_NORM} as norm from benchmark union all select 1000000000 + doc_id, {_NORM} from documents where source = 'src1')
select d.doc_id, min(r.ref) as ref, count(r.ref) as n from (select doc_id, {_NORM} as norm from documents) d left join refs r using (norm) group by 1""")
def references_lookup(spark, sf_dir):
    norm = F.lower(T.collapse(F.col("text"))).alias("norm")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ref"), norm)
    refs = items.unionByName(documents(spark, sf_dir).filter("source = 'src1'").select((F.col("doc_id") + 1000000000).alias("ref"), norm))
    return reports.references_of(documents(spark, sf_dir).select("doc_id", norm), refs, "doc_id", "norm", "ref")


# --- search, samples ----------------------------------------------------------------------------


@query("select doc_id from documents where contains(lower(text), 'license') or contains(lower(source), 'license')")
def search_substring(spark, sf_dir):
    return documents(spark, sf_dir).filter(reports.contains(["text", "source"], "License")).select("doc_id")


@query("select doc_id from documents where (contains(lower(text), 'tion') and not contains(lower(text), 'the')) or contains(lower(text), 'of the')")
def search_boolean(spark, sf_dir):
    return documents(spark, sf_dir).filter(reports.matches(["text"], '(tion NOT the) OR "of the"')).select("doc_id")


@query("select doc_id from documents where list_contains(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), 'avec')")
def search_tokens(spark, sf_dir):
    return documents(spark, sf_dir).filter(reports.has_token("text", "Avec")).select("doc_id")


@query("select doc_id from documents where starts_with(source, 'src1')")
def prefix_filter(spark, sf_dir):
    return documents(spark, sf_dir).filter(F.startswith("source", F.lit("src1"))).select("doc_id")


@query("""with r as (select doc_id, source, row_number() over (partition by source order by doc_id) - 1 as r, count(*) over (partition by source) as n from documents)
select doc_id, source from r where n <= 7 or r in (select (i * n) // 7 from range(7) as t(i))""")
def systematic_sample(spark, sf_dir):
    return reports.systematic_sample(documents(spark, sf_dir).select("doc_id", "source"), ["source"], "doc_id", 7, 100)


@query("select conv_id, turn, coalesce(role <> lag(role) over (partition by conv_id order by turn), true) as changed from conversations")
def change_marks(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", reports.change_marks(rows, ["conv_id"], ["turn"], "role").alias("changed"))


_FORMS = "forms as (select * from (values ('tion', 'tion', 'WORD', 0), ('ion', 'tion', 'WORD', 0), ('th', 'the', 'ART', 1), ('the', 'the', 'ART', 1)) t(form, canonical, label, gaz_index))"


def known_forms(spark):
    entries = spark.createDataFrame([(0, "tion", "WORD", ["ion"]), (1, "the", "ART", ["th"])], "gaz_index int, surface string, type string, aliases array<string>")
    return gazetteer.forms(entries)


#: None of the forms overlaps itself, so the pieces between its places tell them.
_PLACES = f"""{_FORMS}, pieces as (select doc_id, form, label, unnest(range(len(a))) as k, unnest(a) as piece from (select doc_id, form, label, string_split(text, form) as a from documents, forms)),
places as (select doc_id, form, label, k, cast(sum(length(piece)) over (partition by doc_id, form order by k) + k * length(form) as bigint) as start, max(k) over (partition by doc_id, form) as last from pieces)"""


@query(f"""with {_PLACES} select doc_id, cast(start as int) as start, cast(start + length(form) as int) as "end", form, label from places where k < last""")
def entity_spans(spark, sf_dir):
    return gazetteer.find_entities(documents(spark, sf_dir), "doc_id", "text", known_forms(spark)).select("doc_id", "start", "end", "form", "label")


@query(f"with {_PLACES} select doc_id, label, count(*) as n from places where k < last and form in ('the', 'tion') group by 1, 2")
def entity_dedup(spark, sf_dir):
    forms = known_forms(spark).filter("form in ('the', 'tion')")
    found = gazetteer.find_entities(documents(spark, sf_dir), "doc_id", "text", forms.union(forms.withColumn("gaz_index", F.lit(7))))
    return gazetteer.dedupe(found, "doc_id").groupBy("doc_id", "label").agg(F.count("*").alias("n"))


# --- web, e-texts, files ------------------------------------------------------------------------


@query("""select page_id, regexp_extract(url, 'example\\.com/([^/]+)/book/([^/]+)(?:/d/doc([0-9]+)\\.html)?', 1) as section, regexp_extract(url, 'example\\.com/([^/]+)/book/([^/]+)(?:/d/doc([0-9]+)\\.html)?', 2) as book,
try_cast(regexp_extract(url, 'example\\.com/([^/]+)/book/([^/]+)(?:/d/doc([0-9]+)\\.html)?', 3) as int) as book_doc
from (select page_id, regexp_replace(url, '/([a-z][a-z])/([0-9]+).*$', '/\\1/book/b' || (page_id % 9) || case when page_id % 4 = 0 then '' else '/d/doc' || page_id || '.html' end) as url from pages) where regexp_matches(url, 'example\\.com/([^/]+)/book/')""")
def url_parse(spark, sf_dir):
    tail = F.expr("concat('/$1/book/b', page_id % 9, case when page_id % 4 = 0 then '' else concat('/d/doc', page_id, '.html') end)")
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", F.lit("/([a-z][a-z])/([0-9]+).*$"), tail).alias("url"))
    return web.scan_archive(pages, "example.com").select("page_id", "section", "book", "book_doc")


@query("select host as book, count(*) as n_pages, min_by(lang, url) as section from (select url, regexp_extract(url, '://([^/]+)/([a-z]+)/', 1) as host, regexp_extract(url, '://([^/]+)/([a-z]+)/', 2) as lang from pages) group by 1")
def books(spark, sf_dir):
    part = lambda k: F.regexp_extract("url", "://([^/]+)/([a-z]+)/", k)
    return web.books(table(spark, sf_dir, "pages").select("url", part(1).alias("book"), part(2).alias("section")))


@query("select page_id, regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g') as heading from pages")
def html_headings(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(F.get(web.headings(F.col("html")), F.lit(0)), F.lit("")).alias("heading"))


@query("select page_id, url from pages where contains(lower(url || ' ' || html), 'blog.') order by url, page_id limit 30")
def archive_search(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.filter(F.contains(F.lower(F.concat_ws(" ", "url", "html")), F.lit("blog."))).orderBy("url", "page_id").limit(30).select("page_id", "url")


@query("""with l as (select c_custkey % 997 as c, c_custkey // 997 % 100 as v, c_custkey, c_name from customer where c_custkey % 7 > 0),
p as (select c, dense_rank() over (order by c) as page_no from (select distinct c from l))
select cast(c as int) as chapter, cast(v as int) as verse, count(*) as padas, string_agg(c_name, chr(10) order by c_custkey) as text, cast(any_value(page_no) as int) as page_no from l join p using (c) group by c, v""")
def etext_verses(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.concat(F.lit("01,"), F.lpad(F.expr("c_custkey % 997").cast("string"), 3, "0"), F.lit("."), F.lpad(F.expr("c_custkey div 997 % 100").cast("string"), 3, "0"), F.when(k % 7 == 0, "*0001").otherwise("a"), F.lit(" <b>"), F.col("c_name"), F.lit("</b>"))
    lines = table(spark, sf_dir, "customer").select(k.alias("pos"), raw.alias("value"))
    return files.etext_verses(files.etext_lines(lines, 1)).select("chapter", "verse", "padas", "text", "page_no")


@query("""with n as (select 'd' || (o_custkey % 500) as doc, cast(o_orderkey // 3 % 10000 as int) as page, o_orderkey % 3 as k from orders)
select distinct doc, page from n where k < 2 and not exists (select 1 from n m where m.doc = n.doc and m.page = n.page and m.k = 2)""")
def missing_scans(spark, sf_dir):
    name = F.expr("concat('d', o_custkey % 500, '_', lpad(o_orderkey div 3 % 10000, 4, '0'), case when o_orderkey % 3 = 2 then case when o_orderkey % 2 = 0 then '_norm.jsonl' else '.jsonl' end else '.pdf' end)")
    return files.missing_scans(table(spark, sf_dir, "orders").select(name.alias("name"), F.lit(1).alias("length")))


@query("select doc_id, case doc_id % 3 when 0 then cast(doc_id as int) when 1 then 1 else cast(doc_id as int) end as page_no from documents")
def page_numbers(spark, sf_dir):
    name = F.expr("case doc_id % 3 when 0 then concat('doc_', lpad(doc_id, 8, '0')) when 1 then 'doc' else concat('doc_', lpad(doc_id, 8, '0'), '_norm') end")
    return documents(spark, sf_dir).select("doc_id", files.page_from_name(name).alias("page_no"))


@query("select date_trunc('hour', ts) as hour, event_type, count(*) as calls, cast(sum(cast(value as decimal(18,4))) as double) as cost from events group by 1, 2")
def stream_hourly(spark, sf_dir):
    return intake.hourly_usage(table(spark, sf_dir, "events")).withColumn("cost", F.col("cost").cast("double"))


@query("""with o as (select o_custkey, max(o_orderkey % 1000) as last from orders where o_orderkey % 2 = 0 group by 1)
select o_orderkey, n.o_custkey, cast(row_number() over (partition by n.o_custkey order by o_orderkey) - 1 + coalesce(last + 1, 0) as int) as idx
from orders n left join o on n.o_custkey = o.o_custkey where o_orderkey % 2 = 1""")
def append_index(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    old = rows.filter("o_orderkey % 2 = 0").withColumn("idx", F.col("o_orderkey") % 1000)
    return pages_in.append_index(old, rows.filter("o_orderkey % 2 = 1"), ["o_custkey"], ["o_orderkey"])


@query("""select page_id, cast(row_number() over (partition by page_id % 9 order by page_id // 9 > 0, page_id) as int) as page_no from pages
where length(html) > 1500""")
def number_pages(spark, sf_dir):
    number = F.when(F.col("page_id") >= 9, F.col("page_id"))  # the first page of each book is its index
    numbered = table(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 9).alias("book"), number.alias("n"), F.length("html").alias("size"))
    return pages_in.number_pages(numbered, "book", "n", F.col("size") > 1500).select("page_id", "page_no")


@query(f"with {PASSAGES} select key, page_no from passages where page_no between 2 and 5 and length(trim(text)) > 40 and coalesce(quality_score, 0) >= 0.5")
def benchmark_rows(spark, sf_dir):
    rows = pages_in.page_range(passages(spark, sf_dir), "page_no", 5, 2)
    return rows.filter(pages_in.fit_for_benchmark(F.col("text"), F.col("quality_score"))).select("key", "page_no")


from scriptorium.plans import more_queries  # noqa: E402, F401  registers the rest
