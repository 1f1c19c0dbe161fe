"""Queries over the driver's tables, each with the SQL that an independent engine answers alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import hashing, papers, remote, text
from quillmill.operators import bleu, chat, rows, segments, summaries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The white-space class of the text functions, for SQL.
WS = text.SPACES
NORM = f"trim(regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g'))"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha_mod(key: str, n: int) -> str:
    """SQL of SHA-1 modulo n by Horner's rule."""
    out = "0"
    for at in range(1, 41, 8):
        out = f"(({out}) * 4294967296 + ('0x' || substr(sha1({key}), {at}, 8))::BIGINT) % {n}"
    return out


def split_sql(key: str, validation: int = 10, test: int = 10) -> str:
    return f"CASE WHEN {sha_mod(key, 100)} < {validation} THEN 'validation' WHEN {sha_mod(key, 100)} < {validation + test} THEN 'test' ELSE 'train' END"


def at(template: str, expression: str) -> str:
    return template.replace("{0}", expression)


def values(spark: SparkSession, literal: str, columns: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {literal} AS t({columns})")


def fixture(literal: str, columns: str) -> str:
    """The same rows for the other engine."""
    return f"(VALUES {literal}) AS t({columns})"


# ---- documents: normalisation, splits, deduplication -------------------------------------------


@query(f"""WITH n AS (SELECT doc_id, {NORM} AS body FROM documents),
 u AS (SELECT min(doc_id) AS doc_id, body FROM n WHERE length(body) >= 80 GROUP BY body)
 SELECT {split_sql("doc_id::VARCHAR")} AS split, count(*) AS n_docs, sum(length(body))::BIGINT AS n_chars FROM u GROUP BY 1""")
def q_minimum_slice(spark, d):
    body = table(spark, d, "documents").select("doc_id", text.normalize(F.col("text")).alias("body")).where(F.length("body") >= 80)
    first = rows.keep_first(body, ["body"], ["doc_id"])
    return first.groupBy(hashing.split_name(F.col("doc_id").cast("string")).alias("split")).agg(F.count("*").alias("n_docs"), F.sum(F.length("body")).cast("long").alias("n_chars"))


@query(f"SELECT doc_id, {NORM} AS body, length({NORM})::INT AS n_body FROM documents")
def q_normalize(spark, d):
    body = text.normalize(F.col("text"))
    return table(spark, d, "documents").select("doc_id", body.alias("body"), F.length(body).alias("n_body"))


@query(f"SELECT doc_id, lower({NORM}) AS search_form, concat_ws(chr(10) || chr(10), nullif(trim(lang), ''), nullif({NORM}, '')) AS joined FROM documents WHERE lang = 'en'")
def q_joined_parts(spark, d):
    return table(spark, d, "documents").where("lang = 'en'").select("doc_id", text.search_form(F.col("text")).alias("search_form"), text.join_parts(F.col("lang"), F.col("text")).alias("joined"))


@query("SELECT lang, source, count(*) AS n_rows, min(length(text)) AS min_chars, max(length(text)) AS max_chars, avg(length(text)) AS mean_chars FROM documents GROUP BY 1, 2")
def q_char_stats(spark, d):
    return summaries.length_stats(table(spark, d, "documents"), F.col("text"), ["lang", "source"])


@query(f"SELECT doc_id, {split_sql('doc_id::VARCHAR')} AS split, {split_sql('doc_id::VARCHAR', 5, 5)} AS paper_split FROM documents")
def q_hash_split(spark, d):
    key = F.col("doc_id").cast("string")
    return table(spark, d, "documents").select("doc_id", hashing.split_name(key).alias("split"), hashing.split_name(key, 5, 5).alias("paper_split"))


@query(f"SELECT doc_id, {sha_mod('source', 7)} AS shard FROM documents WHERE {sha_mod('source', 7)} IN (2, 5)")
def q_shard(spark, d):
    docs = table(spark, d, "documents")
    own, either = hashing.shard(F.col("source"), F.col("doc_id").cast("string"), 7), F.lit(False)
    for k in (2, 5):
        either = either | hashing.in_shard(F.col("source"), F.col("doc_id").cast("string"), 7, k)
    return docs.where(either).select("doc_id", own.alias("shard"))


@query("SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text")
def q_dedupe_first(spark, d):
    return rows.keep_first(table(spark, d, "documents").select("doc_id", "text"), ["text"], ["doc_id"]).select("doc_id", F.md5("text").alias("text_md5"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS ordinal, printf('quickmt_train_%010d', row_number() OVER (ORDER BY doc_id) - 1) AS id FROM documents")
def q_row_index(spark, d):
    numbered = rows.with_ordinal(table(spark, d, "documents"), ["doc_id"])
    return numbered.select("doc_id", F.col("ordinal").cast("long").alias("ordinal"), F.format_string("quickmt_train_%010d", "ordinal").alias("id"))


@query("SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS ordinal FROM orders")
def q_order_ordinal(spark, d):
    numbered = rows.with_ordinal(table(spark, d, "orders").repartition(7), ["o_orderkey"])
    return numbered.select("o_orderkey", "o_totalprice", F.col("ordinal").cast("long").alias("ordinal"))


@query("SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END AS split FROM documents")
def q_offset_split(spark, d):
    return table(spark, d, "documents").select("doc_id", rows.offset_split(F.col("doc_id")).alias("split"))


USEFUL = f"(length({NORM}) >= 80 AND length(regexp_replace({NORM}, '[^A-Za-z]', '', 'g')) >= 0.45 * length({NORM}))"


@query(f"SELECT doc_id, {USEFUL} AS useful, contains(text, '$') AS has_math, ({USEFUL} OR contains(text, '$')) AS kept FROM documents")
def q_useful_text(spark, d):
    c = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.useful_english(c).alias("useful"), text.has_math(c).alias("has_math"), text.kept_paragraph(c).alias("kept"))


@query(f"SELECT doc_id, n_chars FROM documents WHERE {USEFUL} ORDER BY doc_id LIMIT 100")
def q_first_n_valid(spark, d):
    kept = table(spark, d, "documents").where(text.useful_english(F.col("text"))).select("doc_id", "n_chars")
    return rows.first_n(kept, 100, ["doc_id"])


@query(r"SELECT doc_id, len(regexp_extract_all(text, '(?s)(\$\$.*?\$\$|\$[^$\n]+?\$)', 1))::INT AS n_spans, array_to_string(regexp_extract_all(text, '(?s)(\$\$.*?\$\$|\$[^$\n]+?\$)', 1), '|') AS spans FROM documents WHERE contains(text, '$')")
def q_math_spans(spark, d):
    found = text.math_spans(F.col("text"))
    return table(spark, d, "documents").where(text.has_math(F.col("text"))).select("doc_id", F.size(found).alias("n_spans"), F.array_join(found, "|").alias("spans"))


SENTENCES = f"list_filter(list_transform(string_split(regexp_replace(text, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"


@query(f"SELECT doc_id, len({SENTENCES})::INT AS n_sentences, {SENTENCES}[1] AS first_sentence FROM documents")
def q_sentences(spark, d):
    s = text.sentences(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(s).alias("n_sentences"), F.try_element_at(s, F.lit(1)).alias("first_sentence"))


@query(f"""WITH RECURSIVE split AS MATERIALIZED (SELECT doc_id, {SENTENCES} AS ss FROM documents),
 placed(doc_id, i, chunk, size, long) AS (
  SELECT doc_id, 0, 0, 0, false FROM split
  UNION ALL
  SELECT doc_id, i + 1, chunk + (n > 400 OR long OR size > 0 AND size + n + 1 > 400)::INT, CASE WHEN n > 400 THEN 0 WHEN size > 0 AND size + n + 1 > 400 THEN n ELSE size + n + 1 END, n > 400
  FROM (SELECT placed.*, length(ss[i + 1]) AS n FROM placed JOIN split USING (doc_id) WHERE i < len(ss))),
 chunks AS (SELECT doc_id, chunk, bool_or(long) AS long, string_agg(ss[i], ' ' ORDER BY i) AS body FROM placed JOIN split USING (doc_id) WHERE i > 0 GROUP BY ALL),
 cut AS (SELECT doc_id, chunk, unnest(CASE WHEN long THEN range(0, length(body), 400) ELSE [0] END) AS start, long, body FROM chunks)
 SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY chunk, start) - 1)::INT AS place, CASE WHEN long THEN substr(body, start + 1, 400) ELSE body END AS chunk FROM cut""")
def q_pack_sentences(spark, d):
    packed = table(spark, d, "documents").select("doc_id", F.posexplode(segments.pack_sentences(F.col("text"), 400)).alias("place", "chunk"))
    return packed.select("doc_id", "place", "chunk")


@query()
def q_segments(spark, d):
    paragraphs = F.filter(F.split("text", "\n"), lambda p: F.trim(p) != "")
    section = F.array(F.struct(F.lit("1 Introduction").alias("heading"), F.lit("body").alias("kind"), paragraphs.alias("paragraphs")))
    key = F.format_string("2401.%05dv1", "doc_id")
    documents = table(spark, d, "documents").select(key.alias("arxiv_id"), papers.strip_version(key).alias("arxiv_base_id"), F.col("source").alias("title"), F.lit("https://arxiv.org/html/").alias("html_url"), F.col("n_chars").alias("cited_by_count"), F.lit(None).cast("string").alias("license"), section.alias("sections"))
    return segments.segment_documents(documents).select("id", "source", "split", "metadata.section", "metadata.paper_id")


# ---- language and validity filters on fixed rows ------------------------------------------------

PAIRS = """(1, 'A normal English sentence of some length.', '这是一个正常的中文句子。'),
 (2, '', '这是一个正常的中文句子。'), (3, 'A normal English sentence.', ''), (4, 'short one', '这'),
 (5, 'A normal English sentence.', '<think>这是一个想法</think>这是译文'), (6, 'eleven char', '这是六个汉字'),
 (7, 'twelve chars', '这是六个汉字'), (8, 'Attention is all you need here.', '注意力 attention 就是一切。'),
 (9, 'A normal English sentence.', '這是個國際會議的長篇論文。'), (10, 'A normal English sentence.', 'これは日本語の文章です。'),
 (11, 'A normal English sentence.', 'No Chinese in it at all.'), (12, 'As an AI model, I can do it.', '作为一个模型我可以。'),
 (13, 'A normal English sentence.', '我无法回答这个问题。'), (14, 'A plain sentence, in two parts.', NULL),
 (15, 'abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuv', '这是六个汉字'), (16, 'abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvx', '这是六个汉字'),
 (17, NULL, '这是一个正常的中文句子。'), (18, 'A normal English sentence.', '汉abcd'), (19, 'A normal English sentence.', '汉字abcdefgh')"""
TALK = "regexp_matches({0}, '(?i)<\\s*/?\\s*think\\s*>|\\b(as an ai|i cannot|i can''t|i am unable)\\b|作为\\s*(一个)?\\s*ai|我是\\s*(一个)?\\s*ai|我无法')"
NORM_OF = "trim(regexp_replace(coalesce({0}, ''), '" + WS + "+', ' ', 'g'))"
HAN_SHARE = "CASE WHEN length({0}) = 0 THEN 0.0 ELSE length(regexp_replace({0}, '[^\\x{4e00}-\\x{9fff}]', '', 'g')) / length({0}) END"
SCRIPTS = "regexp_matches({0}, '" + text.OTHER_SCRIPTS + "')"
#: For the fixed rows; the query itself uses the rule-made set.
SOME_TRADITIONAL = "這個際會議長論語"
S_, T_ = at(NORM_OF, "source"), at(NORM_OF, "target")


@query(f"SELECT id, {at(TALK, S_)} AS source_talk, {at(TALK, T_)} AS target_talk FROM {fixture(PAIRS, 'id, source, target')}")
def q_self_talk(spark, d):
    return values(spark, PAIRS, "id, source, target").select("id", text.self_talk(text.normalize(F.col("source"))).alias("source_talk"), text.self_talk(text.normalize(F.col("target"))).alias("target_talk"))


@query(f"SELECT id, ({at(HAN_SHARE, T_)})::DOUBLE AS han_ratio, {at(SCRIPTS, T_)} AS other_script, regexp_matches({T_}, '[{SOME_TRADITIONAL}]') AS traditional FROM {fixture(PAIRS, 'id, source, target')}")
def q_script_filters(spark, d):
    t = text.normalize(F.col("target"))
    return values(spark, PAIRS, "id, source, target").select("id", text.han_ratio(t).cast("double").alias("han_ratio"), text.other_script(t).alias("other_script"), text.traditional(t).alias("traditional"))


@query(f"""SELECT id FROM {fixture(PAIRS, 'id, source, target')} WHERE length({S_}) >= 12 AND length({T_}) >= 6 AND NOT {at(TALK, S_)} AND NOT {at(TALK, T_)}
 AND {at(HAN_SHARE, T_)} >= 0.2 AND NOT {at(SCRIPTS, T_)} AND NOT regexp_matches({T_}, '[{SOME_TRADITIONAL}]')
 AND greatest(length({S_}), length({T_})) <= 8.0 * least(length({S_}), length({T_}))""")
def q_pair_valid(spark, d):
    return values(spark, PAIRS, "id, source, target").where(text.valid_pair(F.col("source"), F.col("target"))).select("id")


CITED = r"""(1, 'Alpha [12] beta (Smith et al., 2020) gamma.'), (2, 'As in [key2020x, other2021y] and [3, 4-7] we see .'), (3, 'See Table 2 and Figure 3.1: the   result ; fine'),
 (4, 'Nothing to cut here'), (5, '(Jones and Miller, 2019a) start [abc12]'), (6, 'fig. 4 and FIGURE 10 shown , too')"""
CLEAN_SQL = "t"
for _p in text.CITATIONS:
    CLEAN_SQL = f"regexp_replace({CLEAN_SQL}, '{_p.replace(chr(39), chr(39) * 2)}', '', 'g')"
CLEAN_SQL = f"regexp_replace(regexp_replace(regexp_replace({CLEAN_SQL}, '{text.FLOAT_MENTION}', '', 'gi'), '{WS}+([.,;:?!])', '\\1', 'g'), '{WS}+', ' ', 'g')"


@query(f"SELECT id, {CLEAN_SQL} AS cleaned FROM {fixture(CITED, 'id, t')}")
def q_strip_citations(spark, d):
    return values(spark, CITED, "id, t").select("id", text.clean_prose(F.col("t")).alias("cleaned"))


HEADS = "(1, '3.1 Related Work'), (2, 'A. Appendix'), (3, 'References'), (4, 'Abstract'), (5, '1 Introduction and Aims'), (6, 'Acknowledgements'), (7, '5 Conclusions'), (8, '***'), (9, 'B Supplementary Material'), (10, '参考文献')"
BARE = f"lower(regexp_replace(trim(h), '{text.HEADING_NUMBER}', ''))"
NAME = f"regexp_replace(lower(trim(h)), '{text.SECTION_NUMBER}', '')"


@query(f"""SELECT id, ({BARE} IN ('references', 'bibliography', '参考文献') OR regexp_matches({BARE}, '^(acknowledgment|acknowledgement|appendix|supplementary)')) AS dropped,
 CASE WHEN contains({NAME}, 'abstract') THEN 'abstract' WHEN contains({NAME}, 'introduction') THEN 'introduction' WHEN contains({NAME}, 'conclusion') THEN 'conclusion'
 ELSE coalesce(nullif(trim(regexp_replace({NAME}, '[^a-z0-9]+', '_', 'g'), '_'), ''), 'body') END AS name FROM {fixture(HEADS, 'id, h')}""")
def q_headings(spark, d):
    return values(spark, HEADS, "id, h").select("id", text.dropped_heading(F.col("h")).alias("dropped"), text.section_name(F.col("h")).alias("name"))


@query(r"SELECT p_partkey, replace(replace(replace(replace(p_name || '_{' || p_brand || '}', '_', '\_'), '{', '\{'), '}', '\}'), '#', '\#') AS escaped FROM part")
def q_latex_escape(spark, d):
    return table(spark, d, "part").select("p_partkey", text.latex_escape(F.concat("p_name", F.lit("_{"), "p_brand", F.lit("}"))).alias("escaped"))


USERS = "(1, 'kept', 'Ask this:' || chr(10) || chr(10) || 'unused'), (2, '', 'Ask this:' || chr(10) || chr(10) || 'first' || chr(10) || chr(10) || 'second'), (3, NULL, 'no blank line'), (4, NULL, NULL)"


@query(f"SELECT id, CASE WHEN coalesce(s, '') <> '' THEN s WHEN position(chr(10) || chr(10) IN coalesce(m, '')) > 0 THEN substr(m, position(chr(10) || chr(10) IN m) + 2) ELSE coalesce(m, '') END AS body FROM {fixture(USERS, 'id, s, m')}")
def q_user_text(spark, d):
    return values(spark, USERS, "id, s, m").select("id", text.user_text(F.col("s"), F.col("m")).alias("body"))


# ---- identifiers and bibliographic records -------------------------------------------------------

URLS = "(1, 'https://arxiv.org/abs/2401.00001v2'), (2, 'http://arxiv.org/pdf/2401.00002v11.pdf'), (3, 'https://arxiv.org/html/2401.00003/'), (4, 'https://example.org/x'), (5, 'https://arxiv.org/abs/cs/0112017'), (6, 'https://arxiv.org/pdf/2401.00004?x=1'), (7, NULL), (8, '')"
FOUND = r"nullif(regexp_extract(u, 'arxiv\.org/(abs|pdf|html)/([^?#/]+)', 2), '')"
CLEAN_ID = rf"regexp_replace(regexp_replace({FOUND}, '\.pdf$', ''), '/+$', '')"


@query(rf"SELECT id, {CLEAN_ID} AS arxiv_id, regexp_replace({CLEAN_ID}, 'v\d+$', '') AS base_id, coalesce(try_cast(nullif(regexp_extract({CLEAN_ID}, 'v(\d+)$', 1), '') AS BIGINT), 0) AS version FROM {fixture(URLS, 'id, u')}")
def q_arxiv_ids(spark, d):
    found = papers.arxiv_id_from_url(F.col("u"))
    return values(spark, URLS, "id, u").select("id", found.alias("arxiv_id"), papers.strip_version(found).alias("base_id"), papers.version_number(found).alias("version"))


@query(r"""WITH v AS (SELECT 'p' || user_id || 'v' || (event_id % 4) AS arxiv_id, 'p' || user_id AS base_id, event_id % 4 AS version, event_id FROM events)
 SELECT arxiv_id, base_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY version DESC, event_id) AS k FROM v) WHERE k = 1""")
def q_latest_version(spark, d):
    arxiv_id = F.concat(F.lit("p"), "user_id", F.lit("v"), F.col("event_id") % 4)
    versions = table(spark, d, "events").select(arxiv_id.alias("arxiv_id"), papers.strip_version(arxiv_id).alias("base_id"), "event_id", papers.version_number(arxiv_id).alias("version"), (-F.col("event_id")).alias("early"))
    return rows.keep_last(versions, ["base_id"], ["version", "early"]).select("arxiv_id", "base_id", "event_id")


WORKS = [
    '{"id":"w1","title":"One","cited_by_count":30,"publication_date":"2023-05-01","ids":{"arxiv":"arXiv:2301.00001"},"open_access":{"oa_url":"https://arxiv.org/pdf/2301.00009v3"},"primary_topic":{"display_name":"Nets","field":{"id":"https://openalex.org/fields/17"}},"topics":[{"display_name":"Nets","field":{"id":"fields/17"}},{"display_name":"Graphs","field":{"id":"fields/17"}}],"locations":[],"primary_location":{"license":"cc-by"}}',
    '{"id":"w2","display_name":"Two","cited_by_count":21,"ids":{"arxiv":"2302.00002v1"},"open_access":{},"primary_topic":{"display_name":"Vision","field":{"id":"fields/22"}},"topics":[{"display_name":"","field":{"id":"https://openalex.org/fields/17"}}],"locations":[{"landing_page_url":"https://example.org","pdf_url":"https://arxiv.org/pdf/2302.00022v2.pdf"}]}',
    '{"id":"w3","title":"Three","cited_by_count":20,"ids":{"arxiv":"2303.00003"},"primary_topic":{"display_name":null,"field":{"id":"fields/17"}},"topics":[]}',
    '{"id":"w4","title":"","display_name":"Four","cited_by_count":99,"ids":{},"primary_topic":{"display_name":"Nets","field":{"id":"fields/17"}}}',
    '{"id":"w5","title":"Five","cited_by_count":50,"ids":{"arxiv":"2305.00005"},"primary_topic":{"display_name":"Law","field":{"id":"fields/33"}}}',
]
WORK = "struct<id:string,title:string,display_name:string,publication_date:string,cited_by_count:bigint,doi:string,ids:struct<arxiv:string>,open_access:struct<oa_url:string>,locations:array<struct<landing_page_url:string,pdf_url:string>>,primary_location:struct<license:string>,primary_topic:struct<display_name:string,field:struct<id:string,display_name:string>>,topics:array<struct<display_name:string,field:struct<id:string,display_name:string>>>>"


@query("""SELECT * FROM (VALUES ('2301.00009v3', '2301.00009', 'One', 30::BIGINT, 'openalex:Nets|openalex:Graphs', 'cc-by', true), ('2302.00022v2', '2302.00022', 'Two', 21::BIGINT, 'openalex:Vision', NULL, true),
 ('2303.00003', '2303.00003', 'Three', 20::BIGINT, 'openalex:computer_science', NULL, false), (NULL, NULL, 'Four', 99::BIGINT, 'openalex:Nets', NULL, false), ('2305.00005', '2305.00005', 'Five', 50::BIGINT, 'openalex:Law', NULL, false)) AS t(arxiv_id, arxiv_base_id, title, cited_by_count, categories, license, accepted)""")
def q_openalex_works(spark, d):
    works = spark.createDataFrame([(w,) for w in WORKS], "raw string").select(F.from_json("raw", WORK).alias("w"))
    record, accepted = papers.work_candidate(F.col("w"))
    return works.select(record.alias("r"), accepted.alias("accepted")).select("r.arxiv_id", "r.arxiv_base_id", "r.title", "r.cited_by_count", F.array_join("r.categories", "|").alias("categories"), "r.license", "accepted")


# ---- joins ---------------------------------------------------------------------------------------


@query(f"SELECT d.doc_id, l.quality, l.toxic, concat_ws(chr(10) || chr(10), nullif(trim(d.source), ''), nullif(trim(regexp_replace(coalesce(d.text, ''), '{WS}+', ' ', 'g')), '')) AS source FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def q_join_bilingual(spark, d):
    labels = table(spark, d, "labels")
    docs = table(spark, d, "documents").join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "source", "text")
    pairs = rows.checked_join(docs, labels, "doc_id")
    return pairs.select("left.doc_id", "right.quality", "right.toxic", text.join_parts(F.col("left.source"), F.col("left.text")).alias("source"))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 200")
def q_pending(spark, d):
    todo = rows.pending(table(spark, d, "documents").select("doc_id", "n_chars"), table(spark, d, "labels"), ["doc_id"])
    return rows.first_n(todo, 200, ["doc_id"])


@query("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)")
def q_seen_candidates(spark, d):
    seen = table(spark, d, "customer").where("c_nationkey < 10").select(F.col("c_custkey").alias("user_id"))
    return rows.pending(table(spark, d, "events").select("user_id").distinct(), seen, ["user_id"])


EFFORTS = ["none", "low", "medium", "high"]


@query("SELECT n.n_nationkey, e.effort FROM nation n CROSS JOIN (VALUES ('none'), ('low'), ('medium'), ('high')) AS e(effort) WHERE NOT (n.n_regionkey = 1 AND e.effort = 'low')")
def q_cross_pending(spark, d):
    nation = table(spark, d, "nation")
    wanted = nation.select("n_nationkey", F.explode(F.array(*map(F.lit, EFFORTS))).alias("effort"))
    done = nation.where("n_regionkey = 1").select("n_nationkey", F.lit("low").alias("effort"))
    return rows.pending(wanted, done, ["n_nationkey", "effort"])


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderpriority = '1-URGENT')::INT DESC, o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1""")
def q_best_match(spark, d):
    found = rows.best_match(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority"), "o_custkey", F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"), "o_orderkey")
    return found.select("o_custkey", "o_orderkey", "o_totalprice")


# ---- chat records --------------------------------------------------------------------------------


@query(f"SELECT c.conv_id, len(list(c.turn))::INT AS n_messages, CASE WHEN len(list(c.turn)) <> 3 THEN 'three messages are needed' WHEN list(c.role ORDER BY c.turn) <> ['system', 'user', 'assistant'] THEN 'roles must be system, user, assistant' WHEN bool_or(trim(coalesce(c.text, '')) = '') THEN 'a message is empty' WHEN bool_or({at(TALK, 'coalesce(c.text, chr(32))')}) THEN 'self-talk in a message' END AS error FROM conversations c GROUP BY c.conv_id")
def q_sft_validate(spark, d):
    return _validated(spark, d).select("conv_id", F.size("messages").alias("n_messages"), "error")


def _validated(spark, d):
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("t"))
    records = turns.select("conv_id", F.col("conv_id").cast("string").alias("id"), F.lit("general").alias("domain"), rows.offset_split(F.col("conv_id")).alias("split"), F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
    return chat.validate(records)


@query(f"WITH v AS (SELECT conv_id, len(list(turn)) <> 3 OR list(role ORDER BY turn) <> ['system', 'user', 'assistant'] OR bool_or(trim(coalesce(text, '')) = '') OR bool_or({at(TALK, 'coalesce(text, chr(32))')}) AS bad FROM conversations GROUP BY conv_id) SELECT CASE conv_id % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END AS split, count(*) AS n_records, count(*) FILTER (bad) AS n_errors FROM v GROUP BY 1")
def q_validate_counts(spark, d):
    return chat.count_by_file(_validated(spark, d), "split")


@query("SELECT doc_id, 3 AS n_messages, '" + chat.USER_PREFIX.replace("\n", "' || chr(10) || '") + "' || text AS user_content, source AS answer, '{\"source_dataset\":\"' || source || '\",\"score\":null}' AS metadata FROM documents")
def q_sft_build(spark, d):
    examples = table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("id"), F.lit("general").alias("domain"), F.lit("train").alias("split"), F.to_json(F.struct(F.col("source").alias("source_dataset"), F.lit(None).cast("double").alias("score")), {"ignoreNullFields": "false"}).alias("metadata"), F.col("text").alias("source"), F.col("source").alias("target"))
    built = chat.build_records(examples)
    return built.select(F.col("id").cast("long").alias("doc_id"), F.size("messages").alias("n_messages"), F.col("messages")[1]["content"].alias("user_content"), F.col("messages")[2]["content"].alias("answer"), "metadata")


# ---- profiles and reports ------------------------------------------------------------------------


@query("""SELECT 'lang' AS field, coalesce(lang, 'None') AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'source', coalesce(source, 'None'), count(*) FROM documents GROUP BY 2""")
def q_profile(spark, d):
    return summaries.value_counts(table(spark, d, "documents"), ["lang", "source"])


@query("SELECT lang, count(DISTINCT nullif(source, '')) AS n_sources FROM documents GROUP BY lang")
def q_distinct_sources(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.count_distinct(F.nullif(F.col("source"), F.lit(""))).alias("n_sources"))


@query("""WITH l AS (SELECT lang, list(n_chars ORDER BY n_chars) AS x FROM documents GROUP BY lang)
 SELECT lang, len(x) AS n, list_avg(x) AS mean, x[len(x) // 2 + 1] AS upper_median, x[(len(x) * 9) // 10 + 1] AS p90, x[len(x)] AS largest FROM l""")
def q_upper_median_p90(spark, d):
    return summaries.rank_stats(table(spark, d, "documents"), "n_chars", ["lang"])


@query("SELECT l_returnflag, min(l_quantity) AS least, median(l_quantity) AS middle, avg(l_quantity) AS mean, max(l_quantity) AS most FROM lineitem GROUP BY l_returnflag")
def q_median(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.min("l_quantity").alias("least"), F.median("l_quantity").alias("middle"), F.avg("l_quantity").alias("mean"), F.max("l_quantity").alias("most"))


@query("SELECT replace(source, 'src', '') AS category, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, category LIMIT 10")
def q_topk(spark, d):
    return summaries.top_k(table(spark, d, "documents"), F.replace(F.col("source"), F.lit("src"), F.lit("")), 10, "category")


@query("SELECT substr(o_orderdate::VARCHAR, 1, 4) AS year, count(*) AS n FROM orders GROUP BY 1")
def q_years(spark, d):
    return summaries.per_year(table(spark, d, "orders"), F.col("o_orderdate"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def q_keep_last(spark, d):
    return rows.keep_last(table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("SELECT o_orderkey, o_totalprice / 3600 AS hours, CASE WHEN o_orderstatus = 'O' AND o_orderkey <= 1000 THEN 'open early' WHEN o_orderstatus = 'F' AND o_orderkey > 1000 THEN 'filled late' END AS series FROM orders WHERE o_totalprice IS NOT NULL AND ((o_orderstatus = 'O' AND o_orderkey <= 1000) OR (o_orderstatus = 'F' AND o_orderkey > 1000))")
def q_series(spark, d):
    series = F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") <= 1000), "open early").when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") > 1000), "filled late")
    kept = table(spark, d, "orders").where(F.col("o_totalprice").isNotNull())
    return kept.select("o_orderkey", (F.col("o_totalprice") / 3600).alias("hours"), series.alias("series")).where("series is not null")


@query("SELECT DISTINCT ON (lang) lang, doc_id FROM documents WHERE length(text) > 200 ORDER BY lang, doc_id")
def q_examples(spark, d):
    long = table(spark, d, "documents").where(F.length("text") > 200).select("lang", "doc_id")
    return rows.keep_first(long, ["lang"], ["doc_id"])


@query("SELECT list(doc_id ORDER BY doc_id)[1:10]::VARCHAR AS first_ids FROM documents")
def q_first_ids(spark, d):
    ten = rows.first_n(table(spark, d, "documents").select("doc_id"), 10, ["doc_id"])
    return ten.agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("doc_id")), ", "), F.lit("]")).alias("first_ids"))


@query("SELECT count(*) FILTER (event_type = 'click') AS n_click, count(*) FILTER (event_type = 'view') AS n_view, count(*) AS n_all FROM events")
def q_run_summary(spark, d):
    return summaries.run_summary(table(spark, d, "events"), F.col("event_type"), ["click", "view"])


@query("SELECT 0 AS part, c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT 1, s_suppkey, s_acctbal, NULL FROM supplier")
def q_union_parts(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return rows.combine([customers, suppliers]).select("part", "id", "balance", "segment")


@query("SELECT n_nationkey, 'model-' || n_regionkey AS shard FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey % 3 = 0)")
def q_missing_shards(spark, d):
    wanted = table(spark, d, "nation").select("n_nationkey", F.concat(F.lit("model-"), "n_regionkey").alias("shard"))
    there = table(spark, d, "customer").where("c_nationkey % 3 = 0").select(F.col("c_nationkey").alias("n_nationkey"))
    return rows.pending(wanted, there, ["n_nationkey"])


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'de')")
def q_category_filter(spark, d):
    return table(spark, d, "documents").where(F.coalesce(F.col("lang").isin("en", "de"), F.lit(False))).select("doc_id")


# ---- remote calls --------------------------------------------------------------------------------

CALLS = "(1, 429, false, '3', 1), (2, 500, false, NULL, 2), (3, 404, false, 'soon', 3), (4, 406, false, '-1', 4), (5, 400, false, '0.5', 1), (6, NULL, true, NULL, 2), (7, NULL, false, NULL, 3), (8, 503, false, '10', 4)"


@query(f"SELECT id, CASE WHEN status IN (404, 406) THEN 'permanent' WHEN status = 429 OR status >= 500 THEN 'retryable' WHEN status IS NOT NULL THEN 'fatal' WHEN timed_out THEN 'retryable' ELSE 'fatal' END AS class, greatest(0, coalesce(try_cast(header AS DOUBLE), 0)) AS wait, 2.0::DOUBLE * pow(2, attempt - 1) AS pause FROM {fixture(CALLS, 'id, status, timed_out, header, attempt')}")
def q_classify_errors(spark, d):
    calls = values(spark, CALLS, "id, status, timed_out, header, attempt")
    return calls.select("id", remote.classify_error(F.col("status"), F.col("timed_out")).alias("class"), remote.retry_after(F.col("header")).alias("wait"), remote.backoff(F.lit(2.0), F.col("attempt")).alias("pause"))


RESPONSES = ['{"output_text":" direct "}', '{"output":[{"content":[{"type":"t","text":"one"},{"type":"t","text":" "}]},{"content":[{"type":"t","text":"two "}]}]}', '{"output":[]}', '{"output":[{"content":null}]}', '{"output":[{"content":" as a string"},{"content":[{"text":"and a part"}]}]}', '{"output":[{"content":"[1] cited"}]}']


@query("SELECT * FROM (VALUES (0, 'direct'), (1, 'one' || chr(10) || 'two'), (2, NULL), (3, NULL), (4, 'as a string' || chr(10) || 'and a part'), (5, '[1] cited')) AS t(id, body)")
def q_response_text(spark, d):
    raw = spark.createDataFrame(list(enumerate(RESPONSES)), "id int, raw string").withColumn("r", F.from_json("raw", remote.RESPONSE))
    return raw.select("id", remote.response_text(F.col("r")).alias("body"))


# ---- pages ---------------------------------------------------------------------------------------


def removed_sql(group: str, opening: str) -> str:
    return f"'{group}=' || len(regexp_extract_all(html, '(?i){opening}'))"


#: Elements that the cleaner takes out, by what opens them; the table has none inside another.
REMOVED = {"captions": r"<figcaption[\s>]", "citations": 'href="#bib', "figures": r"<(?:figure|img)[\s/>]", "math": r"<math[\s>]", "references": 'id="bib', "scripts": r"<(?:script|style|noscript)[\s>]", "tables": r"<table[\s>]"}


@query(f"""WITH heads AS (SELECT page_id, html, replace(replace(replace(regexp_replace(coalesce(nullif(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), ''), regexp_extract(html, '(?s)<title>(.*?)</title>', 1)), '&amp;?', '&', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"') AS h FROM pages),
 pieces AS (SELECT *, string_split(regexp_replace(h, '(?s){text.MATH_SPAN}', chr(1), 'g'), chr(1)) AS prose, regexp_extract_all(h, '(?s){text.MATH_SPAN}', 1) AS spans FROM heads)
 SELECT page_id, trim(array_to_string(list_transform(list_zip(list_transform(prose, lambda t: {CLEAN_SQL}), spans), lambda z: z[1] || coalesce(z[2], '')), '')) AS title,
 len(regexp_extract_all(html, '(?i)<section[\\s>]'))::INT AS n_sections, array_to_string([{", ".join(removed_sql(g, o) for g, o in REMOVED.items())}], ',') AS removed FROM pieces""")
def q_html_documents(spark, d):
    from quillmill.operators.html import clean_html

    pages = table(spark, d, "pages").select("page_id", clean_html(F.col("html")).alias("doc"))
    return pages.select("page_id", "doc.title", F.size("doc.sections").alias("n_sections"), F.array_join(F.transform(F.array_sort(F.map_entries("doc.removed_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("removed"))


@query(r"SELECT page_id, len(regexp_extract_all(html, '(?i)<(script|style|noscript)[\s>]'))::INT AS n_scripts FROM pages")
def q_html_scripts(spark, d):
    from quillmill.operators.html import clean_html

    return table(spark, d, "pages").select("page_id", clean_html(F.col("html"))["removed_counts"]["scripts"].alias("n_scripts"))


# ---- scores --------------------------------------------------------------------------------------


def _pairs(spark, d):
    """Each benchmark text beside the document of the same number, and beside itself."""
    items = table(spark, d, "benchmark").select("item_id", F.col("text").alias("reference"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), F.col("text").alias("prediction"))
    return items.join(docs, "item_id").select("item_id", "prediction", "reference").unionByName(items.select((-F.col("item_id") - 1).alias("item_id"), F.col("reference").alias("prediction"), "reference"))


def bleu_sql(key: str, rest: str) -> str:
    """BLEU by the value of ``key``, 0 for all pairs together; ``rest`` is what else is selected of its pairs."""
    out = f"regexp_replace(trim(coalesce(x, '')), '{bleu.CJK}', ' \\1 ', 'g')"
    for pattern, new in ((r"([{-~\[-` -&(-+:-@/])", r" \1 "), ("([^0-9])([.,])", r"\1 \2 "), ("([.,])([^0-9])", r" \1 \2"), ("([0-9])(-)", r"\1 \2 ")):
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
    words = f"list_filter(string_split_regex({out}, '\\s+'), lambda t: t <> '')"
    grams = "SELECT k, n, unnest(list_transform(range(1, len({0}) - n + 2), lambda i: array_to_string({0}[i:i + n - 1], ' '))) AS g, {1} AS side FROM split, range(1, 5) AS o(n)"
    return f"""WITH pairs AS MATERIALIZED (SELECT b.item_id, d.text AS p, b.text AS r FROM benchmark b JOIN documents d ON d.doc_id = b.item_id UNION ALL SELECT -item_id - 1, text, text FROM benchmark),
 split AS MATERIALIZED (SELECT row_number() OVER () AS k, item_id, length(p) AS p_chars, length(r) AS r_chars, list_transform([p, r], lambda x: {words}) AS sides, sides[1] AS pw, sides[2] AS rw FROM pairs),
 met AS (SELECT k, n, sum(least(mine, theirs)) AS m FROM (SELECT k, n, g, sum(side) AS mine, sum(1 - side) AS theirs FROM ({grams.format("pw", 1)} UNION ALL {grams.format("rw", 0)}) GROUP BY ALL) GROUP BY ALL),
 sums AS (SELECT {key} AS key, n, sum(coalesce(m, 0)) AS m, sum(greatest(len(pw) - n + 1, 0)) AS total, sum(len(pw))::BIGINT AS sys_len, sum(len(rw))::BIGINT AS ref_len, count(*) AS n_pairs, min(p_chars / greatest(r_chars, 1)) AS length_ratio FROM split CROSS JOIN range(1, 5) AS o(n) LEFT JOIN met USING (k, n) GROUP BY ALL),
 logs AS (SELECT *, ln(CASE WHEN m = 0 THEN 100.0 / (2 ** sum((m = 0 AND total > 0)::INT) OVER (PARTITION BY key ORDER BY n) * greatest(total, 1)) ELSE 100.0 * m / greatest(total, 1) END) AS log FROM sums)
 SELECT {rest}, CASE WHEN sys_len > 0 AND min(total) > 0 AND max(m) > 0 THEN CASE WHEN sys_len < ref_len THEN exp(1 - ref_len / sys_len) ELSE 1 END * exp(sum(log ORDER BY n) / 4) ELSE 0 END AS bleu FROM logs GROUP BY key, sys_len, ref_len, n_pairs, length_ratio"""


@query(bleu_sql("item_id", "key AS item_id, length_ratio"))
def q_bleu_rows(spark, d):
    return bleu.sentence_bleu(_pairs(spark, d)).select("item_id", "bleu", "length_ratio")


@query(bleu_sql("0", "n_pairs, sys_len, ref_len"))
def q_bleu_corpus(spark, d):
    return bleu.corpus_bleu(_pairs(spark, d))


@query("SELECT item_id, length(text) / greatest(length(text), 1) AS length_ratio, len(string_split(trim(regexp_replace(regexp_replace(text, '([.,!?;:])', ' \\1 ', 'g'), '\\s+', ' ', 'g')), ' '))::BIGINT AS n_tokens FROM benchmark")
def q_bleu_tokens(spark, d):
    return table(spark, d, "benchmark").select("item_id", (F.length("text") / F.greatest(F.length("text"), F.lit(1))).alias("length_ratio"), F.size(bleu.tokens(F.col("text"))).cast("long").alias("n_tokens"))


# ---- streams -------------------------------------------------------------------------------------


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events, sum(value) AS sum_value FROM events GROUP BY 1, 2")
def q_event_windows(spark, d):
    from quillmill.streaming.resume import windowed_counts

    return windowed_counts(table(spark, d, "events"))


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def q_stream_resume(spark, d):
    """A stream over the events table into a sink that keeps one row for each user."""
    import uuid

    from quillmill.sources.durable import checkpoint_dir
    from quillmill.sources.files import stream_source
    from quillmill.streaming.resume import collect

    at = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(stream_source(spark, f"{d}/events.parquet"))
    collect(stream.select("user_id", "event_id"), f"{at}/out", f"{at}/checkpoint", "user_id", ["event_id"]).awaitTermination()
    return spark.read.parquet(f"{at}/out").select("user_id", "event_id")
