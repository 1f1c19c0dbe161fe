"""Operators on small cases of their own."""

import json
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillmill.functions import hashing, plain, text
from quillmill.operators import bleu, chat, html, rows, segments, summaries
from quillmill.plans import stages
from quillmill.sources import files, paged


def column(spark, values, kind="string"):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")


def test_normalize_knows_all_white_space(spark):
    odd = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8202, 8232, 8233, 8239, 8287, 12288]))
    values = [f"{odd}a{odd}b{odd}", None, "", "plain", "​x​"]
    got = [r[0] for r in column(spark, values).orderBy("k").select(text.normalize(F.col("v"))).collect()]
    assert got == ["a b", "", "", "plain", "​x​"] == [" ".join((v or "").split()) for v in values]


def test_hash_split_is_the_big_number_modulo(spark):
    import hashlib

    keys = [f"2401.{k:05d}" for k in range(200)]
    for n in (7, 100, 1000):
        got = [r[0] for r in column(spark, keys).orderBy("k").select(hashing.sha1_mod(F.col("v"), n)).collect()]
        assert got == [int(hashlib.sha1(x.encode()).hexdigest(), 16) % n for x in keys]
    with pytest.raises(ValueError):
        hashing.sha1_mod(F.lit("x"), 0)
    with pytest.raises(ValueError):
        hashing.in_shard(F.lit(None), F.lit("x"), 3, 3)


def test_traditional_rule(spark):
    got = [r[0] for r in column(spark, ["简体中文句子", "繁體中文", "國", "兹", None]).orderBy("k").select(text.traditional(F.col("v"))).collect()]
    assert got == [False, True, False, True, False]


def test_first_and_last_copies(spark):
    df = spark.createDataFrame([(k, k % 3, chr(97 + k)) for k in range(9)] + [(20, None, "z"), (21, None, "y")], "at int, key int, v string")
    assert sorted((r.at, r.v) for r in rows.keep_first(df, ["key"], ["at"]).collect()) == [(0, "a"), (1, "b"), (2, "c"), (20, "z")]
    assert sorted(r.at for r in rows.keep_last(df, ["key"], ["at"]).collect()) == [6, 7, 8, 21]
    numbered = rows.with_ordinal(df, ["at"]).collect()
    assert [r.ordinal for r in sorted(numbered, key=lambda r: r.at)] == list(range(11))


def test_checked_join_fails_on_strangers(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    good = rows.checked_join(a, spark.createDataFrame([(2, "p"), (1, "q")], "id int, b string"), "id").collect()
    assert sorted((r.left.a, r.right.b) for r in good) == [("x", "q"), ("y", "p")]
    with pytest.raises(Exception, match="one to one"):
        rows.checked_join(a, spark.createDataFrame([(1, "q"), (3, "r")], "id int, b string"), "id").collect()


def fold(text_, limit):
    """Sentence packing restated: sizes count a space after all pieces but one that follows a flush."""
    out, held, size = [], [], 0
    for s in [x.strip() for x in re.split(r"(?<=[.!?])\s+", text_) if x.strip()]:
        if len(s) > limit:
            out += ([" ".join(held)] if held else []) + [s[k : k + limit] for k in range(0, len(s), limit)]
            held, size = [], 0
        elif held and size + len(s) + 1 > limit:
            out.append(" ".join(held))
            held, size = [s], len(s)
        else:
            held.append(s)
            size += len(s) + 1
    return out + ([" ".join(held)] if held else [])


def test_sentence_packing_native_and_plain(spark):
    import random

    rng = random.Random(1)
    texts = [" ".join("w" * rng.randint(1, 30) + rng.choice(["", ".", "!", "? "]) for _ in range(rng.randint(0, 80))) for _ in range(60)] + ["", "x" * 95, "a. " + "y" * 41 + ". b."]
    got = [r[0] for r in column(spark, texts).orderBy("k").select(segments.pack_sentences(F.col("v"), 40)).collect()]
    want = [fold(t, 40) for t in texts]
    assert got == want and [segments.split_prose(t, 40) for t in texts] == want


def test_mathematics_is_never_cut():
    formula = "$$" + "x + " * 35 + "$$"
    paragraph = "Word after word. " * 7 + formula + " Another sentence here." * 5
    chunks = segments.split_long(segments.fenced(paragraph), 100)
    assert all(c.count("$$") in (0, 2) for c in chunks) and formula in chunks
    assert all(len(c) <= 100 for c in chunks if "$$" not in c)
    assert segments.fenced("a  $$x$$ b $y$ c") == "a\n\n$$x$$\n\nb $y$ c"


def test_paragraph_packing():
    pack = segments.pack_paragraphs
    assert pack(["a" * 500, "b" * 700], 180, 1400, 1800, False) == ["a" * 500 + "\n\n" + "b" * 700]
    assert pack(["a" * 700, "b" * 699], 180, 1400, 1800, False) == ["a" * 700, "b" * 699]
    assert pack(["a" * 100], 180, 1400, 1800, False) == [] and pack(["a" * 100], 180, 1400, 1800, True) == ["a" * 100]
    assert [len(c) for c in pack(["a" * 90, "b" * 1801], 180, 1400, 1800, False)] == [90, 1800]


PAGE = """<html><head><title>Short title</title><script>var x = "<p>no</p>";</script></head><body><h1 class="ltx_title">A <b>Study</b> of Things</h1>
<div class="ltx_abstract"><p>We study things that matter in this short abstract <cite class="ltx_cite">[1]</cite>.</p></div>
<section><h2>1 Introduction</h2><p>First paragraph with <math alttext="x^2"><mi>x</mi></math> inside and a citation [12] as well (Smith et al., 2020), see <a href="#S4.T1">Table 1</a> and <a href="#S2">Section 2</a>.
<p>Second paragraph is left open and has quite enough letters in it to be kept by the filter of useful text.<br>More of it.
<div class="ltx_equation"><span class="ltx_Math" alttext="E=mc^2"></span></div>
<section><h3>1.1 Nested</h3><p>The nested paragraph also has quite enough letters in it to be kept by the filter of useful text, truly.</p></section>
<figure><img src="a.png"><figcaption>Figure 1: a caption</figcaption></figure><table><tr><td>cell</td></tr></table></section>
<section><h2>References</h2><p>Some reference that has quite enough letters in it to be kept by the filter of useful text, but is not.</p></section></body></html>"""


def test_page_cleaning(spark):
    doc = column(spark, [PAGE, None, "<p>a<br><p>b"]).orderBy("k").select(html.clean_html(F.col("v")).alias("d")).collect()
    page = doc[0].d
    assert page.title == "A Study of Things" and doc[1].d is None and doc[2].d.sections == []
    assert [(s.heading, s.kind) for s in page.sections] == [("Abstract", "abstract"), ("1 Introduction", "body"), ("1.1 Nested", "body")]
    intro = page.sections[1].paragraphs
    assert "$x^2$" in intro[0] and "[12]" not in intro[0] and "Smith" not in intro[0] and "Section 2" in intro[0] and "Table 1" not in intro[0]
    assert any("$$E=mc^2$$" in p for p in intro) and not any("nested" in p for p in intro)
    assert page.removed_counts == {"math": 2, "citations": 2, "tables": 1, "figures": 2, "captions": 0, "references": 0, "scripts": 1}


def test_pages_with_very_many_removed_elements():
    page = html.clean_page("<section><h2>1 Aims</h2><p>" + "<img>word " * 20_000 + "<table><tr><td><img></td></tr></table></section>")
    assert page["removed_counts"]["figures"] == 20_000 and page["removed_counts"]["tables"] == 1
    assert [s["paragraphs"] for s in page["sections"]] == [[" ".join(["word"] * 20_000)]]


def test_plain_text_cleaner():
    assert plain.clean_text("Alpha [12] beta $x+y$ and $$L=x^2$$.") == "Alpha beta $x+y$ and $$L=x^2$$."
    assert plain.clean_text("A &amp;lt; b [key2020x, other2021y] , c") == "A &lt; b, c"
    assert plain.section_name("3.1 Related Work") == "related_work" and plain.section_name("***") == "body"


def test_segments_of_documents(spark):
    section = [("Abstract", "abstract", ["a" * 100]), ("1 Introduction", "body", ["b" * 500, "c" * 700, "d" * 900])]
    schema = "arxiv_id string, arxiv_base_id string, title string, html_url string, cited_by_count long, license string, sections array<struct<heading: string, kind: string, paragraphs: array<string>>>"
    got = segments.segment_documents(spark.createDataFrame([("2401.1v2", "2401.1", "T", "u", 3, None, section)], schema)).collect()
    assert [r.id for r in got] == ["2401.1v2_abstract_0001", "2401.1v2_introduction_0002", "2401.1v2_introduction_0003"]
    assert {r.split for r in got} <= {"train", "validation", "test"} and got[0].metadata.paper_id == "2401.1v2"


def message(*contents, roles=("system", "user", "assistant")):
    return [{"role": r, "content": c} for r, c in zip(roles, contents)]


def test_chat_records(spark):
    schema = "id string, domain string, split string, messages array<struct<role: string, content: string>>"
    cases = [("1", "d", "train", message("s", "u", "a")), ("2", "d", "train", message("s", "u", "<think>x</think>")), ("3", "d", "train", message("s", "u")), ("4", "d", "train", message("s", "a", "u", roles=("system", "assistant", "user"))), ("5", "d", "train", message("s", " ", "a")), ("6", None, "train", message("s", "u", "a"))]
    errors = [r.error for r in chat.validate(spark.createDataFrame(cases, schema)).orderBy("id").collect()]
    assert errors == [None, "self-talk in a message", "three messages are needed", "roles must be system, user, assistant", "a message is empty", "missing fields: domain"]
    assert chat.validate(spark.createDataFrame([("1",)], "id string")).first().error.startswith("missing fields: domain")
    seg = spark.createDataFrame([("a", "text", "cs", "train", ("arxiv",))], "id string, source string, domain string, split string, metadata struct<source_dataset: string>")
    made = chat.teacher_records(seg, F.lit(" 译文 "), "model-x").first()
    assert made.metadata.teacher_model == "model-x" and made.messages[2].content == "译文" == made.target


def test_bleu(spark):
    same = spark.createDataFrame([("注意力 attention 就是一切，真的。", "注意力 attention 就是一切，真的。"), ("一二三四五", "一二三四六"), ("", "一二")], "prediction string, reference string")
    got = [r.bleu for r in bleu.sentence_bleu(same).collect()]
    assert got[0] > 99 and abs(got[1] - 100 * (4 / 5 * 3 / 4 * 2 / 3 * 1 / 2) ** 0.25) < 1e-9 and got[2] == 0
    total = bleu.corpus_bleu(same.limit(1)).first()
    assert total.bleu > 99 and total.n_pairs == 1
    assert bleu.corpus_bleu(same.limit(0)).first().bleu == 0


def test_rank_stats(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4)] + [("b", 7), ("b", None)], "g string, v int")
    got = {r.g: (r.n, r.mean, r.upper_median, r.p90, r.largest) for r in summaries.rank_stats(df, "v", ["g"]).collect()}
    assert got == {"a": (4, 2.5, 3, 4, 4), "b": (1, 7.0, 7, 7, 7)}
    assert summaries.latex_table(df.where("g = 'b' and v = 7")).count("\\\\") >= 2 and summaries.markdown_table(df.limit(1)).startswith("| g | v |")


def test_file_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"1","metadata":{"a":1}}\n\n{"id":\n{"id":"3","metadata":{"b":"x","c":null}}\n', encoding="utf-8")
    numbered = files.read_jsonl_numbered(spark, f"{tmp_path}/a.jsonl", "id string").orderBy("line").collect()
    assert [(r.line, r.record.id if r.record else None) for r in numbered] == [(1, "1"), (3, None), (4, "3")]
    assert files.read_jsonl(spark, f"{tmp_path}/none.jsonl", "id string", missing_ok=True).count() == 0
    with pytest.raises(Exception):
        files.read_jsonl(spark, f"{tmp_path}/a.jsonl", "id string, metadata string").collect()
    files.write_jsonl(spark.createDataFrame([("1", None, "train"), ("2", "é", "test")], "id string, v string, split string"), f"{tmp_path}/out", by=["split"])
    lines = [json.loads(x) for f in (tmp_path / "out/split=train").glob("*.json") for x in f.read_text().splitlines()]
    assert lines == [{"id": "1", "v": None}]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/2401.1.html").write_text("<p>x")
    assert [(r.page_key, r.html) for r in files.read_pages(spark, f"{tmp_path}/pages").collect()] == [("2401.1", "<p>x")]
    assert files.shard_paths(["b", "a", "c"], 2) == ["a", "b"]


def test_atom_feed_and_retries():
    feed = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><entry><id>http://arxiv.org/abs/2401.1v2</id><title>A
    title</title><published>2024</published><category term="cs.AI"/><category/><link title="pdf" href="p"/><arxiv:license>cc</arxiv:license></entry><entry><id/></entry></feed>"""
    assert paged.parse_feed(feed) == [("http://arxiv.org/abs/2401.1v2", "A title", "2024", None, "", ["cs.AI"], "p", "cc")]
    waits, calls = [], iter([paged.RemoteError(429, 0.0), paged.RemoteError(None), "ok"])

    def call():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert paged.with_retries(call, sleep=waits.append) == "ok" and waits == [5.0, 10.0]
    with pytest.raises(paged.RemoteError):
        paged.with_retries(lambda: (_ for _ in ()).throw(paged.RemoteError(404)), sleep=waits.append)


ABSTRACT = "doc_id string, title string, abstract string, keywords array<string>, category string, category_eng string, discipline string, discipline_eng string"


def test_stage_one(spark):
    raw = spark.createDataFrame([(k, "A normal English sentence.", "这是一个正常的中文句子。" if k % 2 else "no", 0.5) for k in range(6)] + [(9, "Another normal sentence.", "这是另一个正常的句子。", None)], "at long, en string, zh string, sco double")
    got = stages.general_examples(raw, "at", "train").orderBy("at").collect()
    assert [r.id for r in got] == ["quickmt_train_0000000001", "quickmt_train_0000000009"]
    assert got[0].metadata.asDict() == {"source_dataset": "quickmt", "score": 0.5, "paper_id": None, "section": None}
    target = ("标题一二三四", "摘要的内容在这里。")
    native = [("b", *target, ["词"], "工学", "Engineering", "d", "D"), ("a", "太短", "", None, "工学", None, None, None), ("c", *target, None, "文学", None, None, None), ("a", *target, None, "理学", "", None, None), ("a", "另外一个标题", "另外一个摘要的内容。", None, "理学", None, None, None)]
    english = [(i, f"Title {k}", "An abstract of some length.", None, "Eng", None, "Phys", None) for k, (i, *_) in enumerate(native)]
    sides = [spark.createDataFrame([(*r, k) for k, r in enumerate(x)], f"{ABSTRACT}, position long").repartition(3) for x in (native, english)]
    made = {r.id: r for s in ("train", "validation", "test") for r in stages.abstract_examples(*sides, s).collect()}
    assert set(made) == {"a", "b"} and made["b"].source == "Title 0\n\nAn abstract of some length." and made["b"].metadata.keywords_en == []
    assert made["a"].at == 3 and made["a"].metadata.category_eng == "Eng" and made["a"].metadata.discipline_eng == "Phys" and made["a"].metadata.section == "title_abstract"
    with pytest.raises(Exception, match="at place 1"):
        rows.positional_pairs(sides[0], sides[1].replace("a", "x", ["doc_id"]).where("position <> 4").union(sides[1].where("position = 4")), "position", "doc_id").where("position = 1").collect()
    with pytest.raises(Exception, match="at place 4"):
        rows.positional_pairs(sides[0], sides[1].where("position < 4"), "position", "doc_id").collect()
    held = spark.createDataFrame([(k, f"A normal English sentence {k}.", "这是一个正常的中文句子。", 0.5) for k in range(40)], "at long, en string, zh string, sco double")
    assert sorted((r.split, r.at) for r in stages.evaluation_examples(held, "at", {"validation": 3, "test": 2}).collect()) == [("test", 1), ("test", 11), ("validation", 0), ("validation", 10), ("validation", 20)]
    assert stages.training_set([stages.general_examples(raw, "at", "train"), stages.abstract_examples(*sides, made["a"].split)]).count() >= 3


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ordinals_hold_over_partitions_of_wide_rows(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        wide = spark.range(60_000).select((F.col("id") * 7919 % 60_000).alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 40).alias("payload")).repartition(9)
        got = rows.with_ordinal(wide, ["k"], start=5)
        assert got.columns == ["k", "payload", "ordinal"]
        assert got.agg(F.count("*"), F.count_distinct("ordinal"), F.sum((F.col("ordinal") != F.col("k") + 5).cast("int"))).first() == (60_000, 60_000, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert rows.with_ordinal(wide.limit(0), ["k"]).count() == 0


def test_written_tables_leave_the_session_as_it_was(spark, monkeypatch):
    from quillmill.sources import durable

    before = [spark.conf.get(k, None) for k in durable.BATCHES]
    written = durable.materialize(spark.range(5).toDF("id"), "some")
    assert [spark.conf.get(k, None) for k in durable.BATCHES] == before and written.count() == 5
    durable.discard(written)
    assert not files.exists(spark, written.materialized_at)


def test_written_tables_leave_no_shuffle_files(spark):
    from quillmill.sources import durable

    def shuffles():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f.name for d in folders for f in Path(d).rglob("shuffle_*")}

    before = shuffles()
    counts = spark.range(50_000).groupBy((F.col("id") % 997).alias("k")).count()
    written = durable.materialize(counts, "some")
    for _ in range(50):  # they are deleted in the background
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before and written.count() == 997
    durable.discard(written)


def test_top_k_ties_and_own_lists(spark, tmp_path):
    df = spark.createDataFrame([(0, "z"), (1, "a"), (2, "a"), (3, "z"), (4, "m")], "at int, v string")
    assert [r.value for r in summaries.top_k(df, F.col("v"), 2, position="at").collect()] == ["z", "a"]
    assert [r.value for r in summaries.top_k(df, F.col("v"), 2).collect()] == ["a", "z"]
    (tmp_path / "list.txt").write_text("國 國\n們", encoding="utf-8")
    own = text.listed_characters(f"{tmp_path}/list.txt")
    got = [r[0] for r in column(spark, ["繁體", "我們", "裏面"]).orderBy("k").select(text.traditional(F.col("v"), own)).collect()]
    assert own == "國們" and got == [False, True, False]
    assert all(r[0] for r in column(spark, list("裏説綫啓僞")).select(text.traditional(F.col("v"))).collect())
